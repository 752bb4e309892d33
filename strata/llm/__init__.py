"""Operators for preparing training text at scale.  Nothing outside this folder
imports it; its queries are in :mod:`strata.llm.queries`."""
