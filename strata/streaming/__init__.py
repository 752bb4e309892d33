"""Streaming trigger for the batch chain (file stream over the landing root)."""

from strata.streaming.landed import chain_for_new_pages, landed_dates

__all__ = ["chain_for_new_pages", "landed_dates"]
