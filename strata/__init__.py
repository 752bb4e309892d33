"""strata: a dated bronze/silver/gold table pipeline built on Spark DataFrames.

Layers
------
* ``strata.functions``  column expressions (numeric-text validity, lenient cast,
  null fill, location label, date stamp).
* ``strata.operators``  DataFrame -> DataFrame operators (keyed dedupe, group
  count, quality metrics, quarantine split, ordered report and sample).
* ``strata.sources``    table I/O: declared schemas, dated partition reads and
  rerun-safe writes, landed-page ingest with gap detection.
* ``strata.plans``      the jobs (bronze, silver, gold, end-to-end run) and the
  registered queries used by the correctness harness and the benchmark.
* ``strata.streaming``  the bronze load driven by an ``availableNow`` file
  stream, for landing folders that receive pages continuously.

Every transform is a pure function of DataFrames; only ``strata.sources``
touches storage, and nothing collects rows to the driver.
"""

__version__ = "0.1.0"
