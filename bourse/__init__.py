"""bourse: keyed price-series analytics on Spark DataFrames.

Layers:
  sources/    readers (symbols, bronze JSON, company map, silver, calendar)
              and fixtures derived from the TPC-H-style test tables
  operators/  bars, bronze -> silver, price-range aggregates, gold questions,
              data-quality checks
  sinks/      bronze landing, silver / gold / calendar writers
  functions/  column expressions (dates, time zones, safe arithmetic)
  plans/      the bronze -> silver -> gold job
  streaming/  incremental bronze -> silver and tick -> bar ingestion
"""

from bourse.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
