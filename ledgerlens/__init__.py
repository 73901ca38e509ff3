"""ledgerlens: PySpark operators for large transaction ledgers.

Subpackages
-----------
sources    -- strict CSV/TSV scans, drifted Parquet unions, sinks
functions  -- column expressions (name normalisation, calendar, geohash, keys)
operators  -- DataFrame -> DataFrame operators (resolution, aggregation,
              history windows, dashboards, profiling, models)
plans      -- derived fixture tables and the registered query catalogue
streaming  -- JSON file ingest and keyed idempotent upserts
"""

from ledgerlens.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
