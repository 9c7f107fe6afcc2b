"""strata — a Spark-native file-to-gold analytics library.

JSON order events land as files, are ingested incrementally and exactly once
(``strata.sources.ingest``), flattened and validated against expectations
(``strata.operators.silver`` / ``strata.operators.quality``), and served as
daily gold aggregates (``strata.operators.gold``) refreshed only where new data
arrived (``strata.plans.refresh``).  Everything is DataFrames, Structured
Streaming and built-in functions: no UDFs, no custom Catalyst rules.
"""

from strata.session import get_session, state_root, new_run_dir

__all__ = ["get_session", "state_root", "new_run_dir"]
