"""riskfabric — country-level risk analytics on Spark DataFrames.

Sub-packages:

* ``sources``   landing-file readers, source normalisers, dimension seeds and the
                fixture views that map the driver's test tables to canonical shape
* ``functions`` column-expression helpers (ids, text, dates, scoring)
* ``operators`` reusable relational building blocks (as-of join, latest-per-key,
                adjacent-period pairs, cascade / prefix lookups, upsert, dedupe)
* ``plans``     the analytic views, the composite risk score, dashboard queries
                and data-quality checks
* ``streaming`` incremental ingest with Structured Streaming
"""

from riskfabric.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
