"""caresight — claims and care-management reporting jobs as lazy Spark DataFrame plans.

Layout:
  sources/    table loaders, reference-shaped adapters over the test tables, sinks
  functions/  column-level helpers (T-SQL scalar semantics, code lists, parameter splitting)
  operators/  reusable DataFrame -> DataFrame operators (filters, joins, as-of/range scans,
              windows, aggregates, snapshots)
  plans/      the three report jobs (oncology cost, alert responsiveness, action completion)
  streaming/  (the reference has no streaming operators; see the module docstring)
  oracle/     DuckDB SQL used as an independent correctness oracle
"""
from caresight.session import build_session, ensure_checkpoint_dir  # noqa: F401
