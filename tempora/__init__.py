"""tempora: time-series analytics on Spark DataFrames.

Every public operator takes DataFrames and returns a DataFrame; the work
stays in Spark plans (no collect, no driver loops).  Sub-packages:

* ``sources``   - reading landed files, tables, append / upsert / DDL (A)
* ``functions`` - projections, casts, predicates and scalar columns (B, C)
* ``operators`` - joins, aggregation, series windows, forecasting (D-G)
* ``plans``     - composite data products and the registered checks (H)
* ``streaming`` - (empty) the reference has no streaming work
"""

from tempora.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
