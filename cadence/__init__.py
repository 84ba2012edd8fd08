"""cadence: cohort-retention and time-series operators on Spark DataFrames.

Every operator takes DataFrames plus column names and returns a lazy
DataFrame built only from Catalyst expressions (no Python UDFs), so the
whole plan runs distributed and is optimised by Catalyst/AQE.

Sub-packages
------------
sources    explicit-schema readers: the driver's tables (with adapters onto the
           canonical shapes) and the canonical tables themselves
functions  column-expression helpers (calendar arithmetic, exact rounding,
           ordering) and the same helpers as Spark SQL functions
operators  cohort, series, rolling and growth operators; hot-key splitting
plans      view registration, plan inspection, the registered query set
streaming  intentionally empty: the analyses have no streaming operator
"""

from cadence.session import build_session, cluster_conf

__all__ = ["build_session", "cluster_conf"]
