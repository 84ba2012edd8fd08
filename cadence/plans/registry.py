"""All registered queries and their DuckDB oracles, keyed alike."""

from __future__ import annotations

from cadence.plans import calendar_queries, cohort_queries, oracle_calendar, oracle_cohort, oracle_series, series_queries

QUERIES = {}
QUERIES.update(cohort_queries.QUERIES)
QUERIES.update(series_queries.QUERIES)
QUERIES.update(calendar_queries.QUERIES)

ORACLE_SQL = {}
ORACLE_SQL.update(oracle_cohort.SQL)
ORACLE_SQL.update(oracle_series.SQL)
ORACLE_SQL.update(oracle_calendar.SQL)

_missing = set(ORACLE_SQL) - set(QUERIES)
assert not _missing, f"oracle without query: {_missing}"
