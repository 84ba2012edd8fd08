"""DuckDB oracle SQL for the cohort queries, from the operators' definitions.

The shapes differ from the Spark plans on purpose: an entity's first row is
the one numbered 1, covered year ends are a range join to generated Dec 31
dates (from the data's own first start to its last end), cohort sizes are
keyed joins to the smallest period. Completed years and months come from
``age()``; rounded ratios use exact integer rounding, half away from zero.
"""

from cadence.plans import analogs as A

HISTORY = """history AS (
    SELECT o_custkey AS id, CAST(o_orderdate AS DATE) AS begins,
           CAST(o_orderdate AS DATE) + 730 AS ends, o_orderpriority AS label, o_orderkey AS tie
    FROM orders),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY begins, tie) AS place FROM history),
opening AS (
    SELECT id, begins AS opened, label AS opening_label FROM numbered WHERE place = 1)"""

YEAR_ENDS = """year_ends AS (
    SELECT make_date(y, 12, 31) AS closing
    FROM (SELECT unnest(range(lo, hi + 1)) AS y
          FROM (SELECT min(year(begins)) AS lo, max(year(ends)) AS hi FROM history)))"""


def whole_years(later: str, earlier: str) -> str:
    return f"date_part('year', age(CAST({later} AS TIMESTAMP), CAST({earlier} AS TIMESTAMP)))"


def whole_months(later: str, earlier: str) -> str:
    return (
        f"{whole_years(later, earlier)} * 12 + "
        f"date_part('month', age(CAST({later} AS TIMESTAMP), CAST({earlier} AS TIMESTAMP)))"
    )


def rounded(n: str, d: str, k: int) -> str:
    """round(n / d, k) for integers n >= 0, d > 0, as double."""
    p = 10**k
    return f"(CAST((2 * CAST({n} AS HUGEINT) * {p} + ({d})) // (2 * ({d})) AS DOUBLE) / {p})"


def share(counts: str, keys: list[str], size: str, pct: str, digits: int | None) -> str:
    """Counts with their cohort's size: the count at its smallest period (a null one is the largest)."""
    names = "".join(f"c.{k}, " for k in keys)
    same = "".join(f" AND z.{k} IS NOT DISTINCT FROM c.{k}" for k in keys)
    of = "".join(f"{k}, " for k in keys)
    ratio = "CAST(c.n AS DOUBLE) / z.n" if digits is None else rounded("c.n", "z.n", digits)
    group = f" GROUP BY {', '.join(keys)}" if keys else ""
    return f"""{counts},
sizes AS (SELECT {of}arg_min(n, coalesce(period, 9223372036854775807)) AS n FROM counts{group})
SELECT {names}c.period, z.n AS {size}, c.n AS cohort_retained, {ratio} AS {pct}
FROM counts c JOIN sizes z ON true{same}"""


def by_interval(
    keys: dict[str, str] | None = None, joined: str = "", ranged: bool = False
) -> str:
    """CTEs up to ``counts``: entities per key and completed years at the year ends their intervals cover."""
    keys = keys or {}
    picked = "".join(f"{e} AS {k}, " for k, e in keys.items())
    group = ", ".join([*keys.values(), "period"])
    where = f"\n    WHERE f.opened >= DATE '{A.COHORT_FROM}' AND f.opened <= DATE '{A.COHORT_TO}'" if ranged else ""
    return f"""WITH {HISTORY},
{YEAR_ENDS},
covered AS (
    SELECT h.id, e.closing FROM history h
    LEFT JOIN year_ends e ON e.closing >= h.begins AND e.closing <= h.ends),
counts AS (
    SELECT {picked}coalesce({whole_years('v.closing', 'f.opened')}, 0) AS period, count(DISTINCT f.id) AS n
    FROM covered v JOIN opening f USING (id){joined}{where}
    GROUP BY {group})"""


def plain_counts(keys: list[str]) -> str:
    names = "".join(f"{k}, " for k in keys)
    return f"\nSELECT {names}period, n AS cohort_retained FROM counts"


def since_first(source: str, period: str) -> str:
    """Entities per period of (who, moment) rows since each one's first moment."""
    return f"""WITH seen AS ({source}),
since AS (SELECT who, moment, min(moment) OVER (PARTITION BY who) AS start FROM seen WHERE who IS NOT NULL)
SELECT {period} AS period, count(DISTINCT who) AS retained FROM since GROUP BY 1 ORDER BY 1"""


_ORDER_DAYS = "SELECT o_custkey AS who, CAST(o_orderdate AS DATE) AS moment FROM orders"
_EVENT_DAYS = "SELECT user_id AS who, CAST(ts AS DATE) AS moment FROM events"
_EVENT_TIMES = "SELECT user_id AS who, ts AS moment FROM events"

_EVENTS = f"""WITH {HISTORY},
counts AS (
    SELECT {whole_years('h.begins', 'f.opened')} AS period, count(DISTINCT h.id) AS n
    FROM history h JOIN opening f USING (id) GROUP BY 1)"""

_CURVE = share(_EVENTS, [], "cohort_size", "pct_retained", 2)
_CELLS = ", ".join(f"max(pct_retained) FILTER (period = {p}) AS yr_{p}" for p in A.PIVOT_PERIODS)

_SEGMENT = {"gender": "s.c_mktsegment"}
_JOIN_SEGMENT = " JOIN customer s ON s.c_custkey = f.id"
_FIRST_YEAR = {"first_year": "CAST(year(f.opened) AS BIGINT)"}
_FIRST_CENTURY = {"first_century": "CAST(century(f.opened) AS BIGINT)"}
_FIRST_LABEL = {"first_state": "f.opening_label"}
_BY_SEGMENT = ("cohort_size_by_gender", "pct_retained_by_gender")

SQL = {
    "first_event": f"WITH {HISTORY}\nSELECT id AS id_bioguide, opened AS first_term FROM opening",
    "retention_counts": _EVENTS + plain_counts([]),
    "retention_curve": _CURVE,
    "retention_generic": since_first(_ORDER_DAYS, whole_years("moment", "start")),
    "retention_events_week": since_first(_EVENT_DAYS, "CAST((moment - start) // 7 AS BIGINT)"),
    "retention_generic_month": since_first(_ORDER_DAYS, whole_months("moment", "start")),
    "retention_events_month": since_first(_EVENT_TIMES, whole_months("moment", "start")),
    "retention_events_day": since_first(_EVENT_DAYS, "CAST(moment - start AS BIGINT)"),
    "retention_pivot": f"SELECT max(cohort_size) AS cohort_size, {_CELLS} FROM ({_CURVE})",
    "interval_spine": f"""WITH {HISTORY},
{YEAR_ENDS}
SELECT h.id AS id_bioguide, f.opened AS first_term, h.begins AS term_start, h.ends AS term_end, e.closing AS date,
       {whole_years('e.closing', 'f.opened')} AS period
FROM history h JOIN opening f USING (id)
LEFT JOIN year_ends e ON e.closing >= h.begins AND e.closing <= h.ends""",
    "interval_retention_counts": by_interval() + plain_counts([]),
    "interval_retention_curve": share(by_interval(), [], "cohort_size", "pct_retained", 4),
    "retention_counts_by_year": by_interval(_FIRST_YEAR) + plain_counts(["first_year"]),
    "retention_by_year": share(by_interval(_FIRST_YEAR), ["first_year"], "cohort_size", "pct_retained", None),
    "retention_by_century": share(by_interval(_FIRST_CENTURY), ["first_century"], "cohort_size", "pct_retained", 4),
    "first_attribute": f"""WITH {HISTORY}
SELECT id AS id_bioguide, opened AS first_term, opening_label AS first_state FROM opening""",
    "retention_by_first_attribute": share(
        by_interval(_FIRST_LABEL), ["first_state"], "cohort_size_by_state", "pct_retained_by_state", None
    ),
    "retention_by_dimension": share(by_interval(_SEGMENT, _JOIN_SEGMENT), ["gender"], *_BY_SEGMENT, None),
    "retention_by_dimension_range": share(
        by_interval(_SEGMENT, _JOIN_SEGMENT, ranged=True), ["gender"], *_BY_SEGMENT, None
    ),
    "retention_sparse_multi": share(
        by_interval(_FIRST_LABEL | _SEGMENT, _JOIN_SEGMENT, ranged=True),
        ["first_state", "gender"],
        "cohort_size",
        "pct_retained",
        None,
    ),
}
