"""DuckDB oracle SQL for the time-series queries.

Written from the operators' definitions by another route than the Spark
plans take: everything is computed on integer cents, frames and lags are
joins of numbered rows instead of window frames, trailing months are month
distances, and the spine is generated month by month. Rounding is half away
from zero on integers, because DuckDB rounds on doubles.
"""

from cadence.plans import analogs as A

a, b, one = A.LABEL_A, A.LABEL_B, A.LABEL_SINGLE
AM, BM, OM = f"{a}_monthly_sales", f"{b}_monthly_sales", f"{one}_monthly_sales"
AY, BY, OY = f"{a}_yearly_sales", f"{b}_yearly_sales", f"{one}_yearly_sales"


def money(c: str) -> str:
    """Cents as decimal(38,2)."""
    return f"CAST(CAST({c} AS DECIMAL(36,0)) * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(38,2))"


def dbl(c: str) -> str:
    return f"CAST({money(c)} AS DOUBLE)"


def rounded(n: str, d: str, digits: int = 2) -> str:
    """n / d of integers to ``digits``, half away from zero; NULL where d is 0."""
    unit = 10**digits
    size = f"(2 * abs({n}) * {unit} + abs({d})) // (2 * abs(nullif({d}, 0)))"
    return f"CAST(sign({n}) * sign({d}) * ({size}) AS DOUBLE) / {unit}"


def change(new: str, old: str) -> str:
    return rounded(f"(({new} - {old}) * 100)", old)


def share(part: str, whole: str) -> str:
    return rounded(f"({part} * 100)", f"({whole})")


def mean(total: str, n: str) -> str:
    """Mean in money of a sum of cents."""
    return rounded(total, f"(100 * {n})")


def names(*cats: str) -> str:
    return "(" + ", ".join(f"'{c}'" for c in cats) + ")"


def of(cat: str) -> str:
    return f"sum(c) FILTER (seg = '{cat}')"


YEAR = "CAST(year(m) AS BIGINT)"
CELLS = """cells AS (
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, c_mktsegment AS seg,
           sum(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS HUGEINT)) AS c
    FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY ALL)"""
PAIR = f"""{CELLS},
two AS (
    SELECT m, row_number() OVER (ORDER BY m) AS pos, {of(A.CAT_A)} AS x, {of(A.CAT_B)} AS y
    FROM cells WHERE seg IN {names(A.CAT_A, A.CAT_B)} GROUP BY m)"""
YEARS = f"""{PAIR},
annual AS (SELECT {YEAR} AS yr, sum(x) AS x, sum(y) AS y FROM two GROUP BY 1),
base AS (SELECT x AS x0, y AS y0 FROM annual WHERE yr = (SELECT min(yr) FROM annual))"""
SINGLE = f"""{CELLS},
mono AS (SELECT m, row_number() OVER (ORDER BY m) AS pos, {of(A.CAT_SINGLE)} AS v FROM cells GROUP BY m),
ranked AS (SELECT m, v, (SELECT count(*) FROM mono o WHERE month(o.m) = month(mono.m) AND o.m < mono.m) AS nth FROM mono)"""


def gathered(name: str, within: str) -> str:
    """Sums, counts and maxima over the rows q of each row p's frame."""
    return f"""{name} AS (
    SELECT p.m, sum(q.x) AS sx, count(q.x) AS nx, max(q.x) AS mx, sum(q.y) AS sy, count(q.y) AS ny, max(q.y) AS my
    FROM two p JOIN two q ON {within} GROUP BY p.m)"""


TRAIL = gathered("trail", "q.pos BETWEEN p.pos - 11 AND p.pos")
SO_FAR = gathered("so_far", "year(q.m) = year(p.m) AND q.m <= p.m")
EARLIER = "FROM ranked t LEFT JOIN ranked u ON month(u.m) = month(t.m) AND u.nth = t.nth - "
SPARSE = f"""{PAIR},
kept AS (SELECT m, x, y FROM two WHERE month(m) IN ({', '.join(map(str, A.SPARSE_MONTHS))})),
spine AS (
    SELECT CAST(range AS DATE) AS d
    FROM range(TIMESTAMP '{A.MONTH_SPINE_FROM}', TIMESTAMP '{A.MONTH_SPINE_TO}' + INTERVAL 1 DAY, INTERVAL 1 MONTH))"""
NEAR = "date_diff('month', kept.m, spine.d) BETWEEN 0 AND 11"


def _so_far(how: str) -> str:
    cols = {
        "sum": (f"{money('sx')} AS total_{a}_sales_ytd", f"{money('sy')} AS total_{b}_sales_ytd"),
        "avg": (f"{mean('sx', 'nx')} AS avg_{a}_sales_ytd", f"{mean('sy', 'ny')} AS avg_{b}_sales_ytd"),
        "max": (f"{money('mx')} AS max_{a}_sales_ytd", f"{money('my')} AS max_{b}_sales_ytd"),
    }[how]
    return f"""WITH {PAIR}, {SO_FAR}
SELECT two.m AS sales_month, {money('x')} AS {AM}, {money('y')} AS {BM}, {', '.join(cols)}
FROM two JOIN so_far ON so_far.m = two.m"""


def _by_year(*cats: str) -> str:
    return f"""WITH {CELLS}
SELECT {YEAR} AS sales_year, seg AS kind_of_business, {money('sum(c)')} AS sales
FROM cells WHERE seg IN {names(*cats)} GROUP BY ALL"""


SQL = {
    "trend": f"WITH {CELLS} SELECT m AS sales_month, {money('c')} AS sales FROM cells WHERE seg = '{A.CAT_TREND}'",
    "yearly_total": f"""WITH {CELLS}
SELECT {YEAR} AS sales_year, {money(of(A.CAT_TREND))} AS sales FROM cells GROUP BY 1 HAVING sales IS NOT NULL""",
    "yearly_by_category": _by_year(*A.CATS_THREE),
    "yearly_two_categories": _by_year(A.CAT_A, A.CAT_B),
    "compare_categories": f"""WITH {CELLS}
SELECT m AS sales_month, seg AS kind_of_business, {money('c')} AS sales FROM cells WHERE seg IN {names(A.CAT_A, A.CAT_B)}""",
    "pivot_monthly": f"WITH {PAIR} SELECT m AS sales_month, {money('x')} AS {AM}, {money('y')} AS {BM} FROM two",
    "pivot_yearly": f"WITH {YEARS} SELECT yr AS sales_year, {money('x')} AS {a}_sales, {money('y')} AS {b}_sales FROM annual",
    "yearly_gap": f"""WITH {YEARS}
SELECT yr AS sales_year, {money('x')} AS {a}_sales, {money('y')} AS {b}_sales, {money('y - x')} AS {b}_{a}_sales_diff
FROM annual""",
    "panel": f"""WITH {YEARS}, {TRAIL}, {SO_FAR}
SELECT two.m AS sales_month, {money('two.x')} AS {AM}, {money('two.y')} AS {BM},
       {money('two.y - two.x')} AS {b}_{a}_sales_diff,
       {rounded('two.y', 'two.x')} AS {b}_to_{a}_sales_ratio,
       {change('two.y', 'two.x')} AS {b}_to_{a}_pctage_diff,
       {share('two.x', 'two.x + two.y')} AS {a}_pctage_of_total,
       {share('two.y', 'two.x + two.y')} AS {b}_pctage_of_total,
       {share('two.x', 'annual.x')} AS {a}_pctage_of_yearly_sales,
       {share('two.y', 'annual.y')} AS {b}_pctage_of_yearly_sales,
       {money('so_far.sx')} AS total_{a}_sales_ytd,
       {money('so_far.sy')} AS total_{b}_sales_ytd,
       {mean('trail.sx', 'trail.nx')} AS {a}s_12_month_moving_average,
       {mean('trail.sy', 'trail.ny')} AS {b}s_12_month_moving_average
FROM two JOIN trail ON trail.m = two.m JOIN so_far ON so_far.m = two.m JOIN annual ON annual.yr = year(two.m)""",
    "index_base": f"""WITH {YEARS}
SELECT yr AS sales_year, {money('x0')} AS {a}_index_sales, {money('y0')} AS {b}_index_sales FROM annual CROSS JOIN base""",
    "index_to_base": f"""WITH {YEARS}
SELECT yr AS sales_year, {money('x')} AS {AY}, {money('y')} AS {BY},
       {money('x0')} AS {a}_index_sales, {money('y0')} AS {b}_index_sales,
       {change('x', 'x0')} AS pct_from_{a}_index, {change('y', 'y0')} AS pct_from_{b}_index,
       {rounded('y', 'x')} AS yearly_{b}_to_{a}_sales_ratio, {change('y', 'x')} AS {b}_to_{a}_yearly_pctage_diff
FROM annual CROSS JOIN base""",
    "moving_average": f"""WITH {PAIR}, {TRAIL}
SELECT m AS sales_month, {mean('sx', 'nx')} AS {a}s_12_month_moving_average, nx AS {a}s_record_count,
       {mean('sy', 'ny')} AS {b}s_12_month_moving_average, ny AS {b}s_record_count
FROM trail""",
    "sparse_trailing_rows": f"""WITH {SPARSE}
SELECT d AS date, m AS sales_month, {money('y')} AS {BM} FROM kept JOIN spine ON {NEAR}""",
    "rolling_sparse_range": f"""WITH {SPARSE}
SELECT d AS date, {dbl('sum(y)')} / nullif(count(y), 0) AS {b}_sales_moving_avg, count(y) AS records
FROM spine LEFT JOIN kept ON {NEAR} GROUP BY d""",
    "rolling_sparse_window": f"""WITH {SPARSE}
SELECT d AS full_date,
       {dbl('sum(y)')} / nullif(count(y), 0) AS {b}_sales_moving_avg, count(y) AS {b}_records_in_window,
       {dbl('sum(x)')} / nullif(count(x), 0) AS {a}_sales_moving_avg, count(x) AS {a}_records_in_window
FROM spine LEFT JOIN kept ON {NEAR} AND kept.m >= DATE '{A.MONTH_SPINE_FROM}' GROUP BY d""",
    "ytd_sum": _so_far("sum"),
    "ytd_avg": _so_far("avg"),
    "ytd_max": _so_far("max"),
    "pivot_single": f"WITH {SINGLE} SELECT m AS sales_month, {money('v')} AS {OM} FROM mono",
    "prev_month": f"""WITH {SINGLE}
SELECT t.m AS sales_month, {money('t.v')} AS {OM}, u.m AS previous_month, {money('u.v')} AS prev_month_sales
FROM mono t LEFT JOIN mono u ON u.pos + 1 = t.pos""",
    "mom_growth": f"""WITH {SINGLE}
SELECT t.m AS sales_month, {money('t.v')} AS {OM}, u.m AS previous_month, {money('u.v')} AS prev_month_sales,
       ({dbl('t.v')} / nullif({dbl('u.v')}, 0) - 1) * 100 AS pct_growth_from_previous
FROM mono t LEFT JOIN mono u ON u.pos + 1 = t.pos""",
    "yoy_growth": f"""WITH {SINGLE},
annual AS (SELECT {YEAR} AS yr, row_number() OVER (ORDER BY {YEAR}) AS pos, sum(v) AS v FROM mono GROUP BY {YEAR})
SELECT t.yr AS sales_year, {money('t.v')} AS {OY}, u.yr AS prev_year, {money('u.v')} AS prev_year_sales,
       {change('t.v', 'u.v')} AS pct_growth_from_prev_year
FROM annual t LEFT JOIN annual u ON u.pos + 1 = t.pos""",
    "same_month_last_year": f"""WITH {SINGLE}
SELECT t.m AS sales_month, {money('t.v')} AS {OM}, u.m AS prev_year_month, {money('u.v')} AS prev_years_month_sales,
       {money('t.v - u.v')} AS absolute_diff, {change('t.v', 'u.v')} AS pct_diff
{EARLIER}1""",
    "growth_extremes": f"""WITH {SINGLE}
SELECT max({change('t.v', 'u.v')}) AS max_pct_diff, min({change('t.v', 'u.v')}) AS min_pct_diff {EARLIER}1""",
    "overlay_years": f"""WITH {SINGLE}
SELECT CAST(month(m) AS BIGINT) AS month_number, rpad(monthname(min(m)), 9, ' ') AS month_name,
       {', '.join(f"{money(f'max(v) FILTER (year(m) = {y})')} AS sales_{y}" for y in A.OVERLAY_YEARS)}
FROM mono WHERE m >= DATE '{A.OVERLAY_FROM}' AND m <= DATE '{A.OVERLAY_TO}' GROUP BY month(m)""",
    "lag3_same_month": f"""WITH {SINGLE}
SELECT t.m AS sales_month, {money('t.v')} AS {OM}, {money('u.v')} AS last_3yrs_sales {EARLIER}3""",
    "pct_of_prior3": f"""WITH {SINGLE}
SELECT t.m AS sales_month, {money('any_value(t.v)')} AS {OM},
       {dbl('any_value(t.v)')} * 100 * count(u.v) / nullif({dbl('sum(u.v)')}, 0) AS pctage_of_prev_3
FROM ranked t LEFT JOIN ranked u ON month(u.m) = month(t.m) AND u.nth BETWEEN t.nth - 3 AND t.nth - 1
GROUP BY t.m""",
}

_KEYED = f"""{CELLS},
lines AS (SELECT seg, m, c, row_number() OVER (PARTITION BY seg ORDER BY m) AS pos FROM cells)"""
_PREVIOUS = "FROM lines t LEFT JOIN lines u ON u.seg = t.seg AND "
_KEEP = f"month(m) IN ({', '.join(map(str, A.SPARSE_MONTHS))})"


def _means(rows: str, within: str) -> str:
    return f"""SELECT p.seg AS kind_of_business, p.m AS sales_month,
       {mean('sum(q.c)', 'count(q.c)')} AS sales_12_month_moving_average, count(q.c) AS sales_record_count
FROM {rows} p JOIN {rows} q ON q.seg = p.seg AND {within} GROUP BY p.seg, p.m"""


SQL |= {
    "moving_average_by_segment": f"WITH {_KEYED} {_means('lines', 'q.pos BETWEEN p.pos - 11 AND p.pos')}",
    "moving_average_months_by_segment": f"""WITH {CELLS}, few AS (SELECT * FROM cells WHERE {_KEEP})
{_means("few", "date_diff('month', q.m, p.m) BETWEEN 0 AND 11")}""",
    "ytd_by_segment": f"""WITH {CELLS}
SELECT p.seg AS kind_of_business, p.m AS sales_month, {money('any_value(p.c)')} AS sales,
       {money('sum(q.c)')} AS total_segment_sales_ytd
FROM cells p JOIN cells q ON q.seg = p.seg AND year(q.m) = year(p.m) AND q.m <= p.m GROUP BY p.seg, p.m""",
    "growth_by_segment": f"""WITH {_KEYED}
SELECT t.seg AS kind_of_business, t.m AS sales_month, {money('t.c')} AS sales, u.m AS previous_month,
       {money('u.c')} AS prev_month_sales, {change('t.c', 'u.c')} AS pct_growth_from_previous
{_PREVIOUS}u.pos + 1 = t.pos""",
    "same_month_by_segment": f"""WITH {_KEYED}, nth AS (
    SELECT seg, m, c, row_number() OVER (PARTITION BY seg, month(m) ORDER BY m) AS pos FROM cells)
SELECT t.seg AS kind_of_business, t.m AS sales_month, {money('t.c')} AS sales, u.m AS prev_year_month,
       {money('u.c')} AS prev_years_month_sales, {money('t.c - u.c')} AS absolute_diff, {change('t.c', 'u.c')} AS pct_diff
FROM nth t LEFT JOIN nth u ON u.seg = t.seg AND month(u.m) = month(t.m) AND u.pos + 1 = t.pos""",
    "extremes_of_view": SQL["growth_extremes"],
    "overlay_of_view": SQL["overlay_years"],
    "rolling_sparse_lead_in": f"""WITH {SPARSE}
SELECT d AS full_date,
       {dbl('sum(y)')} / nullif(count(y), 0) AS {b}_sales_moving_avg, count(y) AS {b}_records_in_window,
       {dbl('sum(x)')} / nullif(count(x), 0) AS {a}_sales_moving_avg, count(x) AS {a}_records_in_window
FROM spine LEFT JOIN kept ON {NEAR} GROUP BY d""",
}
