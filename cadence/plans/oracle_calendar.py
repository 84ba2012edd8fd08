"""DuckDB oracle SQL for the calendar queries: literal ``BETWEEN`` range joins,
window frames by interval, and ``age()``."""

from cadence.plans import analogs as A
from cadence.plans import oracle_cohort, oracle_series
from cadence.plans.oracle_cohort import whole_months, whole_years

TERMS = """terms AS (
    SELECT o_custkey AS id, o_orderkey AS term, CAST(o_orderdate AS DATE) AS begins, CAST(o_orderdate AS DATE) + 730 AS ends
    FROM orders),
opening AS (SELECT id, min(begins) AS opened FROM terms GROUP BY id)"""

DAYS = f"""days AS (
    SELECT CAST(x AS DATE) AS day
    FROM generate_series(DATE '{A.CALENDAR_FROM}', DATE '{A.CALENDAR_TO}', INTERVAL 1 DAY) AS g(x))"""


def _retention(chosen: str, units) -> str:
    return f"""WITH {TERMS}, {DAYS},
    calendar AS (SELECT day FROM days WHERE {chosen})
SELECT CAST(coalesce({units('c.day', 'o.opened')}, 0) AS BIGINT) AS period, count(DISTINCT t.id) AS cohort_retained
FROM terms t JOIN opening o USING (id) LEFT JOIN calendar c ON c.day BETWEEN t.begins AND t.ends
GROUP BY 1"""


ORDERS = """o AS (
    SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS day,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS amount
    FROM orders)"""

DAY_SPINE = f"""spine AS (
    SELECT CAST(x AS DATE) AS date
    FROM generate_series(DATE '{A.DAY_SPINE_FROM}', DATE '{A.DAY_SPINE_TO}', INTERVAL 1 DAY) AS g(x))"""

TRAILING = """CAST(sum(o.amount) AS BIGINT) AS order_sum, count(o.amount) AS order_count,
       CAST(sum(o.amount) AS DOUBLE) / count(o.amount) AS order_mean"""


SQL = {
    "retention_kept_up": f"""WITH {TERMS}
SELECT CAST({whole_years('t.begins', 'o.opened')} AS BIGINT) AS period, count(DISTINCT t.id) AS cohort_retained
FROM terms t JOIN opening o USING (id) GROUP BY 1""",
    "interval_retention_kept_up": f"""WITH {TERMS}, {DAYS}
SELECT CAST(year(o.opened) AS BIGINT) AS first_year, CAST(coalesce({whole_years('d.day', 'o.opened')}, 0) AS BIGINT) AS period,
       count(DISTINCT t.id) AS cohort_retained
FROM terms t JOIN opening o USING (id)
LEFT JOIN days d ON d.day BETWEEN t.begins AND t.ends AND month(d.day) = 12 AND day(d.day) = 31 GROUP BY 1, 2""",
    "retention_rolled_up": f"""WITH {TERMS}
SELECT CAST(year(o.opened) AS BIGINT) AS first_year, CAST({whole_years('t.begins', 'o.opened')} AS BIGINT) AS period,
       count(DISTINCT t.id) AS cohort_retained
FROM terms t JOIN opening o USING (id) GROUP BY 1, 2""",
    "trailing_year_by_day": f"""WITH {ORDERS}, {DAY_SPINE}
SELECT s.date, {TRAILING}
FROM spine s LEFT JOIN o ON o.day BETWEEN s.date - 364 AND s.date GROUP BY s.date""",
    "trailing_months_by_day_and_segment": f"""WITH {ORDERS}, {DAY_SPINE},
    v AS (SELECT o.*, c.c_mktsegment FROM o JOIN customer c ON c.c_custkey = o.o_custkey),
    segments AS (SELECT DISTINCT c_mktsegment FROM v)
SELECT g.c_mktsegment, s.date, {TRAILING}
FROM spine s CROSS JOIN segments g LEFT JOIN v o
  ON o.c_mktsegment = g.c_mktsegment AND o.day BETWEEN CAST(s.date - INTERVAL 11 MONTH AS DATE) AND s.date
GROUP BY g.c_mktsegment, s.date""",
    "moving_average_of_orders": f"""WITH {ORDERS}
SELECT o_orderkey, day, CAST(sum(amount) OVER w AS DOUBLE) / count(amount) OVER w AS moving_mean,
       count(amount) OVER w AS records
FROM o WINDOW w AS (ORDER BY day, o_orderkey ROWS BETWEEN 499 PRECEDING AND CURRENT ROW)""",
    "previous_order_of_customer": f"""WITH {ORDERS}, n AS (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY day, o_orderkey) AS place FROM o)
SELECT n.o_custkey, n.o_orderkey, n.day, p.day AS previous_day, p.amount AS previous_amount, n.amount - p.amount AS diff
FROM n LEFT JOIN n p ON p.o_custkey = n.o_custkey AND p.place = n.place - 1""",
    "orders_to_date": f"""WITH {ORDERS}
SELECT o_orderkey, year(day) AS year, CAST(sum(amount) OVER w AS BIGINT) AS order_running_sum,
       count(amount) OVER w AS order_running_count, max(amount) OVER w AS order_running_max
FROM o WINDOW w AS (PARTITION BY year(day) ORDER BY day, o_orderkey)""",
    "retention_december_31": _retention("monthname(day) = 'December' AND day(day) = 31", whole_years),
    "retention_month_ends": _retention("day = last_day(day)", whole_months),
    "intervals_at_quarter_days": f"""WITH {TERMS}, {DAYS},
    quarters AS (
        SELECT CAST(date_trunc('quarter', day) AS DATE) AS first_day_of_quarter, min(day) AS quarter_day
        FROM days WHERE isodow(day) < 6 GROUP BY 1)
SELECT t.id AS id_bioguide, t.term AS term_id, t.begins AS term_start, t.ends AS term_end,
       q.first_day_of_quarter, q.quarter_day
FROM terms t LEFT JOIN quarters q ON q.quarter_day BETWEEN t.begins AND t.ends""",
    "open_at_opening_days": f"""WITH {TERMS},
    calendar AS (SELECT min(begins) AS day FROM terms GROUP BY year(begins), month(begins))
SELECT c.day, count(DISTINCT t.id) AS active
FROM calendar c LEFT JOIN terms t ON c.day BETWEEN t.begins AND t.ends GROUP BY c.day""",
    "purchases_after_signup": """SELECT s.user_id, s.event_id AS signup_id, count(p.event_id) AS purchases,
       CAST(sum(CAST(p.value AS DECIMAL(18,2)) * 100) AS BIGINT) AS total_cents
FROM events s LEFT JOIN events p
  ON p.event_type = 'purchase' AND p.user_id = s.user_id AND p.ts BETWEEN s.ts AND s.ts + INTERVAL 3 DAY
WHERE s.event_type = 'signup' GROUP BY s.user_id, s.event_id""",
    "membership_age": f"""WITH {TERMS},
    span AS (SELECT id, min(begins) AS first, max(ends) AS last FROM terms GROUP BY id),
    aged AS (SELECT *, age(CAST(last AS TIMESTAMP), CAST(first AS TIMESTAMP)) AS a FROM span)
SELECT id AS id_bioguide, first, last, date_part('year', a) AS years, date_part('month', a) AS months,
       date_part('day', a) AS days
FROM aged""",
    "growth_of_kept_view": oracle_series.SQL["growth_by_segment"],
    "extremes_of_kept_view": oracle_series.SQL["growth_extremes"],
    "retention_by_dimension_bucketed": oracle_cohort.SQL["retention_by_dimension"],
    "retention_from_pruned_years": f"""WITH {TERMS}, {DAYS}
SELECT CAST(coalesce({whole_years('d.day', 'o.opened')}, 0) AS BIGINT) AS period, count(DISTINCT t.id) AS cohort_retained
FROM terms t JOIN opening o USING (id)
LEFT JOIN days d ON d.day BETWEEN t.begins AND t.ends AND month(d.day) = 12 AND day(d.day) = 31
WHERE o.opened BETWEEN DATE '{A.COHORT_FROM}' AND DATE '{A.COHORT_TO}' GROUP BY 1""",
}
