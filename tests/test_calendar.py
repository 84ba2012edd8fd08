import datetime as dt

import pytest
from pyspark.sql import functions as F

from cadence.functions import calendar as cal
from cadence.functions import numeric as num


def _one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


D = dt.date


@pytest.mark.parametrize(
    "a,b,unit,expected",
    [
        (D(1996, 2, 29), D(1997, 2, 28), "year", 0),
        (D(1996, 2, 29), D(2000, 2, 29), "year", 4),
        (D(1996, 2, 29), D(2000, 2, 28), "year", 3),
        (D(2000, 1, 31), D(2000, 3, 30), "month", 1),
        (D(2000, 2, 29), D(2000, 3, 31), "month", 1),
        (D(2000, 1, 31), D(2000, 2, 29), "month", 0),
        (D(2024, 1, 1), D(2024, 1, 15), "week", 2),
        (D(2024, 1, 1), D(2024, 1, 14), "week", 1),
        (D(2024, 1, 1), D(2024, 1, 14), "day", 13),
        (D(2000, 6, 1), D(1999, 7, 1), "year", 0),
        (D(2001, 6, 1), D(1999, 7, 1), "year", -1),
    ],
)
def test_completed_units(spark, a, b, unit, expected):
    assert _one(spark, cal.completed_units(unit, F.lit(a), F.lit(b))) == expected


def test_completed_units_null(spark):
    assert _one(spark, cal.completed_units("year", F.lit(None).cast("date"), F.lit(D(2000, 1, 1)))) is None


@pytest.mark.parametrize("year,expected", [(1900, 19), (1901, 20), (2000, 20), (2001, 21), (1000, 10)])
def test_century(spark, year, expected):
    assert _one(spark, cal.century(F.lit(D(year, 6, 1)))) == expected


def test_padded_month_name(spark):
    assert _one(spark, cal.padded_month_name(F.lit(D(2020, 5, 1)))) == "May      "
    assert _one(spark, cal.padded_month_name(F.lit(D(2020, 9, 1)))) == "September"


def test_year_ends_within(spark):
    got = _one(spark, cal.year_ends_within(F.lit(D(1900, 3, 1)), F.lit(D(1902, 3, 1))))
    assert got == [D(1900, 12, 31), D(1901, 12, 31)]
    assert _one(spark, cal.year_ends_within(F.lit(D(1901, 1, 3)), F.lit(D(1901, 6, 30)))) == []
    assert _one(spark, cal.year_ends_within(F.lit(D(1920, 3, 4)), F.lit(D(1921, 12, 31)))) == [
        D(1920, 12, 31),
        D(1921, 12, 31),
    ]
    clipped = cal.year_ends_within(F.lit(D(1990, 1, 1)), F.lit(D(2010, 1, 1)), "1995-01-01", "1997-12-31")
    assert _one(spark, clipped) == [D(1995, 12, 31), D(1996, 12, 31), D(1997, 12, 31)]
    assert _one(spark, cal.year_ends_within(F.lit(None).cast("date"), F.lit(D(2000, 1, 1)))) is None


def test_month_helpers(spark):
    assert _one(spark, cal.months_after(F.lit(D(2001, 11, 1)), 2)) == [D(2001, 11, 1), D(2001, 12, 1), D(2002, 1, 1)]
    assert cal.shift_months("1996-01-01", -11) == "1995-02-01"


def test_exact_rounding(spark):
    assert _one(spark, num.round_div(F.lit(23), F.lit(40), 2, integral=True)) == 0.58
    pct = num.round_pct_change(F.lit(8660911.16).cast("decimal(18,2)"), F.lit(8493171.54).cast("decimal(18,2)"), 2)
    assert _one(spark, pct) == 1.97
    assert _one(spark, num.round_div(F.lit(111736347.90).cast("decimal(18,2)"), F.lit(12), 2)) == 9311362.33
    assert _one(spark, num.round_div(F.lit(-1), F.lit(8), 2, integral=True)) == -0.13
    assert _one(spark, num.round_div(F.lit(1), F.lit(0), 2, integral=True)) is None


def test_decimal_average_rounding(spark):
    df = spark.createDataFrame([(v,) for v in ["9311362.32", "9311362.33"]], "v string").select(
        F.col("v").cast("decimal(18,2)").alias("v")
    )
    assert df.agg(num.round_money(F.avg("v")).alias("m")).first()["m"] == 9311362.33


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.tuples(st.integers(min_value=-10**11, max_value=10**11), st.integers(min_value=0, max_value=4)),
        min_size=50,
        max_size=200,
    )
)
def test_cents_equal_decimal_cast(spark, pairs):
    """Whole cents from a double equal the unscaled decimal(18,2) cast,
    including half-cent ties such as 1.005 and 2.675."""
    values = [n / 10**k for n, k in pairs] + [1.005, 2.675, -0.125, 0.29, 1013.7, 499978.59]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = df.select(
        num.cents("x").alias("c"),
        (F.col("x").cast("decimal(18,2)") * 100).cast("bigint").alias("d"),
        num.from_cents(num.cents("x")).alias("back"),
        F.col("x").cast("decimal(18,2)").alias("dec"),
    ).collect()
    assert all(r["c"] == r["d"] and r["back"] == r["dec"] for r in rows)


from decimal import ROUND_HALF_UP, Decimal, getcontext  # noqa: E402

_money = st.integers(min_value=-(10**16) + 1, max_value=10**16 - 1).map(lambda c: Decimal(c).scaleb(-2))


def _q(x: Decimal, digits: int) -> float:
    return float(x.quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(_money, _money), min_size=20, max_size=80))
def test_exact_ratio_rounding_matches_decimal(spark, pairs):
    """round(n/d, 2), round((n/d - 1) * 100, 2) and round(n*100/d, 2) equal
    exact decimal arithmetic with half-up rounding, for amounts up to 1e14."""
    getcontext().prec = 60
    pairs = [(n, d) for n, d in pairs if d != 0]
    df = spark.createDataFrame([(str(n), str(d)) for n, d in pairs], "n string, d string").selectExpr(
        "cast(n as decimal(18,2)) n", "cast(d as decimal(18,2)) d"
    )
    rows = df.select(
        num.round_div("n", "d", 2).alias("r"),
        num.round_pct_change("n", "d", 2).alias("p"),
        num.round_share("n", "d", 2).alias("s"),
    ).collect()
    for (n, d), r in zip(pairs, rows):
        assert r["r"] == _q(n / d, 2)
        assert r["p"] == _q((n - d) * 100 / d, 2)
        assert r["s"] == _q(n * 100 / d, 2)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_totals_have_no_ceiling(spark, ansi):
    """Totals far above 1e16, and past a bigint of cents, stay exact through sums, ratios and shares."""
    from cadence.operators import growth, rolling, series

    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = spark.range(0, 30_000, 1, 4).select(
            F.make_date((F.col("id") % 2 + 2000).cast("int"), (F.col("id") % 3 + 1).cast("int"), F.lit(1)).alias("sales_month"),
            num.cents(F.lit(89_999_999_999_999.25) - F.col("id") % 7).alias("c"),
        )
        cents = [8_999_999_999_999_925 - i % 7 * 100 for i in range(30_000)]
        total = rows.agg(num.sum_cents("c").alias("t")).first()["t"]
        assert int(total) == sum(cents) > 2**63
        months = rows.groupBy("sales_month").agg(num.from_cents(num.sum_cents("c")).alias("sales"))
        months = months.withColumn("kind_of_business", F.lit("a")).cache()
        exact = {}
        for i, c in enumerate(cents):
            key = (2000 + i % 2, i % 3 + 1)
            exact[key] = exact.get(key, 0) + c
        want = {k: Decimal(v) / 100 for k, v in exact.items()}
        got = {(r["sales_month"].year, r["sales_month"].month): r["sales"] for r in months.collect()}
        assert got == want and min(want.values()) > Decimal(10) ** 16

        yearly = {r["sales_year"]: r["sales"] for r in series.rollup(months, "year").collect()}
        assert yearly == {y: sum(v for k, v in want.items() if k[0] == y) for y in (2000, 2001)}
        pair = series.pivot_categories(months, {"x": "a"}, "month").withColumn("y_monthly_sales", F.col("x_monthly_sales") * 3)
        panel = series.panel(pair.select("sales_month", "x_monthly_sales", F.col("y_monthly_sales").cast(num.MONEY)), "x", "y")
        for r in panel.collect():
            key = (r["sales_month"].year, r["sales_month"].month)
            assert r["x_monthly_sales"] == want[key] and r["y_x_sales_diff"] == 2 * want[key]
            assert r["y_to_x_sales_ratio"] == 3.0 and r["x_pctage_of_total"] == 25.0
            assert r["total_x_sales_ytd"] == sum(v for k, v in want.items() if k[0] == key[0] and k[1] <= key[1])
            of_year = (want[key] * 100 / yearly[key[0]]).quantize(Decimal("0.01"), ROUND_HALF_UP)
            assert r["x_pctage_of_yearly_sales"] == float(of_year)
        moved = {r["sales_month"]: r for r in rolling.moving_average(months, {"s": "sales"}, rows=2).collect()}
        order = sorted(want)
        for before, key in zip(order, order[1:]):
            mean = ((want[before] + want[key]) / 2).quantize(Decimal("0.01"), ROUND_HALF_UP)
            assert moved[dt.date(*key, 1)]["ss_2_month_moving_average"] == float(mean)
        grown = growth.same_period_last_year(months, "sales").where("prev_years_month_sales is not null").collect()
        assert len(grown) == 3
        for r in grown:
            a, b = r["sales"], r["prev_years_month_sales"]
            assert r["absolute_diff"] == a - b
            assert r["pct_diff"] == float(((a - b) * 100 / b).quantize(Decimal("0.01"), ROUND_HALF_UP))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
