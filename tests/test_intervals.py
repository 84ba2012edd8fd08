"""Interval joins: against literal BETWEEN on random tables, edge cases, plans."""

import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from cadence.operators import intervals as iv
from cadence.sources.date_dim import date_dim

BASE = dt.date(2000, 1, 1)


def day(n):
    return None if n is None else BASE + dt.timedelta(days=n)


def random_intervals(rng, n):
    out = []
    for i in range(n):
        a = None if rng.random() < 0.05 else rng.randint(-50, 400)
        b = None if rng.random() < 0.05 else (a or 0) + rng.choice([-3, 0, 1, 10, 40, 300])
        out.append((rng.choice(["x", "y", "z", None]), i % 40, day(a), day(b)))
    return out + out[:5]


def random_points(rng, n):
    return [
        (rng.choice(["x", "y", None]), rng.randint(0, 9), None if rng.random() < 0.05 else day(rng.randint(0, 300)))
        for _ in range(n)
    ]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same_rows(df, con, sql):
    rel = con.sql(sql)
    got = sorted(map(tuple, df.select(*rel.columns).collect()), key=str)
    assert got == sorted(rel.fetchall(), key=str)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(5)
    left, right = random_intervals(rng, 200), random_points(rng, 150)
    con = duckdb.connect()
    con.execute("CREATE TABLE l (k VARCHAR, i BIGINT, s DATE, e DATE)")
    con.executemany("INSERT INTO l VALUES (?, ?, ?, ?)", left)
    con.execute("CREATE TABLE r (k VARCHAR, v BIGINT, d DATE)")
    con.executemany("INSERT INTO r VALUES (?, ?, ?)", right)
    return (
        spark.createDataFrame(left, "k string, i long, s date, e date"),
        spark.createDataFrame(right, "k string, v long, d date"),
        con,
    )


@pytest.mark.parametrize("how", ["left", "inner"])
def test_calendar_with_gaps_and_several_rows_a_date(tables, how):
    left, right, con = tables
    joined = iv.calendar_join(left, right.drop("k"), "s", "e", "d", how)
    same_rows(joined, con, f"SELECT l.*, r.v, r.d FROM l {how} JOIN r ON r.d BETWEEN l.s AND l.e")


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("width,levels", [(1, 3), (30, 1), (7, 2), (1000, 1)])
def test_keyed_points(tables, how, width, levels):
    left, right, con = tables
    joined = iv.interval_join(left, right, "s", "e", "d", width, ["k"], how, levels)
    same_rows(joined, con, f"SELECT l.*, r.v, r.d FROM l {how} JOIN r ON r.k = l.k AND r.d BETWEEN l.s AND l.e")
    assert "NestedLoop" not in plan_of(joined) and "Cartesian" not in plan_of(joined)


def test_points_without_keys_before_the_epoch(spark):
    left = spark.range(-40, 40).select(F.col("id").alias("a"), (F.col("id") + 5).alias("b"))
    right = spark.range(-50, 50, 3).select(F.col("id").alias("p"))
    got = iv.interval_join(left, right, "a", "b", "p", 4).groupBy("a").count().collect()
    assert {r["a"]: r["count"] for r in got} == {
        a: sum(a <= p <= a + 5 for p in range(-50, 50, 3)) for a in range(-40, 40)
    }


def test_timestamps_are_compared_with_midnight(spark):
    rows = [("2000-01-01 00:00:00", "2000-01-03 00:00:00"), ("2000-01-01 00:00:01", "2000-01-02 23:59:59")]
    left = spark.createDataFrame(rows, "s string, e string").selectExpr("timestamp(s) s", "timestamp(e) e")
    got = iv.calendar_join(left, date_dim(spark, "2000-01-01", "2000-01-05").select("date"), "s", "e")
    assert sorted(r["date"].day for r in got.where("second(s) = 0").collect()) == [1, 2, 3]
    assert sorted(r["date"].day for r in got.where("second(s) = 1").collect()) == [2]


def test_empty_sides(tables, spark):
    left, right, _ = tables
    none = right.where("false")
    assert iv.calendar_join(left, none.drop("k"), "s", "e", "d").where("d is null").count() == left.count()
    assert iv.calendar_join(left, none.drop("k"), "s", "e", "d", "inner").count() == 0
    assert iv.interval_join(left, none, "s", "e", "d", 5, ["k"]).where("d is null").count() == left.count()
    assert iv.calendar_join(left.where("false"), right.drop("k"), "s", "e", "d").count() == 0
    assert iv.interval_join(left.where("false"), right, "s", "e", "d", 5, ["k"]).count() == 0


def test_arguments_are_checked(tables):
    left, right, _ = tables
    with pytest.raises(ValueError):
        iv.calendar_join(left, right, "s", "e", "d")  # column k on both sides
    with pytest.raises(ValueError):
        iv.calendar_join(left, right.drop("k"), "s", "e", "d", "full")
    with pytest.raises(ValueError):
        iv.calendar_join(left, right.select(F.col("v").alias("d")), "s", "e", "d")
    with pytest.raises(ValueError):
        iv.interval_join(left, right, "s", "e", "v", 5, ["k"])  # unlike types
    with pytest.raises(ValueError):
        iv.interval_join(left, right, "s", "e", "d", 0, ["k"])


def test_small_calendar_leaves_the_history_unshuffled(tables):
    left, _, _ = tables
    from pyspark.sql import SparkSession

    days = date_dim(SparkSession.active(), "2000-01-01", "2001-12-31").where("is_month_end").select("date")
    plan = plan_of(iv.calendar_join(left, days, "s", "e"))
    assert "SortMergeJoin" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_hot_bin_is_split(spark):
    """A third of all intervals and of all points in one bin: AQE splits its partition."""
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        at = F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.col("id") * 10_000 + 100_000)
        left = spark.range(0, 9_000, 1, 6).select(at.alias("a"), (at + F.col("id") % 7).alias("b"), "id")
        right = spark.range(0, 9_000, 1, 6).select((at + 3).alias("p"))
        joined = iv.interval_join(left, right, "a", "b", "p", 10_000, how="inner")
        rows = joined.collect()
        final = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in final
        x = [i if i % 3 == 0 else i * 10_000 + 100_000 for i in range(9_000)]
        points = {v + 3 for v in x}
        assert len(points) == 9_000
        want = [(v, p) for i, v in enumerate(x) for p in range(v, v + i % 7 + 1) if p in points]
        assert sorted((r["a"], r["p"]) for r in rows) == sorted(want)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_date_dim_columns(spark):
    rows = {r["date"]: r for r in date_dim(spark, "1999-12-30", "2000-03-01").collect()}
    assert len(rows) == 63
    leap = rows[dt.date(2000, 2, 29)]
    assert (leap["month_name"], leap["day_of_month"], leap["is_month_end"], leap["day_of_year"]) == ("February", 29, True, 60)
    assert (leap["day_of_week"], leap["day_name"], leap["is_weekend"]) == (2, "Tuesday", False)
    eve = rows[dt.date(1999, 12, 31)]
    assert (eve["month_name"], eve["quarter"], eve["week_of_year"]) == ("December", 4, 52)
    assert eve["first_day_of_quarter"] == dt.date(1999, 10, 1) and eve["first_day_of_year"] == dt.date(1999, 1, 1)
    assert date_dim(spark, "2000-01-02", "2000-01-01").count() == 0


def test_named_december_31_equals_year_ends(spark):
    import __spark_entry__ as entry
    from tests.conftest import SF001

    a, b = (
        sorted(map(tuple, entry.queries()[n](spark, SF001).collect()))
        for n in ("retention_december_31", "interval_retention_counts")
    )
    assert a == b
