"""Ages as values, kept views, bucketed tables and histories by year."""

import datetime as dt
import os
import random
import re
import uuid
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from cadence.functions import sql as sql_functions
from cadence.functions.age import age
from cadence.operators import cohort as co
from cadence.plans.kept_views import MonthlyView, _runs
from cadence.sources import layout


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- age()
def random_pairs(n):
    rng = random.Random(1)
    edges = [dt.date(2000, 2, 29), dt.date(1999, 1, 31), dt.date(2000, 12, 31), dt.date(2001, 3, 1), dt.date(1900, 2, 28)]

    def one():
        return rng.choice(edges) if rng.random() < 0.3 else dt.date(1890, 1, 1) + dt.timedelta(days=rng.randint(0, 50_000))

    return [(one(), one()) for _ in range(n)] + [(None, edges[0]), (edges[0], None)]


def test_age_of_dates_equals_duckdb(spark):
    pairs = random_pairs(600)
    sql_functions.register(spark)
    df = spark.createDataFrame(pairs, "a date, b date")
    got = df.select("a", "b", age("a", "b").alias("x"), F.expr("age_parts(a, b)").alias("y")).collect()
    con = duckdb.connect()
    for r in got:
        assert r["x"] == r["y"]
        if r["a"] is None or r["b"] is None:
            assert r["x"] is None
            continue
        want = con.execute(
            "SELECT date_part('year', a), date_part('month', a), date_part('day', a) FROM (SELECT age(?::TIMESTAMP, ?::TIMESTAMP) AS a)",
            [r["a"], r["b"]],
        ).fetchone()
        assert tuple(r["x"]) == want, (r["a"], r["b"])


def test_age_of_timestamps_equals_duckdb(spark):
    rng = random.Random(2)
    pairs = [
        tuple(dt.datetime(1999, 1, 28) + dt.timedelta(seconds=rng.randint(0, 90_000_000), microseconds=rng.randint(0, 999_999)) for _ in "ab")
        for _ in range(300)
    ]
    got = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz").select("a", "b", age("a", "b", timed=True).alias("x"))
    con = duckdb.connect()
    for r in got.collect():
        y, m, d, us = con.execute(
            "SELECT date_part('year', a), date_part('month', a), date_part('day', a), "
            "date_part('hour', a) * 3600000000 + date_part('minute', a) * 60000000 + date_part('microsecond', a) "
            "FROM (SELECT age(?::TIMESTAMP, ?::TIMESTAMP) AS a)",
            [r["a"], r["b"]],
        ).fetchone()
        assert tuple(r["x"]) == (y, m, d, us), (r["a"], r["b"])


# ---------------------------------------------------------------- kept views
SALES = [
    ("a", dt.date(2000, 1, 5), 100),
    ("a", dt.date(2000, 1, 9), 50),
    ("b", dt.date(2000, 1, 9), 7),
    ("a", dt.date(2000, 2, 1), 30),
    (None, dt.date(2000, 3, 1), 4),
    ("a", None, 999),
    ("b", dt.date(2000, 3, 31), None),
]
SCHEMA = "kind_of_business string, day date, cents long"


def files(path):
    return {
        d: sorted(f for f in os.listdir(os.path.join(path, d)) if f.endswith(".parquet"))
        for d in os.listdir(path)
        if d.startswith("sales_month=")
    }


def kept(view):
    return sorted(((r["sales_month"], r["kind_of_business"], r["sales"]) for r in view.series().collect()), key=str)


def test_only_touched_months_are_written(spark, tmp_path):
    rows = spark.createDataFrame(SALES, SCHEMA)
    path = str(tmp_path / "view")
    view = MonthlyView(spark, path)
    view.build(rows, "day", "cents")
    jan, feb, mar = (dt.date(2000, m, 1) for m in (1, 2, 3))
    first = [(jan, "a", Decimal("1.50")), (jan, "b", Decimal("0.07")), (feb, "a", Decimal("0.30")), (mar, None, Decimal("0.04")), (mar, "b", None)]
    assert kept(view) == sorted(first, key=str)
    before = files(path)

    batch = spark.createDataFrame([("a", dt.date(2000, 2, 20), 5), ("c", dt.date(2000, 4, 2), 1)], SCHEMA)
    assert view.add(batch, "day", "cents") == [feb, dt.date(2000, 4, 1)]
    after = files(path)
    assert {d for d in after if after[d] != before.get(d)} == {"sales_month=2000-02-01", "sales_month=2000-04-01"}
    assert (feb, "a", Decimal("0.35")) in kept(view) and (dt.date(2000, 4, 1), "c", Decimal("0.01")) in kept(view)

    # January is corrected in the source; April's only row is gone there.
    corrected = spark.createDataFrame([("b", dt.date(2000, 1, 1), 11)], SCHEMA)
    view.refresh(corrected, "day", "cents", [jan, dt.date(2000, 4, 1)])
    last = files(path)
    assert {d for d in last if last[d] != after[d]} == {"sales_month=2000-01-01", "sales_month=2000-04-01"}
    assert [r for r in kept(view) if r[0] in (jan, dt.date(2000, 4, 1))] == [(jan, "b", Decimal("0.11"))]
    assert view.add(batch.where("false"), "day", "cents") == []
    view.refresh(corrected, "day", "cents", [])
    assert files(path) == last


def test_totals_of_a_kept_view_have_no_ceiling(spark, tmp_path):
    view = MonthlyView(spark, str(tmp_path / "view"))
    big = 9 * 10**18
    rows = spark.createDataFrame([("a", dt.date(2000, 1, 1), big)] * 5, SCHEMA)
    view.build(rows, "day", "cents")
    view.add(rows, "day", "cents")
    assert kept(view) == [(dt.date(2000, 1, 1), "a", Decimal(10 * big) / 100)]


def test_reading_some_months_prunes_directories(spark, tmp_path):
    view = MonthlyView(spark, str(tmp_path / "view"))
    view.build(spark.createDataFrame(SALES, SCHEMA), "day", "cents")
    some = view.series().where(F.col("sales_month") == dt.date(2000, 2, 1))
    assert len(some.inputFiles()) == 3  # of the relation; the scan's partitions are filtered:
    assert re.search(r"PartitionFilters: \[[^\]]*sales_month", plan_of(some))


def test_months_of_a_refresh_become_ranges():
    d = dt.date
    assert _runs([d(2000, 11, 1), d(2000, 12, 1), d(2001, 1, 1), d(2001, 5, 1)]) == [
        (d(2000, 11, 1), d(2001, 2, 1)),
        (d(2001, 5, 1), d(2001, 6, 1)),
    ]


# ---------------------------------------------------------------- layouts
def history(spark):
    rng = random.Random(6)
    rows = []
    for i in range(500):
        begin = None if i % 50 == 0 else dt.date(1995, 1, 1) + dt.timedelta(days=rng.randint(0, 2500))
        rows.append((rng.randint(0, 60), begin, None if begin is None else begin + dt.timedelta(days=700), i))
    return spark.createDataFrame(rows, "e long, s date, t date, i long")


def test_bounds_read_only_their_years(spark, tmp_path):
    rows = history(spark)
    path = str(tmp_path / "history")
    layout.write_by_year(rows, path, "s", "e")
    found = layout.read_by_year(spark, path, rows.schema, "1997-03-01", "1998-02-01", "s")
    want = rows.where("s BETWEEN '1997-03-01' AND '1998-02-01'")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    read = {os.path.basename(os.path.dirname(r["f"])) for r in found.select(F.input_file_name().alias("f")).distinct().collect()}
    assert read == {"start_year=1997", "start_year=1998"}
    assert re.search(r"PartitionFilters: \[[^\]]*start_year", plan_of(found))
    whole = layout.read_by_year(spark, path, rows.schema, start="s")
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)


def test_writing_again_replaces_only_its_years(spark, tmp_path):
    rows = history(spark)
    path = str(tmp_path / "history")
    layout.write_by_year(rows, path, "s", "e")
    more = rows.where("year(s) = 1996").union(rows.where("year(s) = 1996 AND i < 100"))
    layout.write_by_year(more, path, "s", "e")
    counts = {r[0]: r[1] for r in layout.read_by_year(spark, path, rows.schema, start="s").groupBy(F.year("s")).count().collect()}
    want = {r[0]: r[1] for r in rows.where("s IS NULL OR year(s) != 1996").union(more).groupBy(F.year("s")).count().collect()}
    assert counts == want


def test_a_hot_entity_spreads_over_a_years_files(spark, tmp_path):
    """One entity, one year: the rows' dates spread it."""
    rows = spark.range(0, 4000, 1, 4).select(F.lit(1).alias("e"), F.date_add(F.lit(dt.date(1999, 1, 1)), (F.col("id") % 360).cast("int")).alias("s"), "id")
    path = str(tmp_path / "history")
    coalesced = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions stay, as large ones do
    try:
        layout.write_by_year(rows, path, "s", "e")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesced)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) > 4 and max(sizes) < 2000


def exchanges(df):
    lines = plan_of(df).splitlines()
    return [line.strip() for line in lines if "Exchange" in line and "ReusedExchange" not in line]


def test_bucketed_tables_meet_without_shuffles(spark, tmp_path):
    rows = history(spark)
    dimension = spark.range(61).select(F.col("id").alias("e"), F.concat(F.lit("g"), F.col("id") % 3).alias("g"))
    names = [f"t{uuid.uuid4().hex}" for _ in range(2)]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with a large dimension
    try:
        h = layout.write_bucketed(rows, names[0], str(tmp_path / "h"), "e", 4)
        d = layout.write_bucketed(dimension, names[1], str(tmp_path / "d"), "e", 4)
        counts = co.interval_retention_counts(h, "e", "s", "t", ["g"], dimension=d, dimension_cols=["g"])
        plain = co.interval_retention_counts(rows, "e", "s", "t", ["g"], dimension=dimension, dimension_cols=["g"])
        assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, plain.collect()))
        # Only the counts by (cohort, period) are exchanged; the plain plan moves history and dimension too.
        assert all("hashpartitioning(g#" in x for x in exchanges(counts)) and exchanges(counts)
        assert any("hashpartitioning(e#" in x for x in exchanges(plain))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for n in names:
            spark.sql(f"DROP TABLE IF EXISTS {n}")


def test_the_layouts_own_column_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        layout.write_by_year(history(spark).withColumn("start_year", F.lit(1)), str(tmp_path / "x"), "s", "e")
