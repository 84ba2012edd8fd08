"""Windows over ranges and blocks: against plain windows on small blocks, plans."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cadence.operators import long_windows as lw


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(8)
    out = []
    for i in range(700):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        out.append((key, rng.choice([None, *range(12)]), i, None if rng.random() < 0.1 else rng.randint(-99, 99), i % 5))
    return spark.createDataFrame(out, "k string, t int, u int, x long, year int").repartition(5)


def plain(keys):
    return Window.partitionBy(*keys).orderBy(F.asc_nulls_last("t"), "u")


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


@pytest.mark.parametrize("keys", [(), ("k",)])
@pytest.mark.parametrize("n,block", [(1, 10), (4, 3), (12, 50), (250, 60), (1000, 1_000_000)])
def test_moving_and_lagged(rows, keys, n, block):
    series = lw.numbered(rows, ["t", "u"], keys, ranges=7)
    frame = plain(keys).rowsBetween(1 - n, 0)
    same(
        lw.moving(series, {"v": "x"}, n, rows_per_block=block),
        rows.select("*", F.sum("x").over(frame).alias("v_moving_sum"), F.count("x").over(frame).alias("v_moving_count")),
    )
    same(
        lw.lagged(series, {"before": "x", "at": "t"}, n, rows_per_block=block),
        rows.select("*", F.lag("x", n).over(plain(keys)).alias("before"), F.lag("t", n).over(plain(keys)).alias("at")),
    )


@pytest.mark.parametrize("keys", [(), ("k",)])
@pytest.mark.parametrize("reset", [(), ("year",)])
def test_running(rows, keys, reset):
    series = lw.numbered(rows, ["t", "u"], keys, ranges=7)
    got = lw.running(series, {"v": "x"}, ("sum", "count", "max", "min"), reset)
    frame = Window.partitionBy(*keys, *reset).orderBy(F.asc_nulls_last("t"), "u").rowsBetween(Window.unboundedPreceding, 0)
    want = rows.select("*", *[getattr(F, h)("x").over(frame).alias(f"v_running_{h}") for h in ("sum", "count", "max", "min")])
    same(got, want)


def test_rows_are_numbered_in_order(rows):
    series = lw.numbered(rows, ["t", "u"], ("k",), ranges=4)
    got = series.rows.orderBy("_row").collect()
    assert [r["_row"] for r in got] == list(range(700))
    key = [(r["k"] is None, r["k"], r["t"] is None, r["t"], r["u"]) for r in got]
    assert key == sorted(key, key=lambda x: (x[0], x[1] or "", x[2], x[3] or 0, x[4]))


def test_hot_key_and_equal_times_spread(spark):
    """One key, one time: a unique last column in the order spreads the rows over ranges and blocks."""
    rows = spark.range(4000).select(F.lit(1).alias("k"), F.lit(0).alias("t"), "id", F.lit(1).cast("long").alias("x"))
    series = lw.numbered(rows, ["t", "id"], ("k",), ranges=8)
    sizes = [r["count"] for r in series.rows.groupBy("_range").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2000
    last = lw.running(series, {"v": "x"}).agg(F.max("v_running_sum")).first()[0]
    assert last == 4000
    moved = lw.moving(series, {"v": "x"}, 10, rows_per_block=100)
    assert moved.groupBy("v_moving_sum").count().where("v_moving_sum = 10").first()["count"] == 3991


def test_empty_and_bad_input(rows):
    none = lw.numbered(rows.where("false"), ["t"], ("k",))
    assert lw.moving(none, {"v": "x"}, 3).count() == 0
    assert lw.lagged(none, {"b": "x"}).count() == 0
    assert lw.running(none, {"v": "x"}).count() == 0
    with pytest.raises(ValueError):
        lw.numbered(rows.withColumn("_row", F.lit(1)), ["t"])
    for bad in (lambda: lw.moving(none, {"v": "x"}, 0), lambda: lw.lagged(none, {"b": "x"}, 0)):
        with pytest.raises(ValueError):
            bad()
    with pytest.raises(ValueError):
        lw.running(none, {"v": "x"}, ("median",))


def test_no_plan_gathers_all_rows(rows):
    series = lw.numbered(rows, ["t", "u"], (), ranges=7)
    for df in (lw.moving(series, {"v": "x"}, 5), lw.lagged(series, {"b": "x"}), lw.running(series, {"v": "x"})):
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
        for i, line in enumerate(lines):
            if "SinglePartition" in line:
                assert "HashAggregate" in "\n".join(lines[i + 1 : i + 4])
