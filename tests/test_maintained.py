"""State kept up batch by batch: equal to one run over everything, late rows included."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cadence.functions import calendar as cal
from cadence.operators import bitmaps as bm
from cadence.operators import cohort as co
from cadence.operators import maintained as mt


def history(rng, n, entities):
    out = []
    for i in range(n):
        e = None if rng.random() < 0.03 else rng.randint(0, entities)
        begin = None if rng.random() < 0.05 else dt.date(1990, 1, 1) + dt.timedelta(days=rng.randint(0, 4000))
        end = None if begin is None else begin + dt.timedelta(days=rng.randint(0, 1500))
        out.append((e, begin, end, rng.choice("abc"), i))
    return out


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(history(random.Random(2), 900, 120), "e long, s date, t date, a string, i long")


def found(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


@pytest.mark.parametrize("order", ["i", "-i", "i * 7 % 900"])
def test_batches_equal_one_run(rows, order):
    """In any order of arrival: most batches hold rows that move first dates."""
    how = mt.Retention("e", "s", "s", "year")
    part = F.floor(F.expr(f"pmod({order}, 900)") / 300)
    kept = how.begin(rows.where(part == 0))
    for k in (1, 2):
        kept = how.add(kept, rows.where(part == k), history=rows.where(part < k))
    want = co.retention_counts(rows, "e", "s")
    assert found(how.counts(kept), "period", "cohort_retained") == found(want, "period", "cohort_retained")


def test_intervals_by_cohort_equal_one_run(rows):
    how = mt.Retention("e", "s", "at", "year", {"y": cal.year_of("first")}, null_is_zero=True)
    ends = rows.select("e", "s", "i", F.explode_outer(cal.covered_years(F.col("s"), F.col("t"))).alias("z"))
    ends = ends.withColumn("at", cal.year_end("z"))
    kept = how.add(how.begin(ends.where("i % 2 = 1")), ends.where("i % 2 = 0"), history=ends.where("i % 2 = 1"))
    want = co.interval_retention_counts(rows, "e", "s", "t", ["y"], derived={"y": cal.year_of("first_term")})
    assert found(how.counts(kept), "y", "period", "cohort_retained") == found(want, "y", "period", "cohort_retained")
    total = how.counts(kept, by=["period"])
    want = co.interval_retention_counts(rows, "e", "s", "t")
    assert found(total, "period", "cohort_retained") == found(want, "period", "cohort_retained")


def test_batches_in_order_of_time_read_no_history(rows):
    """New dates only: no first date moves, so no history is asked for."""
    how = mt.Retention("e", "s", "s", "year")
    dated = rows.where("s is not null")
    kept = how.add(how.begin(dated.where("s < '1996-01-01'")), dated.where("s >= '1996-01-01'"))
    assert found(how.counts(kept), "period", "cohort_retained") == found(
        co.retention_counts(dated, "e", "s"), "period", "cohort_retained"
    )
    with pytest.raises(ValueError):
        how.add(how.begin(dated.where("s >= '1996-01-01'")), dated.where("s < '1996-01-01'"))


def test_a_batch_added_twice_changes_nothing(rows):
    how = mt.Retention("e", "s", "s", "month")
    kept = how.begin(rows)
    again = how.add(kept, rows.where("i < 100"))
    assert found(how.counts(again), "period", "cohort_retained") == found(how.counts(kept), "period", "cohort_retained")


def test_empty_batches(rows):
    how = mt.Retention("e", "s", "s", "year")
    none = how.begin(rows.where("false"))
    assert how.counts(none).count() == 0
    kept = how.add(how.add(none, rows), rows.where("false"))
    assert found(how.counts(kept), "period", "cohort_retained") == found(
        co.retention_counts(rows, "e", "s"), "period", "cohort_retained"
    )


def test_first_dates_and_rows_merge(rows):
    parts = [rows.where(F.col("i") % 3 == k) for k in range(3)]
    whole = mt.first_dates(rows, "e", "s")
    merged = mt.merged_first_dates([mt.first_dates(p, "e", "s") for p in reversed(parts)], "e")
    assert found(merged, "e", "first") == found(whole, "e", "first")
    states = [mt.first_rows(p, "e", ["s", "i"], ["a"]) for p in parts]
    both = states[0].union(states[1]).union(states[2])
    again = mt.first_rows(both, "e", ["s", "i"], ["a"])
    assert found(again, "e", "s", "i", "a") == found(mt.first_rows(rows, "e", ["s", "i"], ["a"]), "e", "s", "i", "a")
    want = co.first_attribute(rows.where("e is not null"), "e", "s", "a", "i")
    got = again.select("e", F.col("a").alias("first_a"))
    assert found(got, "e", "first_a") == found(want, "e", "first_a")


def test_sets_roll_up_and_leave_out(spark):
    rng = random.Random(4)
    data = [(rng.choice("xyz"), rng.choice("pq"), rng.randint(1, 100_000)) for _ in range(3000)]
    data += [("x", None, None), (None, "p", 5)]
    df = spark.createDataFrame(data, "k string, j string, n long")
    sets = bm.merged([bm.bitmaps_of(df.where("n % 2 = 0"), "n", ["k", "j"]), bm.bitmaps_of(df.where("n % 2 = 1"), "n", ["k", "j"])], ["k", "j"])
    gone = set(range(1, 100_000, 3))
    left_out = bm.bitmaps_of(spark.createDataFrame([(n,) for n in gone], "n long"), "n")
    for by in (["k", "j"], ["k"], []):
        at = [("k", "j").index(c) for c in by]
        whole, some = {}, {}
        for row in data:
            if row[2] is not None:
                whole.setdefault(tuple(row[i] for i in at), set()).add(row[2])
        some = {k: len(v - gone) for k, v in whole.items() if v - gone}
        got = {tuple(r[c] for c in by): r["n"] for r in bm.counts(sets, by).collect()}
        assert got == {k: len(v) for k, v in whole.items()}
        assert {tuple(r[c] for c in by): r["n"] for r in bm.counts(sets, by, without=left_out).collect()} == some
