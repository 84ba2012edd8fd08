import pytest

import __spark_entry__ as entry
from cadence.plans import views
from cadence.plans.registry import QUERIES
from tests.conftest import SF001


def test_entry_runs_with_stable_schema(spark):
    df = entry.entry(spark)
    assert df.columns == ["first_state", "gender", "period", "cohort_size", "cohort_retained", "pct_retained"]
    assert df.count() > 0
    again = entry.entry(spark)
    assert again.schema == df.schema


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_every_query_runs_on_smoke_data(spark, name):
    df = entry.queries()[name](spark, SF001)
    rows = df.collect()
    assert rows and len(set(df.columns)) == len(df.columns)
    assert any(v is not None for v in rows[0])


def test_register_read_drop_view(spark):
    df = entry.queries()["same_month_last_year"](spark, SF001)
    views.register(df, "bookstore_sales_view")
    extremes = spark.sql(
        "select max(pct_diff) as max_pct_diff, min(pct_diff) as min_pct_diff from bookstore_sales_view"
    ).first()
    direct = entry.queries()["growth_extremes"](spark, SF001).first()
    assert extremes == direct
    assert views.read(spark, "bookstore_sales_view").count() == df.count()
    assert views.drop(spark, "bookstore_sales_view") is True
    assert views.drop(spark, "bookstore_sales_view") is False
