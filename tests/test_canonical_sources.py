import tempfile

from cadence.operators import cohort as co
from cadence.operators import series as se
from cadence.sources import canonical


def _write(tmp, name, text):
    path = f"{tmp}/{name}.csv"
    with open(path, "w") as fh:
        fh.write(text)
    return path


def test_canonical_csv_tables_feed_the_operators(spark):
    tmp = tempfile.mkdtemp(prefix="cadence-canonical-")
    terms = canonical.read(
        spark,
        "legislators_terms",
        _write(
            tmp,
            "terms",
            "id_bioguide,term_start,term_end,state,term_id\n"
            "A,1900-03-01,1902-03-01,NY,1\nA,1902-03-01,1904-02-28,OH,2\nB,1901-01-03,1901-06-30,NY,3\n",
        ),
        "csv",
    )
    counts = co.interval_retention_counts(terms, "id_bioguide", "term_start", "term_end")
    assert {r["period"]: r["cohort_retained"] for r in counts.collect()} == {0: 2, 1: 1, 2: 1, 3: 1}
    sales = canonical.read(
        spark,
        "retail_sales",
        _write(
            tmp,
            "sales",
            "sales_month,kind_of_business,sales\n"
            "1992-01-01,Book stores,790.00\n1992-02-01,Book stores,539.00\n1993-01-01,Book stores,998.00\n",
        ),
        "csv",
    )
    yearly = se.rollup(sales, "year", ["Book stores"], ordered=True).collect()
    assert [(r["sales_year"], float(r["sales"])) for r in yearly] == [(1992, 1329.0), (1993, 998.0)]
    assert dict(zip(terms.columns, [f.dataType.simpleString() for f in terms.schema.fields]))["term_start"] == "date"
