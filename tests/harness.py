"""Spark-versus-DuckDB comparison used by the oracle tests and by hand.

Rows are compared order-insensitively and exactly (doubles bit for bit),
columns by name; types are compared through a small mapping.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

_SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "date": "DATE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def duck_connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else "nan"
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return repr(v) if not isinstance(v, str) else v


def _sort_key(row):
    return tuple("\x00" if x is None else str(x) for x in row)


def duck_result(con, sql: str):
    rel = con.sql(sql)
    cols = rel.columns
    types = [str(t) for t in rel.types]
    return cols, types, rel.fetchall()


def spark_result(df):
    cols = df.columns
    types = [f.dataType.simpleString() for f in df.schema.fields]
    return cols, types, [tuple(r) for r in df.collect()]


def spark_type_to_duck(t: str) -> str:
    if t.startswith("decimal"):
        return t.upper()
    return _SPARK_TO_DUCK.get(t, t.upper())


def compare(spark_df, con, sql: str) -> dict:
    s_cols, s_types, s_rows = spark_result(spark_df)
    d_cols, d_types, d_rows = duck_result(con, sql)
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows)}
    out["columns_equal"] = sorted(s_cols) == sorted(d_cols)
    if not out["columns_equal"]:
        out["detail"] = f"columns spark={s_cols} oracle={d_cols}"
        out["ok"] = False
        return out
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_index = {c: i for i, c in enumerate(d_cols)}
    d_order = [d_index[s_cols[i]] for i in order]
    type_pairs = [(s_cols[i], spark_type_to_duck(s_types[i]), d_types[d_index[s_cols[i]]]) for i in order]
    out["type_mismatch"] = [p for p in type_pairs if p[1] != p[2]]
    srows = sorted((tuple(_norm(r[i]) for i in order) for r in s_rows), key=_sort_key)
    drows = sorted((tuple(_norm(r[i]) for i in d_order) for r in d_rows), key=_sort_key)
    out["values_equal"] = srows == drows
    if not out["values_equal"]:
        diffs = []
        for a, b in zip(srows, drows):
            if a != b:
                diffs.append((a, b))
                if len(diffs) >= 3:
                    break
        out["detail"] = diffs
        out["n_diff"] = sum(1 for a, b in zip(srows, drows) if a != b)
    out["ok"] = out["values_equal"] and not out["type_mismatch"] and len(s_rows) == len(d_rows)
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from cadence.session import build_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    names = argv or list(entry.queries())
    spark = build_session("local[8]", 8)
    con = duck_connect(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names:
        if name not in sqls:
            rows = qs[name](spark, sf_dir).count()
            print(f"{name:34s} rows-only {rows}")
            continue
        try:
            res = compare(qs[name](spark, sf_dir), con, sqls[name])
        except Exception as exc:  # noqa: BLE001
            res = {"ok": False, "detail": f"{type(exc).__name__}: {str(exc)[:400]}"}
        bad += 0 if res.get("ok") else 1
        flag = "OK " if res.get("ok") else "BAD"
        print(f"{flag} {name:34s} rows {res.get('spark_rows')}/{res.get('oracle_rows')}"
              f" types {res.get('type_mismatch')} {res.get('detail', '')}")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
