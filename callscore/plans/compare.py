"""Spark-vs-DuckDB result comparison used by the tests and the check tool.

Order-insensitive: columns sorted by name, floats rounded, rows sorted.
"""

from __future__ import annotations

import math
from decimal import Decimal

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v, nd: int):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        r = round(v, nd)
        return 0.0 if r == 0 else r
    if isinstance(v, Decimal):
        return _norm(float(v), nd)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, nd) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist(), nd)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, nd)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict(), nd)
    return v


def normalise(columns, rows, nd: int = 6):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = [tuple(_norm(r[i], nd) for i in order) for r in rows]
    out.sort(key=repr)
    return cols, out


def duck_connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create or replace view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def run_duck(con, sql: str):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def run_spark(df):
    return list(df.columns), [tuple(r) for r in df.collect()]


_DUCK = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
         "FLOAT": "float", "SMALLINT": "smallint", "TINYINT": "tinyint", "DATE": "date"}


def duck_types(con, sql: str) -> dict:
    rel = con.sql(sql)
    return {c: _DUCK.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}


def spark_types(df) -> dict:
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def compare(spark_df, con, sql: str, nd: int = 6) -> dict:
    sc, sr = normalise(*run_spark(spark_df), nd=nd)
    dc, dr = normalise(*run_duck(con, sql), nd=nd)
    st, dt = spark_types(spark_df), duck_types(con, sql)
    tdiff = {c: (st[c], dt.get(c)) for c in st if st[c] != dt.get(c)}
    res = {"spark_rows": len(sr), "oracle_rows": len(dr), "schema_match": sc == dc,
           "rows_match": len(sr) == len(dr), "values_match": sr == dr}
    if tdiff:
        res["type_diff"] = tdiff
    if not res["values_match"]:
        ss, ds = set(sr), set(dr)
        res["only_spark"] = [r for r in sr if r not in ds][:3]
        res["only_oracle"] = [r for r in dr if r not in ss][:3]
        if sc != dc:
            res["spark_cols"], res["oracle_cols"] = sc, dc
    return res
