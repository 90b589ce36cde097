"""Compare a registered query with its SQL oracle (as the driver does):
row count, column names, and the multiset of rows with doubles compared
to a tolerance."""

from __future__ import annotations

import math
import os
from dataclasses import dataclass

import duckdb
import pandas as pd

RAW_TABLES = ("region nation customer supplier part orders lineitem events documents "
              "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in RAW_TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    if hasattr(v, "isoformat"):
        return str(v)[:10] if len(str(v)) >= 10 and str(v)[10:] in ("", " 00:00:00") else str(v)
    return v


def _rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(None if (not isinstance(v, (list, dict, tuple)) and pd.isna(v)) else v)
                         for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


_DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                  "DATE": "date", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz"}


def type_mismatches(spark_df, sql: str, con) -> list[str]:
    """Columns whose Spark type differs from the oracle's DuckDB type."""
    rel = con.sql(sql)
    duck_types = {name: str(t) for name, t in zip(rel.columns, rel.types)}
    out = []
    for name, spark_type in spark_df.dtypes:
        want = _DUCK_TO_SPARK.get(duck_types.get(name, "?"), duck_types.get(name, "?"))
        if want != spark_type:
            out.append(f"{name}: spark {spark_type} vs oracle {duck_types.get(name)}")
    return out


@dataclass
class Result:
    name: str
    rows_spark: int
    rows_oracle: int
    columns_match: bool
    values_match: bool
    detail: str = ""

    @property
    def ok(self) -> bool:
        return (self.rows_spark == self.rows_oracle and self.columns_match
                and self.values_match)


def compare(name: str, spark_df, sql: str, con) -> Result:
    left = spark_df.toPandas()
    right = con.execute(sql).df()
    cols_ok = sorted(left.columns) == sorted(right.columns)
    detail = "" if cols_ok else f"cols {sorted(left.columns)} vs {sorted(right.columns)}"
    vals_ok = False
    if cols_ok:
        lr, rr = _rows(left), _rows(right)
        vals_ok = lr == rr
        if not vals_ok:
            diff_l = [r for r in lr if r not in rr][:3]
            diff_r = [r for r in rr if r not in lr][:3]
            detail = f"spark-only {diff_l} oracle-only {diff_r}"
    return Result(name, len(left), len(right), cols_ok, vals_ok, detail)
