"""The behaviour catalogue: sentence code -> label, error text, activity.

A small dimension. It is supplied as data (a table or local rows), never
hard-coded: codes without a label fall back to the raw code, codes without
an error text or activity get the report's defaults.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas


def catalog_from_rows(spark: SparkSession, rows: Iterable[Mapping]) -> DataFrame:
    """Build the catalogue from dicts with keys sentence, label, error_text
    and activity (a dict with title, duration, objective, how, materials,
    tags, or None)."""
    data = []
    for r in rows:
        act = r.get("activity")
        data.append((
            r["sentence"], r.get("label"), r.get("error_text"),
            None if act is None else (
                act.get("title"), act.get("duration"), act.get("objective"),
                act.get("how"), act.get("materials"), list(act.get("tags") or []),
            ),
        ))
    return spark.createDataFrame(data, schemas.CATALOG)


def conform_catalog(df: DataFrame) -> DataFrame:
    """The catalogue with one row per sentence: of several the smallest by label,
    error text and activity stays, so that a lookup never multiplies rows."""
    names = [f.name for f in schemas.CATALOG.fields]
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise schemas.SchemaError(f"catalog: missing columns {missing}")
    rest = [n for n in names if n != "sentence"]
    one = df.where(F.col("sentence").isNotNull()).groupBy("sentence").agg(F.min(F.struct(*rest)).alias("row"))
    return one.select("sentence", *[F.col(f"row.{n}").alias(n) for n in rest])
