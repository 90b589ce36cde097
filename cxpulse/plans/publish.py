"""Publishing: report payloads (R11) and page publishing.

``as_payload`` turns one aggregated report into one payload row. The
report must already be small (its size is bounded by its dimension keys,
e.g. teams x processes): the payload is a single JSON document, which is
what a page embeds. For large outputs use ``write_report_rows`` (one JSON text
per row, written in parallel, one partition per report) instead.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import stamp as stamp_text
from ..operators import pages as pg
from ..operators import payload as pl
from ..operators.guard import within_bytes
from ..params import DATE_FORMAT, ZONE_OFFSET_HOURS


@dataclass(frozen=True)
class PayloadSpec:
    """How one report is published: slot (marker + JS variable), the row
    order of the JSON array, or a key column for the ``{key: {...}}`` form."""

    name: str
    var: str
    order: tuple[tuple[str, bool], ...] = ()
    key: str | None = None

    @property
    def slot(self) -> pg.Slot:
        return pg.Slot(self.name, self.var)


def as_payload(df: DataFrame, spec: PayloadSpec, max_bytes: int = pg.MAX_PAYLOAD_BYTES // 2) -> DataFrame:
    """One row: name, var, n (rows or keys), json, b64, js. A JSON text of more
    than ``max_bytes`` fails the job (a page cannot carry it); use
    ``write_report_rows``. The bytes of the rows' JSON texts are added up first, so
    an oversized report fails before any task holds it whole."""
    rows = pl.jsonable(df)
    rows = within_bytes(rows, F.octet_length(pl.to_json(F.struct(*rows.columns))), max_bytes, f"payload {spec.name}")
    if spec.key is None:
        doc = pl.row_objects(rows, spec.order)
    else:
        value_cols = [c for c in rows.columns if c != spec.key]
        entry = F.struct(F.col(spec.key).alias("key"),
                         F.struct(*[F.col(c) for c in value_cols]).alias("value"))
        doc = F.map_from_entries(F.array_sort(F.collect_list(entry)))
    agg = rows.agg(F.count(F.lit(1)).alias("n"), pg.limited(pl.to_json(doc), f"payload {spec.name}", max_bytes).alias("json"))
    b64 = pl.base64_text(F.col("json"))
    return agg.select(F.lit(spec.name).alias("name"), F.lit(spec.var).alias("var"), "n", "json",
                      b64.alias("b64"), pl.js_const(spec.var, b64).alias("js"))


def report_rows(df: DataFrame, name: str) -> DataFrame:
    """Distributed sink form: (report, json) per row (see ``write_report_rows``)."""
    rows = pl.jsonable(df)
    return rows.select(F.lit(name).alias("report"),
                       pl.to_json(F.struct(*[F.col(c) for c in rows.columns])).alias("json"))


SINK_SCHEMA = "report string, kind string, json string"


def write_report_rows(reports: Mapping[str, DataFrame], folder: str) -> None:
    """Write all rows of the given reports as JSON texts, in parallel, into one
    table partitioned by report. Each report given replaces what the table held of
    it (also one without rows), other reports stay. A row of kind ``schema``
    carries the report's columns and types."""
    parts = []
    for name, df in reports.items():
        spark = df.sparkSession
        header = spark.createDataFrame([(name, "schema", pl.jsonable(df).schema.json())], SINK_SCHEMA)
        parts += [header, report_rows(df, name).select("report", F.lit("row").alias("kind"), "json")]
    if parts:
        table = reduce(DataFrame.unionByName, parts)
        table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("report").parquet(folder)


def read_report_rows(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A report of the table, with the columns and types it was written with."""
    texts = spark.read.schema("kind string, json string, report string").parquet(folder).where(F.col("report") == name)
    header = texts.where("kind = 'schema'").first()
    if header is None:
        raise KeyError(f"no report {name} in {folder}")
    schema = T.StructType.fromJson(json.loads(header["json"]))
    return texts.where("kind = 'row'").select(F.from_json("json", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def payloads(reports: dict[str, DataFrame], specs: Sequence[PayloadSpec]) -> DataFrame:
    """Union of the payload rows of the given reports (one row each)."""
    out = None
    for spec in specs:
        p = as_payload(reports[spec.name], spec)
        out = p if out is None else out.unionByName(p)
    return out


@dataclass(frozen=True)
class StampSpec:
    """Where the refresh time is written in a page."""

    element_ids: tuple[str, ...] = ()
    style_id: str | None = None
    offset_hours: float = ZONE_OFFSET_HOURS
    date_format: str = DATE_FORMAT
    suffix: str = ""


def stamp_column(refreshed_at: dt.datetime, spec: StampSpec) -> Column:
    return F.concat(stamp_text(refreshed_at, spec.offset_hours, spec.date_format),
                    F.lit(spec.suffix))


def publish_pages(pages: DataFrame, payload_rows: DataFrame, specs: Sequence[PayloadSpec],
                  refreshed_at: dt.datetime, stamp: StampSpec = StampSpec()) -> DataFrame:
    """Pages with payloads injected and the refresh stamp written.

    Output: the page columns with ``html`` replaced, plus ``injected`` and
    ``missing`` (payload names), ``refreshed_at`` (stamp text)."""
    out = pg.inject(pages, payload_rows, [s.slot for s in specs])
    text = stamp_column(refreshed_at, stamp)
    out = out.withColumn("refreshed_at", text)
    if stamp.element_ids:
        out = out.withColumn("html", pg.stamp_elements(F.col("html"), stamp.element_ids,
                                                       F.col("refreshed_at")))
    if stamp.style_id:
        out = out.withColumn("html", pg.stamp_style(F.col("html"), stamp.style_id,
                                                    F.col("refreshed_at")))
    return out
