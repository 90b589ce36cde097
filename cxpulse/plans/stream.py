"""The survey as a stream: day measures of closed days, for R1 and R2.

``start`` reads an input stream of survey rows, adds the measures up by day and
team in Spark's state store and writes a day once it is closed: when the watermark
(the latest response date seen, less ``delay``) has passed its end. Closed days
are appended to a table by Spark's file sink, exactly once; the state holds the
open days only, so it does not grow with the stream.

``rows`` joins both sides of the watermark: closed days from that table, later days
from the facts themselves, read from the first open day on. So a report is
complete at any time and reads ``delay`` days instead of the whole period.

Late rows: a row of a day that is already closed is left out of the table
(``dropped`` counts them per run). ``plans.state`` replaces whole days and is the
way to correct them. Days are those of the stored dates; the session's time zone
plays no part.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import scores
from ..functions.dates import as_date, week_label
from ..operators.filters import survey_rows
from ..params import Scope
from .survey import weekly_since

_DAY = 86_400
SCHEMA = "day date, team string, n long, pro long, neu long, det long, score_sum decimal(38,10), score_n long, target_sum decimal(38,10), target_n long"


def day_measures(survey: DataFrame, scope: Scope, delay: str, weeks_back: int = 4) -> DataFrame:
    """Measures by day and team of the streamed (or stored) survey rows."""
    rows = survey_rows(survey, scope, since=weekly_since(scope, weeks_back))
    # midnight UTC of the day, whatever the session's zone
    at = F.timestamp_seconds(F.unix_date(as_date(F.col("response_date"))).cast("long") * _DAY)
    rows = rows.select(at.alias("at"), "team", *scores.measures(F.col("score"), F.col("target_text"))).withWatermark("at", delay)
    by_day = rows.groupBy(F.window("at", "1 day").alias("w"), "team").agg(*scores.combined())
    day = F.date_from_unix_date((F.unix_seconds(F.col("w.start")) / _DAY).cast("int"))
    return by_day.select(day.alias("day"), "team", *scores.MEASURES)


def start(survey: DataFrame, scope: Scope, folder: str, delay: str, weeks_back: int = 4) -> StreamingQuery:
    """Take in what is new and stop (``availableNow``); closed days go to
    ``folder``/closed, progress to ``folder``/progress."""
    closed = day_measures(survey, scope, delay, weeks_back)
    return (closed.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
            .option("checkpointLocation", os.path.join(folder, "progress")).start(os.path.join(folder, "closed")))


def dropped(query: StreamingQuery) -> int:
    """Rows the run left out because their day was closed."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)


def closed_days(spark: SparkSession, folder: str) -> DataFrame:
    """The closed days' measures; no rows before the first day is closed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(folder, "closed", "_spark_metadata"))
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(os.path.join(folder, "closed"))


def rows(spark: SparkSession, folder: str, survey: DataFrame, scope: Scope, weeks_back: int = 4) -> DataFrame:
    """R1's and R2's ``rows``: closed days from the stream's table, later ones
    from ``survey``."""
    closed = closed_days(spark, folder)
    last = closed.agg(F.max("day")).first()[0]
    since = weekly_since(scope, weeks_back)
    first_open = since if last is None else max(since, last + dt.timedelta(days=1))
    opened = survey_rows(survey, scope, since=first_open).select(
        as_date(F.col("response_date")).alias("day"), "team", *scores.measures(F.col("score"), F.col("target_text")))
    both = closed.where(F.col("day") >= F.lit(since)).unionByName(opened)
    return both.withColumn("week", week_label(F.col("day"))).withColumn("in_month", F.col("day") >= F.lit(scope.month_start))
