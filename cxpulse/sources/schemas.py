"""Logical input tables and their column contracts.

Each report names the columns it needs; ``conform`` checks they exist and
selects only those, so the Parquet scan reads nothing else. Types are
checked loosely (a family, e.g. "any date-like"), because source systems
deliver DATE, TIMESTAMP or TIMESTAMP_NTZ for the same concept.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_DATE_LIKE = (T.DateType, T.TimestampType, T.TimestampNTZType)
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)
_ANY = (T.DataType,)

SURVEY = {
    "team": (T.StringType,),
    "agent": _ANY,
    "response_date": _DATE_LIKE,
    "channel": (T.StringType,),
    "process": (T.StringType,),
    "driver": (T.StringType,),
    "score": _NUMERIC,
    "target_text": (T.StringType,),
    "segment": (T.StringType,),
    "on_target_channel": (T.BooleanType,),
    "office": (T.StringType,),
    "training_id": _ANY,
}

QA_EVAL = {
    "team": (T.StringType,),
    "channel": (T.StringType,),
    "reason": (T.StringType,),
    "metric_type": (T.StringType,),
    "assigned_date": _DATE_LIKE,
    "qa_total": _NUMERIC,
    "sentence": (T.StringType,),
    "moment": (T.StringType,),
    "sentence_value": (T.StringType,),
}

QA_FLAGS = {
    "team": (T.StringType,),
    "flag_type": (T.StringType,),
    "flag": (T.StringType,),
    "is_valid": (T.BooleanType,),
    "not_dup": (T.BooleanType,),
    "reason": (T.StringType,),
    "picklist_value": _ANY,
    "inappropriate": _NUMERIC,
    "reference_date": _DATE_LIKE,
}

AGENT_TIME = {
    "agent": _ANY,
    "team": (T.StringType,),
    "role": (T.StringType,),
    "work_date": _DATE_LIKE,
}


def agent_time(buckets: Iterable[str]) -> dict:
    """Contract of agent time with the given buckets (seconds in ``<bucket>_s``)."""
    return {**AGENT_TIME, **{f"{b}_s": _NUMERIC for b in buckets}}


TRAINING_STATUS = {
    "agent": _ANY,
    "work_date": _DATE_LIKE,
    "status": (T.StringType,),
}

ACTIVITY = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("duration", T.StringType()),
    T.StructField("objective", T.StringType()),
    T.StructField("how", T.StringType()),
    T.StructField("materials", T.StringType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
])

CATALOG = T.StructType([
    T.StructField("sentence", T.StringType(), False),
    T.StructField("label", T.StringType()),
    T.StructField("error_text", T.StringType()),
    T.StructField("activity", ACTIVITY),
])

class SchemaError(ValueError):
    pass


def conform(df: DataFrame, contract: dict, columns: Iterable[str] | None = None,
            name: str = "input") -> DataFrame:
    """Select the needed ``columns`` (default: all of the contract) after
    checking presence and type family. No data is touched: this only shapes
    the plan, and the projection is pushed into the scan."""
    wanted = list(columns) if columns is not None else list(contract)
    fields = {f.name: f.dataType for f in df.schema.fields}
    for col in wanted:
        if col not in fields:
            raise SchemaError(f"{name}: missing column {col!r}")
        families = contract.get(col, _ANY)
        if not isinstance(fields[col], families):
            raise SchemaError(
                f"{name}.{col}: type {fields[col].simpleString()} not accepted")
    return df.select(*wanted)
