"""Report rows to a page payload: JSON (nulls kept, ASCII only), base64,
and a ``const NAME = JSON.parse(atob("..."));`` line.

JSON is written by Spark's ``to_json``. Numbers that JSON cannot carry
natively are normalised first: DECIMAL to DOUBLE, DATE / TIMESTAMP to text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

JSON_OPTIONS = {
    "ignoreNullFields": "false",                    # keep "x": null
    "writeNonAsciiCharacterAsCodePoint": "true",    # ASCII-only text, \uXXXX escapes
}


def jsonable(df: DataFrame) -> DataFrame:
    """Top-level DECIMAL -> DOUBLE and date-likes -> ISO text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def to_json(col: Column) -> Column:
    return F.to_json(col, JSON_OPTIONS)


def base64_text(text: Column) -> Column:
    """Base64 of the UTF-8 bytes on one line (Spark may chunk with CRLF)."""
    return F.regexp_replace(F.base64(F.encode(text, "UTF-8")), r"[\r\n]", "")


def js_const(var_name: str, b64: Column) -> Column:
    return F.concat(F.lit(f'const {var_name} = JSON.parse(atob("'), b64, F.lit('"));'))


def sort_key(cols: Sequence[tuple[str, bool]]) -> Column:
    """A struct usable with ``array_sort``: numeric descending keys are
    negated; text keys must be ascending."""
    parts = []
    for i, (name, ascending) in enumerate(cols):
        c = F.col(name)
        parts.append((c if ascending else -c).alias(f"k{i}"))
    return F.struct(*parts)


def row_objects(df: DataFrame, order: Sequence[tuple[str, bool]]) -> Column:
    """Aggregate: all rows as an ordered array of structs (for ``agg``)."""
    types = dict(df.dtypes)
    for name, ascending in order:
        if not ascending and types.get(name) not in ("tinyint", "smallint", "int", "bigint",
                                                     "float", "double"):
            raise ValueError(f"descending payload order needs a numeric column: {name}")
    row = F.struct(*[F.col(c) for c in df.columns])
    arr = F.array_sort(F.collect_list(F.struct(sort_key(order).alias("k"), row.alias("r"))))
    return F.transform(arr, lambda x: x["r"])
