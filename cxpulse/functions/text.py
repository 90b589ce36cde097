"""Sentence templates rendered as Spark expressions.

A template is plain text with ``{name}`` placeholders; ``render`` turns it
into one ``concat`` over literals and columns, evaluated on the executors.
Numbers print as ``CAST(x AS STRING)``: for doubles that is ``24.0`` /
``-3.5`` (the same as Python's ``str(float)`` below 1e7), for integers the
plain digits.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

_FIELD = re.compile(r"\{([A-Za-z_][A-Za-z0-9_]*)\}")


def render(template: str, values: Mapping[str, Column]) -> Column:
    """Render ``template`` with the given columns (NULL stays NULL)."""
    parts: list[Column] = []
    pos = 0
    for m in _FIELD.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        name = m.group(1)
        if name not in values:
            raise KeyError(f"template field {name!r} has no value")
        parts.append(values[name].cast("string"))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    if not parts:
        return F.lit("")
    return F.concat(*parts)
