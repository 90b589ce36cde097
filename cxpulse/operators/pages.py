"""Publish payloads into a table of HTML pages.

A page may hold, per payload, a marker block
``// __M_START__ ... // __M_END__`` (replaced whole, first choice) or an
earlier declaration ``const NAME = JSON.parse(atob("..."));`` (replaced
when there is no block). Pages without an injection point stay unchanged
and report the payload as missing.

Slots are handled one after the other, and each looks at the text that the one
before it left. ``injected`` and ``missing`` hold for the final text: a slot that
another one has overwritten, before or after its own turn, is missing. Payload
texts are one row, broadcast under a size rule (``MAX_PAYLOAD_BYTES`` per slot; a
longer one fails the job, it is never cut); pages are not shuffled. Every step
is a ``transform`` over the text, so it refers to the previous text once and
the plan stays linear in the number of slots.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


MAX_PAYLOAD_BYTES = 8 * 1024 * 1024


def limited(text: Column, what: str, limit: int = MAX_PAYLOAD_BYTES) -> Column:
    """``text``, or an error if it has more than ``limit`` bytes."""
    return F.when(F.octet_length(text) <= limit, text).when(text.isNotNull(), F.raise_error(F.lit(f"{what} is over {limit} bytes")))


@dataclass(frozen=True)
class Slot:
    """One payload's injection point: marker name and JS variable name."""

    marker: str
    var: str


# The page format of marker blocks and of earlier declarations.
def block_pattern(marker: str) -> str:
    m = re.escape(marker)
    return rf"(?s)// __{m}_START__.*?// __{m}_END__"


def decl_pattern(var: str) -> str:
    return rf'const {re.escape(var)} = JSON\.parse\(atob\("[A-Za-z0-9+/=]*"\)\);'


def literal_replacement(text: Column) -> Column:
    """Escape ``\\`` and ``$`` so the text is inserted as is."""
    return F.regexp_replace(text, r"([\\$])", r"\\$1")


def _step(state: Column, slot: Slot, js: Column) -> Column:
    """struct(html, injected) after one slot."""
    html, done = state["html"], state["injected"]
    maybe = html.contains(f"// __{slot.marker}_START__") | html.contains(f"const {slot.var} = JSON.parse(atob(")
    framed = F.concat(F.lit(f"// __{slot.marker}_START__\n"), js, F.lit(f"\n// __{slot.marker}_END__"))
    struct = lambda text: F.struct(text.alias("html"), F.concat(done, F.array(F.lit(slot.marker))).alias("injected"))
    return (F.when(js.isNull() | ~maybe, state)
            .when(html.rlike(block_pattern(slot.marker)), struct(F.regexp_replace(html, block_pattern(slot.marker), literal_replacement(framed))))
            .when(html.rlike(decl_pattern(slot.var)), struct(F.regexp_replace(html, decl_pattern(slot.var), literal_replacement(js))))
            .otherwise(state))


def _slot_step(slot: Slot, js: Column):
    return lambda state: _step(state, slot, js)


def _then(value: Column, step) -> Column:
    """``step`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), step), 0)


def inject(pages: DataFrame, payloads: DataFrame, slots: Sequence[Slot]) -> DataFrame:
    """Replace each page's injection points with the payload lines.

    ``payloads``: (name, js) with ``name`` the slot's marker; of several rows of
    a name the smallest text is taken, other names are ignored. Adds ``injected``
    and ``missing`` (marker names).
    """
    texts = payloads.where(F.col("name").isin([s.marker for s in slots])).groupBy("name").agg(F.min("js").alias("js"))
    line = texts.agg(*[F.max(F.when(F.col("name") == s.marker, limited(F.col("js"), f"payload {s.marker}"))).alias(f"_js{i}") for i, s in enumerate(slots)])
    line = F.broadcast(line.withColumn("_one", F.lit(1)))  # one row, bounded by ``limited``
    out = pages.withColumn("_one", F.lit(1)).join(line, "_one").drop("_one")
    state = F.struct(F.col("html").alias("html"), F.array().cast("array<string>").alias("injected"))
    for i, s in enumerate(slots):
        state = _then(state, _slot_step(s, F.col(f"_js{i}")))
    out = out.withColumn("_state", state)
    names = F.array(*[F.lit(s.marker) for s in slots])
    # a later slot may have overwritten an earlier one: what counts is the final text
    there = [F.when(F.array_contains("_state.injected", s.marker) & F.col("_state.html").contains(F.col(f"_js{i}")), F.lit(s.marker)) for i, s in enumerate(slots)]
    out = out.withColumn("_there", F.array_compact(F.array(*there)))
    out = out.withColumns({"html": F.col("_state.html"), "injected": F.col("_there"), "missing": F.array_except(names, F.col("_there"))}).drop("_there")
    return out.drop("_state", *[f"_js{i}" for i in range(len(slots))])


def _element(tag: str, element_id: str) -> str:
    """Opening tag (group 1) of an element with this id."""
    return rf'(<{tag}\b[^>]*\bid="{re.escape(element_id)}"[^>]*>)'


def stamp_elements(html: Column, element_ids: Sequence[str], text: Column, tags: Sequence[str] = ("strong", "span")) -> Column:
    """Set the text of the elements with the given ids: for each tag that may
    carry the stamp, from its opening tag to the same tag's end."""
    fill = F.concat(F.lit("$1"), literal_replacement(text), F.lit("$2"))
    for eid in element_ids:
        for tag in tags:
            html = F.regexp_replace(html, F.lit(rf"{_element(tag, eid)}[^<]*(</{tag}>)"), fill)
    return html


def stamp_style(html: Column, style_id: str, text: Column) -> Column:
    """Set every quoted ``content`` value in every style block with the id.

    The page is split before each ``<style``; the pieces that begin with a block
    of that id are rewritten up to the block's end and put together again."""
    head = rf"(?s)^{_element('style', style_id)}(.*?)(</style>.*)$"
    value = F.concat(F.lit("$1"), literal_replacement(text), F.lit("$2"))

    def rewrite(piece: Column) -> Column:
        body = F.regexp_replace(F.regexp_extract(piece, head, 2), F.lit(r'(content\s*:\s*")[^"]*(")'), value)
        return F.when(piece.rlike(rf"(?s)^{_element('style', style_id)}.*?</style>"),
                      F.concat(F.regexp_extract(piece, head, 1), body, F.regexp_extract(piece, head, 3))).otherwise(piece)

    return _then(html, lambda h: F.when(h.contains(f'id="{style_id}"'), F.array_join(F.transform(F.split(h, "(?=<style)"), rewrite), "")).otherwise(h))
