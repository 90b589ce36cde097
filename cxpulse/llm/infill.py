"""Fill-in-the-middle transformation of documents.

A text is cut into units (runs of ASCII letters, every other character alone) and
two hashed unit numbers split it into prefix, middle and suffix, which are then
written in another order between marks:

* ``plain``: the text as it is;
* ``psm``: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle;
* ``spm``: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle.

Cuts are found as byte places but reported as code points. A ``CharIndex`` keeps
only the multibyte characters: where each begins and how many bytes it has
beyond one. A byte place becomes a code point (and back) by a binary search among
those and a subtraction; text of ASCII alone needs no table at all.

A null text is an empty one (plain). A text that already holds a mark stays plain,
so a mark in an output is always one that was put there, and ``restored`` is exact.
Hash numbers are 8 hexadecimal digits of the SHA-256 of ``<seed>:<doc_id>``; a
null doc_id hashes as the empty text and stays null. Repeated rows give equal
results; an empty table gives an empty one; columns besides doc_id and text are
ignored. Texts are handled in chunks of a megabyte (a longer text alone).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cxpulse.llm import textnum as T
from cxpulse.llm.common import importable, table

# The marks and the shares of plain and spm texts in percent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM = 90
SPM_BELOW = 20
_LETTER = T.lut([(0x41, 0x5A), (0x61, 0x7A)])
_MARKS = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]


class CharIndex:
    """Multibyte characters of a UTF-8 buffer: first bytes and excess bytes."""

    def __init__(self, data: np.ndarray):
        self.at = np.flatnonzero(data >= 0xC0)
        lead = data[self.at]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.before = np.concatenate([np.zeros(1, np.int64), np.cumsum(excess)])  # excess bytes before the k-th
        self.char_at = self.at - self.before[:-1]

    def chars(self, places: np.ndarray) -> np.ndarray:
        """Code points before each byte place (a character's first byte, or the end)."""
        return places - self.before[np.searchsorted(self.at, places, "left")]

    def bytes(self, chars: np.ndarray) -> np.ndarray:
        """The byte place of each code point number."""
        return chars + self.before[np.searchsorted(self.char_at, chars, "left")]


def unit_starts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """First bytes of the units of adjoining texts that begin at ``starts``."""
    if not len(data):
        return np.zeros(0, np.int64)
    letter = _LETTER[data]
    begins = ~letter & ((data & 0xC0) != 0x80)
    begins |= letter
    begins[1:] &= ~(letter[1:] & letter[:-1])
    begins[starts[starts < len(data)]] = True
    return np.flatnonzero(begins)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = T.text_buffers(batch.column("text"))
        drawn = [np.asarray(batch.column(f"h{k}"), np.int64) for k in range(1, 5)]
        for lo, hi in T.chunks(offsets):
            part, at = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
            units, index = unit_starts(part, at[:-1]), CharIndex(part)
            bounds = np.searchsorted(units, at)
            n = np.diff(bounds)
            h1, h2, h3, h4 = (h[lo:hi] for h in drawn)
            first, second = h1 % (n + 1), h2 % (n + 1)
            place = np.append(units, len(part))
            cuts = [np.where(c < n, place[np.minimum(bounds[:-1] + c, len(units))], at[1:]) for c in (np.minimum(first, second), np.maximum(first, second))]
            begin, left, right = index.chars(at[:-1]), index.chars(cuts[0]), index.chars(cuts[1])
            raw = part.tobytes()
            forms, outputs = [], []
            for a, p, m, b, plain, spm in zip(at[:-1].tolist(), cuts[0].tolist(), cuts[1].tolist(), at[1:].tolist(), (h3 % 100 >= PLAIN_FROM).tolist(), (h4 % 100 < SPM_BELOW).tolist()):
                text = raw[a:b]
                if plain or not text or any(mark in text for mark in _MARKS):
                    forms.append("plain")
                    outputs.append(text)
                elif spm:
                    forms.append("spm")
                    outputs.append(b"".join((_MARKS[1], raw[m:b], _MARKS[0], raw[a:p], _MARKS[2], raw[p:m])))
                else:
                    forms.append("psm")
                    outputs.append(b"".join((_MARKS[0], raw[a:p], _MARKS[1], raw[m:b], _MARKS[2], raw[p:m])))
            plain = np.array(forms) == "plain"
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(forms, pa.string()),
                 pa.array(left - begin, pa.int64(), mask=plain), pa.array(right - left, pa.int64(), mask=plain), pa.array(outputs, pa.binary()).cast(pa.string())],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def infill(docs: DataFrame, seed: str = "1") -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (code points; null if
    plain), output."""
    importable(docs.sparkSession)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), digest.alias("digest"))
    drawn = [F.conv(F.substring("digest", 8 * k - 7, 8), 16, 10).cast("long").alias(f"h{k}") for k in range(1, 5)]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "text", *drawn).mapInArrow(_cut, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that ``infill`` was given."""
    after = lambda text, mark: F.substring(text, F.instr(text, F.lit(mark)) + len(mark), F.length(text))
    upto = lambda text, mark: F.substring(text, F.lit(1), F.instr(text, F.lit(mark)) - 1)
    last = after(output, MIDDLE)
    psm = F.concat(upto(after(output, PREFIX), SUFFIX), last, upto(after(output, SUFFIX), MIDDLE))
    spm = F.concat(upto(after(output, PREFIX), MIDDLE), last, upto(after(output, SUFFIX), PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op12_infill(spark, sf_dir: str) -> DataFrame:
    done = infill(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.encode("output", "UTF-8"), 256).alias("output_sha256"),
                       F.sha2(F.encode(restored(F.col("output"), F.col("form")), "UTF-8"), 256).alias("restored_sha256"))


SQL = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents),
h AS (
  SELECT *, len(u) AS n, ('0x' || d[1:8])::BIGINT AS h1, ('0x' || d[9:16])::BIGINT AS h2, ('0x' || d[17:24])::BIGINT AS h3, ('0x' || d[25:32])::BIGINT AS h4 FROM t),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
         WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (
  SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""
