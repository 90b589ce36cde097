"""Repeated passages by enhanced suffix arrays over anchor buckets.

A byte is removed when a string of ``LENGTH`` bytes that covers it also starts
earlier (smaller doc_id, or same document and earlier start).

* Anchors. Every ``LENGTH``-byte window selects the smallest hash of its
  ``GRAM``-byte substrings (leftmost on ties). Equal windows select the same
  place, so all copies of a window meet in the bucket of one anchor; about
  one position in forty is an anchor. An anchor's context is what the windows
  around it cover: up to ``BEFORE`` bytes before and ``LENGTH`` from it.
* Buckets are sorted by (anchor, context hash, doc_id, start). Occurrences with
  equal contexts form a class: all but the first repeat their whole context.
* Buckets with several classes get a suffix array over the contexts of the
  classes' first occurrences, with longest common prefixes. A stack scan over
  them walks the common-prefix interval tree; an interval of ``LENGTH``
  or more whose suffixes are preceded by different bytes is a maximal repeat;
  its occurrences are a slice of the array. Intervals with one preceding byte
  are the same repeat seen a byte later. For removal, an occurrence counts in the
  innermost interval that holds an earlier one, so the scan is linear.
* Anchors in ``HOT_SHARE`` of all documents or more (found by a pass over all
  documents; at most about 80 / (HOT_SHARE / 2) hashes), and buckets of over
  ``MOST`` classes, would be long work for one task. The windows that select
  them are compared one by one instead: hashed to 128 bits, settled within a batch
  of documents first, then the first start per window by a partial aggregate,
  joined back. The result is the same; nothing is dropped.
* ``repeats`` lists the maximal repeats of such buckets by aggregates over the
  prefixes of their suffixes: the nodes of the same interval tree, found without
  a task that holds the bucket.

Texts travel compressed. Contexts of one class are equal by 128 bits of hash,
everything else is compared byte by byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from cxpulse.llm import textnum as T
from cxpulse.llm.common import materialise, table

LENGTH = 100
GRAM = 24
BEFORE = LENGTH - GRAM
HOT_SHARE = 0.01
MOST = 2048
SUFFIXES = 100_000  # suffixes sorted at a time, unless one bucket has more
_SEGMENT = 1 << 20
_PLACE = np.uint64((1 << 22) - 1)
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
SPAN, WINDOW, CONTEXT = 1, 2, 3  # kinds of rows


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position."""
    n = len(data) - GRAM + 1
    words = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), strides=(1,))
    return T.mix64(words[:n] * _C[0] + words[8:8 + n] * _C[1] + words[16:16 + n] * _C[2])


def _selected(data: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """(place from ``lo`` that each window start in [lo, hi) selects, hash of the
    GRAM bytes from each place)."""
    h = _gram_hashes(data[lo:hi + LENGTH - 1])
    v = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    span = 1
    while 2 * span <= BEFORE + 1:
        v = np.minimum(v[:-span], v[span:])
        span *= 2
    rest = BEFORE + 1 - span
    v = np.minimum(v[:-rest], v[rest:]) if rest else v
    return (v & _PLACE).astype(np.int64), h


def anchors(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the anchors of the adjoining texts data[at[k]:at[k + 1]]."""
    places, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    row_end = at[1:]
    for lo in range(0, max(0, len(data) - LENGTH + 1), _SEGMENT):
        hi = min(lo + _SEGMENT, len(data) - LENGTH + 1)  # window starts [lo, hi)
        place, h = _selected(data, lo, hi)
        end = row_end[np.searchsorted(row_end, np.arange(lo, hi), "right")]
        chosen = np.unique(place[np.arange(lo, hi) + LENGTH <= end])
        places.append(chosen + lo)
        hashes.append(h[chosen])
    places, first = np.unique(np.concatenate(places), return_index=True)
    return places, np.concatenate(hashes)[first]


def _windows_of(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Starts of the windows of one text that select one of ``places``."""
    found = [np.zeros(0, np.int64)]
    for lo in range(0, max(0, len(data) - LENGTH + 1), _SEGMENT):
        hi = min(lo + _SEGMENT, len(data) - LENGTH + 1)
        place, _ = _selected(data, lo, hi)
        found.append(np.flatnonzero(np.isin(place + lo, places)) + lo)
    return np.concatenate(found)


def _window_hashes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hash of the ``LENGTH`` bytes from each start. Every 8 bytes are mixed in
    before the next are read, so it has nothing in common with ``span_hashes``."""
    words = np.ndarray((max(0, len(data) - 7),), "<u8", np.ascontiguousarray(data), strides=(1,))
    h = np.full(len(starts), LENGTH, np.uint64)
    for k in [*range(0, LENGTH - 7, 8), LENGTH - 8]:
        h = T.mix64((h ^ words[starts + k]) * _C[0] + _C[1])
    return h


def _anchor_rows(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each chunk: (row in batch, start in text, hash, context hash) of its anchors."""
    data, offsets = T.text_buffers(column)
    for lo, hi in T.chunks(offsets):
        part = data[offsets[lo]:offsets[hi]]
        at = offsets[lo:hi + 1] - offsets[lo]
        places, h = anchors(part, at)
        if not len(places):
            continue
        row = np.searchsorted(at, places, "right") - 1
        left, right = np.minimum(places - at[row], BEFORE), np.minimum(at[row + 1] - places, LENGTH)
        c = T.mix64(T.span_hashes(part, places - left, places + right) + left.astype(np.uint64) * _C[0] + right.astype(np.uint64) * _C[1])
        yield row + lo, places - at[row], h, c


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, documents) of the anchors in HOT_SHARE / 2 of a task's documents
    or more: what is in HOT_SHARE of all documents keeps half its count at least."""
    seen: list[np.ndarray] = []
    docs = 0
    for batch in batches:
        docs += len(batch)
        for row, _, h, _ in _anchor_rows(batch.column("text")):
            order = np.lexsort((h, row))
            row, h = row[order], h[order]
            new = np.ones(len(h), bool)
            new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])  # once per document
            seen.append(h[new])
    h, n = np.unique(np.concatenate(seen), return_counts=True) if seen else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    often = n >= max(2, docs * HOT_SHARE / 2)
    yield pa.RecordBatch.from_arrays([pa.array(h[often].view(np.int64)), pa.array(n[often].astype(np.int64))], names=["h", "n"])


def hot_anchors(docs: DataFrame) -> np.ndarray:
    total = docs.count()
    counts = docs.select("text").mapInArrow(_frequent, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    hot = counts.filter(F.col("n") >= max(MOST, total * HOT_SHARE / 2)).toArrow()
    return np.sort(hot.column("h").to_numpy().view(np.uint64)) if len(hot) else np.zeros(0, np.uint64)


def _anchor_batches(hot: np.ndarray):
    """Rows (key, c, doc_id, start, kind) of a batch's anchors; kind 0 goes to its
    bucket. A context seen before in the batch is settled (SPAN, on a key of its
    own); the others of a hot anchor are keyed by their context too (WINDOW)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = list(_anchor_rows(batch.column("text")))
            if not parts:
                continue
            row, start, h, c = (np.concatenate(x) for x in zip(*parts))
            doc = batch.column("doc_id").to_numpy()[row]
            order = np.lexsort((start, doc, c, h))
            start, h, c, doc = start[order], h[order], c[order], doc[order]
            kind = np.zeros(len(h), np.int32)
            same = (h[1:] == h[:-1]) & (c[1:] == c[:-1])
            kind[1:][same] = SPAN
            again = np.zeros(len(h), bool)
            again[1:] = same & (doc[1:] == doc[:-1]) & (start[1:] == start[:-1])
            if len(hot):
                at = np.minimum(np.searchsorted(hot, h), len(hot) - 1)
                kind[(hot[at] == h) & (kind == 0)] = WINDOW
            own = np.where(kind == WINDOW, c, doc.astype(np.uint64) * _C[0] + start.astype(np.uint64) * _C[1])
            key = np.where(kind == 0, h, T.mix64(h + own * _C[2]))
            keep = ~again
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[keep].view(np.int64)), pa.array(c[keep].view(np.int64)), pa.array(doc[keep]), pa.array(start[keep].astype(np.int32)), pa.array(kind[keep])],
                names=["key", "c", "doc_id", "start", "kind"])
    return run


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (kind, key, doc_id, start) from rows sorted by (key, kind, c, doc_id,
    start): SPAN for occurrences of a class after its first; the first ones of a
    bucket with several classes as CONTEXT, and as WINDOW too beyond MOST. A hot
    anchor's classes are apart already; their first ones stay WINDOW."""
    key = c = None
    last: tuple | None = None
    firsts: list[tuple] = []  # of the bucket; no more than MOST + 1 are held
    n = 0
    out: list[tuple] = []
    before = (0, 0, -1, -1)  # key, c, doc_id, start of the last WINDOW row

    for batch in batches:
        keys, cs, docs, starts, kinds = (batch.column(x).to_numpy() for x in ("key", "c", "doc_id", "start", "kind"))
        # a key of one row only, whose neighbours in the batch differ, repeats nowhere
        lone = np.zeros(len(keys), bool)
        if len(keys) > 2:
            lone[1:-1] = (keys[1:-1] != keys[:-2]) & (keys[1:-1] != keys[2:]) & (kinds[1:-1] == 0)
        hot = np.flatnonzero(kinds == WINDOW)
        if len(hot):
            k, cc, d, s = (np.concatenate([[before[i]], x[hot]]) for i, x in enumerate((keys, cs, docs, starts)))
            before = (k[-1], cc[-1], d[-1], s[-1])
            same = (k[1:] == k[:-1]) & (cc[1:] == cc[:-1])
            kinds = kinds.copy()
            kinds[hot[same]] = SPAN
            kinds[hot[same & (d[1:] == d[:-1]) & (s[1:] == s[:-1])]] = -1  # the same place again
        settled = np.flatnonzero(~lone & (kinds > 0))
        if len(settled):
            yield pa.RecordBatch.from_arrays([pa.array(kinds[settled]), pa.array(keys[settled]), pa.array(docs[settled]), pa.array(starts[settled])], names=["kind", "key", "doc_id", "start"])
        todo = np.flatnonzero(~lone & (kinds == 0))
        for k, cc, d, s in zip(keys[todo].tolist(), cs[todo].tolist(), docs[todo].tolist(), starts[todo].tolist()):
            if k != key:
                key, c, n, last, firsts = k, cc, 1, (d, s), [(d, s)]
                continue
            if cc == c:
                if (d, s) != last:
                    out.append((SPAN, k, d, s))
                    last = (d, s)
                continue
            c, last, n = cc, (d, s), n + 1
            if n <= MOST:
                firsts.append((d, s))
                if n == 2:
                    out.append((CONTEXT, k, *firsts[0]))
                out.append((CONTEXT, k, d, s))
            else:
                out += [(WINDOW, k, *x) for x in firsts]
                firsts = []
                out.append((WINDOW, k, d, s))
        if out:
            yield _rows(out)
            out = []


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kind, key, doc, start = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(key, pa.int64()), pa.array(doc, pa.int64()), pa.array(start, pa.int32())], names=["kind", "key", "doc_id", "start"])


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    z = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        data, offsets = T.text_buffers(batch.column("text"))
        packed = [z.compress(data[offsets[k]:offsets[k + 1]].tobytes()) for k in range(len(batch))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(packed, pa.binary())], names=["doc_id", "packed"])


_FETCHED = "kind int, key long, key2 long, doc_id long, start int, before int, context binary"
_HELD = 1_000_000  # windows settled at a time


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts (CONTEXT) and windows (WINDOW) of the wanted places of each text.

    Of a window that several texts at hand hold only the first goes out; the
    others are settled (SPAN; ``before`` has its length)."""
    z = zstandard.ZstdDecompressor()
    for batch in batches:
        held: list[tuple] = []
        size = 0
        wanted = batch.column("wanted")
        bounds = wanted.offsets.to_numpy()
        kinds, keys, starts = (wanted.values.field(c).to_numpy() for c in ("kind", "key", "start"))
        out: list[tuple] = []
        for k, (doc_id, packed) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("packed").to_pylist())):
            text = z.decompress(packed)
            own = slice(bounds[k], bounds[k + 1])
            kind, key, start = kinds[own], keys[own], starts[own]
            place, which = np.unique(start[kind == CONTEXT], return_index=True)  # rows that repeat a doc_id bring a place twice
            out += [(h, doc_id, s, min(s, BEFORE), text[s - min(s, BEFORE):s + LENGTH]) for s, h in zip(place.tolist(), key[kind == CONTEXT][which].tolist())]
            if len(out) >= 20_000:
                yield _contexts(out)
                out = []
            hot = np.unique(start[kind == WINDOW]).astype(np.int64)
            if len(hot):
                data = np.frombuffer(text, np.uint8)
                s = _windows_of(data, hot)
                held.append((T.span_hashes(data, s, s + LENGTH), _window_hashes(data, s), np.full(len(s), doc_id), s))
                size += len(s)
                if size >= _HELD:
                    yield from _settle(held)
                    held, size = [], 0
        if out:
            yield _contexts(out)
        if held:
            yield from _settle(held)


def _contexts(rows: list[tuple]) -> pa.RecordBatch:
    key, doc_id, start, before, context = zip(*rows)
    return _fetched([CONTEXT] * len(rows), key, [0] * len(rows), doc_id, start, before, context)


def _settle(held: list[tuple]) -> Iterator[pa.RecordBatch]:
    k1, k2, doc, start = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((start, doc, k2, k1))
    k1, k2, doc, start = k1[order], k2[order], doc[order], start[order]
    again = np.zeros(len(k1), bool)
    again[1:] = (k1[1:] == k1[:-1]) & (k2[1:] == k2[:-1])
    n = int((~again).sum())
    yield _fetched([WINDOW] * n, k1[~again].view(np.int64), k2[~again].view(np.int64), doc[~again], start[~again], [0] * n, [None] * n)
    doc, start, length = _merged(doc[again], start[again], np.full(int(again.sum()), LENGTH))
    n = len(doc)
    yield _fetched([SPAN] * n, [0] * n, [0] * n, doc, start, length, [None] * n)


def _merged(doc: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping and touching spans of a document as one."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], (start + length)[order]
    if not len(doc):
        return doc, start, end
    group = np.concatenate([[0], np.cumsum(doc[1:] != doc[:-1])])
    reach = int(end.max()) + 1
    furthest = np.maximum.accumulate(end + group * reach) - group * reach  # furthest end so far in the document
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > furthest[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], start[first], furthest[last] - start[first]


def _fetched(kind, key, key2, doc_id, start, before, context) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(kind, pa.int32()), pa.array(key, pa.int64()), pa.array(key2, pa.int64()), pa.array(doc_id, pa.int64()), pa.array(start, pa.int32()), pa.array(before, pa.int32()), pa.array(context, pa.binary())],
        names=["kind", "key", "key2", "doc_id", "start", "before", "context"])


def _selecting(text: np.ndarray, size: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last window start of each context (a row of ``text``) that
    selects its anchor: no GRAM hash as small before it, none smaller after it."""
    n = text.shape[1] // 2
    words = np.ndarray((len(text), n), "<u8", np.ascontiguousarray(text), strides=(text.shape[1], 1))
    m = n - 16
    h = T.mix64(words[:, :m] * _C[0] + words[:, 8:8 + m] * _C[1] + words[:, 16:16 + m] * _C[2]) & ~_PLACE
    at, own = np.arange(m)[None, :], np.take_along_axis(h, anchor[:, None], 1)
    inside = at + GRAM <= size[:, None]
    left = np.where((h <= own) & (at < anchor[:, None]), at, -1).max(axis=1)
    right = np.where((h < own) & (at > anchor[:, None]) & inside, at, m + LENGTH).min(axis=1)
    return np.maximum(left + 1, 0), np.minimum(np.minimum(right - BEFORE - 1, anchor), size - LENGTH)


class SuffixArray:
    """Enhanced suffix array over contexts: suffixes of ``least`` bytes or more in
    order, within their bucket (a number per context), and what neighbours
    have in common. ``origin``: (document, first byte) of each context; ``anchor``:
    its anchor's place. With it only suffixes whose first window selects the anchor
    are kept (a stretch of starts; equal windows select alike), else all.
    """

    def __init__(self, contexts: list[bytes], buckets: list[int], origin: list[tuple[int, int]], anchor: list[int] | None = None, least: int = LENGTH):
        self.least = least
        size = np.array([len(c) for c in contexts])
        width = int(size.max(initial=0))
        padded = np.zeros((len(contexts), 4 + 2 * width), np.uint8)
        padded[:, 4:4 + width] = np.frombuffer(b"".join(c.ljust(width, b"\0") for c in contexts), np.uint8).reshape(len(contexts), width)
        lowest, highest = np.zeros(len(contexts), np.int64), size - least
        if anchor is not None and width >= least:
            lowest, highest = _selecting(padded[:, 4:], size, np.array(anchor))
        count = np.maximum(0, highest - lowest + 1)
        self.owner = np.repeat(np.arange(len(contexts)), count)
        self.offset = np.arange(len(self.owner)) - np.repeat(np.cumsum(count) - count - lowest, count)
        _, document = np.unique([d for d, _ in origin], return_inverse=True)
        start = np.array([b for _, b in origin], np.int64)
        self.place = (document * (int(start.max(initial=0)) + width + 1) + start)[self.owner] + self.offset  # order in the corpus
        suffix = np.empty((len(self.owner), 4 + width), np.uint8)
        suffix[:, :4] = np.asarray(buckets, ">u4")[self.owner].view(np.uint8).reshape(-1, 4)
        suffix[:, 4:] = np.lib.stride_tricks.as_strided(padded[:, 4:], (len(contexts), width + 1, width), (padded.strides[0], 1, 1))[self.owner, self.offset]
        if any(b"\0" in c for c in contexts):  # what ends comes before what goes on with a zero byte
            by_size = np.argsort(size[self.owner] - self.offset, kind="stable")
            self.array = by_size[np.argsort(suffix[by_size].view(f"S{4 + width}").ravel(), kind="stable")]
        else:
            self.array = np.argsort(suffix.view(f"S{4 + width}").ravel(), kind="stable")
        left = (size[self.owner] - self.offset)[self.array]
        ordered = suffix[self.array]
        differ = ordered[1:] != ordered[:-1]
        common = np.where(differ.any(axis=1), differ.argmax(axis=1), 4 + width) - 4
        self.common = np.minimum(common, np.minimum(left[1:], left[:-1]))
        # a code per preceding byte; the first suffix of a context has a code of its own,
        # for the one before it is in another anchor's context
        before = padded[self.owner, 4 + np.maximum(self.offset - 1, 0)].astype(np.int64)
        self.preceding = np.where(self.offset > lowest[self.owner], before, 256 + self.owner)[self.array]

    def maximal_repeats(self) -> Iterator[tuple[int, int, int, list[int]]]:
        """(length, first, last, again): the repeat's occurrences are the suffixes
        ``array[first:last + 1]``; ``again`` are those of them (as indices into
        ``array``) that start earlier in this repeat but in none inside it."""
        if not len(self.array):
            return
        joined = self.common >= self.least
        edges = np.flatnonzero(np.diff(np.concatenate([[False], joined, [False]]).astype(np.int8)))
        # per stretch of suffixes that share ``least`` bytes: is any preceded by another byte?
        change = np.concatenate([[0], np.cumsum(self.preceding[1:] != self.preceding[:-1])])
        lows, highs = edges[::2], edges[1::2]
        diverse = change[highs] != change[lows]
        place = self.place[self.array]
        for lo, hi in zip(lows[diverse].tolist(), highs[diverse].tolist()):
            common, changes, places = self.common[lo:hi].tolist(), change[lo:hi + 1].tolist(), place[lo:hi + 1].tolist()
            stack: list[tuple[int, int, list[int]]] = []  # (length, first suffix, suffixes not yet settled) of the open intervals
            for k in range(hi - lo + 1):
                depth = common[k] if k < hi - lo else -1
                first, open_ = k, [k]
                while stack and stack[-1][0] > depth:
                    length, first, rest = stack.pop()
                    rest += open_
                    earliest = min(rest, key=places.__getitem__)
                    if changes[k] != changes[first]:  # preceded by different bytes: maximal
                        yield length, lo + first, lo + k, [lo + x for x in rest if places[x] != places[earliest]]
                    open_ = [earliest]
                if stack and stack[-1][0] == depth:
                    stack[-1][2].extend(open_)
                elif depth >= 0:
                    stack.append((depth, first, open_))


def _arrays(batches: Iterator[pa.RecordBatch], *more: str) -> Iterator[tuple[SuffixArray, list[tuple]]]:
    """Suffix arrays of whole buckets, from CONTEXT rows sorted by key, and the
    rows (key, doc_id, start, before, context, further columns)."""
    def build(rows: list[tuple]) -> tuple[SuffixArray, list[tuple]]:
        keys = {k: n for n, k in enumerate(dict.fromkeys(r[0] for r in rows))}
        return SuffixArray([r[4] for r in rows], [keys[r[0]] for r in rows], [(r[1], r[2] - r[3]) for r in rows], [r[3] for r in rows]), rows

    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("key", "doc_id", "start", "before", "context", *more))):
            if held and held[-1][0] != row[0] and len(held) * BEFORE >= SUFFIXES:
                yield build(held)
                held = []
            held.append(row)
    if held:
        yield build(held)


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, c, doc_id, start) of all anchors."""
    for batch in batches:
        for row, start, h, c in _anchor_rows(batch.column("text")):
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.view(np.int64)), pa.array(batch.column("doc_id").to_numpy()[row]), pa.array(start.astype(np.int32))], names=["key", "c", "doc_id", "start"])


_FIRSTS = "kind int, key long, c long, n long, doc_id long, start int, before int, context binary"


def _first_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wanted classes of each text with their context."""
    z = zstandard.ZstdDecompressor()
    for batch in batches:
        out: list[tuple] = []
        for doc_id, packed, wanted in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "packed", "wanted"))):
            text = z.decompress(packed)
            for w in wanted:
                before = min(w["start"], BEFORE)
                out.append((w["kind"], w["key"], w["c"], w["n"], doc_id, w["start"], before, text[w["start"] - before:w["start"] + LENGTH]))
            if len(out) >= 20_000:
                yield _first_rows(out)
                out = []
        if out:
            yield _first_rows(out)


def _first_rows(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["kind", "key", "c", "n", "doc_id", "start", "before", "context"])


_GROUPS = "repeat string, length int, key long, c long, shift int"
_WINDOWS = "repeat string, key long, c long, at int"
_PREFIXES = f"{_GROUPS}, following int, preceding int"


def _name(repeat: bytes) -> str:
    return hashlib.blake2b(repeat, digest_size=16).hexdigest()


_TYPES = {"repeat": pa.string(), "key": pa.int64(), "c": pa.int64()}  # the other columns are ints


def _named(rows: list[tuple], *names: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES.get(n, pa.int32())) for c, n in zip(zip(*rows), names)], names=list(names))


def _group_rows(rows: list[tuple]) -> pa.RecordBatch:
    return _named(rows, "repeat", "length", "key", "c", "shift")


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(repeat, length, key, c, shift) of the maximal repeats among the classes of
    a bucket: each occurrence of class (key, c) has the repeat ``shift`` bytes from
    its anchor."""
    for found, rows in _arrays(batches, "c"):
        out: list[tuple] = []
        for length, first, last, _ in found.maximal_repeats():
            which = found.array[first:last + 1]
            name = None
            for k, o in zip(found.owner[which].tolist(), found.offset[which].tolist()):
                key, _, _, before, context, c = rows[k]
                name = _name(context[o:o + length]) if name is None else name
                out.append((name, length, key, c, o - before))
            if len(out) >= 20_000:
                yield _group_rows(out)
                out = []
        if out:
            yield _group_rows(out)


def _selecting_rows(batches: Iterator[pa.RecordBatch], *more: str) -> Iterator[list[tuple]]:
    """Lists of (key, c, before, context, further columns, first and last window
    start that selects the anchor) of the classes at hand."""
    for batch in batches:
        for at in range(0, len(batch), 500):
            rows = list(zip(*(batch.column(c).slice(at, 500).to_pylist() for c in ("key", "c", "before", "context", *more))))
            size = np.array([len(r[3]) for r in rows])
            width = int(size.max())
            padded = np.frombuffer(b"".join(r[3].ljust(2 * width, b"\0") for r in rows), np.uint8).reshape(len(rows), 2 * width)
            lowest, highest = _selecting(padded, size, np.array([r[2] for r in rows]))
            yield [(*r, lo, hi) for r, lo, hi in zip(rows, lowest.tolist(), highest.tolist())]


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each class holds by itself, as in ``_shared``: all from the first window
    that selects the anchor on."""
    for rows in _selecting_rows(batches):
        out = [(_name(context[lo:]), len(context) - lo, key, c, lo - before) for key, c, before, context, lo, hi in rows if lo <= hi]
        if out:
            yield _group_rows(out)


def _class_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(repeat, key, c, at) of each window that selects the class's anchor."""
    for rows in _selecting_rows(batches):
        out = [(_name(context[o:o + LENGTH]), key, c, o) for key, c, _, context, lo, hi in rows for o in range(lo, hi + 1)]
        if out:
            yield _named(out, "repeat", "key", "c", "at")


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``_shared`` for every string of ``LENGTH`` bytes or more from the places
    ``at`` of a class on, with the byte that follows it (-1: the context ends) and
    the one that precedes it (-1: that window is in another anchor's context)."""
    for rows in _selecting_rows(batches, "at"):
        out: list[tuple] = []
        for key, c, before, context, places, lo, _ in rows:
            for o in places:
                preceding = context[o - 1] if o > lo else -1
                for end in range(o + LENGTH, len(context) + 1):
                    following = context[end] if end < len(context) else -1
                    out.append((_name(context[o:end]), end - o, key, c, o - before, following, preceding))
            if len(out) >= 20_000:
                yield _named(out, "repeat", "length", "key", "c", "shift", "following", "preceding")
                out = []
        if out:
            yield _named(out, "repeat", "length", "key", "c", "shift", "following", "preceding")


def _wide(firsts: DataFrame) -> DataFrame:
    """``_shared`` for buckets of any number of classes, none of them held whole.

    A string is an interval of the common-prefix tree if two suffixes go on from
    it with different bytes or one ends; it is maximal if they are preceded by
    different bytes. Both are minima and maxima per string, added up task by task.
    Only places whose window occurs twice are looked at: at most 77 places of a
    class and, for each, 77 lengths."""
    windows = firsts.select("key", "c", "before", "context").mapInArrow(_class_windows, _WINDOWS)
    several = windows.groupBy("repeat").agg(F.count("*").alias("n")).filter("n > 1").select("repeat")
    places = windows.join(several, "repeat", "left_semi").groupBy("key", "c").agg(F.collect_list("at").alias("at"))
    held = materialise(firsts.select("key", "c", "before", "context").join(places, ["key", "c"]), "repeat-wide")
    prefixes = held.mapInArrow(_prefixes, _PREFIXES)
    ends = prefixes.groupBy("repeat", "length").agg(
        F.count("*").alias("n"), *(f(c).alias(f"{f.__name__}_{c}") for c in ("following", "preceding") for f in (F.min, F.max)))
    apart = " AND ".join(f"(min_{c} = -1 OR min_{c} < max_{c})" for c in ("following", "preceding"))
    maximal = ends.filter(f"n > 1 AND {apart}").select("repeat", "length")
    return prefixes.drop("following", "preceding").join(maximal, ["repeat", "length"], "left_semi")


def _later_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, start, length) of the occurrences that start earlier elsewhere too."""
    for found, rows in _arrays(batches):
        at: list[int] = []
        lengths: list[int] = []
        for length, _, _, again in found.maximal_repeats():
            at += again
            lengths += [length] * len(again)
        which = found.array[np.array(at, np.int64)]
        doc, start, before = (np.array(x, np.int64) for x in zip(*((r[1], r[2], r[3]) for r in rows)))
        owner = found.owner[which]
        spans = _merged(doc[owner], start[owner] - before[owner] + found.offset[which], np.array(lengths, np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(spans[0]), pa.array(spans[1].astype(np.int32)), pa.array(spans[2].astype(np.int32))], names=["doc_id", "start", "length"])


def _found(docs: DataFrame, packed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(classes: SPAN rows of ``_classes``, fetched: rows of ``_fetch``)."""
    rows = docs.mapInArrow(_anchor_batches(hot_anchors(docs)), "key long, c long, doc_id long, start int, kind int")
    sorted_rows = rows.repartition("key").sortWithinPartitions("key", "kind", "c", "doc_id", "start")
    found = materialise(sorted_rows.mapInArrow(_classes, "kind int, key long, doc_id long, start int"), "repeat-classes")
    wanted = found.filter(F.col("kind") != SPAN).groupBy("doc_id").agg(F.collect_list(F.struct("kind", "key", "start")).alias("wanted"))
    fetched = packed.join(wanted.withColumnRenamed("doc_id", "w").hint("shuffle_hash"), F.col("doc_id") == F.col("w")).select("doc_id", "packed", "wanted")
    return found.filter(F.col("kind") == SPAN), materialise(fetched.mapInArrow(_fetch, _FETCHED), "repeat-contexts")


def _buckets(fetched: DataFrame) -> DataFrame:
    contexts = fetched.filter(F.col("kind") == CONTEXT).select("key", "doc_id", "start", "before", "context")
    return contexts.repartition("key").sortWithinPartitions("key")


def repeats(docs: DataFrame) -> DataFrame:
    """All occurrences (repeat, length, doc_id, start) of the maximal repeats of
    ``LENGTH`` bytes or more, within the reach of a context (longer ones come as
    overlapping parts). ``repeat`` is a hash of the repeated bytes.

    Repeats are found among the classes of equal contexts and then carried over to
    all occurrences of each class; what a class of several occurrences repeats by
    itself is a group too. ``MOST`` only decides which buckets one task sorts and
    which ones are aggregated; the result is the same. A doc_id names one document,
    of which a place occurs once; rows without one take no part.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id IS NOT NULL")
    places = materialise(docs.mapInArrow(_places, "key long, c long, doc_id long, start int").distinct(), "repeat-places")
    classes = places.groupBy("key", "c").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "start")).alias("f"))
    buckets = classes.groupBy("key").agg(F.count("*").alias("classes"), F.sum("n").alias("places")).filter("places > 1").select("key", "classes")
    kind = F.when(F.col("classes") == 1, SPAN).when(F.col("classes") <= MOST, CONTEXT).otherwise(WINDOW)
    wanted = classes.join(buckets, "key").groupBy(F.col("f.doc_id").alias("w")).agg(F.collect_list(F.struct(kind.alias("kind"), "key", "c", "n", F.col("f.start").alias("start"))).alias("wanted"))
    packed = docs.mapInArrow(_compress, "doc_id long, packed binary")
    found = packed.join(wanted.hint("shuffle_hash"), F.col("doc_id") == F.col("w")).select("doc_id", "packed", "wanted")
    firsts = materialise(found.mapInArrow(_first_contexts, _FIRSTS).dropDuplicates(["key", "c"]), "repeat-firsts")

    contexts = firsts.filter(F.col("kind") == CONTEXT).repartition("key").sortWithinPartitions("key")
    alone = firsts.filter("n > 1").select("key", "c", "before", "context").mapInArrow(_own, _GROUPS)
    groups = contexts.mapInArrow(_shared, _GROUPS).union(alone).union(_wide(firsts.filter(F.col("kind") == WINDOW))).distinct()
    return groups.join(places, ["key", "c"]).select("repeat", "length", "doc_id", (F.col("start") + F.col("shift")).alias("start"))


def repeated_spans(docs: DataFrame, packed: DataFrame) -> DataFrame:
    """(doc_id, start, length) of repeats that start earlier elsewhere too; they
    may overlap, and together they cover every byte to remove."""
    found, fetched = _found(docs, packed)
    later = _buckets(fetched).mapInArrow(_later_spans, "doc_id long, start int, length int")
    windows = fetched.filter(F.col("kind") == WINDOW).select("key", "key2", "doc_id", "start")
    firsts = windows.groupBy("key", "key2").agg(F.min(F.struct("doc_id", "start")).alias("f"), F.count("*").alias("n")).filter("n > 1").select("key", "key2", "f")
    again = windows.join(firsts, ["key", "key2"]).filter((F.col("doc_id") != F.col("f.doc_id")) | (F.col("start") != F.col("f.start")))
    classes = found.select("doc_id", F.greatest(F.col("start") - BEFORE, F.lit(0)).alias("start"), (F.least(F.col("start"), F.lit(BEFORE)) + LENGTH).alias("length"))
    settled = fetched.filter(F.col("kind") == SPAN).select("doc_id", "start", F.col("before").alias("length"))
    return classes.union(later).union(settled).union(again.select("doc_id", "start", F.lit(LENGTH).alias("length")))


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    z = zstandard.ZstdDecompressor()
    for batch in batches:
        out = []
        for doc_id, packed, starts, lengths in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "packed", "starts", "lengths"))):
            data = np.frombuffer(z.decompress(packed), np.uint8)
            if starts:
                depth = np.zeros(len(data) + 1, np.int32)
                s = np.array(starts)
                np.add.at(depth, s, 1)
                np.add.at(depth, np.minimum(s + np.array(lengths), len(data)), -1)
                gone = np.cumsum(depth[:-1]) > 0
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
                out.append((doc_id, len(data), int(gone.sum()), spans, data[~gone].tobytes()))
            else:
                out.append((doc_id, len(data), 0, 0, data.tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in out], pa.int64()), *(pa.array([r[k] for r in out], pa.int64()) for k in (1, 2, 3)), pa.array([hashlib.sha256(r[4]).hexdigest() for r in out], pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Texts are UTF-8 bytes, null is empty; texts under ``LENGTH`` bytes keep all.
    A doc_id names one document: rows that repeat it are not copies of each
    other. Rows without doc_id take no part and keep all. An empty table gives an
    empty result; further columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    packed = docs.mapInArrow(_compress, "doc_id long, packed binary")
    spans = repeated_spans(docs.filter("doc_id IS NOT NULL"), packed)
    per_doc = spans.groupBy(F.col("doc_id").alias("s")).agg(F.collect_list("start").alias("starts"), F.collect_list("length").alias("lengths"))
    joined = packed.join(per_doc.hint("shuffle_hash"), F.col("doc_id") == F.col("s"), "left").select("doc_id", "packed", "starts", "lengths")
    return joined.mapInArrow(_remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op3_remove_repeats(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


SQL = """
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, pos, md5(substr(h, 2 * pos + 1, 200)) AS k FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS pos FROM b)),
again AS (SELECT doc_id, pos FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, pos) AS n FROM w) WHERE n > 1),
g AS (
  SELECT doc_id, pos, sum(new) OVER (PARTITION BY doc_id ORDER BY pos) AS run
  FROM (SELECT *, CASE WHEN pos > lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 100 THEN 1 ELSE 0 END AS new FROM again)),
spans AS (SELECT doc_id, run, min(pos) AS a, max(pos) + 100 AS z FROM g GROUP BY doc_id, run),
pieces AS (
  SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS f, a AS t FROM spans
  UNION ALL SELECT doc_id, max(z) AS f, NULL AS t FROM spans GROUP BY doc_id),
kept AS (
  SELECT p.doc_id, string_agg(substr(h, 2 * f + 1, CASE WHEN t IS NULL THEN length(h) ELSE 2 * (t - f) END), '' ORDER BY f) AS h
  FROM pieces p JOIN b ON b.doc_id = p.doc_id GROUP BY p.doc_id),
counts AS (SELECT doc_id, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT b.doc_id, length(b.h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept.h, b.h))) AS kept_sha256
FROM b LEFT JOIN counts ON counts.doc_id = b.doc_id LEFT JOIN kept ON kept.doc_id = b.doc_id
"""
