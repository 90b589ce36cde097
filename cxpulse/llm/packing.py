"""Mixture-controlled packing: deficit round-robin over source queues.

Every document becomes its tokens plus an end id; pieces of documents fill
sequences of ``LENGTH`` tokens without gaps, so that only the very last sequence
is short. Which source fills next is decided by its deficit: the tokens it is
owed (its target proportion of all tokens so far; by default its share of the
corpus) less those it has had. The
source that is longest owed a quantum of ``QUANTUM`` tokens is served next, from
the document at the head of its queue; a deficit that a window does not
settle is carried to the next window.

Documents are dealt over parts of about ``PART_TOKENS`` tokens by a hash of
their row, so each part has every source in about its proportion: its target
until a source is used up, from there on what the others' targets are to each
other. A part starts
where the ones before it end (prefix sums of their token counts), in the middle
of a sequence as a rule, and with the deficits they leave. Within a source the
queue has the order of the row hash. Only (row, source, length) is planned; the
token ids are written once and meet their pieces by one join.
"""

from __future__ import annotations

import heapq
import os
import zlib
from collections import defaultdict, deque
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cxpulse.llm import textnum as T
from cxpulse.llm.common import importable, materialise, table

LENGTH = 2048
QUANTUM = 512
PART_TOKENS = 32_000_000
PART_ROWS = 400_000  # a part is bounded in documents too: a task holds their places in memory
END_ID = 1
CACHE_WORDS = 1_000_000  # about 150 MB
CHUNK = 2 << 20  # bytes of text whose words are told apart at once
#: what a byte is, for the places where texts are cut into parts
_SPACE, _DIGIT, _ALPHA, _PUNCT, _LATIN, _OTHER = range(6)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[~T.NOT_SPACE] = _SPACE
_KIND[T.lut([(0x30, 0x39)])] = _DIGIT
_KIND[T.lut([(0x41, 0x5A), (0x61, 0x7A)])] = _ALPHA
_KIND[T.lut([(0x00, 0x08), (0x0E, 0x1F), (0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])] = _PUNCT
_KIND[T.lut([(0x80, 0x96), (0x98, 0xB6), (0xB8, 0xBF)])] = _LATIN  # a letter if 0xC3 is before it
_LETTERS = (_KIND == _LATIN) | T.lut([(0x61, 0x7A), (0xC3, 0xC3)])  # the bytes of a-z and the letters of U+00C0 to U+00FF
_BEGIN, _END, _IF_LETTER = 1, 2, 4


def _between(cuts: bool) -> bytes:
    """What lies between two bytes, at 8 * the first one's kind + the second's."""
    out = np.zeros(256, np.uint8)
    for a in range(6):
        for b in range(6):
            out[8 * a + b] = _BEGIN * (a == _SPACE != b) | _END * (a != _SPACE == b)
            if cuts and a != _SPACE != b:
                out[8 * a + b] = (_BEGIN | _END) * (_DIGIT in (a, b) or (a, b) == (_ALPHA, _PUNCT)) | _IF_LETTER * ((a, b) == (_LATIN, _PUNCT))
    return out.tobytes()


_KIND_TABLE, _LOWER_TABLE, _PARTS_TABLE, _WORDS_TABLE = _KIND.tobytes(), T.ASCII_LOWER.tobytes(), _between(True), _between(False)


class HashNumbers:
    """Hashes numbered 0, 1, 2, ... in the order they are added, looked up many at
    a time: open addressing in arrays at most half full."""

    def __init__(self):
        self.count = 0
        self.key, self.slot = np.zeros(1 << 12, np.uint64), np.full(1 << 12, -1, np.int32)

    def _place(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes & np.uint64(len(self.slot) - 1)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash; -1 if it has none."""
        at = self._place(hashes)
        slot = self.slot[at]
        wrong = np.flatnonzero((slot >= 0) & (self.key[at] != hashes))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & (len(self.slot) - 1)
            slot[wrong] = found = self.slot[at[wrong]]
            wrong = wrong[(found >= 0) & (self.key[at[wrong]] != hashes[wrong])]
        return slot

    def add(self, hashes: np.ndarray) -> None:
        """Number distinct hashes that have none yet."""
        numbers = np.arange(self.count, self.count + len(hashes), dtype=np.int32)
        self.count += len(hashes)
        if 2 * self.count > len(self.slot):
            used = self.slot >= 0
            hashes, numbers = np.concatenate([self.key[used], hashes]), np.concatenate([self.slot[used], numbers])
            size = len(self.slot)
            while 2 * self.count > size:
                size *= 2
            self.key, self.slot = np.zeros(size, np.uint64), np.full(size, -1, np.int32)
        at, todo = self._place(hashes), np.arange(len(hashes))
        while len(todo):
            free = todo[self.slot[at[todo]] < 0]
            self.slot[at[free]] = numbers[free]  # one of those that want a place gets it
            got = self.slot[at[todo]] == numbers[todo]
            self.key[at[todo[got]]] = hashes[todo[got]]
            todo = todo[~got]
            at[todo] = (at[todo] + 1) & (len(self.slot) - 1)


class WordTokenizer:
    """Token ids of texts through a cache of parts between which no token and no
    normalisation of the vocabulary can reach: white space, around ASCII digits,
    and between a Latin letter and ASCII punctuation after it. Each distinct part of
    a call is looked up once; parts not yet seen go to the tokenizer; ids equal
    those of whole texts. Parts are known by two independent 64-bit hashes; should
    two parts share the first, the call's parts are tokenised without the cache.

    A new part of only ASCII and U+00C0 to U+00FF letters is one word to the
    tokenizer, and composition leaves it alone. Many of them go to the tokenizer
    as one text, without its regular expressions; their ids are told apart by the
    vocabulary's end-of-word tokens.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer, self.letters = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.letters.normalizer = normalizers.Lowercase()
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix, vocabulary = getattr(self.tokenizer.model, "end_of_word_suffix", None), self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.is_end[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.clear()

    def clear(self) -> None:
        self.known = HashNumbers()
        self.second = np.zeros(1024, np.uint64)
        self.lengths, self.ids, self.used = np.zeros(1024, np.int32), np.zeros(4096, np.uint32), 0
        self.starts = np.zeros(1024, np.int64)

    def _tokens(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of them each part has)."""
        found = [enc.ids for enc in self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)]
        n = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(n.sum())), n

    def _letter_tokens(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``_tokens`` of parts that have no bytes but ``_LETTERS``."""
        text = b" ".join(words).decode("utf-8", "replace")
        if "\ufffd" not in text:
            ids = np.array(self.letters.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.is_end[ids]) + 1
            if len(ends) == len(words) and ends[-1] == len(ids):
                return ids, np.diff(ends, prepend=0)
        return self._tokens(words)

    def _add(self, hashes: np.ndarray, second: np.ndarray, words: list[bytes], letters: np.ndarray) -> None:
        groups = []
        of_letters = np.flatnonzero(letters)
        for k in range(0, len(of_letters), 1000):
            groups.append((own := of_letters[k:k + 1000], *self._letter_tokens([words[i] for i in own.tolist()])))
        others = np.flatnonzero(~letters)
        if len(others):
            groups.append((others, *self._tokens([words[i] for i in others.tolist()])))
        old, total = self.known.count, sum(len(ids) for _, ids, _ in groups)
        while old + len(words) > len(self.lengths):
            self.lengths, self.starts, self.second = (np.resize(x, 2 * len(x)) for x in (self.lengths, self.starts, self.second))
        while self.used + total > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.known.add(hashes)
        self.second[old:old + len(words)] = second
        for own, ids, n in groups:
            self.lengths[old + own] = n
            self.starts[old + own] = self.used + np.cumsum(n) - n
            self.ids[self.used:self.used + len(ids)] = ids
            self.used += len(ids)

    @staticmethod
    def _parts(raw: bytes, at: np.ndarray, between: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first, past, the parts' bytes one after the other)."""
        data, kind = np.frombuffer(raw, np.uint8), np.frombuffer(raw.translate(_KIND_TABLE), np.uint8)
        pairs = np.zeros(len(raw) + 1, np.uint8)  # before each byte and after the last: white space
        pairs[:-1] = kind
        pairs[1:] |= kind << 3
        bound = at[(at > 0) & (at < len(raw))]
        edges = np.frombuffer(bytearray(pairs.tobytes().translate(between)), np.uint8)
        after_latin = np.flatnonzero((edges & _IF_LETTER).astype(bool))
        if len(after_latin):
            edges[after_latin[(data[after_latin - 2] == 0xC3) & (after_latin > 1)]] |= _BEGIN | _END
        # a text's first byte begins a part and its last one ends it
        edges[bound] = _BEGIN * (kind[bound] != _SPACE) | _END * (kind[bound - 1] != _SPACE)
        return np.flatnonzero((edges & _BEGIN).astype(bool)), np.flatnonzero((edges & _END).astype(bool)), data[kind != _SPACE]

    def _distinct(self, raw: bytes, upto: np.ndarray, special: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, starts, lengths): the ids of part k, raw[upto[k]:upto[k + 1]], are
        ids[starts[k]:starts[k] + lengths[k]]; no two parts are equal."""
        data, first, past = np.frombuffer(raw, np.uint8), upto[:-1], upto[1:]
        one, two = T.word_hashes(data, first, past, seed=2 * special), T.word_hashes(data, first, past, seed=2 * special + 1)
        if self.known.count > CACHE_WORDS:
            self.clear()
        slot = self.known.find(one)
        missing = np.flatnonzero(slot < 0)
        if len(missing):
            hashes, sample = np.unique(one[missing], return_index=True)
            sample = missing[sample]
            strange = np.concatenate([np.zeros(1, np.int64), np.cumsum(~_LETTERS[data])])
            letters = strange[past[sample]] == strange[first[sample]] if not special else np.zeros(len(sample), bool)
            self._add(hashes, two[sample], [raw[a:b] for a, b in zip(first[sample].tolist(), past[sample].tolist())], letters)
            slot[missing] = self.known.find(one[missing])
        if (self.second[slot] != two).any():  # two words of one hash
            ids, n = self._tokens([raw[a:b] for a, b in zip(first.tolist(), past.tolist())])
            return ids, np.cumsum(n) - n, n
        return self.ids, self.starts[slot], self.lengths[slot]

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of the adjoining texts data[at[k]:at[k + 1]]."""
        raw = data.tobytes()
        # a text that may hold a special token is neither lower-cased nor cut within words
        special = b"<|" in raw
        first, past, data = self._parts(raw, at, _WORDS_TABLE) if special else self._parts(raw.translate(_LOWER_TABLE), at, _PARTS_TABLE)
        if not len(first):
            return np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
        upto = np.zeros(len(first) + 1, np.int64)
        np.cumsum(past - first, out=upto[1:])
        parts = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(upto), pa.py_buffer(data)]).dictionary_encode()
        which, (_, offsets, words) = parts.indices.to_numpy(), parts.dictionary.buffers()
        ids, starts, n = self._distinct(words.to_pybytes(), np.frombuffer(offsets, np.int64)[:len(parts.dictionary) + 1], special)
        n = n[which]
        np.cumsum(n, out=upto[1:])
        return ids[np.arange(upto[-1]) + np.repeat(starts[which] - upto[:-1], n)], upto[np.searchsorted(first, at)]


_loaded: dict[str, WordTokenizer] = {}


def _tokenise(path: str):
    """Rows (doc_id, source, text) -> (doc_id, source, n, ids): ``ids`` holds
    the document's ids, the end id last, as little-endian unsigned 32-bit numbers
    (16-bit if all of its chunk are below 65536, told by the length)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _loaded:
            _loaded[path] = WordTokenizer(path)
        tokenizer = _loaded[path]
        for batch in batches:
            data, offsets = T.text_buffers(batch.column("text"))
            for lo, hi in T.chunks(offsets, CHUNK):
                ids, bounds = tokenizer.encode(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                ids = np.insert(ids, bounds[1:], END_ID).astype("<u2" if not len(ids) or ids.max() < 65536 else "<u4")
                n = np.diff(bounds) + 1
                ends = (bounds + np.arange(hi - lo + 1)) * ids.itemsize
                packed = pa.Array.from_buffers(pa.large_binary(), hi - lo, [None, pa.py_buffer(ends), pa.py_buffer(ids)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), batch.column("source").slice(lo, hi - lo), pa.array(n, pa.int64()), packed],
                    names=["doc_id", "source", "n", "ids"])
    return run


class Rotation:
    """Source queues of one part and the deficits they start with."""

    def __init__(self, at: int):
        self.at = at
        self.queues: dict = defaultdict(deque)
        self.served: dict = {}
        self.share: dict = {}

    def pieces(self) -> Iterator[tuple[int, int, int, int]]:
        """(row, start, length, position in the whole stream), until all queues are empty."""
        due = [((self.served[s] + QUANTUM) / self.share[s], s) for s in self.queues]
        heapq.heapify(due)
        at, held = self.at, None
        while due:
            _, s = heapq.heappop(due)
            queue = self.queues[s]
            row, start, left = queue.popleft()
            take = min(left, QUANTUM, LENGTH - at % LENGTH)
            if left > take:
                queue.appendleft((row, start + take, left - take))
            if held and held[0] == row and held[1] + held[2] == start and at % LENGTH:
                held = (row, held[1], held[2] + take, held[3])
            else:
                if held:
                    yield held
                held = (row, start, take, at)
            at += take
            self.served[s] += take
            if queue:
                heapq.heappush(due, ((self.served[s] + QUANTUM) / self.share[s], s))
        if held:
            yield held


def _rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of each part, from rows sorted by (part, kind, order): kind 0
    has what a source was served before, kind 1 the documents."""
    def out(rotation: Rotation) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for piece in rotation.pieces():
            rows.append(piece)
            if len(rows) == 50_000:
                yield _pieces(rows)
                rows = []
        if rows:
            yield _pieces(rows)

    part, rotation = None, None
    for batch in batches:
        for p, kind, s, row, n, before, share in zip(*(batch.column(c).to_pylist() for c in ("part", "kind", "source", "row", "n", "before", "share"))):
            if p != part:
                if rotation:
                    yield from out(rotation)
                part, rotation = p, Rotation(before)
            if kind == 0:
                rotation.served[s], rotation.share[s] = n, share
            else:
                rotation.queues[s].append((row, 0, n))
    if rotation:
        yield from out(rotation)


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["row", "start", "length", "position"])


def _queue(source: str | None) -> str:
    return "null" if source is None else f"={source}"


def _part_by_targets(named: DataFrame, total: int, parts: int, weights: dict[str, float]) -> Column:
    """The part in which a row is due. Served at their weights, all sources together
    have had T(v) = sum of min(v * weight, n) tokens at time v, and a source's
    queue lasts till n / weight. A row that a hash places at the fraction u of its
    queue is due at v = u * n / weight, in the part that T(v) falls into. Sources
    without a weight of their own weigh their share, so they all last till ``total``."""
    of_named = named.filter(F.col("source").isin(list(weights))).groupBy("source").agg(F.sum("n").alias("n"))
    sizes = {r["source"]: int(r["n"]) for r in of_named.collect()}  # one row per weight given
    rest = total - sum(sizes.values())
    flows = [(rest / max(1, total), float(rest)), *((weights[s], float(n)) for s, n in sizes.items())]
    lasts = F.lit(float(total))
    if sizes:
        known = F.create_map(*[F.lit(x) for s, n in sizes.items() for x in (s, n / weights[s])])
        lasts = F.coalesce(F.try_element_at(known, F.col("source")), lasts)
    due = F.expr("pmod(xxhash64('due', row), 9007199254740992L) / 9007199254740992D") * lasts
    had = F.aggregate(F.array(*[F.struct(F.lit(w).alias("w"), F.lit(n).alias("n")) for w, n in flows]), F.lit(0.0), lambda sum_, x: sum_ + F.least(due * x["w"], x["n"]))
    return F.least(F.floor(had * (parts / max(1, total))), F.lit(parts - 1)).cast("int")


def rotation_plan(lengths: DataFrame, targets: dict[str | None, float] | None = None) -> DataFrame:
    """(row, start, length, position) of all pieces, from rows (row, source, n).
    ``targets`` as in ``pack``."""
    total, rows = lengths.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    parts = max(1, -(-total // PART_TOKENS), -(-rows // PART_ROWS))
    if any(not 0 < w < float("inf") for w in (targets or {}).values()):
        raise ValueError("a target is a positive proportion")
    weights = {_queue(s): float(w) for s, w in (targets or {}).items()}
    # a null source is a queue of its own
    named = lengths.select(F.when(F.col("source").isNull(), F.lit(_queue(None))).otherwise(F.concat(F.lit(_queue("")), F.col("source"))).alias("source"), "row", "n")
    part = _part_by_targets(named, total, parts, weights) if weights else F.expr(f"pmod(xxhash64(row), {parts})").cast("int")
    named = named.select(part.alias("part"), "source", "row", "n")
    sums = materialise(named.groupBy("part", "source").agg(F.sum("n").alias("n")), "pack-sums")
    earlier = lambda by: (Window.partitionBy(*by) if by else Window).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("source")
    starts = sums.groupBy("part").agg(F.sum("n").alias("t")).select("part", F.coalesce(F.sum("t").over(earlier([])), F.lit(0)).alias("before"))
    share = F.sum("n").over(whole) / F.lit(float(total or 1))
    if weights:
        known = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
        share = F.coalesce(F.try_element_at(known, F.col("source")), share)
    carried = sums.select("part", "source", F.coalesce(F.sum("n").over(earlier(["source"])), F.lit(0)).alias("served"), share.alias("share"))
    heads = carried.join(starts, "part").select("part", F.lit(0).alias("kind"), "source", F.lit(0).cast("long").alias("row"), F.col("served").alias("n"), "before", "share", F.lit(0).cast("long").alias("turn"))
    docs = named.select("part", F.lit(1).alias("kind"), "source", "row", "n", F.lit(None).cast("long").alias("before"), F.lit(None).cast("double").alias("share"), F.xxhash64(F.lit("queue"), "row").alias("turn"))
    dealt = heads.union(docs).repartition("part").sortWithinPartitions("part", "kind", "turn", "row", "source")
    return dealt.mapInArrow(_rotate, "row long, start long, length long, position long")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        for doc_id, n, ids, pieces in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "ids", "pieces"))):
            ids = np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4").astype("<u4")
            for p in pieces:
                a, m, at = p["start"], p["length"], p["position"]
                out.append((doc_id, a, m, zlib.crc32(ids[a:a + m].tobytes()), n, at // LENGTH, at % LENGTH))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])


def pack(docs: DataFrame, tokenizer_path: str, targets: dict[str | None, float] | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.

    ``targets``: the proportion of each window's tokens that a source (None: the null
    source) shall have; sources not named have their share of all tokens, and
    only what the numbers are to each other counts. Everything is packed: once a
    source is used up the others go on by theirs. A target of a source that no
    document has changes nothing; one that is not positive is an error.

    A null or empty text is the end id alone. Rows repeating a doc_id are packed
    each; a null doc_id stays null; an empty table gives no pieces; columns
    besides doc_id, source and text are ignored. ``tokenizer_path``
    must be readable on the executors (a file of an installed package).
    """
    importable(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text")
    tokens = rows.mapInArrow(_tokenise(tokenizer_path), "doc_id long, source string, n long, ids binary")
    tokens = materialise(tokens.withColumn("row", F.monotonically_increasing_id()), "token-ids")
    plan = rotation_plan(tokens.select("row", "source", "n"), targets)
    per_row = plan.groupBy("row").agg(F.collect_list(F.struct("start", "length", "position")).alias("pieces"))
    joined = tokens.select("row", "doc_id", "n", "ids").join(per_row.hint("shuffle_hash"), "row").select("doc_id", "n", "ids", "pieces")
    return joined.mapInArrow(_cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op7_pack(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), default_tokenizer())
