"""Exact duplicates with a cuckoo-filter index.

Texts are equal when they are identical after each run of ASCII white space
(``[\\x20\\x09-\\x0D]+``) is replaced by one space; a null text counts as empty.

The index is split by digest (xxhash64 of the normalised text) over Spark's
partitions. Each part is a cuckoo filter of 16-bit fingerprints in front of
buckets of stored content keys: a digest the filter does not know is new; a hit
is verified against the bucket's content (SHA-256 of the whole normalised text
and its byte length), so a false positive never merges two texts. Live digests
can be inserted and deleted; when an insertion finds no free slot the filter is
doubled and filled again from the stored keys.

Hashing is JVM-side, so no text reaches Python; the first index pass runs
on each scan task (pre-aggregation: a group of copies costs one row per task,
however large it is), the second on the digest's own partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cxpulse.llm.common import importable, materialise

PART_ROWS = 2_000_000  # rows behind one part of the index
WHITE_SPACE = r"[\x20\x09-\x0D]+"
GROUP_SCHEMA = "digest long, sha binary, n_bytes long, keep_id long, n_rows long, n_keep long"
GROUP_COLS = ["digest", "sha", "n_bytes", "keep_id", "n_rows", "n_keep"]
_ARROW = pa.schema([("digest", pa.int64()), ("sha", pa.binary()), ("n_bytes", pa.int64()),
                    ("keep_id", pa.int64()), ("n_rows", pa.int64()), ("n_keep", pa.int64())])
_MASK = (1 << 64) - 1
_SLOTS = 4
_MAX_KICKS = 200


class CuckooIndex:
    """Cuckoo filter over 64-bit digests with the content keys behind it.

    ``store``: digest -> {(sha, n_bytes): [keep_id, n_rows, n_keep]}; keep_id is
    the smallest id of the group (None: no id seen), n_keep the rows having it.
    """

    def __init__(self, buckets: int = 1024):
        self.store: dict[int, dict[tuple[bytes, int], list]] = {}
        self.resizes = 0
        self._reset(buckets)

    def _reset(self, buckets: int) -> None:
        self.n = buckets
        self.slots: list[list[int]] = [[] for _ in range(buckets)]

    @staticmethod
    def _mix(x: int) -> int:
        x = (x ^ (x >> 31)) * 0x9E3779B97F4A7C15 & _MASK
        return x ^ (x >> 29)

    def _place(self, digest: int) -> tuple[int, int]:
        h = self._mix(digest & _MASK)
        return (h >> 48) or 1, h & (self.n - 1)

    def _other(self, fp: int, i: int) -> int:
        return (i ^ self._mix(fp)) & (self.n - 1)

    def _put(self, digest: int) -> bool:
        fp, i = self._place(digest)
        for kick in range(_MAX_KICKS):
            for b in (i, self._other(fp, i)):
                if len(self.slots[b]) < _SLOTS:
                    self.slots[b].append(fp)
                    return True
            fp, self.slots[i][kick % _SLOTS] = self.slots[i][kick % _SLOTS], fp
            i = self._other(fp, i)
        return False

    def _grow(self) -> None:
        """Overflow: double until every stored key has its place."""
        buckets = self.n
        while True:
            buckets *= 2
            self.resizes += 1
            self._reset(buckets)
            if all(self._put(d) for d in self.store):
                return

    def may_contain(self, digest: int) -> bool:
        fp, i = self._place(digest)
        return fp in self.slots[i] or fp in self.slots[self._other(fp, i)]

    def find(self, digest: int, sha: bytes, n_bytes: int) -> list | None:
        """The group of equal content, if it is live."""
        if not self.may_contain(digest):
            return None
        return self.store.get(digest, {}).get((sha, n_bytes))

    def insert(self, digest: int, sha: bytes, n_bytes: int, keep_id: int | None, n_rows: int = 1, n_keep: int = 1) -> bool:
        """Add rows of one content; True if the content was not live before."""
        group = self.find(digest, sha, n_bytes)
        if group is not None:
            group[1] += n_rows
            if keep_id == group[0]:
                group[2] += n_keep
            elif keep_id is not None and (group[0] is None or keep_id < group[0]):
                group[0], group[2] = keep_id, n_keep
            return False
        known = digest in self.store
        self.store.setdefault(digest, {})[sha, n_bytes] = [keep_id, n_rows, n_keep]
        if not known and not self._put(digest):
            self._grow()
        return True

    def delete(self, digest: int, sha: bytes, n_bytes: int) -> bool:
        """Remove a live content; its fingerprint goes with the digest's last one."""
        if self.find(digest, sha, n_bytes) is None:
            return False
        del self.store[digest][sha, n_bytes]
        if not self.store[digest]:
            del self.store[digest]
            fp, i = self._place(digest)
            b = i if fp in self.slots[i] else self._other(fp, i)
            self.slots[b].remove(fp)
        return True

    def batches(self, rows: int = 50_000) -> Iterator[pa.RecordBatch]:
        part: list[tuple] = []
        for digest, contents in self.store.items():
            part += [(digest, sha, n, *group) for (sha, n), group in contents.items()]
            if len(part) >= rows:
                yield _batch(part)
                part = []
        if part:
            yield _batch(part)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)


def _index_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One part of the index from rows of GROUP_COLS plus, optionally, ``op``
    (-1: delete; deletions precede insertions in the order of the rows)."""
    index = CuckooIndex()
    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in GROUP_COLS]
        ops = batch.column("op").to_pylist() if "op" in batch.schema.names else None
        for k, row in enumerate(zip(*cols)):
            if ops and ops[k] < 0:
                index.delete(*row[:3])
            else:
                index.insert(*row)
    yield from index.batches()


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, digest, sha, n_bytes of every row (a null text is empty)."""
    norm = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), WHITE_SPACE, " ")
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(norm).alias("digest"),
        F.unhex(F.sha2(norm, 256)).alias("sha"), F.octet_length(norm).cast("long").alias("n_bytes"),
    )


def build_index(rows: DataFrame) -> DataFrame:
    """The live contents (GROUP_SCHEMA) of ``digest_rows``: an index to write
    and to hand to ``update_index`` later."""
    entries = rows.selectExpr("digest", "sha", "n_bytes", "doc_id AS keep_id", "1L AS n_rows", "1L AS n_keep")
    local = entries.mapInArrow(_index_part, GROUP_SCHEMA)
    return local.repartition(_parts(rows), "digest").mapInArrow(_index_part, GROUP_SCHEMA)


def _parts(rows: DataFrame) -> int:
    """Parts of an index over ``rows``: a task holds the contents of one."""
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // PART_ROWS))


def update_index(index: DataFrame, inserts: DataFrame, deletes: DataFrame) -> DataFrame:
    """``index`` without the contents of ``deletes`` and then with the rows of
    ``inserts`` (both as from ``digest_rows``)."""
    old = index.select(*GROUP_COLS, F.lit(-2).alias("at"), F.lit(1).alias("op"))
    gone = deletes.selectExpr("digest", "sha", "n_bytes", "doc_id AS keep_id", "0L AS n_rows", "0L AS n_keep", "-1 AS at", "-1 AS op").dropDuplicates(["digest", "sha"])
    new = build_index(inserts).select(*GROUP_COLS, F.lit(0).alias("at"), F.lit(1).alias("op"))
    events = old.unionByName(gone).unionByName(new)
    return events.repartition("digest").sortWithinPartitions("at").mapInArrow(_index_part, GROUP_SCHEMA)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256, plus n_keep (rows of the group that carry keep_id).

    The smallest doc_id of a group stays. Ties: rows repeating that doc_id are
    all ``kept`` (they are one document; see ``keep_one``). A null doc_id never
    stays ahead of a known one; keep_id is null where a group has no id at all.
    An empty table gives an empty result; other columns are ignored.
    """
    importable(docs.sparkSession)
    rows = materialise(digest_rows(docs, id_col, text_col), "digests")
    groups = build_index(rows).select("digest", "sha", "n_bytes", "keep_id", "n_rows", "n_keep")
    return rows.join(groups, ["digest", "sha", "n_bytes"]).select(
        "doc_id", "keep_id", F.col("n_rows").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"), "n_keep",
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns, whatever their names) without exact copies; a
    repeated row stays once."""
    importable(docs.sparkSession)
    rows = materialise(digest_rows(docs), "digests")
    keep = materialise(build_index(rows), "keep").select("digest", "keep_id", "n_keep")
    norm = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), WHITE_SPACE, " ")
    tagged = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("own_id"), F.xxhash64(norm).alias("own_digest"))

    def members(k: DataFrame) -> DataFrame:
        k = k.select("keep_id", "digest").distinct()
        return tagged.join(k, F.col("own_id").eqNullSafe(F.col("keep_id")) & (F.col("own_digest") == F.col("digest")), "left_semi")

    once = members(keep.filter("n_keep = 1"))
    again = members(keep.filter("n_keep > 1")).dropDuplicates(["own_id", "own_digest"])
    return once.select("row.*").unionByName(again.select("row.*"))


def op10_exact_dedup(spark, sf_dir: str) -> DataFrame:
    from cxpulse.llm.common import table

    return exact_dedup(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
"""
