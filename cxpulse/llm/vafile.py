"""Exact top-k by inner product with a vector-approximation file.

Each component x becomes floor(256 * x); the score of two vectors is their
integer inner product. The file holds, per block of vectors and dimension, the
smallest value and a cell width, and per component one byte: the number of its
cell. A query times the cells' middles bounds every score from below and above
(half a cell per component, the same for all vectors of a block), at the price of
one matrix product over bytes. The file is written once; only it meets the
queries (a stated query set against all rows): blocks of both are dealt to the
cells of a grid in one shuffle, and a cell holds its queries while the file's blocks
pass. No join takes part in that, so neither side is ever gathered in the driver.

A vector is a candidate while its upper bound reaches the k-th largest lower
bound, within its cell first, then over all cells. Exact vectors are fetched for
the candidates left, by one join (of sorted sides), and read in descending order of
their bounds until the k-th result is certain. So nothing is approximate in the
result.

Equal vectors are one entry of the file; the ``k`` + 1 smallest ids that carry it
stand behind it (no more can be among the k best of a query, which leaves out its
own id), with how often each comes. So many copies of one vector cost one entry.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cxpulse.llm.common import importable, materialise, table

SCALE = 256
CELLS = 256
BLOCK = 8192  # vectors in a block of the file
QUERIES = 1024  # queries in a block
CHUNK, STRIP = 256, 1024  # queries and vectors in one product: it stays in the cache
HELD = 64  # candidates a query that a cell holds before it lets go of them
CELL_WORK = (1 << 30, 1 << 39)  # components that meet in a cell: worth a task, and at most
CELL_ASKED = 1 << 22  # components of queries in a cell
_EXACT = 2 ** 53
_KEY = 24  # bytes of a score as a sortable key
_TOP = (1 << 63) - 1


def approximate(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, low, width): component = low + width * (code + 0.5), half a width
    off at most."""
    low = v.min(axis=0, initial=np.inf)
    width = (v.max(axis=0, initial=-np.inf) - low) / CELLS
    codes = np.divide(v - low, width, out=np.zeros_like(v), where=width > 0)
    return np.clip(np.floor(codes), 0, CELLS - 1).astype(np.uint8), low, width


def bounds(codes: np.ndarray, low: np.ndarray, width: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(middle, reach): the score of query r and vector c lies within
    middle[r, c] +- reach[r]."""
    middle = (q * width) @ codes.T.astype(np.float64) + (q @ (low + 0.5 * width))[:, None]
    size = np.abs(q)
    # half a cell, and what the rounding of the sums above can amount to
    largest = size @ (np.abs(low) + CELLS * width)
    return middle, 0.5 * (size @ width) * (1 + 1e-9) + largest * q.shape[1] * 1e-15


def candidates(middle: np.ndarray, reach: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, vector) numbers whose upper bound reaches the k-th largest lower
    bound of the allowed vectors (all allowed ones, if there are at most k)."""
    held = np.where(allowed, middle, -np.inf)
    least = np.full(len(held), -np.inf)
    if held.shape[1] > k:
        least = -np.partition(-held, k - 1, axis=1)[:, k - 1]
    return np.nonzero(allowed & (held >= (least - 2 * reach)[:, None]))


def _pack(kind: str):
    """Rows (block, dim, id, ints, only) sorted by (block, dim) as one row per
    block: for ``file`` the approximation, for ``queries`` the exact vectors."""
    size = BLOCK if kind == "file" else QUERIES

    def packed(held: list[tuple]) -> pa.RecordBatch:
        block, dim = held[0][:2]
        v = np.array([h[3] for h in held], np.float64).reshape(len(held), dim)
        ids, only = np.array([h[2] for h in held], np.int64), np.array([h[4] is not None for h in held])
        own = np.array([h[4] or 0 for h in held], np.int64)
        if kind == "file":
            codes, low, width = approximate(v)
            parts = [codes.tobytes(), low.tobytes(), width.tobytes()]
        else:
            with np.errstate(over="ignore"):
                short = v.astype(np.float32)
            parts = [(short if np.array_equal(short, v) else v).tobytes(), b"", b""]
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int32()), pa.array([dim], pa.int32()), *(pa.array([x], pa.binary()) for x in (ids.tobytes(), only.tobytes(), own.tobytes(), *parts))],
            names=["block", "dim", "ids", "only", "own", "a", "b", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("block", "dim", "id", "ints", "only"))):
                if held and (held[0][:2] != row[:2] or len(held) == 2 * size):
                    yield packed(held)
                    held = []
                held.append(row)
        if held:
            yield packed(held)
    return run


_PACKED = "block int, dim int, ids binary, only binary, own binary, a binary, b binary, c binary"


class _Asked:
    """Up to ``CHUNK`` queries of a cell, with the k largest lower bounds so far and
    the candidates that still reach the k-th."""

    def __init__(self, ids: np.ndarray, own: np.ndarray, q: np.ndarray, k: int):
        self.ids, self.own, self.q = ids, own, q.astype(np.float64)
        self.best = np.full((len(ids), k), -np.inf)
        self.held: list[tuple[np.ndarray, ...]] = []
        self.count = 0

    def meet(self, ids: np.ndarray, only: np.ndarray, own: np.ndarray, codes: np.ndarray, low: np.ndarray, width: np.ndarray) -> None:
        k = self.best.shape[1]
        middle, reach = bounds(codes, low, width, self.q)
        near = middle >= (self.best.min(axis=1) - reach)[:, None]
        # a vector that only the query's own id carries takes no part
        if np.count_nonzero(near) > HELD * len(self.ids):
            near &= ~(only[None, :] & (own[None, :] == self.own[:, None]))
            rows, cols = candidates(middle, reach, near, k)
            more = _largest(np.where(near, middle - reach[:, None], -np.inf), k)
        else:
            rows, cols = np.divmod(np.flatnonzero(near), max(1, len(ids)))
            others = ~(only[cols] & (own[cols] == self.own[rows]))
            rows, cols = rows[others], cols[others]
            more = _spread(rows, middle[rows, cols] - reach[rows], self.best.shape)
        m = middle[rows, cols]
        self.held.append((rows, ids[cols], m - reach[rows], m + reach[rows]))
        self.count += len(rows)
        self.best = _largest(np.concatenate([self.best, more], axis=1), k)

    def left(self) -> tuple[np.ndarray, ...]:
        """(row, vector, lower, upper) of the candidates."""
        rows, vectors, lower, upper = (np.concatenate(x) for x in zip(*self.held))
        on = upper >= self.best.min(axis=1)[rows]
        return rows[on], vectors[on], lower[on], upper[on]

    def give(self, all_of_them: bool) -> Iterator[pa.RecordBatch]:
        """The candidates, at the end or if there are too many to hold."""
        if self.held and (all_of_them or self.count > HELD * len(self.ids)):
            rows, vectors, lower, upper = self.left()
            if all_of_them or 2 * len(rows) > HELD * len(self.ids):
                yield pa.RecordBatch.from_arrays([pa.array(self.ids[rows]), pa.array(vectors), pa.array(lower), pa.array(upper)], names=["query", "vector", "lower", "upper"])
                self.held, self.count = [], 0
            else:
                self.held, self.count = [(rows, vectors, lower, upper)], len(rows)


def _largest(values: np.ndarray, k: int) -> np.ndarray:
    """The k largest of each row (all, if there are fewer)."""
    return -np.partition(-values, k - 1, axis=1)[:, :k] if values.shape[1] > k else values


def _spread(rows: np.ndarray, values: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """The largest values of each row, as many as ``shape`` has columns, else -inf."""
    order = np.lexsort((-values, rows))
    rows, values = rows[order], values[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    out, fits = np.full(shape, -np.inf), place < shape[1]
    out[rows[fits], place[fits]] = values[fits]
    return out


def _scan(k: int):
    """Candidates (query, vector, lower, upper) of each cell, from its packed blocks
    sorted by (cell, dim), those of queries first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, asked = None, []
        for batch in batches:
            column = {c: batch.column(c) for c in batch.schema.names}
            for i in range(batch.num_rows):
                def read(c: str, kind) -> np.ndarray:
                    return np.frombuffer(column[c][i].as_buffer(), kind)

                place = column["cell"][i].as_py(), column["dim"][i].as_py()
                if place != now:
                    for x in asked:
                        yield from x.give(True)
                    now, asked = place, []
                ids, own, dim = read("ids", np.int64), read("own", np.int64), place[1]
                if not column["file"][i].as_py():
                    q = read("a", np.float32 if len(column["a"][i].as_buffer()) == 4 * len(ids) * dim else np.float64).reshape(len(ids), dim)
                    asked += [_Asked(*(x[a:a + CHUNK] for x in (ids, own, q)), k) for a in range(0, len(ids), CHUNK)]
                elif asked:
                    codes, only = read("a", np.uint8).reshape(len(ids), dim), read("only", bool)
                    for a in range(0, len(ids), STRIP):
                        strip = [y[a:a + STRIP] for y in (ids, only, own)] + [codes[a:a + STRIP].astype(np.float64)]
                        for x in asked:
                            x.meet(*strip, read("b", np.float64), read("c", np.float64))
                            yield from x.give(False)
        for x in asked:
            yield from x.give(True)
    return run


def grid(n_vectors: int, n_queries: int, components: int, tasks: int, blocks: tuple[int, int]) -> tuple[int, int]:
    """(parts of the queries, parts of the file): as many cells as tasks where the work
    is worth it, and more where a cell's work (CELL_WORK) or its queries (CELL_ASKED)
    would be too much. Every part of one side is sent to all parts of the other, so
    the cells are as wide and high as sends the fewest bytes. components: of all the
    queries; blocks: of queries, of the file."""
    work = n_vectors * components
    cells = max(1, min(tasks, work // CELL_WORK[0]), -(-work // CELL_WORK[1]))
    even = round((4 * cells * n_queries / max(1, n_vectors)) ** 0.5)  # four bytes a component of a query, one of the file
    across = min(blocks[0], max(1, even, -(-components // CELL_ASKED)))
    return across, min(blocks[1], -(-cells // across))


def _score(a: np.ndarray, b: np.ndarray) -> int:
    if (np.abs(a).max(initial=0) * np.abs(b).max(initial=0)) * max(1, len(a)) < _EXACT:
        return int(a @ b)
    return sum(int(x) * int(y) for x, y in zip(a, b))  # whole numbers of any size


def _read(k: int):
    """The k best of each query vector, from rows sorted by query, its own row (with
    a query_id) first, then by upper descending: (query_id, vec_id, score, place, times)."""
    def best(held: list[tuple], query_id: int, copies: int) -> Iterator[tuple]:
        left = k
        for score, vec_id, n in held:
            if left <= 0:
                return
            yield query_id, vec_id, max(-_TOP - 1, min(_TOP, -score)), (-score + (1 << 8 * _KEY - 1)).to_bytes(_KEY, "big"), min(k, n * copies)
            left -= n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, done, state = [], False, None
        for batch in batches:
            out: list[tuple] = []
            ints = batch.column("ints")
            at, parts = ints.offsets.to_numpy(), ints.values.to_numpy()
            for i, (query_id, copies, upper) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("query_id", "copies", "upper")))):
                if query_id is not None:
                    if state:
                        out += best(held, *state)
                    held, done, state, own = [], False, (query_id, copies), parts[at[i]:at[i + 1]].copy()
                    continue
                if done:
                    continue
                if sum(n for _, _, n in held) >= k and upper < -held[-1][0]:
                    done = True  # no bound left reaches the k-th score
                    continue
                score = _score(parts[at[i]:at[i + 1]], own)
                held = sorted(held + [(-score, x["vec_id"], x["n"]) for x in batch.column("ids")[i].as_py() if x["vec_id"] != state[0]])
                total, keep = 0, 0
                while keep < len(held) and total < k:
                    total += held[keep][2]
                    keep += 1
                held = held[:keep]
            if out:
                yield _rows(out)
        if state:
            out = list(best(held, *state))
            if out:
                yield _rows(out)
    return run


def _rows(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()))],
                                      names=["query_id", "vec_id", "score", "place", "times"])


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id, dim, ints (floor(256 * x)) of the vectors that take part: not
    null, no null or non-finite component. An empty vector has dim 0: score 0."""
    ok = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~F.exists("embedding", lambda x: F.coalesce(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True)))
    ints = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    return embeddings.filter(F.coalesce(ok, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), F.size("embedding").alias("dim"), ints.alias("ints"))


def vector_file(rows: DataFrame, k: int) -> tuple[DataFrame, DataFrame, int, int]:
    """(vectors: id, dim, ints, ids; their number; the file; its blocks) of ``usable``
    rows, both tables written."""
    counted = rows.groupBy("dim", "ints", "vec_id").agg(F.count(F.lit(1)).alias("n"))
    smallest = Window.partitionBy("dim", "ints").orderBy("vec_id")
    few = counted.withColumn("r", F.row_number().over(smallest)).filter(F.col("r") <= k + 1)
    vectors = few.groupBy("dim", "ints").agg(F.array_sort(F.collect_list(F.struct("vec_id", "n"))).alias("ids"))  # at most k + 1
    vectors = materialise(vectors.withColumn("id", F.monotonically_increasing_id()), "vectors")
    n_vectors = vectors.count()
    n_blocks = -(-n_vectors // BLOCK) or 1
    only = F.when(F.size("ids") == 1, F.col("ids")[0]["vec_id"])
    placed = vectors.select(F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int").alias("block"), "dim", "id", "ints", only.alias("only"))
    dealt = placed.repartition(n_blocks, "block").sortWithinPartitions("block", "dim", "id")
    return vectors, n_vectors, materialise(dealt.mapInArrow(_pack("file"), _PACKED), "vector-file"), n_blocks


def top_k(embeddings: DataFrame, is_query, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best rows of each query row
    (``is_query``: a condition on vec_id), all if there are fewer.

    Ties go to the smaller vec_id. Only vectors of equal length are compared.
    Repeated rows count as often as they come, as candidates and as queries; a
    vec_id with several vectors takes part with each: all its queries share one
    ranking. Whole numbers stay within a long; a score beyond a long is ranked by
    its true value and shown as the end of the range. An empty table gives an empty
    result; further columns are ignored.
    """
    importable(embeddings.sparkSession)
    rows = usable(embeddings)
    vectors, n_vectors, file, n_blocks = vector_file(rows, k)
    asked = rows.filter(is_query).groupBy("vec_id", "dim", "ints").agg(F.count(F.lit(1)).alias("copies"))
    asked = materialise(asked.withColumn("query", F.monotonically_increasing_id()), "queries")
    n_asked, components = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum("dim"), F.lit(0))).first()
    n_queries = -(-n_asked // QUERIES) or 1
    placed = asked.select(F.pmod(F.xxhash64("query"), F.lit(n_queries)).cast("int").alias("block"), "dim", F.col("query").alias("id"), "ints", F.col("vec_id").alias("only"))
    packed = placed.repartition(n_queries, "block").sortWithinPartitions("block", "dim", "id").mapInArrow(_pack("queries"), _PACKED)
    tasks = int(embeddings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    across, down = grid(n_vectors, n_asked, components, tasks, (n_queries, n_blocks))
    row, column = F.pmod("block", F.lit(across)) * down, F.pmod("block", F.lit(down))
    dealt = packed.withColumn("cell", F.explode(F.sequence(row, row + (down - 1)))).withColumn("file", F.lit(False))
    dealt = dealt.unionByName(file.withColumn("cell", F.explode(F.sequence(column, column + down * (across - 1), F.lit(down)))).withColumn("file", F.lit(True)))
    cells = dealt.repartitionById(across * down, "cell").sortWithinPartitions("cell", "dim", "file", "block")
    found = cells.mapInArrow(_scan(k), "query long, vector long, lower double, upper double")
    # the k-th largest lower bound over all cells
    ranked = Window.partitionBy("query").orderBy(F.desc("lower"))
    known = found.withColumn("r", F.row_number().over(ranked)).withColumn("least", F.max(F.when(F.col("r") == k, F.col("lower"))).over(Window.partitionBy("query")))
    left = known.filter(F.col("least").isNull() | (F.col("upper") >= F.col("least"))).select("query", "vector", "upper")
    # estimates of sizes know neither what a step in Python adds nor how Parquet shrinks
    # whole numbers: neither side is offered to the driver for a broadcast
    exact = left.join(vectors.select(F.col("id").alias("vector"), "ints", "ids").hint("merge"), "vector")
    own = asked.select("query", F.col("vec_id").alias("query_id"), "copies", "ints")
    ordered = exact.unionByName(own, allowMissingColumns=True).repartition("query").sortWithinPartitions("query", F.col("query_id").isNull(), F.desc("upper"), "vector")
    read = ordered.mapInArrow(_read(k), "query_id long, vec_id long, score long, place binary, times long")
    each = read.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    order = Window.partitionBy("query_id").orderBy(F.desc("place"), "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op8_vafile_topk(spark, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id AS vec_id, list_inner_product(q.e, v.e)::BIGINT AS score
  FROM v q JOIN v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id AND len(q.e) = len(v.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s)
SELECT query_id, k::INTEGER AS rank, vec_id, score FROM r WHERE k <= 5
"""
