"""Exact top-k by inner product with vector-approximation files.

Every component of a vector falls into one of ``CELLS`` equal cells between the bounds of its block.
The cells are computed once and written (checkpointed) apart from the exact vectors, at one byte a
component.  The search has two phases:

* scan: query blocks meet the cells of the candidates, never the exact vectors.  A vector's cells
  give a lower and an upper bound of its score; those whose upper bound reaches the k-th best lower
  bound of the query survive, first within a task, then over all tasks.
* exact reads: only survivors are joined with their exact vectors.  Each query reads them in the order
  of the upper bound (for a similarity, the lower bound of a distance) until the next bound is below
  the k-th exact score, when the result is certain.  Queries with many survivors share them out over
  several readers, whose results are ranked together.

Skew.  Equal vectors tie, and ties go to the smaller id, so of each distinct vector only its k + 1
smallest ids can be listed: further copies are ranked out before the scan, with a limit in each task
before the shuffle.  Queries with the same vector are searched once.  Scan work is a grid of query
blocks and candidate shares; blocks are dealt by hashes of their vectors (never by partition numbers), a
task holds the queries of its block and streams the candidates' cells past them.

Defined cases
* null vectors, and vectors with null or non-finite components, take no part; neither do null ids.
* rows of one id are one vector for the exclusion of the query itself; an id is listed once, with
  its best score.  Ties go to the smaller id.  Repeated rows change nothing.
* vectors of different lengths are not compared; a query without candidates has no rows; empty vectors
  score 0.
* an empty table, or one without queries, gives an empty result.  Only the two named columns are read,
  so other columns, clashing names included, don't matter.  Very long vectors are handled whole.
* scores are exact as long as every partial sum of products is below 2**53 in magnitude.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatlake.session import checkpointed, ship

CELLS, BLOCK, READ_STEP = 256, 2048, 32
QUERY_BLOCK, SHARE, SLICE, HELD, READ_SHARE = 8192, 1 << 20, 512, 1 << 21, 64
PACKED = "n int, dim int, ids binary, h1 binary, h2 binary, low binary, step binary, data binary"
SURVIVED = "q1 bigint, q2 bigint, id bigint, h1 bigint, h2 bigint, lower double, upper double"
FOUND = "q1 bigint, q2 bigint, vec_id bigint, score double"


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v array<double>, h1, h2) of the rows that take part; h1 and h2 are 128 bits of the vector."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter(F.col("id").isNotNull() & F.col("v").isNotNull()).filter(~bad)
    return rows.select("id", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(17), "v").alias("h2"))


def rankable(rows: DataFrame, k: int) -> DataFrame:
    """Each row once, and of each vector only its ``k`` smallest ids: others cannot be among k."""
    place = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("id"))
    return rows.dropDuplicates(["h1", "h2", "id"]).withColumn("place", place).filter(F.col("place") <= k).drop("place")


def matrices(batch: pa.RecordBatch, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their vectors) of up to ``size`` vectors of one length."""
    vectors = batch.column("v")
    dims = vectors.value_lengths().to_numpy(zero_copy_only=False)
    offsets, flat = vectors.offsets.to_numpy(), vectors.values.to_numpy(zero_copy_only=False)
    for dim in np.unique(dims):
        same = np.flatnonzero(dims == dim)
        for at in range(0, len(same), size):
            rows = same[at : at + size]
            yield rows, flat[offsets[rows][:, None] + np.arange(dim)].astype(np.float64)


def packed(batch: pa.RecordBatch, rows: np.ndarray, dim: int, low: np.ndarray, step: np.ndarray, data: np.ndarray) -> pa.RecordBatch:
    keys = [batch.column(c).to_numpy(zero_copy_only=False)[rows].astype(np.int64) for c in ("id", "h1", "h2")]
    blobs = [pa.array([x.tobytes()], pa.binary()) for x in (*keys, low, step, data)]
    return pa.RecordBatch.from_arrays([pa.array([len(rows)], pa.int32()), pa.array([dim], pa.int32()), *blobs], names=["n", "dim", "ids", "h1", "h2", "low", "step", "data"])


def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The vector-approximation file: a row for each block with its bounds and one cell a component."""
    for batch in batches:
        for rows, v in matrices(batch, BLOCK):
            low = v.min(axis=0)
            with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
                step = (v.max(axis=0) - low) / CELLS
                cells = np.where(step > 0, np.floor((v - low) / step), 0)
            yield packed(batch, rows, v.shape[1], low, step, np.clip(np.nan_to_num(cells), 0, CELLS - 1).astype(np.uint8))


def pack_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact query vectors, a row for each query block (``qb``) and length in a batch."""
    none = np.empty(0)
    for batch in batches:
        blocks = batch.column("qb").to_numpy(zero_copy_only=False)
        for qb in np.unique(blocks):
            part = batch.take(pa.array(np.flatnonzero(blocks == qb)))
            for rows, v in matrices(part, QUERY_BLOCK):
                row = packed(part, rows, v.shape[1], none, none, v)
                yield pa.RecordBatch.from_arrays([pa.array([int(qb)], pa.int32()), *row.columns], names=["qb", *row.schema.names])


class Scan:
    """Bounds of one block of queries (of one length) over the candidates' cells that stream past."""

    def __init__(self, q1: np.ndarray, q2: np.ndarray, queries: np.ndarray, k: int):
        self.q1, self.q2, self.queries, self.k = q1, q2, queries, k
        self.size = np.abs(queries)
        self.low = np.full((len(queries), k), -np.inf)  # the best lower bounds, of different ids
        self.ids = np.zeros((len(queries), k), np.int64)
        self.held: list[tuple[np.ndarray, ...]] = []
        self.n_held = 0

    def block(self, ids: np.ndarray, h1: np.ndarray, h2: np.ndarray, low: np.ndarray, step: np.ndarray, cells: np.ndarray) -> None:
        with np.errstate(over="ignore", invalid="ignore"):
            centre = low + (cells + 0.5) * step
            for at in range(0, len(self.queries), SLICE):
                rows = np.arange(at, min(at + SLICE, len(self.queries)))
                score = self.queries[rows] @ centre.T
                slack = self.size[rows] @ (0.5 * step + 1e-9 * (np.abs(low) + CELLS * step)) + 1e-9
                if not (np.isfinite(score).all() and np.isfinite(slack).all()):  # beyond the numbers' range: no bound
                    odd = ~np.isfinite(score + slack[:, None])
                    lower, upper = np.where(odd, -np.inf, score - slack[:, None]), np.where(odd, np.inf, score + slack[:, None])
                else:
                    lower, upper = score - slack[:, None], score + slack[:, None]
                on = np.flatnonzero(upper.max(axis=1) >= self.low[rows, -1])
                if len(on):
                    rows, lower, upper = rows[on], lower[on], upper[on]
                    self.raise_floor(rows, lower, ids)
                    a, b = np.nonzero(upper >= self.low[rows, -1][:, None])
                    self.held.append((rows[a], ids[b], h1[b], h2[b], lower[a, b], upper[a, b]))
                    self.n_held += len(a)

    def raise_floor(self, rows: np.ndarray, lower: np.ndarray, ids: np.ndarray) -> None:
        """Take the block's best lower bounds; an id counts once, or the k-th would be too high."""
        order = np.argsort(ids, kind="stable")
        new = np.flatnonzero(np.concatenate([[True], np.diff(ids[order]) != 0]))
        if len(new) < len(ids):
            lower, ids = np.maximum.reduceat(lower[:, order], new, axis=1), ids[order][new]
        top = np.argpartition(-lower, self.k - 1, axis=1)[:, : self.k] if lower.shape[1] > self.k else np.broadcast_to(np.arange(lower.shape[1]), lower.shape)
        low, found = np.concatenate([self.low[rows], np.take_along_axis(lower, top, axis=1)], axis=1), np.concatenate([self.ids[rows], ids[top]], axis=1)
        order = np.argsort(-low, axis=1, kind="stable")
        low, found = np.take_along_axis(low, order, axis=1), np.take_along_axis(found, order, axis=1)
        for j in range(1, low.shape[1]):
            low[(found[:, :j] == found[:, j : j + 1]).any(axis=1), j] = -np.inf
        order = np.argsort(-low, axis=1, kind="stable")[:, : self.k]
        self.low[rows], self.ids[rows] = np.take_along_axis(low, order, axis=1), np.take_along_axis(found, order, axis=1)

    def survivors(self) -> pa.RecordBatch:
        """Those that reach the floor so far; what came before is let go."""
        none = np.empty(0, np.int64)
        cols = [np.concatenate(c) for c in zip(*self.held, strict=True)] if self.held else [none, none, none, none, np.empty(0), np.empty(0)]
        self.held, self.n_held = [], 0
        kept = np.flatnonzero(cols[5] >= self.low[cols[0], -1])
        owner, *rest = (c[kept] for c in cols)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (self.q1[owner], self.q2[owner], *rest)], names=["q1", "q2", "id", "h1", "h2", "lower", "upper"])


def scan(k: int):
    """Over rows sorted by (qb, share, kind): queries are held, the candidates behind them stream past."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, scans = None, {}, {}
        ints, reals = (lambda b: np.frombuffer(b, np.int64)), (lambda b: np.frombuffer(b, np.float64))
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if (row["qb"], row["share"]) != key:
                    for s in scans.values():
                        yield s.survivors()
                    key, held, scans = (row["qb"], row["share"]), {}, {}
                dim, n = row["dim"], row["n"]
                if row["kind"] == 0:
                    held.setdefault(dim, []).append((ints(row["h1"]), ints(row["h2"]), reals(row["data"]).reshape(n, dim)))
                elif dim in held:
                    if dim not in scans:
                        scans[dim] = Scan(*map(np.concatenate, zip(*held[dim], strict=True)), k)
                    cells = np.frombuffer(row["data"], np.uint8).reshape(n, dim)
                    scans[dim].block(ints(row["ids"]), ints(row["h1"]), ints(row["h2"]), reals(row["low"]), reals(row["step"]), cells)
                    if scans[dim].n_held > HELD:
                        yield scans[dim].survivors()
        for s in scans.values():
            yield s.survivors()

    return run


class Best:
    """The k best (score, id) so far of one query, each id with its best score."""

    def __init__(self, k: int):
        self.k, self.kth = k, -np.inf
        self.scores, self.ids = np.empty(0), np.empty(0, np.int64)

    def take(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))
        order = order[np.sort(np.unique(ids[order], return_index=True)[1])][: self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.kth = self.scores[-1]


def read_exact(k: int):
    """Over rows sorted by (q1, q2, reader, kind, upper falling): the query's vector, then its survivors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, query, best, out = None, None, Best(k), []

        def done() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) if out else [[]] * 4
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["q1", "q2", "vec_id", "score"])

        for batch in batches:
            q1, q2, reader, kind, ids, upper = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("q1", "q2", "reader", "kind", "id", "upper"))
            vectors = batch.column("v")
            offsets, flat = vectors.offsets.to_numpy(), vectors.values.to_numpy(zero_copy_only=False)
            new = np.flatnonzero(np.concatenate([[True], (q1[1:] != q1[:-1]) | (q2[1:] != q2[:-1]) | (reader[1:] != reader[:-1])])) if len(q1) else []
            for start, stop in zip(new, [*new[1:], len(q1)], strict=True):
                if (q1[start], q2[start], reader[start]) != key:
                    if key is not None:
                        out.extend((*key[:2], int(i), float(s)) for i, s in zip(best.ids, best.scores, strict=True))
                    key, query, best = (int(q1[start]), int(q2[start]), int(reader[start])), None, Best(k)
                if kind[start] == 0:
                    query = flat[offsets[start] : offsets[start + 1]]
                    start += 1
                for at in range(start, stop, READ_STEP):
                    if query is None or upper[at] < best.kth:
                        break  # no later bound is higher: certain
                    end = min(at + READ_STEP, stop)
                    best.take(flat[offsets[at] : offsets[end]].reshape(end - at, len(query)) @ query, ids[at:end].astype(np.int64))
            if len(out) > 10_000:
                yield done()
        if key is not None:
            out.extend((*key[:2], int(i), float(s)) for i, s in zip(best.ids, best.scores, strict=True))
        yield done()

    return run


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score double: each query's k best among the other ids."""
    ship(vectors.sparkSession)
    conf = vectors.sparkSession.conf
    wide = k + 1  # the query itself may be among its best
    asked = checkpointed(usable(queries, id_col, vec_col).dropDuplicates(["h1", "h2", "id"]))
    distinct = asked.dropDuplicates(["h1", "h2"])
    exact = checkpointed(rankable(usable(vectors, id_col, vec_col), wide))
    n_blocks = max(1, -(-distinct.count() // QUERY_BLOCK))
    shares = max(-(-exact.count() // SHARE), -(-int(conf.get("spark.sql.shuffle.partitions")) // n_blocks))

    places = ["qb", "share", "kind", "n", "dim", "ids", "h1", "h2", "low", "step", "data"]
    blocks = distinct.withColumn("qb", F.pmod("h1", F.lit(n_blocks)).cast("int")).repartition("qb").mapInArrow(pack_queries, f"qb int, {PACKED}")
    blocks = blocks.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))).withColumn("kind", F.lit(0))
    cells = checkpointed(exact.mapInArrow(quantise, PACKED)).withColumn("share", F.pmod(F.xxhash64("h1"), F.lit(shares)).cast("int"))
    cells = cells.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).withColumn("kind", F.lit(1))
    grid = blocks.select(*places).unionByName(cells.select(*places)).repartition("qb", "share").sortWithinPartitions("qb", "share", "kind")
    survived = checkpointed(grid.mapInArrow(scan(wide), SURVIVED))

    lowest = survived.groupBy("q1", "q2", "id").agg(F.max("lower").alias("lower"))
    lowest = lowest.withColumn("place", F.row_number().over(Window.partitionBy("q1", "q2").orderBy(F.desc("lower")))).filter(F.col("place") <= wide)
    floors = lowest.filter(F.col("place") == wide).select("q1", "q2", F.col("lower").alias("floor"))
    readers = F.ceil(F.col("n") / READ_SHARE).cast("int").alias("readers")
    asks = survived.groupBy("q1", "q2").agg(F.count(F.lit(1)).alias("n")).join(floors, ["q1", "q2"], "left").select(F.col("q1").alias("f1"), F.col("q2").alias("f2"), "floor", readers)
    asks = checkpointed(asks)
    left = survived.join(asks, (F.col("q1") == F.col("f1")) & (F.col("q2") == F.col("f2"))).filter(F.col("floor").isNull() | (F.col("upper") >= F.col("floor")))
    reads = left.withColumn("reader", F.pmod("h1", F.col("readers")).cast("int")).select("q1", "q2", "reader", "id", "h1", "h2", "upper").join(exact, ["id", "h1", "h2"])
    reads = reads.select("q1", "q2", "reader", F.lit(1).alias("kind"), "id", "upper", "v")
    firsts = distinct.join(asks, (F.col("h1") == F.col("f1")) & (F.col("h2") == F.col("f2"))).withColumn("reader", F.explode(F.sequence(F.lit(0), F.col("readers") - 1)))
    firsts = firsts.select(F.col("h1").alias("q1"), F.col("h2").alias("q2"), "reader", F.lit(0).alias("kind"), "id", F.lit(float("inf")).alias("upper"), "v")
    # a key of its own: both sides may already be dealt by (q1, q2), which the union would pass on and adaptive reads undo
    both = firsts.unionByName(reads).withColumn("deal", F.xxhash64("q1", "q2", "reader"))
    ordered = both.repartition("deal").sortWithinPartitions("q1", "q2", "reader", "kind", F.desc("upper"))
    found = ordered.mapInArrow(read_exact(wide), FOUND)

    own = asked.select(F.col("id").alias("query_id"), "h1", "h2").join(found, (F.col("h1") == F.col("q1")) & (F.col("h2") == F.col("q2"))).filter(F.col("query_id") != F.col("vec_id"))
    once = own.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = once.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
