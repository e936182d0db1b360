"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item are compared only if they share a seed, a run of ``MIN_MATCH``
tokens.  For such a pair, the longest common runs of tokens that overlap no earlier tile are marked
again and again, until none of ``MIN_MATCH`` tokens is left; since tiles may stand in any order,
reordered passages are caught.  A document is contaminated by an item if its tiles cover at least
``COVERAGE`` of the item's tokens.  Seeds are Karp-Rabin fingerprints of the token windows; they are
verified by growing the match token by token.

Two plans, by a check of the benchmark's size.  Up to ``BROADCAST_CHARS`` characters the items and
their seeds are broadcast, and one pass over the documents finds and tiles the pairs: no shuffle.
Beyond, seeds of both sides meet in a shuffle join.  Tiles of ``MIN_MATCH`` tokens and more that cover a share
of an item need a number of its seeds; so the most frequent seeds of each item, up to half of that number, are left
out of the join (no seed that everybody uses joins all with all), and a pair must share the rest of the number
before its texts are moved and tiled, once for each different text.  Both use the same tiling and give the same rows.

Defined cases
* tokens are runs of word characters in lower case; null texts have none.
* items with fewer than ``MIN_MATCH`` tokens are too short to be evidence and match nothing.
* ties between equally long matches: the earliest in the item, then in the document.
* each row is judged by itself, so repeated rows and null ids each get their own hits; repeated
  items each report.  Empty tables give empty results; only the named columns are read.
* very long texts are tiled whole.  Other columns of the documents, clashing names included, don't matter.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatlake.session import checkpointed, ship

MIN_MATCH, COVERAGE, BROADCAST_CHARS = 4, 0.5, 16 << 20
TOKEN = re.compile(r"\w+")
HIT = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("coverage", T.DoubleType()), T.StructField("n_tiles", T.IntegerType()), T.StructField("longest", T.IntegerType())])
HITS = T.ArrayType(HIT)
BASE = np.uint64(0x100000001B3)


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").lower())


def fingerprints(codes: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin fingerprints of all windows of ``size`` codes."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for i in range(size):
        h = h * BASE + codes[i : i + n].astype(np.uint64)
    return h


def greedy_tiles(item: np.ndarray, text: np.ndarray, seeds: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """(item start, text start, length) of the tiles; ``seeds`` are equal windows (item, text)."""
    diagonal = seeds[:, 1] - seeds[:, 0]
    order = np.lexsort((seeds[:, 0], diagonal))
    p, d = seeds[order, 0], diagonal[order]
    new = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (p[1:] != p[:-1] + 1)]))
    ends = np.append(new[1:], len(p)) - 1
    heap = [(-(int(p[e]) - int(p[s]) + size), int(p[s]), int(p[s] + d[s])) for s, e in zip(new, ends, strict=True)]
    heapq.heapify(heap)
    marked_item, marked_text, tiles = np.zeros(len(item), bool), np.zeros(len(text), bool), []
    while heap:
        length, at_item, at_text = heapq.heappop(heap)
        length = -length
        free = ~(marked_item[at_item : at_item + length] | marked_text[at_text : at_text + length])
        if free.all():
            tiles.append((at_item, at_text, length))
            marked_item[at_item : at_item + length] = True
            marked_text[at_text : at_text + length] = True
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[0], free.astype(np.int8), [0]])))
        for start, stop in zip(edges[::2], edges[1::2], strict=True):
            if stop - start >= size:
                heapq.heappush(heap, (-int(stop - start), at_item + int(start), at_text + int(start)))
    return tiles


class Benchmark:
    """Items, their token codes and the sorted fingerprints of their seeds."""

    def __init__(self, items: list[tuple[int | None, str | None]], size: int = MIN_MATCH):
        self.size, self.ids, self.code = size, [i for i, _ in items], {}
        self.items = [np.array([self.code.setdefault(w, len(self.code) + 1) for w in tokens(t)], np.int64) for _, t in items]
        prints = [fingerprints(x, size) for x in self.items]
        seeds = np.concatenate([*prints, np.empty(0, np.uint64)])
        owner = np.repeat(np.arange(len(items)), [len(x) for x in prints])
        place = np.concatenate([*[np.arange(len(x)) for x in prints], np.empty(0, np.int64)])
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.owner, self.place = seeds[order], owner[order], place[order].astype(np.int64)

    def hits(self, text: str | None, coverage: float) -> list[tuple[int | None, float, int, int]]:
        code = self.code
        doc = np.fromiter((code.get(w, 0) for w in tokens(text)), np.int64)
        if len(doc) < self.size or not len(self.seeds):
            return []
        prints = fingerprints(doc, self.size)
        known = np.cumsum(np.concatenate([[0], doc > 0]))
        whole = np.flatnonzero(known[self.size :] - known[: -self.size] == self.size)
        first = np.searchsorted(self.seeds, prints[whole], "left")
        count = np.searchsorted(self.seeds, prints[whole], "right") - first
        met = np.flatnonzero(count)
        if not len(met):
            return []
        reps = count[met]
        at = np.repeat(first[met] - np.concatenate([[0], np.cumsum(reps)[:-1]]), reps) + np.arange(reps.sum())
        place_doc = np.repeat(whole[met], reps)
        owner, place = self.owner[at], self.place[at]
        out = []
        for i in np.unique(owner):
            mine = owner == i
            item, seeds = self.items[i], np.stack([place[mine], place_doc[mine]], axis=1)
            same = np.all([item[seeds[:, 0] + k] == doc[seeds[:, 1] + k] for k in range(self.size)], axis=0)
            seeds = seeds[same]
            may = np.zeros(len(item) + 1, np.int64)  # no tiling covers more than the seeds do
            np.add.at(may, seeds[:, 0], 1)
            np.add.at(may, np.minimum(seeds[:, 0] + self.size, len(item)), -1)
            if not len(seeds) or (np.cumsum(may[:-1]) > 0).sum() < coverage * len(item):
                continue
            tiles = greedy_tiles(item, doc, seeds, self.size)
            share = sum(x[2] for x in tiles) / len(item)
            if share >= coverage:
                out.append((self.ids[i], share, len(tiles), max(x[2] for x in tiles)))
        return out


def hit_array(rows: list[list[tuple]]) -> pa.Array:
    return pa.array([[dict(zip(HIT.names, h, strict=True)) for h in r] for r in rows], pa.list_(pa.struct([("item_id", pa.int64()), ("coverage", pa.float64()), ("n_tiles", pa.int32()), ("longest", pa.int32())])))


def small(benchmark: DataFrame, limit: int = BROADCAST_CHARS, text_col: str = "text") -> bool:
    """Whether all items together fit the broadcast's bound."""
    return (benchmark.agg(F.sum(F.length(text_col) + 16).alias("n")).first()["n"] or 0) <= limit


def hits_column(benchmark: DataFrame, text: Column, size: int = MIN_MATCH, coverage: float = COVERAGE, id_col: str = "item_id", text_col: str = "text") -> Column:
    """The hits of each text, for a benchmark that ``small`` has passed."""
    ship(benchmark.sparkSession)
    items = [(r[0], r[1]) for r in benchmark.select(F.col(id_col).cast("long"), text_col).collect()]
    shared = benchmark.sparkSession.sparkContext.broadcast(items)

    @F.arrow_udf(HITS)
    def find(texts: pa.Array) -> pa.Array:
        known = _ready(shared, size)
        return hit_array([known.hits(t, coverage) for t in texts.to_pylist()])

    return find(text)


_KEPT: dict = {}


def _ready(shared, size: int) -> Benchmark:
    """One Benchmark per worker and broadcast."""
    key = (shared._path if hasattr(shared, "_path") else id(shared), size)
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = Benchmark(shared.value, size)
    return _KEPT[key]


SEEDS = T.ArrayType(T.StructType([T.StructField("seed", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("size", T.IntegerType())]))


@F.arrow_udf(SEEDS)
def seed_counts(texts: pa.Array) -> pa.Array:
    """The distinct seeds of each text, how often each occurs, and the text's tokens."""
    out = []
    for t in texts.to_pylist():
        w = tokens(t)
        found = Counter(" ".join(w[i : i + MIN_MATCH]) for i in range(len(w) - MIN_MATCH + 1))
        out.append([{"seed": x, "n": n, "size": len(w)} for x, n in sorted(found.items())])
    return pa.array(out, pa.list_(pa.struct([("seed", pa.string()), ("n", pa.int32()), ("size", pa.int32())])))


def tile_pairs(size: int, coverage: float):
    @F.arrow_udf(HITS)
    def tiled(item_ids: pa.Array, item_texts: pa.Array, texts: pa.Array) -> pa.Array:
        return hit_array([Benchmark([(i, x)], size).hits(t, coverage) for i, x, t in zip(item_ids.to_pylist(), item_texts.to_pylist(), texts.to_pylist(), strict=True)])

    return tiled


def candidate_pairs(texts: DataFrame, items: DataFrame, coverage: float) -> DataFrame:
    """(t1, t2, item_key) of texts (t1, t2, text) and items (item_key, item_text) with enough common seeds.

    Tiles that cover ``coverage`` of an item's tokens hold at least that many, divided by ``MIN_MATCH``, of its
    windows.  Half of these may be among its most frequent seeds, which are not joined.
    """
    wanted = checkpointed(items.select("item_key", F.inline(seed_counts(F.col("item_text")))).dropDuplicates(["item_key", "seed"]))
    known = wanted.select("seed").distinct()
    held = checkpointed(texts.select("t1", "t2", F.explode(seed_counts(F.col("text"))).alias("x")).select("t1", "t2", "x.seed").join(known, "seed", "left_semi").distinct())
    often = held.groupBy(F.col("seed").alias("o_seed")).agg(F.count(F.lit(1)).alias("texts"))
    ranked = wanted.join(often, F.col("seed") == F.col("o_seed"))
    before = F.sum("n").over(Window.partitionBy("item_key").orderBy(F.desc("texts"), "seed").rowsBetween(Window.unboundedPreceding, 0))
    need = F.greatest(F.lit(1), F.ceil(F.col("size") * coverage / MIN_MATCH - 1e-9))
    ranked = ranked.withColumn("need", need).withColumn("common", before <= F.floor(need / 2))
    spared = F.coalesce(F.sum(F.when(F.col("common"), F.col("n"))).over(Window.partitionBy("item_key")), F.lit(0))
    joined = ranked.withColumn("rest", F.col("need") - spared).filter(~F.col("common")).select("seed", "item_key", "n", "rest")
    return held.join(joined, "seed").groupBy("t1", "t2", "item_key").agg(F.sum("n").alias("n"), F.max("rest").alias("rest")).filter(F.col("n") >= F.col("rest")).select("t1", "t2", "item_key")


def shuffled_hits(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, text hash, hit) by a shuffle join on seeds, for a benchmark of any size."""
    own = docs.select("doc_id", "text", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(17), "text").alias("t2"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("item_text"), F.md5(F.coalesce("text", F.lit(""))).alias("item_key"))
    pairs = checkpointed(candidate_pairs(own.select("t1", "t2", "text"), items.select("item_key", "item_text"), coverage))
    texts = own.select("t1", "t2", "text").join(pairs.select("t1", "t2").distinct(), ["t1", "t2"], "left_semi").dropDuplicates(["t1", "t2"])
    tiled = texts.join(pairs, ["t1", "t2"]).join(items, "item_key").select("t1", "t2", F.explode(tile_pairs(MIN_MATCH, coverage)("item_id", "item_text", "text")).alias("hit"))
    return own.select("doc_id", "t1", "t2").join(tiled, ["t1", "t2"]).select("doc_id", "t1", "t2", "hit")


def find_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, limit: int = BROADCAST_CHARS) -> DataFrame:
    """doc_id, item_id, coverage, n_tiles, longest: one row for each contaminated row and its item."""
    ship(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    if small(benchmark, limit):
        hits = docs.select("doc_id", F.explode(hits_column(benchmark, F.col("text"), coverage=coverage)).alias("hit"))
    else:
        hits = shuffled_hits(docs, benchmark, coverage)
    return hits.select("doc_id", "hit.*")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, limit: int = BROADCAST_CHARS) -> DataFrame:
    """``docs`` without the contaminated rows."""
    ship(docs.sparkSession)
    if small(benchmark, limit):
        return docs.filter(F.size(hits_column(benchmark, docs["text"], coverage=coverage)) == 0)
    bad = shuffled_hits(docs.select("doc_id", "text"), benchmark, coverage).select("t1", "t2").distinct()
    return docs.join(bad, (F.xxhash64(docs["text"]) == bad["t1"]) & (F.xxhash64(F.lit(17), docs["text"]) == bad["t2"]), "left_anti")
