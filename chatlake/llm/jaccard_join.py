"""N-gram Jaccard join with MinHash banding.

A document's set is its distinct word 5-grams (its whole word sequence, if shorter).  Documents with
the same word sequence are one class, represented by its smallest doc_id.  Classes whose MinHash
signatures agree in a whole band meet in a bucket; the numbers of bands and rows are chosen for a
target recall at the similarity threshold.  Every pair of a bucket is verified on the full n-gram
sets, once: in the first band in which it agrees.

Whole results without pair lists: a bucket's pairs are verified block against block inside tasks,
and only per-class link counts and the roots of locally linked groups come out.  Buckets with the
same members are verified once; large ones are cut into blocks of bounded document and word counts,
which are dealt out as block pairs, so the work of one hot group is spread.  Sets are never
broadcast or collected; texts travel to the buckets of their class only.  Links are then joined into
components with checkpointed rounds.

Defined cases
* null or word-less texts have no n-grams: they link to nothing, each row is a class of its own.
* a null doc_id takes part like any other, ranks after all ids, and is never reported as class_id
  where a document of the group has an id.
* repeated rows count as copies.  Ties: the smallest doc_id represents.
* very long texts are compared whole; n-gram counts are accumulated in column chunks.
* an empty table gives an empty result; only doc_id and text are read, so other columns don't matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatlake.llm.components import components
from chatlake.llm.names import fresh
from chatlake.session import checkpointed, ship

N, THRESHOLD, RECALL, MAX_HASHES = 5, 0.8, 0.9999, 128
BLOCK_DOCS, BLOCK_WORDS, CHUNK = 256, 1 << 20, 4096
SEED = 20240


def bands_and_rows(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """The most rows a band, and bands for them, that reach the recall within the hash budget."""
    best = (math.ceil(math.log(1 - recall) / math.log(1 - threshold)), 1)
    for rows in range(2, max_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows)))
        if bands * rows <= max_hashes:
            best = (bands, rows)
    return best


def normal(text: Column) -> Column:
    """Lower case, words joined by one space."""
    return F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+", " "))


def word_hashes(norm: Column) -> Column:
    return F.transform(F.split(norm, " "), lambda w: F.xxhash64(w))


def shingles(words: np.ndarray, n: int = N) -> np.ndarray:
    """Distinct 64-bit hashes of the n-grams of a sequence of word hashes."""
    w = words.astype(np.uint64)
    n = min(n, len(w))
    h = np.zeros(len(w) - n + 1, np.uint64)
    for i in range(n):
        h = (h ^ w[i : len(w) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return np.unique(h)


def multipliers(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.integers(1, 1 << 32, count, dtype=np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, count, dtype=np.uint32)


def band_hashes(sets: np.ndarray, bands: int, rows: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit hash a band from the MinHash signature of a set."""
    x = (sets >> np.uint64(32)).astype(np.uint32)
    least = np.full(bands * rows, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 8192):
        np.minimum(least, (a[:, None] * x[None, at : at + 8192] + b[:, None]).min(axis=1), out=least)
    sig = least.reshape(bands, rows).astype(np.uint64)
    out = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for r in range(rows):
        out = (out ^ sig[:, r]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return out.astype(np.int64)


def signatures(bands: int, rows: int, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = multipliers(bands * rows)
        for batch in batches:
            column = batch.column("words")
            offsets, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
            out = np.empty((batch.num_rows, bands), np.int64)
            for i in range(batch.num_rows):
                out[i] = band_hashes(shingles(flat[offsets[i] : offsets[i + 1]], n), bands, rows, a, b)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * bands), pa.array(out.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("k"), pc.list_value_length(column).cast(pa.int64()), lists], names=["doc_id", "k", "n_words", "bands"])

    return run


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of ``left`` with all of ``right``, in bounded memory."""
    if len(left) * len(right) <= 4:
        return np.array([[len(np.intersect1d(x, y, assume_unique=True)) for y in right] for x in left], np.int64)
    sets = left + right
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, code, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[code] > 1  # an n-gram of one document adds nothing
    column = np.cumsum(count > 1)[code[shared]] - 1
    owner = owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((len(left), len(right)), np.float32)
    width = column[-1] + 1 if len(column) else 0
    for at in range(0, width, CHUNK):
        lo, hi = np.searchsorted(column, [at, at + CHUNK])
        m = np.zeros((len(sets), min(CHUNK, width - at)), np.float32)
        m[owner[lo:hi], column[lo:hi] - at] = 1
        out += m[: len(left)] @ m[len(left) :].T
    return np.rint(out).astype(np.int64)


def local_roots(linked: np.ndarray, names: list[bytes]) -> list[bytes]:
    """The smallest name of each node's component of a symmetric adjacency matrix."""
    order = np.argsort(np.array(names, dtype=object))
    label = np.empty(len(names), np.int64)
    label[order] = np.arange(len(names))
    while True:
        near = np.where(linked, label[None, :], len(names)).min(axis=1)
        new = np.minimum(label, near)
        if (new == label).all():
            return [names[order[i]] for i in label]
        label = new


def verify_group(rows: list[dict], band: int, lo: int, hi: int, threshold: float, n: int) -> list[tuple]:
    """(k, linked documents, linked classes, root) of the classes with a link in one block pair."""
    left = [r for r in rows if r["block"] == lo]
    right = left if lo == hi else [r for r in rows if r["block"] == hi]
    if not left or not right:
        return []
    sl = [shingles(r["words"], n) for r in left]
    sr = sl if lo == hi else [shingles(r["words"], n) for r in right]
    bl, br = np.array([r["bands"] for r in left]), np.array([r["bands"] for r in right])
    both = overlaps(sl, sr)
    size_l, size_r = np.array([len(s) for s in sl]), np.array([len(s) for s in sr])
    near = both >= threshold * (size_l[:, None] + size_r[None, :] - both) - 1e-9
    if lo == hi:
        np.fill_diagonal(near, False)
    for earlier in range(band):
        near &= bl[:, None, earlier] != br[None, :, earlier]
    out = []
    nodes = left if lo == hi else left + right
    names = [r["k"] for r in nodes]
    if lo == hi:
        linked = near
    else:
        linked = np.zeros((len(nodes), len(nodes)), bool)
        linked[: len(left), len(left) :] = near
        linked[len(left) :, : len(left)] = near.T
    if not linked.any():
        return []
    weights = np.array([r["size"] for r in nodes], np.int64)
    roots = local_roots(linked, names)
    for i in np.flatnonzero(linked.any(axis=1)):
        out.append((names[i], int(weights[linked[i]].sum()), int(linked[i].sum()), roots[i]))
    return out


def verify(threshold: float, n: int):
    """Over rows sorted by (bh, lo, hi): verify one block pair after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, out = None, [], []

        def done() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) if out else [[]] * 4
            rb = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["k", "docs", "classes", "root"])
            out.clear()
            return rb

        for batch in batches:
            words = batch.column("words")
            offsets, flat = words.offsets.to_numpy(), words.values.to_numpy(zero_copy_only=False)
            rest = batch.drop_columns(["words"]).to_pylist()
            for i, row in enumerate(rest):
                now = (row["bh"], row["lo"], row["hi"])
                if now != key:
                    if held:
                        out.extend(verify_group(held, held[0]["band"], *key[1:], threshold, n))
                    key, held = now, []
                row["words"] = flat[offsets[i] : offsets[i + 1]].copy()
                held.append(row)
            if len(out) > 10_000:
                yield done()
        if held:
            out.extend(verify_group(held, held[0]["band"], *key[1:], threshold, n))
        yield done()

    return run


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, norm, k): k is 128 bits of the normalised text."""
    norm = docs.select(F.col(id_col).alias("doc_id"), normal(F.col(text_col)).alias("norm"))
    return norm.withColumn("k", F.unhex(F.md5("norm")))


def join(docs: DataFrame, threshold: float = THRESHOLD, n: int = N, recall: float = RECALL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, k, copy_of, class_id, class_k, n_links, class_size.

    ``copy_of`` is the smallest doc_id with the same words, ``class_id`` the smallest doc_id of the
    documents that links connect and ``class_k`` the text hash of that one, ``n_links`` the number of other documents at or over the
    threshold, copies included.
    """
    ship(docs.sparkSession)
    spark = docs.sparkSession
    bands, rows = bands_and_rows(threshold, recall)
    source = keyed(docs, id_col, text_col)
    shaped = source.filter(F.col("norm") != "").select("doc_id", "k", word_hashes(F.col("norm")).alias("words"))
    kind = docs.schema[id_col].dataType.simpleString()
    signed = checkpointed(shaped.mapInArrow(signatures(bands, rows, n), f"doc_id {kind}, k binary, n_words bigint, bands array<bigint>"))
    classes = checkpointed(signed.groupBy("k").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("size"), F.first("n_words").alias("n_words"), F.first("bands").alias("bands")))

    spread = classes.select("k", "n_words", F.posexplode("bands").alias("band", "bh"))
    stats = spread.groupBy("bh").agg(F.count(F.lit(1)).alias("n"), F.sum("n_words").alias("w"), F.min("band").alias("band"), F.bit_xor(F.xxhash64("k")).alias("f1"), F.bit_xor(F.xxhash64(F.lit(3), "k")).alias("f2")).filter(F.col("n") > 1)
    once = stats.groupBy("n", "f1", "f2").agg(F.min(F.struct("band", "bh", "w")).alias("x")).select("x.band", "x.bh", F.greatest(F.ceil(F.col("n") / BLOCK_DOCS), F.ceil(F.col("x.w") / BLOCK_WORDS)).cast("int").alias("blocks"))
    members = checkpointed(spread.select("k", "bh").join(once, "bh"))
    candidates = members.select("k").distinct()

    texts = source.join(classes.join(candidates, "k").select(F.col("k").alias("c_k"), "rep", "size", "bands"), (F.col("k") == F.col("c_k")) & F.col("doc_id").eqNullSafe(F.col("rep")))
    texts = texts.select("k", "size", "bands", "norm").dropDuplicates(["k"])
    own = F.pmod(F.xxhash64("k"), F.col("blocks")).cast("int")
    dealt = members.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("k", "bh", "band", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    grouped = dealt.join(texts, "k").repartition("bh", "lo", "hi").sortWithinPartitions("bh", "lo", "hi")
    checked = grouped.select("bh", "lo", "hi", "band", "block", "k", "size", "bands", word_hashes(F.col("norm")).alias("words")).mapInArrow(verify(threshold, n), "k binary, docs bigint, classes bigint, root binary")
    links = checkpointed(checked)

    roots = components(links.filter(F.col("k") != F.col("root")).select(F.col("k").alias("a"), F.col("root").alias("b")))
    counted = links.groupBy(F.col("k").alias("n_k")).agg(F.sum("docs").alias("linked"))
    named = classes.select("k", "rep", "size").join(counted, F.col("k") == F.col("n_k"), "left").join(roots.withColumnRenamed("node", "r_k"), F.col("k") == F.col("r_k"), "left")
    named = named.select("k", "rep", "size", F.coalesce("linked", F.lit(0)).alias("linked"), F.coalesce("root", "k").alias("root"))
    first = F.min(F.struct(F.col("rep").isNull().alias("no_id"), F.col("rep").alias("id"), F.col("k").alias("k")))
    groups = named.groupBy("root").agg(first.alias("first"), F.sum("size").alias("class_size"))
    table = checkpointed(named.join(groups, "root").select(F.col("k").alias("t_k"), F.col("rep").alias("copy_of"), F.col("first.id").alias("class_id"), F.col("first.k").alias("class_k"), (F.col("size") - 1 + F.col("linked")).alias("n_links"), "class_size"))
    with_words = signed.select("doc_id", "k").join(table, F.col("k") == F.col("t_k")).select("doc_id", "k", "copy_of", "class_id", "class_k", "n_links", "class_size")
    without = source.filter(F.col("norm") == "").select("doc_id", "k", F.col("doc_id").alias("copy_of"), F.col("doc_id").alias("class_id"), F.col("k").alias("class_k"), F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("class_size"))
    return with_words.unionByName(without)


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, n: int = N) -> DataFrame:
    """``docs`` with one row of each group of linked documents, that of class_id.

    Rows without words all stay.  Of repeated rows of the kept document, one stays.
    """
    joined = join(docs, threshold, n)
    row_key = lambda i, k: F.unhex(F.md5(F.concat_ws("|", F.coalesce(i.cast("string"), F.lit("null")), F.hex(k))))
    kept = joined.filter(F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("k") == F.col("class_k"))).select(row_key(F.col("doc_id"), F.col("k")).alias("kept")).distinct()
    norm = normal(docs["text"])
    alone, own, rank = fresh(docs, "alone", "own", "rank")
    marked = docs.withColumn(own, row_key(docs["doc_id"], F.unhex(F.md5(norm)))).withColumn(alone, F.when(norm == "", F.monotonically_increasing_id()))
    met = marked.join(kept, marked[own] == kept["kept"], "left_semi")
    ranked = met.withColumn(rank, F.row_number().over(Window.partitionBy(own, alone).orderBy(own)))  # limited in each task first
    return ranked.filter(F.col(rank) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
