"""MinHash near-dedup by an inverted join over the coordinates of signatures.

A document's set is its distinct word pairs (its whole word sequence, if shorter); documents with the same set are
one class.  A class has a signature of ``COORDS`` minima.  It is posted under coordinate-value pairs: two sets with
a Jaccard similarity of 0.8 agree in ``t`` coordinates at least, but for a chance of ``MISS`` (2e-7), so they share
one of the ``COORDS - t + 1`` rarest pairs of each.  Only this prefix is posted, the long lists beyond are skipped;
members of a list then count their collisions over all coordinates (4 bits of each, so never too few), and only
members with a partner of ``t`` collisions stay.  How rare a pair is comes from a table of 2^20 counters, a fixed size
at any scale; it decides the order of the pairs alone, not the result.

Links are confirmed on full sets, whole texts.  Components are wanted, not pairs, so the pairs checked are few:

1. each member's best partner in its list, over lists of any length cut into chunks;
2. then members outside the component of their list's best-linked member, against that one;
3. all pairs of a list with ``t`` collisions that are still in different components, block against block inside tasks,
   each in the first list that both members share.  This alone makes the result whole; 1 and 2 make it cheap.

No list is held in one task, no pair list is written but one partner a posting, and nothing of the documents
reaches the driver.

Defined cases
* null and word-less texts have an empty set: linked with nothing, each row is a component of its own.
* a null doc_id takes part, ranks after all ids, and is a component's id only where no document of it has one.
* repeated rows and ties: rows with the same set are linked; the smallest doc_id names the component, and all rows
  that carry it are kept.
* very long texts are compared whole; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlake.llm.components import components
from chatlake.llm.jaccard_join import multipliers, shingles
from chatlake.llm.names import fresh
from chatlake.llm.phrase_mining import bit_table, found
from chatlake.llm.tables import written
from chatlake.llm.words import mixed, slices, words
from chatlake.session import ship

N, PERCENT, COORDS, MISS = 2, 80, 64, 2e-7
BUCKET_BITS, PAGE_BITS = 20, 14
CHUNK, SHORT, BLOCK, ROUNDS, SALTED = 4096, 32, 256, 2, 64


def least_matches(coords: int = COORDS, percent: int = PERCENT, miss: float = MISS) -> int:
    """The most coordinates t in which sets at the threshold agree, but for a chance of ``miss``."""
    p, below = percent / 100, 0.0
    for t in range(coords + 1):
        below += math.comb(coords, t) * p**t * (1 - p) ** (coords - t)
        if below > miss:
            return t
    return coords


def sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The shingle hashes of each text, distinct and in order; none for a text without words."""
    for buf, offsets in slices(texts):
        _, _, h, first = words(buf, offsets)
        for i in range(len(offsets) - 1):
            own = h[first[i] : first[i + 1]]
            yield shingles(own, n) if len(own) else own


def minima(s: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (s >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 8192):
        np.minimum(least, (a[:, None] * x[None, at : at + 8192] + b[:, None]).min(axis=1), out=least)
    return least


def signed(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = multipliers(COORDS)
        for batch in batches:
            keys, sizes, signatures = [], [], []
            for s in sets(batch.column("text"), n):
                sizes.append(len(s))
                keys.append(hashlib.md5(s.tobytes()).digest() if len(s) else None)
                signatures.append(minima(s, a, b).tobytes() if len(s) else None)
            made = [pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("h"), *made], names=["doc_id", "h", "k", "n_shingles", "sig"])

    return run


def matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    """Binary values of one length as rows of numbers."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, kind, (offsets[-1] - offsets[0]) // np.dtype(kind).itemsize, offsets[0]).reshape(-1, width) if len(column) else np.zeros((0, width), kind)


def pairs_of(sig: np.ndarray) -> np.ndarray:
    """The coordinate-value pairs of signatures, as spread 64-bit numbers."""
    return mixed((np.arange(COORDS, dtype=np.uint64) << np.uint64(32))[None] | sig.astype(np.uint64))


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many classes of this task have a pair in each counter, by pages of counters."""
    table = np.zeros(1 << BUCKET_BITS, np.int64)
    for batch in batches:
        at = pairs_of(matrix(batch.column("sig"), COORDS, np.uint32)) >> np.uint64(64 - BUCKET_BITS)
        table += np.bincount(at.reshape(-1).astype(np.int64), minlength=len(table))
    pages = table.reshape(-1, 1 << PAGE_BITS)
    used = np.flatnonzero(pages.any(axis=1))
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([pages[p].tobytes() for p in used], pa.binary())], names=["page", "counts"])


def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pages: dict[int, np.ndarray] = {}
    for batch in batches:
        for page, counts in zip(batch.column("page").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            pages[page] = pages.get(page, 0) + np.frombuffer(counts, np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(pages, pa.int32()), pa.array([c.tobytes() for c in pages.values()], pa.binary())], names=["page", "counts"])


def rarity(classes: DataFrame) -> np.ndarray:
    """Eight times the binary logarithm of each counter: 1 MiB, whatever the number of documents."""
    ddl = "page int, counts binary"
    rows = classes.select("sig").mapInArrow(counted, ddl).repartition("page").mapInArrow(summed, ddl).collect()  # 8 MiB at most
    table = np.zeros((1 << BUCKET_BITS - PAGE_BITS, 1 << PAGE_BITS), np.int64)
    for r in rows:
        table[r["page"]] = np.frombuffer(r["counts"], np.int64)
    return np.minimum(255, np.round(8 * np.log2(np.maximum(1, table)))).astype(np.uint8).reshape(-1)


def prefixes(sig: np.ndarray, table: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """(pairs, mask): all pairs of each signature, and which of them are among its COORDS - t + 1 rarest."""
    pairs = pairs_of(sig)
    rank = (table[(pairs >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (pairs & np.uint64((1 << 56) - 1))
    last = np.sort(rank, axis=1)[:, COORDS - t]
    return pairs, rank <= last[:, None]


def posted(table: np.ndarray, t: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        room = CHUNK + 8 * (2.0 ** (table / 8.0)).mean()  # a counter far above the others is dealt out
        salts = np.ceil(2.0 ** (table / 8.0) / room).astype(np.int64)
        for batch in batches:
            sig = matrix(batch.column("sig"), COORDS, np.uint32)
            small = packed(sig)
            pairs, mask = prefixes(sig, table, t)
            row, coord = np.nonzero(mask)
            own = pairs[row, coord]
            many = salts[(own >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]
            salt = np.where(many > 1, mixed(sig[:, 0].astype(np.uint64) * np.uint64(31) + sig[:, 1])[row] % many.astype(np.uint64) + 1, 0)
            nibbles = pa.array([x.tobytes() for x in small], pa.binary())
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own.view(np.int64)), pa.array(salt.astype(np.int32)), batch.column("k").take(take), batch.column("n_shingles").take(take), nibbles.take(take)],
                names=["pair", "salt", "k", "n", "small"],
            )

    return run


def similar_sizes(x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum(x, y) >= percent * np.maximum(x, y)


def agreeing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of signatures as rows of four numbers with 4 bits a coordinate: in how many coordinates they agree."""
    ones, out = np.uint64(0x1111111111111111), np.uint8(COORDS)
    for j in range(COORDS // 16):
        d = x[..., j] ^ y[..., j]
        d |= d >> np.uint64(1)
        d |= d >> np.uint64(2)
        out = out - np.bitwise_count(d & ones)
    return out


def best_of_short(lists: np.ndarray, small: np.ndarray, sizes: np.ndarray, t: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, partners) of rows that have a partner of ``t`` collisions in their list; lists of ``SHORT`` rows at most."""
    xs, ys, ns = [], [], []
    for d in range(1, SHORT):
        x = np.flatnonzero(lists[d:] == lists[:-d])
        if not len(x):
            break
        x = x[similar_sizes(sizes[x], sizes[x + d], percent)]
        n = agreeing(small[x], small[x + d])
        near = n >= t
        xs += [x[near], x[near] + d]
        ys += [x[near] + d, x[near]]
        ns += [n[near], n[near]]
    if not xs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    x, y, n = np.concatenate(xs), np.concatenate(ys), np.concatenate(ns).astype(np.int64)
    order = np.lexsort((y, -n, x))
    x, y = x[order], y[order]
    first = np.append(True, x[1:] != x[:-1])[: len(x)]
    return x[first], y[first]


def best_of_long(small: np.ndarray, sizes: np.ndarray, t: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's best partner, and whether it has ``t`` collisions, over one chunk in blocks of rows."""
    best, near = np.zeros(len(small), np.int64), np.zeros(len(small), bool)
    for lo in range(0, len(small), BLOCK):
        rows = np.arange(lo, min(len(small), lo + BLOCK))
        n = agreeing(small[rows, None], small[None])
        n[rows - lo, rows] = 0
        n[~similar_sizes(sizes[rows, None], sizes[None], percent)] = 0
        best[rows] = n.argmax(axis=1)
        near[rows] = n[rows - lo, best[rows]] >= t
    return best, near


def partners(t: int, percent: int):
    """Over rows sorted by list: (pair, k, partner, whole) of the members that have one in their chunk.

    A list that is longer than a chunk, or dealt out, isn't ``whole``: its other members come out without a partner.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        cut: tuple | None = None  # the list of which chunks are gone already

        def done(batch: pa.RecordBatch, last: bool) -> pa.RecordBatch:
            nonlocal held, cut
            pair, salt = batch.column("pair").to_numpy(), batch.column("salt").to_numpy()
            new = np.ones(len(pair), bool)
            new[1:] = (pair[1:] != pair[:-1]) | (salt[1:] != salt[:-1])
            edge = np.append(np.flatnonzero(new), len(pair))
            groups = [(lo, hi, not salt[lo] and cut != (pair[lo], salt[lo])) for lo, hi in zip(edge[:-1], edge[1:], strict=True)]
            held = None
            if groups and not last:
                lo, hi, _ = groups.pop()
                keep = lo + (hi - lo) // CHUNK * CHUNK  # of a long list, whole chunks go now
                if keep > lo:
                    cut = (pair[lo], salt[lo])
                    groups.append((lo, keep, False))
                held = batch.slice(keep)
            small, sizes = matrix(batch.column("small"), COORDS // 16, np.uint64), batch.column("n").to_numpy()
            rows, found, wholes = [], [], []
            short = np.zeros(len(pair), bool)
            for lo, hi, whole in groups:
                whole = whole and hi - lo <= CHUNK
                if whole and hi - lo <= SHORT:
                    short[lo:hi] = hi - lo > 1
                    continue
                for at in range(lo, hi, CHUNK):
                    to = min(hi, at + CHUNK)
                    best, near = best_of_long(small[at:to], sizes[at:to], t, percent)
                    take = np.flatnonzero(near) if whole else np.arange(to - at)
                    rows.append(take + at)
                    found.append(np.where(near, best + at, -1)[take])
                    wholes.append(np.full(len(take), whole))
            at = np.flatnonzero(short)
            x, y = best_of_short(np.cumsum(new)[at], small[at], sizes[at], t, percent)
            rows.append(at[x])
            found.append(at[y])
            wholes.append(np.ones(len(x), bool))
            row, partner = np.concatenate(rows), np.concatenate(found)
            k = batch.column("k")
            columns = [batch.column("pair").take(pa.array(row)), k.take(pa.array(row)), k.take(pa.array(np.maximum(partner, 0), mask=partner < 0)), pa.array(np.concatenate(wholes))]
            return pa.RecordBatch.from_arrays(columns, names=["pair", "k", "partner", "whole"])

        for batch in batches:
            if held is not None and held.num_rows:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            yield done(batch, False)
        if held is not None and held.num_rows:
            yield done(held, True)

    return run


def only(bits: bytes):
    """Rows whose key the table may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(found(bits, batch.column("key").to_numpy().view(np.uint64)))).select(["doc_id", "text", "h"])

    return run


def confirmed(percent: int, n: int):
    """Of rows (a, b, text_a, text_b) the pairs that are linked on their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, right = None, None
        for batch in batches:
            good = []
            texts_b = batch.column("text_b")
            for i, (b, left) in enumerate(zip(batch.column("b").to_pylist(), sets(batch.column("text_a"), n), strict=True)):
                if b != key:
                    key, right = b, next(sets(texts_b.slice(i, 1), n))
                good.append(linked(left, right, percent))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(good, pa.bool_())), batch.column("b").filter(pa.array(good, pa.bool_()))], names=["a", "b"])

    return run


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if not similar_sizes(np.int64(len(x)), np.int64(len(y)), percent):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def confirm(edges: DataFrame, texts: DataFrame, percent: int, n: int) -> DataFrame:
    """The linked ones among ``edges`` (a, b); a partner of many is spread over ``SALTED`` pairs a share."""
    many = edges.groupBy(F.col("b").alias("m_b")).agg(F.ceil(F.count(F.lit(1)) / SALTED).cast("int").alias("shares"))
    dealt = edges.join(many, F.col("b") == F.col("m_b")).select("a", "b", F.pmod(F.xxhash64("a"), F.col("shares")).cast("int").alias("share"))
    right = many.join(texts, F.col("m_b") == F.col("k")).select("m_b", F.col("text").alias("text_b"), F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("m_share"))
    left = dealt.join(texts.withColumnRenamed("text", "text_a"), F.col("a") == F.col("k")).select("a", "b", "share", "text_a")
    met = left.join(right, (F.col("b") == F.col("m_b")) & (F.col("share") == F.col("m_share"))).select("a", "b", "text_a", "text_b")
    return written(met.mapInArrow(confirmed(percent, n), "a binary, b binary"))


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of each key as one batch, of rows sorted by the keys."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        if not batch.num_rows:
            continue
        columns = [batch.column(c).to_numpy() for c in keys]
        edge = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        bounds = [0, *edge.tolist(), batch.num_rows]
        for lo, hi in zip(bounds[:-2], bounds[1:-1], strict=True):
            yield batch.slice(lo, hi - lo)
        held = batch.slice(bounds[-2])
    if held is not None:
        yield held


def packed(sig: np.ndarray) -> np.ndarray:
    """4 bits of each coordinate, as ``posted`` sends them."""
    return np.ascontiguousarray((sig[:, 0::2] & 15 | (sig[:, 1::2] & 15) << 4).astype(np.uint8)).view(np.uint64)


def still_open(table: np.ndarray, t: int, percent: int, n: int, with_texts: bool):
    """Over rows sorted by block pair: members with an unsettled partner, or with texts the links among them."""

    def judged(rows: pa.RecordBatch) -> list[tuple]:
        pair, lo, hi = (rows.column(c)[0].as_py() for c in ("pair", "lo", "hi"))
        block = rows.column("block").to_numpy()
        x, y = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        if not len(x) or not len(y):
            return []
        sig, sizes, comp = matrix(rows.column("sig"), COORDS, np.uint32), rows.column("n").to_numpy(), matrix(rows.column("comp"), 2, np.uint64)
        small = packed(sig)
        near = (agreeing(small[x, None], small[None, y]) >= t) & similar_sizes(sizes[x, None], sizes[None, y], percent)
        near &= (comp[x, None] != comp[None, y]).any(axis=2)
        if lo == hi:
            near = np.triu(near)
        i, j = np.nonzero(near)
        i, j = x[i], y[j]
        same = sig[i] == sig[j]
        good = same.sum(axis=1) >= t
        i, j, same = i[good], j[good], same[good]
        if len(i):  # only in the first list that both are in
            pairs, mask = prefixes(sig, table, t)
            coord = int(np.flatnonzero(pairs[i[0]] == np.uint64(pair % (1 << 64)))[0])  # the same for all members
            first = ~(same & mask[i] & mask[j])[:, :coord].any(axis=1)
            i, j = i[first], j[first]
        k = rows.column("k")
        if not with_texts:
            return [(pair, k[int(r)].as_py()) for r in np.unique(np.concatenate([i, j]))]
        _, code = np.unique(comp, axis=0, return_inverse=True)
        code, texts = code.reshape(-1), rows.column("text")
        root = np.arange(code.max() + 1)  # of each component here
        own: dict[int, np.ndarray] = {}
        out = []
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            if root[code[a]] == root[code[b]]:
                continue
            for r in (a, b):
                if r not in own:
                    own[r] = next(sets(texts.slice(r, 1), n))
            if linked(own[a], own[b], percent):
                root[root == root[code[a]]] = root[code[b]]
                out.append((k[a].as_py(), k[b].as_py()))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, types = (["a", "b"], [pa.binary(), pa.binary()]) if with_texts else (["pair", "k"], [pa.int64(), pa.binary()])
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [[], []]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(columns, types, strict=True)], names=names)

        for rows in groups(batches, ["pair", "lo", "hi"]):
            out.extend(judged(rows))
            if len(out) > 10_000:
                yield flush()
        yield flush()

    return run


def blocks(members: DataFrame) -> DataFrame:
    """``members`` of lists with more than one component, dealt out as pairs of blocks.

    Members of a list's largest component needn't meet each other: they go to the blocks of the others alone, so a
    list that holds one large group and few others is dealt out in proportion to its length.
    """
    sizes = members.groupBy("pair", "comp").agg(F.count(F.lit(1)).alias("n"))
    several = sizes.groupBy(F.col("pair").alias("l_pair")).agg(F.sum("n").alias("members"), F.max(F.struct("n", "comp")).alias("top"), F.count(F.lit(1)).alias("comps")).filter("comps > 1")
    count = lambda c: F.ceil(c / BLOCK).cast("int")
    cut = several.select("l_pair", F.col("top.comp").alias("top"), count(F.col("members") - F.col("top.n")).alias("few"), count(F.col("top.n")).alias("many"))
    placed = members.join(cut, F.col("pair") == F.col("l_pair"))
    inside = F.col("comp") == F.col("top")
    block = F.when(inside, F.col("few") + F.pmod(F.xxhash64("k"), F.col("many"))).otherwise(F.pmod(F.xxhash64("k"), F.col("few"))).cast("int")
    met = F.explode(F.sequence(F.lit(0), F.when(inside, F.col("few")).otherwise(F.col("few") + F.col("many")) - 1))
    dealt = placed.withColumn("block", block).withColumn("other", met)
    return dealt.select(*members.columns, "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))


def with_components(members: DataFrame, links: DataFrame) -> DataFrame:
    """``members`` (pair, k) with comp, the smallest k of their component so far."""
    roots = components(links, cut=written)
    return written(members.join(roots.withColumnRenamed("node", "r_k"), F.col("k") == F.col("r_k"), "left").select(*members.columns, F.coalesce("root", "k").alias("comp")))


def best_linked(members: DataFrame, links: DataFrame, tried: DataFrame) -> DataFrame:
    """(a, b): members outside the component of their list's best-linked member, with that one; pairs not tried yet."""
    degree = links.select(F.explode(F.array("a", "b")).alias("d_k")).groupBy("d_k").agg(F.count(F.lit(1)).alias("degree"))
    ranked = members.join(degree, F.col("k") == F.col("d_k"), "left").select("pair", "k", "comp", F.coalesce("degree", F.lit(0)).alias("degree"))
    tops = ranked.groupBy(F.col("pair").alias("t_pair")).agg(F.max(F.struct("degree", "k", "comp")).alias("top"), F.min("comp").alias("least"), F.max("comp").alias("most")).filter("least <> most AND top.degree > 0")
    met = members.join(tops, (F.col("pair") == F.col("t_pair")) & (F.col("comp") != F.col("top.comp"))).select(F.col("k").alias("a"), F.col("top.k").alias("b")).distinct()
    return written(met.join(tried.select(F.col("a").alias("x"), F.col("b").alias("y")), (F.col("a") == F.col("x")) & (F.col("b") == F.col("y")), "left_anti"))


def near_dedup(docs: DataFrame, percent: int = PERCENT, n: int = N) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (the smallest doc_id reachable), kept and h.

    ``h`` is the MD5 of the text, so rows of one doc_id can be told apart.
    """
    ship(docs.sparkSession)
    t = least_matches(COORDS, percent)
    kind = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select("doc_id", "text", F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("h"))
    rows = written(source.mapInArrow(signed(n), f"doc_id {kind}, h binary, k binary, n_shingles bigint, sig binary"))
    held = rows.filter(F.col("k").isNotNull())
    classes = written(held.groupBy("k").agg(F.min("doc_id").alias("rep"), F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h")).alias("of"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig")))

    table = rarity(classes)
    postings = classes.select("k", "n_shingles", "sig").mapInArrow(posted(table, t), "pair bigint, salt int, k binary, n bigint, small binary")
    met = postings.repartition("pair", "salt").sortWithinPartitions("pair", "salt").mapInArrow(partners(t, percent), "pair bigint, k binary, partner binary, whole boolean")
    met = written(met)
    members = met.select("pair", "k").distinct()
    needed = members.select("k").distinct()
    named = classes.join(needed, "k").select(F.col("k").alias("c_k"), F.col("of.doc_id").alias("c_id"), F.col("of.h").alias("c_h"))
    bits = bit_table(named.select(F.xxhash64("c_h").alias("key")))  # most texts needn't move; a full table moves all
    few = source.withColumn("key", F.xxhash64("h")).mapInArrow(only(bits), f"doc_id {kind}, text string, h binary")
    texts = written(few.join(named, (F.col("h") == F.col("c_h")) & F.col("doc_id").eqNullSafe(F.col("c_id"))).select(F.col("c_k").alias("k"), "text").dropDuplicates(["k"]))

    edges = written(met.filter("partner IS NOT NULL").select(F.least("k", "partner").alias("a"), F.greatest("k", "partner").alias("b")).distinct())
    links = tried = placed = None
    for _ in range(ROUNDS):
        new = confirm(edges, texts, percent, n)
        tried = edges if tried is None else tried.union(edges)
        links = new if links is None else links.union(new)
        if placed is not None and new.isEmpty():
            break
        placed = with_components(members, links)
        edges = best_linked(placed, links, tried)
        if edges.isEmpty():
            break
    signatures = classes.select(F.col("k").alias("s_k"), F.col("n_shingles").alias("n"), "sig")
    order = ["pair", "lo", "hi"]
    with_sig = lambda df: df.join(signatures, F.col("k") == F.col("s_k")).drop("s_k")
    dealt = with_sig(blocks(placed)).repartition(*order).sortWithinPartitions(*order)
    unsettled = written(dealt.mapInArrow(still_open(table, t, percent, n, False), "pair bigint, k binary")).distinct()
    full = with_sig(blocks(placed.join(unsettled, ["pair", "k"]))).join(texts.withColumnRenamed("k", "x_k"), F.col("k") == F.col("x_k")).drop("x_k")
    links = links.union(written(full.repartition(*order).sortWithinPartitions(*order).mapInArrow(still_open(table, t, percent, n, True), "a binary, b binary")))

    roots = components(links, cut=written)
    grouped = classes.select("k", "rep").join(roots.withColumnRenamed("node", "r_k"), F.col("k") == F.col("r_k"), "left").select("k", "rep", F.coalesce("root", "k").alias("root"))
    first = grouped.groupBy(F.col("root").alias("g_root")).agg(F.min("rep").alias("component_id"))
    of = written(grouped.join(first, F.col("root") == F.col("g_root")).select(F.col("k").alias("of_k"), "component_id"))
    done = held.join(of, F.col("k") == F.col("of_k")).select("doc_id", "n_shingles", "component_id", "h")
    alone = rows.filter(F.col("k").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "h")
    return done.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, percent: int = PERCENT, n: int = N) -> DataFrame:
    """``docs`` without the rows that aren't their component's first; a row is told by doc_id and text."""
    own, gone = fresh(docs, "own", "gone")
    key = lambda i, h: F.md5(F.concat_ws("|", F.coalesce(i.cast("string"), F.lit("null")), F.hex(h)))
    dropped = near_dedup(docs, percent, n).filter("NOT kept").select(key(F.col("doc_id"), F.col("h")).alias(gone)).distinct()
    marked = docs.withColumn(own, key(docs["doc_id"], F.unhex(F.md5(F.coalesce(docs["text"], F.lit(""))))))
    return marked.join(dropped, F.col(own) == F.col(gone), "left_anti").drop(own)
