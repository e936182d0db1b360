"""Phrase collocations by prefix-free parsing.

Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and pieces into words at spaces and tabs.  A
text is parsed into chunks that begin where the hash of two successive words is 0 modulo ``EVERY``, so the same passage
gives the same chunks wherever it stands.  Chunks overlap by the ``MOST - 1`` words that phrases of their last words run
into.  The dictionary holds each distinct chunk once with the number of its parses; phrases are counted inside distinct
chunks, weighted by that number, and belong to the chunk in which they begin, so an overlap counts once.

Only frequent phrases are ever spelled out.  Counting goes by 96-bit keys, level by level: a phrase of n words takes part
only if both its phrases of n - 1 words are frequent, looked up in a bit table of 2^25 bits.  The table is of a fixed size
and only leaves work out (a full one would leave out none).  Tasks sum by key before the shuffle, so a phrase that is
everywhere is no hot spot; with the sum goes one chunk that holds the phrase, and that chunk alone spells it.

Scores are exact: products are decimals of 38 digits, which hold them up to 10^12 occurrences of a phrase in 10^22 words.

Defined cases
* null and empty texts have no words; null langs are ``und``, as are rows that say so.
* repeated rows count again; ties of scores are settled by count, then by the phrase's bytes.
* very long texts are parsed whole (one without a trigger is one chunk); words are any other characters, of any length.
* an empty table, or one without a frequent phrase, gives no row; columns other than text and lang are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatlake.llm.tables import written
from chatlake.llm.words import BREAK, WORD, kinds, mixed, slices, words
from chatlake.session import ship

MOST, LEAST, TOP, EVERY = 5, 100, 2000, 64
BITS, PAGE = 25, 15
HELD, SALTS = 1 << 21, 256
_SECOND, _FACTORS = np.uint64(0xA0761D6478BD642F), (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xE7037ED1A0B428DB))
RAW = kinds(b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d")
PARSED = kinds(b" ", b"\n")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, core, chunk) of texts: words joined by a space or, at the end of a piece, a line end; the first ``core`` are its own."""
    for batch in batches:
        langs, at = batch.column("lang"), 0
        for buf, offsets in slices(batch.column("text")):
            starts, ends, h, first = words(buf, offsets, RAW)
            n = len(starts)
            doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
            if n:
                breaks = np.cumsum(np.append(0, RAW[buf] == BREAK), dtype=np.int32)[starts]
                apart = np.ones(n, bool)  # the word ends its piece
                apart[:-1] = (breaks[1:] != breaks[:-1]) | (doc[1:] != doc[:-1])
                begins = np.ones(n, bool)
                begins[1:] = (mixed(h[1:] ^ (h[:-1] * np.uint64(3))) % np.uint64(EVERY) == 0) | (doc[1:] != doc[:-1])
                # the words one after the other, each with one separator behind
                size = ends - starts + 1
                to = np.cumsum(size)
                source = np.arange(to[-1]) + np.repeat(starts - (to - size), size)
                plain = LOWER[buf[np.minimum(source, len(buf) - 1)]]
                plain[to - 1] = np.where(apart, 10, 32)
                head = np.flatnonzero(begins)
                tail = np.append(head[1:], n)  # first word behind the core
                piece = np.cumsum(np.append(0, apart[:-1]))
                last = tail - 1
                for _ in range(MOST - 1):
                    more = last + 1 < n
                    more[more] = piece[last[more] + 1] == piece[tail[more] - 1]
                    last = last + more
                lo, hi = (to - size)[head], to[last] - 1
                data = plain.tobytes()
                texts = pa.array([data[a:b] for a, b in zip(lo, hi, strict=True)], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([langs.take(pa.array(doc[head] + at)), pa.array((tail - head).astype(np.int32)), texts], names=["lang", "core", "chunk"])
            at += len(offsets) - 1


def dictionary(docs: DataFrame) -> DataFrame:
    """(lang, core, chunk, parses, owner) of all texts; ``owner`` tells a chunk, nearly always alone."""
    ship(docs.sparkSession)
    parsed = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").mapInArrow(chunks, "lang string, core int, chunk string")
    return parsed.groupBy("lang", "core", "chunk").agg(F.count(F.lit(1)).alias("parses")).withColumn("owner", F.hash("lang", "core", "chunk"))


class Chunks:
    """The words of a run of chunks, and the keys of the phrases that begin at each."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, seeds: np.ndarray, cores: np.ndarray, row: int) -> None:
        self.buf = buf
        self.starts, self.ends, self.h, first = words(buf, offsets, PARSED)
        count = np.diff(first)
        n = len(self.starts)
        self.row = row + np.repeat(np.arange(len(count)), count)  # of the batch
        self.core = np.arange(n) - np.repeat(first[:-1], count) < np.repeat(cores, count)
        ends = np.ones(n, bool)
        inside = self.ends < len(buf)
        ends[inside] = buf[self.ends[inside]] == 10
        ends[first[1:][count > 0] - 1] = True
        self.piece = np.cumsum(np.append(0, ends[:-1])) if n else np.zeros(0, np.int64)
        one = mixed(self.h ^ np.repeat(seeds, count))
        self.keys = [(one, mixed(one + _SECOND))]

    def phrases(self, n: int) -> np.ndarray:
        """Whether a phrase of n words begins at each word."""
        fits = np.zeros(len(self.piece), bool)
        k = len(fits) - n + 1
        if k > 0:
            fits[:k] = self.piece[n - 1 :] == self.piece[:k]
        return fits

    def key(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Two keys, drawn apart, of the phrases of n words at each word; 0 where there is none."""
        while len(self.keys) < n:
            m, new = len(self.keys), []
            for before, factor in zip(self.keys[-1], _FACTORS, strict=True):
                own = np.zeros(len(before), np.uint64)
                k = len(before) - m
                if k > 0:
                    own[:k] = mixed(before[:k] * factor + self.h[m:])
                new.append(own)
            self.keys.append(tuple(new))
        return self.keys[n - 1]


def runs(batch: pa.RecordBatch) -> Iterator[Chunks]:
    """The chunks of a batch, in runs of about a megabyte."""
    langs = batch.column("lang")
    seeds = {x: hash_of(x) for x in pc.unique(langs).to_pylist()}
    seed = np.array([seeds[x] for x in langs.to_pylist()], np.uint64)
    cores, at = batch.column("core").to_numpy(), 0
    for buf, offsets in slices(batch.column("chunk")):
        rows = slice(at, at + len(offsets) - 1)
        at = rows.stop
        yield Chunks(buf, offsets, seed[rows], cores[rows], rows.start)


def hash_of(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little")


def found(table: bytes, keys: np.ndarray) -> np.ndarray:
    at = keys & np.uint64((1 << BITS) - 1)
    return (np.frombuffer(table, np.uint8)[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


KEYS = "key bigint, key2 int, owner int, n bigint"


def level(n: int, table: bytes | None):
    """Keys and weights of the phrases of n words whose two shorter ones are in ``table``, summed in each task, with one owner."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            k, k2, owner, w = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((k2, k))
            k, k2, owner, w = k[order], k2[order], owner[order], w[order]
            first = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (k2[1:] != k2[:-1])))
            columns = k[first].view(np.int64), k2[first], np.minimum.reduceat(owner, first), np.add.reduceat(w, first)
            for at in range(0, len(first), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[at : at + 100_000]) for c in columns], names=["key", "key2", "owner", "n"])
            held.clear()

        for batch in batches:
            owners, parses = batch.column("owner").to_numpy(), batch.column("parses").to_numpy()
            for c in runs(batch):
                take = c.core & c.phrases(n)
                if table is not None:
                    good = found(table, c.key(n - 1)[0])
                    take[:-1] &= good[:-1] & good[1:]
                if take.any():
                    k, k2 = c.key(n)
                    held.append((k[take], (k2[take] >> np.uint64(32)).astype(np.uint32).view(np.int32), owners[c.row[take]], parses[c.row[take]]))
                if sum(len(x[0]) for x in held) >= HELD:
                    yield from flush()
        if held:
            yield from flush()

    return run


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for at in batch.column("at").to_pylist():
            bits = np.zeros(1 << PAGE, np.uint8)
            bits[at] = 1
            out.append(np.packbits(bits, bitorder="little").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("page"), pa.array(out, pa.binary())], names=["page", "bits"])


def bit_table(counts: DataFrame) -> bytes:
    """The bits of the keys in ``counts``: 4 MiB, however many there are."""
    at = F.col("key").bitwiseAND((1 << BITS) - 1)
    pages = counts.select(F.shiftright(at, PAGE).alias("page"), at.bitwiseAND((1 << PAGE) - 1).alias("at")).groupBy("page").agg(F.collect_set("at").alias("at"))
    table = bytearray(1 << BITS - 3)
    for r in pages.mapInArrow(packed, "page bigint, bits binary").collect():  # 1,024 pages of 4 KiB at most
        table[r["page"] << PAGE - 3 : (r["page"] + 1) << PAGE - 3] = r["bits"]
    return bytes(table)


def owners(bits: bytes):
    """The chunks that may own a phrase."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = found(bits, batch.column("owner").to_numpy().astype(np.int64).view(np.uint64))
            yield batch.filter(pa.array(keep)).select(["lang", "core", "chunk", "owner"])

    return run


def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, key2, lang, words, phrase) of the phrases that chunks (with ``wanted`` keys) own."""
    names, types = ["key", "key2", "lang", "words", "phrase"], [pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.string()]
    for batch in batches:
        langs, rows = batch.column("lang").to_pylist(), batch.column("wanted").to_pylist()
        left = {(i, x["key"], x["key2"], x["words"]) for i, wanted in enumerate(rows) for x in wanted}
        of = {n: np.array(sorted({k for _, k, _, m in left if m == n}), np.int64) for n in range(1, MOST + 1)}
        out = []
        for c in runs(batch):
            for n, keys in of.items():
                k, k2 = c.key(n)
                at = np.flatnonzero(np.isin(k.view(np.int64), keys) & c.phrases(n) & c.core)
                for i, row, x, y in zip(at.tolist(), c.row[at].tolist(), k[at].view(np.int64).tolist(), (k2[at] >> np.uint64(32)).astype(np.uint32).view(np.int32).tolist(), strict=True):
                    if (row, x, y, n) in left:
                        left.discard((row, x, y, n))
                        out.append((x, y, langs[row], n, c.buf[c.starts[i] : c.ends[i + n - 1]].tobytes().decode()))
        columns = zip(*out, strict=True) if out else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, types, strict=True)], names=names)


def frequent(parsed: DataFrame, least: int = LEAST, most: int = MOST) -> DataFrame:
    """(lang, words, phrase, f): the phrases of up to ``most`` words that occur ``least`` times and more."""
    ship(parsed.sparkSession)
    levels, table = [], None
    for n in range(1, most + 1):
        sums = parsed.mapInArrow(level(n, table), KEYS).groupBy("key", "key2").agg(F.sum("n").alias("f"), F.min("owner").alias("owner"))
        levels.append(written(sums.filter(F.col("f") >= least).withColumn("words", F.lit(n))))
        table = bit_table(levels[-1])
        if not any(table):
            break
    keys = levels[0]
    for x in levels[1:]:
        keys = keys.unionByName(x)
    wanted = keys.groupBy(F.col("owner").alias("w_owner")).agg(F.collect_list(F.struct("key", "key2", "words")).alias("wanted"))  # those of one chunk
    few = parsed.mapInArrow(owners(bit_table(keys.select(F.col("owner").cast("long").alias("key")))), "lang string, core int, chunk string, owner int")
    named = few.join(wanted, F.col("owner") == F.col("w_owner")).mapInArrow(spelled, "key bigint, key2 int, lang string, words int, phrase string").dropDuplicates(["key", "key2"])
    return named.join(keys.select("key", "key2", "f"), ["key", "key2"]).select("lang", "words", "phrase", "f")


def collocations(docs: DataFrame, least: int = LEAST, top: int | None = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each lang's best phrases of 2 to ``MOST`` words (all, if ``top`` is None).

    a, l and r are the occurrences of the phrase and of the two parts at its lowest-scoring cut, n all words of the lang.
    """
    parsed = written(dictionary(docs))
    counts = written(frequent(parsed, least))
    size = parsed.groupBy(F.col("lang").alias("s_lang")).agg(F.sum(F.col("core") * F.col("parses")).alias("total"))
    many = counts.filter("words > 1")

    part = lambda a, b: F.array_join(F.slice(F.split("phrase", " "), a, b), " ")
    cuts = many.select("lang", "words", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("*", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    of = lambda side: counts.select(F.col("lang").alias(f"{side}_lang"), F.col("phrase").alias(f"{side}_phrase"), F.col("f").alias(side))
    met = cuts.join(of("l"), (F.col("lang") == F.col("l_lang")) & (F.col("left") == F.col("l_phrase"))).join(of("r"), (F.col("lang") == F.col("r_lang")) & (F.col("right") == F.col("r_phrase")))
    met = met.join(size, F.col("lang") == F.col("s_lang"))
    exact = F.expr("(CAST(1000 AS DECIMAL(4, 0)) * CAST(a AS DECIMAL(13, 0)) * CAST(total AS DECIMAL(20, 0))) DIV (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(18, 0)))")
    best = F.min(F.struct(exact.alias("score"), F.col("k"), F.col("l"), F.col("r"), F.col("total").alias("n"))).alias("x")
    scored = met.groupBy("lang", "phrase", "a").agg(best).select("lang", "phrase", "a", "x.l", "x.r", "x.n", "x.score")

    inner = many.filter("words > 2").select("lang", "words", "phrase", "f", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("m"))
    inner = inner.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("m") + 1)).alias("at")).select("lang", "f", part(F.col("at"), F.col("m")).alias("sub"))
    covered = inner.groupBy(F.col("lang").alias("i_lang"), "sub").agg(F.max("f").alias("longer"))
    alone = scored.join(covered, (F.col("lang") == F.col("i_lang")) & (F.col("phrase") == F.col("sub")) & (F.col("longer") >= F.col("a")), "left_anti")

    by = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if top is not None:  # each share's best first, so that no task sorts a whole lang
        share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*by)
        alone = alone.withColumn("place", F.row_number().over(share)).filter(F.col("place") <= top).drop("place")
    ranked = alone.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by)).cast("long"))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
