"""Substring dedup by hashing lines and their parts.

Every line is cut into units at the ends of sentences of at least ``UNIT_WORDS`` words; lines too short for
that flow on into each other, up to the end of the paragraph, until a unit has its words.  Units are
normalised (white space, case) and hashed to 128 bits, and the digests are grouped over all
documents.  Of each digest the earliest ranked occurrence, by doc_id and then by offset, is kept;
the others are repeats and are removed.  What goes is reported with its offsets in the original text, one
row for the units that follow each other here and where they are kept.

``run_words`` above 0 removes repeats only in sequences of units of so many words that stand anywhere
earlier as such, wherever else their single units are first seen: short phrases that everybody uses then
stay.  To find these sequences, the shortest ones of so many words that start or end with each unit are
hashed and grouped like the units: any longer one is made up of them.

Skew: each task combines its own occurrences of a digest before the shuffle, so a passage that a
third of all documents hold arrives as one row a task; the repeated digests are
checkpointed, so that the join that marks the repeats is a plain shuffle join, whose large keys
adaptive execution can split.  Only digests and offsets are shuffled.

Defined cases
* null and empty texts have no units.  Fewer than ``UNIT_WORDS`` words left over at the end of a line or of a
  block of short lines are not hashed; they neither make nor break a run and are never removed.
* a word counts once for every 8 characters, and at least once, where words average over 12: text without
  white space (other scripts, encoded data) is cut at its sentence marks and lines, and has units too.
* null doc_ids rank after all ids.  Ties: of rows with the same doc_id and different texts, the smaller text hash ranks
  first; equal rows are one document, so repeated rows alone remove nothing.
* offsets are code points, end exclusive.  An empty table gives an empty result.
* very long texts and lines are handled whole.  Only doc_id and text are read by the search; columns with
  clashing names stay as they are, but for ``removed``, which is replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from hashlib import blake2b
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatlake.llm.names import fresh
from chatlake.session import checkpointed, ship

UNIT_WORDS, LONG_LINE, LONG_WORD = 5, 80, 12
LINE, CUT = re.compile(r"[^\n]+"), re.compile(r"[.!?][^\w\s]*[\x20\t\r\f\v]+|[。！？]")


def count(part: str) -> int:
    """Words of a part of a text; long ones count by their characters."""
    found = part.split()
    if sum(map(len, found)) <= LONG_WORD * len(found):
        return len(found)
    return sum(max(1, len(w) // 8) for w in found)


def flowing(text: str, lines: list[tuple[int, int, int]], unit_words: int) -> Iterator[tuple[int, int, int]]:
    """Units of consecutive short lines.

    A unit has at least ``unit_words`` and ends with a line chosen by the line's own hash (every other one,
    on average), so units fall alike wherever the lines stand; or with four times as many words.
    """
    words, start = 0, None
    for a, b, n in lines:
        start = a if start is None else start
        words += n
        if words >= unit_words and (words >= 4 * unit_words or digest(text[a:b])[0] % 2):
            yield start, b, words
            words, start = 0, None
    if words >= unit_words:
        yield start, lines[-1][1], words


def units(text: str, unit_words: int = UNIT_WORDS) -> Iterator[tuple[int, int, int]]:
    """(start, end, words) of the hashed units of a text.

    A unit ends with each sentence of enough words and takes in the shorter ones before it, so where
    units end depends on their own sentences only: a passage is cut alike wherever it stands.
    Where there are none, a unit ends with the sentence that brings it to four times as many words.
    """
    short, behind = [], 0
    for line in LINE.finditer(text):
        start, stop = line.span()
        n = count(line[0]) if stop - start < LONG_LINE else unit_words
        if short and (n == 0 or n >= unit_words or start > behind + 1):  # a long line or the end of the paragraph
            yield from flowing(text, short, unit_words)
            short = []
        behind = stop
        if n < unit_words:
            if n:
                short.append((start, stop, n))
            continue
        words, last = 0, start
        for end in [*(cut.end() for cut in CUT.finditer(text, start, stop)), stop]:
            own = count(text[last:end])
            words, last = words + own, end
            if own >= unit_words or words >= 4 * unit_words:
                yield start, end, words
                start, words = end, 0
    if short:
        yield from flowing(text, short, unit_words)


def digest(unit: str) -> bytes:
    return blake2b(" ".join(unit.lower().split()).encode("utf-8", "replace"), digest_size=16).digest()


def windows(words: list[int], run_words: int) -> Iterator[tuple[int, int]]:
    """(first, behind the last) of the shortest sequences of ``run_words`` that start or end with each unit.

    Single units are left out, as they are hashed anyway; for ``run_words`` 0 there are no others.  Each unit of a sequence that
    long is in a window inside of it: one that ends with the unit, or one that starts with the sequence.
    """
    sums = [0, *accumulate(words)]
    forward = ((i, bisect_left(sums, sums[i] + run_words)) for i in range(len(words)))
    backward = ((bisect_right(sums, sums[j] - run_words) - 1, j) for j in range(1, len(sums)))
    yield from sorted({(i, j) for i, j in chain(forward, backward) if i >= 0 and j < len(sums) and j - i > 1})


def hashed(run_words: int):
    """Rows of the units, with one span, and of their windows, with the spans of the window's units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("t")
            keys, owner, rows, spans, ends = [], [], [], [], [0]
            for i, text in enumerate(batch.column("text").to_pylist()):
                found = list(units(text or ""))
                own = [digest(text[start:end]) for start, end, _ in found]
                for place, (start, end, words) in enumerate(found):
                    keys.append(own[place])
                    rows.append((place, start, words))
                    spans += (start, end)
                    ends.append(len(spans))
                for a, b in windows([u[2] for u in found], run_words):
                    keys.append(blake2b(b"".join(own[a:b]), digest_size=16).digest())
                    rows.append((a, found[a][0], run_words))
                    spans += (x for u in found[a:b] for x in u[:2])
                    ends.append(len(spans))
                owner += [i] * (len(rows) - len(owner))
            halves = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            cols = np.array(rows, np.int32).reshape(-1, 3)
            arrays = [pa.array(np.ascontiguousarray(halves[:, 0])), pa.array(np.ascontiguousarray(halves[:, 1])), ids.take(pa.array(owner, pa.int64())), texts.take(pa.array(owner, pa.int64()))]
            parts = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(spans, pa.int32()))
            yield pa.RecordBatch.from_arrays([*arrays, *[pa.array(np.ascontiguousarray(cols[:, j])) for j in range(3)], parts], names=["h1", "h2", "doc_id", "t", "place", "start", "words", "spans"])

    return run


def text_key(text: Column) -> Column:
    """Tells the rows of one doc_id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def find_repeats(docs: DataFrame, run_words: int = 0) -> DataFrame:
    """doc_id, start, end, n_units, n_words, kept_doc_id, kept_start, t: removed units that follow each other.

    ``kept_doc_id`` and ``kept_start`` are where the first of them is kept, and the others behind it; ``t`` is the
    ``text_key`` of the row.  A passage whose units are kept in several places makes several rows.
    """
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType
    ints = [T.StructField(x, T.IntegerType()) for x in ("place", "start", "words")]
    out = T.StructType([T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType()), T.StructField("doc_id", kind), T.StructField("t", T.LongType()), *ints, T.StructField("spans", T.ArrayType(T.IntegerType()))])
    found = docs.select("doc_id", text_key(F.col("text")).alias("t"), "text").mapInArrow(hashed(run_words), out)
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("t").alias("t"), F.col("start").alias("at"), F.col("place").alias("place"))
    firsts = found.groupBy("h1", "h2").agg(F.min(rank).alias("first"), F.max(rank).alias("last")).filter(~F.col("first").eqNullSafe(F.col("last")))
    firsts = checkpointed(firsts.select(F.col("h1").alias("f1"), F.col("h2").alias("f2"), "first"))
    repeats = found.join(firsts, (F.col("h1") == F.col("f1")) & (F.col("h2") == F.col("f2"))).filter(~rank.eqNullSafe(F.col("first")))
    one = F.size("spans") == 2
    kept = F.when(one, F.struct("words", F.col("first.id").alias("kept_doc_id"), F.col("first.at").alias("kept_start"), (F.col("first.place") - F.col("place")).alias("shift")))
    each = repeats.select("doc_id", "t", "place", "spans", kept.alias("kept"), (F.col("words") >= run_words).alias("gone"), F.explode(F.sequence(F.lit(0), F.floor(F.size("spans") / 2).cast("int") - 1)).alias("k"))
    each = each.select("doc_id", "t", (F.col("place") + F.col("k")).alias("place"), F.get("spans", 2 * F.col("k")).alias("start"), F.get("spans", 2 * F.col("k") + 1).alias("end"), "kept", "gone")
    removed = each.groupBy("doc_id", "t", "place", "start", "end").agg(F.max("kept").alias("kept"), F.max("gone").alias("gone")).filter("gone").select("doc_id", "t", "place", "start", "end", "kept.*")
    own = Window.partitionBy("doc_id", "t", "kept_doc_id", "shift").orderBy("start", "end")
    placed = removed.withColumn("run", F.col("place") - F.row_number().over(own))
    runs = placed.groupBy("doc_id", "t", "kept_doc_id", "shift", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("n_units"), F.sum("words").alias("n_words"),
        F.min_by("kept_start", "start").alias("kept_start"),
    )
    return runs.select("doc_id", "start", "end", "n_units", "n_words", "kept_doc_id", "kept_start", "t")


@F.arrow_udf(T.StringType())
def cut_out(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for text, cuts in zip(texts.to_pylist(), spans.to_pylist(), strict=True):
        if text is not None and cuts:
            kept, at = [], 0
            for c in sorted(cuts, key=lambda c: c["start"]):
                kept.append(text[at : c["start"]])
                at = max(at, c["end"])
            text = "".join([*kept, text[at:]])
        out.append(text)
    return pa.array(out, pa.string())


def remove_repeats(docs: DataFrame, run_words: int = 0) -> DataFrame:
    """``docs`` with the repeats cut out of the text, and their original spans in ``removed``; each row loses its own."""
    own, key, found = fresh(docs, "own", "key", "cuts")
    spans = find_repeats(docs, run_words).groupBy(F.col("doc_id").alias(own), F.col("t").alias(key)).agg(F.collect_list(F.struct("start", "end")).alias(found))
    met = docs.join(spans, docs["doc_id"].eqNullSafe(spans[own]) & (text_key(docs["text"]) == spans[key]), "left")
    names = [c for c in docs.columns if c != "removed"]
    cuts = F.coalesce(F.array_sort(spans[found]), F.array().cast("array<struct<start:int,end:int>>"))
    return met.select(*[cut_out(docs["text"], cuts).alias("text") if c == "text" else docs[c] for c in names], cuts.alias("removed"))
