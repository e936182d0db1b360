"""Line dedup: drop long lines that many documents share, keeping the newest holder's copy.

Main path is DataFrame functions only.  Lines are exploded, normalised and hashed to 128 bits; the
distinct (line, document) pairs are counted per line; a document's lines whose hash is over the
threshold are dropped unless the document is the line's keeper, and the others are joined again by
position.  Only hashes are shuffled for the counting; whole texts move once, to meet the positions
that they lose.

Skew: the distinct pairs are dealt by (hash, document), so a line that a third of all documents hold
is spread over all tasks before one partial count per task is merged.  The shared lines, few as they
are, are checkpointed: the join with them is then a plain one, which Spark turns into a broadcast where
they are small and whose hot keys adaptive execution splits where they are not.

Defined cases
* null or empty text: one empty line, nothing dropped, the result text is empty.
* null doc_id: such rows count as one document that ranks below every id, hence is never the keeper
  of a line that another document holds.
* rows with the same doc_id count as one document; each row is still returned, and keeps or loses its own
  lines: positions are gathered by doc_id and text, so many rows of one id, or without one, are no hot group.
* ties cannot occur: the keeper is the largest doc_id, and every occurrence inside it stays.
* very long texts and lines are handled whole, in time that grows with their lines.
* an empty table gives an empty result; input columns named like a result column are replaced, others stay,
  whatever their names.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlake.llm.names import fresh
from chatlake.session import checkpointed

WHITE = " \t\n\x0b\x0c\r"
MIN_CHARS, MIN_DOCS = 40, 5


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(WHITE)), string.ascii_uppercase, string.ascii_lowercase)


def key_hash(line: Column) -> Column:
    """128 bits of the key."""
    key = line_key(line)
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(17), key).alias("h2"))


def long_lines(docs: DataFrame, min_chars: int, id_col: str, text_col: str) -> DataFrame:
    """(h1, h2, id, t1, t2, pos) of every line that takes part; t1 and t2 are 128 bits of its text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(17), text).alias("t2"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    kept = lines.filter(F.char_length(F.btrim("line", F.lit(WHITE))) >= min_chars)
    return kept.select(key_hash(F.col("line")).alias("h"), "id", "t1", "t2", "pos").select("h.h1", "h.h2", "id", "t1", "t2", "pos")


def shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(h1, h2, n_docs, keeper) of the lines in at least ``min_docs`` documents."""
    pairs = long_lines(docs, min_chars, id_col, text_col).select("h1", "h2", "id").distinct()
    return pairs.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("keeper")).filter(F.col("n_docs") >= min_docs)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the text reduced, and n_lines (before) and n_dropped."""
    shared = checkpointed(shared_lines(docs, min_chars, min_docs, id_col, text_col).select(F.col("h1").alias("s1"), F.col("h2").alias("s2"), "keeper"))
    own_id, one, two, lost_at, lines, kept, h1, h2 = fresh(docs, "id", "t1", "t2", "lost", "lines", "kept", "h1", "h2")
    lost = (
        long_lines(docs, min_chars, id_col, text_col).join(shared, (F.col("h1") == F.col("s1")) & (F.col("h2") == F.col("s2")))
        .filter(~F.col("id").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("id").alias(own_id), F.col("t1").alias(one), F.col("t2").alias(two))
        .agg(F.collect_set("pos").alias(lost_at))
    )
    text = F.coalesce(docs[text_col], F.lit(""))
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    cut = docs.select(*[docs[c] for c in names if c != text_col], F.split(text, "\n").alias(lines), F.xxhash64(text).alias(h1), F.xxhash64(F.lit(17), text).alias(h2))
    joined = cut.join(lost, cut[id_col].eqNullSafe(lost[own_id]) & (cut[h1] == lost[one]) & (cut[h2] == lost[two]), "left")
    stay = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(lost_at)), lambda i: F.get(F.col(lines), i))
    done = joined.withColumn(kept, F.when(F.col(lost_at).isNull(), F.col(lines)).otherwise(stay))
    return done.select(
        *[F.array_join(kept, "\n").alias(c) if c == text_col else F.col(f"`{c}`") for c in names],
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(kept)).cast("long").alias("n_dropped"),
    )
