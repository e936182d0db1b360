"""Mixing sources to target weights by Sainte-Lague apportionment.

Equal blocks of tokens are seats.  The mix's blocks are apportioned to the sources by their target
tokens, then each source's blocks to its shards by the shards' tokens; both times by the highest
quotients x/1, x/3, x/5, ...  Within a shard the documents stand in a seeded order and their tokens,
one after the other, are cut into blocks; the shard's quota takes that many blocks from the start,
going round at most twice.

Scale: the quotients are not listed seat by seat.  Rounding x / (X / seats) is the apportionment of
some nearby number of seats, and the few that are missing or too many are settled by their
quotients.  One row a source and one a shard take part in this; documents are read once for their
sizes, which are kept in a checkpoint.  A source is split into shards of ``SHARD_DOCS`` documents,
so the windows over documents stay small whatever a source holds.

Defined cases
* null text has size 0; null source is a source of its own, after all others.
* sources without words get target 0; if there is no word at all, nothing is taken.
* a document's order depends on its doc_id and the seed alone; rows equal in doc_id and size are
  interchangeable, so reruns give the same rows.  An empty table gives an empty result.
* ties of quotients: the source or shard that sorts first.
* very long texts count whole.  Input columns named size, target or taken are replaced in the documents of the
  mix; others stay, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatlake.llm.names import fresh
from chatlake.session import checkpointed

WEIGHTS = (5, 2, 1)
SEED, BLOCK_TOKENS, SHARD_DOCS = "mix-1", 64, 4096
WORD = r"[^\x20\x09-\x0D]+"


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, the seeded order key and the ``carry`` columns of each row."""
    key = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"), key.alias("h"), *carry)


def targets(by_source: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """by_source (source, source_size, n_docs) with weight and target.

    A source is capped at twice its size if its weight's share of what is left, after all sources
    with a smaller size per weight are capped, reaches that.  All comparisons are in integers.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("long")
    all_rows = Window.partitionBy()
    before = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left4 = 3 * F.sum("source_size").over(all_rows) - 4 * F.coalesce(F.sum("source_size").over(before), F.lit(0))  # twice the tokens left
    left_w = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    filled = by_source.withColumn("weight", weight).withColumn("capped", 4 * F.col("source_size") * left_w <= F.col("weight") * left4)
    rest4 = 3 * F.sum("source_size").over(all_rows) - 4 * F.coalesce(F.sum(F.when(F.col("capped"), F.col("source_size"))).over(all_rows), F.lit(0))
    rest_w = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(all_rows)
    share = (F.col("weight") * rest4).cast("double") / (2 * rest_w).cast("double")
    return filled.withColumn("target", F.when(F.col("capped"), (2 * F.col("source_size")).cast("double")).otherwise(share))


def sainte_lague(cells: DataFrame, group: list[str], key: Column, x: str, seats: str) -> DataFrame:
    """``cells`` with ``quota``: the seats of each group's cells by the highest quotients x/(2m-1)."""
    own = Window.partitionBy(*group)
    total, total_x = F.max(seats).over(own), F.sum(x).over(own)
    share = F.when(total_x > 0, F.col(x) / total_x).otherwise(0.0)
    rounded = cells.withColumn("__share", share).withColumn("__q", F.floor(F.col("__share") * total + 0.5).cast("long"))
    # moved to the divisor that gives all seats, shares sum to at most half a seat a cell more or less
    most = F.least(F.abs("__d"), F.ceil(F.col("__share") * F.count(F.when(F.col(x) > 0, 1)).over(own) / 2) + 2)
    short = rounded.withColumn("__d", F.when(F.max("__share").over(own) > 0, total - F.sum("__q").over(own)).otherwise(0))
    moves = short.withColumn("__most", most.cast("int")).withColumn("__j", F.explode(F.concat(F.array(F.lit(0)), F.when((F.col("__d") != 0) & (F.col(x) > 0), F.sequence(F.lit(1), F.col("__most"))).otherwise(F.array().cast("array<int>")))))
    seat = F.when(F.col("__d") > 0, F.col("__q") + F.col("__j")).otherwise(F.col("__q") - F.col("__j") + 1)
    moves = moves.withColumn("__v", F.when((F.col("__j") > 0) & (seat > 0), F.col(x) / (2 * seat - 1)))
    gain = F.row_number().over(own.orderBy(F.col("__v").desc_nulls_last(), key.asc_nulls_last()))
    loss = F.row_number().over(own.orderBy(F.col("__v").asc_nulls_last(), key.desc_nulls_first()))
    moved = moves.withColumn("__n", F.when(F.col("__v").isNull(), 0).when((F.col("__d") > 0) & (gain <= F.col("__d")), 1).when((F.col("__d") < 0) & (loss <= -F.col("__d")), -1).otherwise(0))
    each = [c for c in cells.columns if c not in group]
    by = moved.groupBy(*cells.columns).agg((F.max("__q") + F.sum("__n")).alias("quota"))
    return by.select(*group, *each, "quota")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, seed: str = SEED, block: int = BLOCK_TOKENS, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, taken (tokens of the document that the mix takes), carry."""
    sized = checkpointed(sizes(docs, id_col, text_col, source_col, seed, carry))
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    aimed = targets(by_source, weights).select("source", "source_size", "n_docs", "target", F.floor(F.lit(1.5) * F.sum("source_size").over(Window.partitionBy()) / block + 0.5).cast("long").alias("seats"), F.lit(0).alias("one"))
    quotas = sainte_lague(aimed, ["one"], F.col("source"), "target", "seats").select(F.col("source").alias("s"), "source_size", "target", F.col("quota").alias("blocks"), F.ceil(F.col("n_docs") / SHARD_DOCS).cast("long").alias("shards"))
    quotas = checkpointed(quotas)
    dealt = sized.join(quotas, F.col("source").eqNullSafe(F.col("s"))).withColumn("shard", F.conv(F.substring("h", 1, 8), 16, 10).cast("long") % F.col("shards"))
    by_shard = dealt.groupBy("s", "shard").agg(F.sum("size").cast("long").alias("shard_size"), F.max("blocks").alias("blocks"))
    shares = by_shard.withColumn("x", F.col("shard_size").cast("double"))
    shard_quota = sainte_lague(shares, ["s"], F.col("shard"), "x", "blocks").select(F.col("s").alias("q_s"), F.col("shard").alias("q_shard"), "shard_size", "quota")
    placed = dealt.join(shard_quota, F.col("s").eqNullSafe(F.col("q_s")) & (F.col("shard") == F.col("q_shard")))
    start = F.coalesce(F.sum("size").over(Window.partitionBy("source", "shard").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tokens = F.least(F.col("quota") * block, 2 * F.col("shard_size"))
    rounds = F.when(F.col("shard_size") > 0, F.floor(tokens / F.col("shard_size"))).otherwise(0)
    rest = tokens - rounds * F.col("shard_size")
    taken = rounds * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - start))
    return placed.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"), *carry)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of which the mix takes something, with size, target and taken added.

    Rows with the same doc_id and text share what the mix takes of them evenly, rounded down.
    Only sizes and hashes go through the apportionment; texts move once, to meet their share.
    """
    key, own = fresh(docs, "key", "own")
    content = F.unhex(F.md5(F.concat_ws("|", F.coalesce(docs["doc_id"].cast("string"), F.lit("null")), F.coalesce(docs["source"], F.lit("null")), F.coalesce(F.md5("text"), F.lit("null")))))
    taken = mix(docs.select("doc_id", "text", "source", content.alias(key)), carry=(key,))
    shares = taken.groupBy(key).agg(F.max("size").alias("size"), F.max("target").alias("target"), F.floor(F.sum("taken") / F.count(F.lit(1))).cast("long").alias("taken")).filter(F.col("taken") > 0)
    names = [c for c in docs.columns if c not in ("size", "target", "taken")]
    keyed = docs.withColumn(own, content)
    met = keyed.join(shares, keyed[own] == shares[key])
    return met.select(*[keyed[c] for c in names], *[shares[c] for c in ("size", "target", "taken")])
