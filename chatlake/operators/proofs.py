"""Proofs over DataFrames: completeness, validation, lineage digests, compaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlake.operators import lineage


def incomplete_streams(chunks: DataFrame, keys: list[Column], final: Column) -> DataFrame:
    """Streams without any final chunk."""
    return chunks.groupBy(*keys).agg(F.max(F.when(final, 1).otherwise(0)).alias("m")).filter("m = 0").drop("m")


def completeness(session: DataFrame, chunk: DataFrame) -> DataFrame:
    """One row: whether the latest session is finished, and its streams without a final chunk."""
    latest = session.orderBy(F.col("ID").desc()).limit(1).select(F.col("ID").alias("SESSION_ID"), F.col("FINISHED").alias("finished"))
    inside = chunk.join(F.broadcast(latest), "SESSION_ID").filter(F.col("TYPE_ID").isin(0, 1))
    keys = [F.col("SESSION_ID"), F.col("TYPE_ID"), F.coalesce("CHANNEL_ID", F.lit("")), F.coalesce("SEARCH_QUERY", F.lit("")), F.coalesce("THREAD_ONLY", F.lit(0))]
    streams = incomplete_streams(inside, keys, F.col("FINAL") != 0)
    return latest.agg(F.coalesce(F.max(F.col("finished") == 1), F.lit(False)).alias("finished")).join(F.broadcast(streams.agg(F.count(F.lit(1)).alias("incomplete"))))


def table_digest(df: DataFrame, table: str) -> DataFrame:
    """One row: table, row count and an order-free digest of all rows.

    The digest is that of one range over the whole table (``lineage``), so it is combined in every task before the
    shuffle, and no table is ordered or passes through one task.  Equal multisets of rows have equal digests.
    """
    whole = df.select(lineage.row_digest(df).alias("r")).agg(*lineage.sums())
    return whole.select(F.lit(table).alias("table"), "rows", lineage.shown(F.col("a"), F.col("b"), F.col("x")).alias("digest"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, n) of each table."""
    counts = [df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n")) for name, df in tables.items()]
    out = counts[0]
    for one in counts[1:]:
        out = out.unionByName(one)
    return out


def high_waters(log: DataFrame, marks: dict[str, str]) -> DataFrame:
    """One row with the largest value of each column, by the names of ``marks``."""
    return log.agg(*[F.max(column).alias(name) for name, column in marks.items()])


def accepted_checkpoints(workspaces: DataFrame, checkpoints: DataFrame, runs: DataFrame) -> DataFrame:
    """The workspaces (workspace_id, ...) with a checkpoint whose run (run_id, status) has succeeded."""
    done = runs.filter("status = 'succeeded'").select(F.col("run_id").alias("successful_run_id")).distinct()
    return workspaces.join(checkpoints.join(done, "successful_run_id", "left_semi").select("workspace_id").distinct(), "workspace_id", "left_semi")


def validation(source: DataFrame, lake: DataFrame, keys: list[str]) -> DataFrame:
    """One row over newest source rows and lake rows (keys, chunk, digest, ts, ts_us): keys, payloads, chunks
    and latest timestamps compared, from one full-outer join."""
    a = source.select(*keys, F.struct("digest", "chunk").alias("a"), F.struct("ts_us", F.col("ts").alias("t")).alias("a_time"))
    b = lake.groupBy(*keys).agg(F.max(F.struct("digest", "chunk")).alias("b"), F.max(F.struct("ts_us", F.col("ts").alias("t"))).alias("b_time"))
    in_a, in_b = F.col("a").isNotNull(), F.col("b").isNotNull()
    differs = lambda x: in_a & in_b & ~F.col(f"a.{x}").eqNullSafe(F.col(f"b.{x}"))
    row = a.join(b, keys, "full_outer").agg(
        F.count_if(in_a).alias("source_natural_key_count"), F.count_if(in_b).alias("canonical_natural_key_count"), F.count_if(~in_b).alias("missing_canonical_key_count"), F.count_if(~in_a).alias("extra_canonical_key_count"),
        F.count_if(differs("digest") | differs("chunk")).alias("selected_payload_mismatch_count"), F.count_if(differs("digest")).alias("raw_json_mismatch_count"), F.count_if(differs("chunk")).alias("source_chunk_mismatch_count"),
        F.max("a_time").alias("a_time"), F.max("b_time").alias("b_time"),
    )
    return row.select(
        "*", ((F.col("missing_canonical_key_count") == 0) & (F.col("extra_canonical_key_count") == 0)).alias("natural_keys_match"), F.col("a_time.t").eqNullSafe(F.col("b_time.t")).alias("latest_timestamp_matches"),
        F.col("a_time.t").alias("source_latest_timestamp"), F.col("b_time.t").alias("canonical_latest_timestamp"),
    ).drop("a_time", "b_time")


def compaction_differences(original: DataFrame, compacted: DataFrame, keys: list[str], digest: str) -> DataFrame:
    """Newest rows that a compacted copy lost, gained or changed."""
    a = original.select(*keys, F.col(digest).alias("before"))
    b = compacted.select(*keys, F.col(digest).alias("after"))
    return a.join(b, keys, "full_outer").filter(~F.col("before").eqNullSafe(F.col("after")))
