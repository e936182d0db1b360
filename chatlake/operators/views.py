"""The four read models, and the message flags they filter by."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatlake.session import checkpointed


def enriched(messages: DataFrame, workspaces: DataFrame, channels: DataFrame, users: DataFrame) -> DataFrame:
    """Messages with workspace, channel and user names; a message without a known user stays."""
    w = workspaces.select("workspace_id", "workspace_slug", "team_name")
    c = channels.select("workspace_id", "channel_id", F.col("name").alias("channel_name"))
    u = users.select("workspace_id", "user_id", "username", "real_name", "display_name")
    return messages.join(w, "workspace_id").join(c, ["workspace_id", "channel_id"], "left").join(u, ["workspace_id", "user_id"], "left")


def timeline(messages: DataFrame, deleted: str = "is_deleted", reply: str = "is_thread_reply", broadcast: str = "is_thread_broadcast") -> DataFrame:
    """What a channel shows: neither deleted messages nor replies that weren't broadcast."""
    return messages.filter(~F.col(deleted) & (~F.col(reply) | F.col(broadcast)))


def threads(messages: DataFrame, group: list[Column | str], order: str = "ts_us", key: str = "message_key") -> DataFrame:
    """Per thread: message_count, first and last time, and the message keys in order of time, then key."""
    listed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(key).alias("k"))))
    return messages.groupBy(*group).agg(
        F.count(F.lit(1)).alias("message_count"), F.min(order).alias("first_ts_us"), F.max(order).alias("last_ts_us"), F.transform(listed, lambda x: x["k"]).alias("message_keys")
    )


def thread_pages(messages: DataFrame, group: list[str], order: str = "ts_us", key: str = "message_key", page: int = 1000) -> DataFrame:
    """``threads`` in pages: group, page (from 0), message_count, first and last time, and the page's message keys in order.

    Messages are sorted over all tasks by thread, time and key, so a thread of any size is spread; the ranges' counts give
    each its first position in its thread, and a page is what ``page`` positions hold.  Joined in order, the pages of a
    thread are its list.
    """
    sort = [*group, order, key]
    ranged = messages.select(*sort).repartitionByRange(*sort).sortWithinPartitions(*sort)
    placed = checkpointed(ranged.withColumn("share", F.spark_partition_id()))  # the ranges are drawn once
    counts = placed.groupBy(*group, "share").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(*group).orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    names = [f"__{c}" for c in [*group, "share"]]
    starts = counts.select(*[F.col(c).alias(n) for c, n in zip([*group, "share"], names, strict=True)], F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    met = placed.join(starts, [F.col(c).eqNullSafe(F.col(n)) for c, n in zip([*group, "share"], names, strict=True)]).drop(*names)
    own = F.row_number().over(Window.partitionBy(*group, "share").orderBy(order, key))
    numbered = met.withColumn("page", F.floor((F.col("start") + own - 1) / page).cast("long"))
    return threads(numbered, [*group, "page"], order, key)


def message_threads(messages: DataFrame) -> DataFrame:
    """``threads`` over the lake's messages; deleted ones count."""
    inside = messages.filter(F.col("thread_ts").isNotNull() | F.col("is_thread_parent"))
    return threads(inside, ["workspace_id", "channel_id", F.coalesce("thread_ts", "ts").alias("thread_ts")])


def search_documents(messages: DataFrame) -> DataFrame:
    """One search document for each visible message with text; JSON keeps its nulls."""
    meta = F.to_json(F.struct("subtype", "is_edited", F.col("file_metadata_json").isNotNull().alias("has_files")), {"ignoreNullFields": "false"})
    return messages.filter(~F.col("is_deleted") & (F.col("search_text") != "")).select(
        F.col("message_key").alias("document_id"), "message_key", "workspace_id", "channel_id", "user_id", "ts", "ts_us", "thread_ts",
        F.lit("message").alias("document_kind"), F.col("search_text").alias("document_text"), meta.alias("metadata_json"), F.col("payload_hash").alias("document_version"),
    )


def orphan_replies(replies: DataFrame, keys: list[str], parent: str, own: str, messages: DataFrame | None = None) -> DataFrame:
    """Replies whose parent isn't among ``messages`` (themselves, if not given)."""
    parents = (replies if messages is None else messages).select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(own).alias("__own"))
    on = [replies[k] == parents[f"__{k}"] for k in keys] + [replies[parent] == parents["__own"]]
    return replies.filter(F.col(parent).isNotNull()).join(parents, on, "left_anti")
