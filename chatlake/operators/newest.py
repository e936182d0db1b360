"""Newest rows of an append-only log, whole or for the keys touched since a checkpoint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatlake.functions.scalars import folded


def newest_rows(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in ``order``.

    ``row_number() = 1`` plans a window group limit before the shuffle: each task sends one row a key.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")


def touched_keys(df: DataFrame, keys: list[str], version: str, since: int | Column) -> DataFrame:
    """Distinct keys with a version after the checkpoint."""
    return df.filter(F.col(version) > since).select(*keys).distinct()


def newest_for_touched(df: DataFrame, keys: list[str], order: list[Column], version: str, since: int | Column) -> DataFrame:
    """The global newest row of each touched key.  The semi join stands before the window, so
    untouched history is neither sorted nor shuffled for it."""
    return newest_rows(df.join(touched_keys(df, keys, version, since), keys, "left_semi"), keys, order)


def membership_snapshot(df: DataFrame, group: str, member: str, version: str) -> DataFrame:
    """Members of each group in the group's latest version."""
    latest = df.groupBy(group).agg(F.max(version).alias(version))
    return df.join(latest, [group, version]).select(group, member, version).distinct()


def duplicate_stats(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: keys that occur more than once, and the rows beyond the first of each."""
    many = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return many.agg(F.count(F.lit(1)).alias("duplicate_keys"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def identical_copies_removed(df: DataFrame, keys: list[str], payload: Column, order: list[Column]) -> DataFrame:
    """One row for each key and payload."""
    keyed = df.withColumn("__payload", F.sha2(payload, 256))
    return newest_rows(keyed, [*keys, "__payload"], order).drop("__payload")


def folded_duplicates(df: DataFrame, text: Column, own: str) -> DataFrame:
    """(folded, n): texts that are the same without case for more than one ``own``."""
    return df.select(folded(text).alias("folded"), own).groupBy("folded").agg(F.count_distinct(own).alias("n")).filter("n > 1")


def latest_value(df: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """keys, latest_type and latest_ts: the value of the last row of each key; later order columns settle ties."""
    last = F.max(F.struct(*order, F.col(value).alias("__value"))).alias("x")
    return df.groupBy(*keys).agg(last).select(*keys, F.col("x.__value").alias("latest_type"), F.col(f"x.{order[0]}").alias("latest_ts"))
