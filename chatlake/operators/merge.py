"""Change classification and set-based merges; each returns the next version of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def classify(incoming: DataFrame, current: DataFrame, keys: list[str], digest: str) -> DataFrame:
    """``incoming`` with ``change``: insert, update or unchanged."""
    old = current.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(digest).alias("__digest"), F.lit(True).alias("__known"))
    on = [incoming[k] == old[f"__{k}"] for k in keys]
    change = F.when(F.col("__known").isNull(), "insert").when(~F.col(digest).eqNullSafe(F.col("__digest")), "update").otherwise("unchanged")
    return incoming.join(old, on, "left").withColumn("change", change).select(*incoming.columns, "change")


def event_type(change: Column, is_deleted: Column) -> Column:
    """observed_deleted, created or edited; null for unchanged rows."""
    return F.when(change == "unchanged", None).when(is_deleted, "observed_deleted").when(change == "insert", "created").otherwise("edited")


def change_counts(classified: DataFrame) -> DataFrame:
    """One row with the numbers of inserts, updates and unchanged rows."""
    return classified.agg(*[F.count_if(F.col("change") == c).alias(n) for c, n in (("insert", "inserted"), ("update", "updated"), ("unchanged", "unchanged"))])


def merge(current: DataFrame, incoming: DataFrame, keys: list[str], keep_old: list[str] = (), keep_if_null: list[str] = ()) -> DataFrame:
    """Full-outer merge: incoming values win, but for columns that are kept once they are set.

    ``keep_old`` columns keep the current value of an existing row, ``keep_if_null`` ones keep it
    where the incoming value is null.  Columns missing from ``incoming`` keep the current value.
    """
    a, b = current.withColumn("__old", F.lit(True)).alias("a"), incoming.withColumn("__new", F.lit(True)).alias("b")
    joined = a.join(b, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys], "full_outer")
    out = []
    for c in current.columns:
        old = F.col(f"a.{c}")
        if c not in incoming.columns:
            out.append(old.alias(c))
            continue
        new = F.col(f"b.{c}")
        if c in keep_old:
            value = F.when(F.col("__old"), old).otherwise(new)
        elif c in keep_if_null or c in keys:
            value = F.coalesce(new, old)
        else:
            value = F.when(F.col("__new"), new).otherwise(old)
        out.append(value.alias(c))
    return joined.select(*out)


def scoped_replace(current: DataFrame, incoming: DataFrame, scope: list[str], keys: list[str], keep_old: list[str] = ()) -> DataFrame:
    """Within the scopes that ``incoming`` observes, its rows replace the current ones; other scopes
    stay.  Rows that persist keep their ``keep_old`` columns."""
    outside = current.join(incoming.select(*scope).distinct(), scope, "left_anti")
    old = current.select(*keys, *[F.col(c).alias(f"__{c}") for c in keep_old])
    inside = incoming.join(old, keys, "left").select(*[F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) if c in keep_old else F.col(c) for c in current.columns])
    return outside.unionByName(inside)


def replace_children(current: DataFrame, parents: DataFrame, children: DataFrame, keys: list[str]) -> DataFrame:
    """Children of the observed parents are replaced; others survive."""
    return current.join(parents.select(*keys).distinct(), keys, "left_anti").unionByName(children)


def record_values(current: DataFrame, found: DataFrame, keys: list[str], column: str) -> DataFrame:
    """``current`` with ``column`` from ``found`` (the smallest, if several) where it differs, and
    ``changed`` telling where it did."""
    one = found.groupBy(*keys).agg(F.min(column).alias("__found"))
    joined = current.join(one, keys, "left")
    changed = F.col("__found").isNotNull() & ~F.col("__found").eqNullSafe(F.col(column))
    return joined.select(*[F.coalesce("__found", column).alias(column) if c == column else F.col(c) for c in current.columns], changed.alias("changed"))


def vanished(current: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of ``current`` that the source no longer holds."""
    return current.select(*keys).distinct().join(source.select(*keys).distinct(), keys, "left_anti")


def regressions(current: DataFrame, incoming: DataFrame, keys: list[str], version: str, digest: str) -> DataFrame:
    """Keys that came back with an older version, or rewritten within the same one."""
    a = current.select(*keys, F.col(version).alias("old_version"), F.col(digest).alias("__old"))
    b = incoming.select(*keys, F.col(version).alias("new_version"), F.col(digest).alias("__new"))
    older, same = F.col("new_version") < F.col("old_version"), F.col("new_version") == F.col("old_version")
    bad = a.join(b, keys).filter(older | (same & ~F.col("__new").eqNullSafe(F.col("__old"))))
    return bad.select(*keys, "old_version", "new_version", F.when(older, "regressed").otherwise("rewritten").alias("reason"))


def comparison(left: DataFrame, right: DataFrame, keys: list[str], digest: str) -> DataFrame:
    """One row: keys on one side only, common keys and mismatches, from one full-outer join."""
    a = left.select(*keys, F.col(digest).alias("__l"), F.lit(True).alias("__in_l"))
    b = right.select(*keys, F.col(digest).alias("__r"), F.lit(True).alias("__in_r"))
    joined = a.join(b, keys, "full_outer")
    both = F.col("__in_l").isNotNull() & F.col("__in_r").isNotNull()
    return joined.agg(
        F.count_if(F.col("__in_r").isNull()).alias("missing"),
        F.count_if(F.col("__in_l").isNull()).alias("extra"),
        F.count_if(both).alias("common"),
        F.count_if(both & ~F.col("__l").eqNullSafe(F.col("__r"))).alias("mismatched"),
    )


def common_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys that both sides hold."""
    return left.select(*keys).intersect(right.select(*keys))


def mismatches(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Common keys with any difference: keys and, for each column, ``<column>_differs``."""
    other = right.select(*keys, *[F.col(c).alias(f"__{c}") for c in columns])
    marked = left.join(other, keys).select(*keys, *[(~F.col(c).eqNullSafe(F.col(f"__{c}"))).alias(f"{c}_differs") for c in columns])
    any_differs = F.lit(False)
    for c in columns:
        any_differs = any_differs | F.col(f"{c}_differs")
    return marked.filter(any_differs)
