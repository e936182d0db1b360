"""Lineage digests as a tree over ranges of chunks, and hashes of byte blocks as a tree.

The digest of a range of chunks is additive: the numbers of its rows are summed in the tasks, those of two neighbouring
ranges add up to those of the range above, and rows that are appended add to what a checkpoint holds.  One pass gives all
leaves; a comparison with the checkpoint's names the ranges that were rewritten, at any level.  A checkpoint holds
``RANGES`` leaves of a table at most: where chunks grow beyond, leaves are paired.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANGES, FAN = 256, 64
Leaf = tuple[int, int, int, int, int]  # range, rows, two sums, one xor


def row_digest(df: DataFrame) -> Column:
    """SHA-256 of a row's columns in the order of their names."""
    return F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256)


def sums(digest: str = "r") -> list[Column]:
    """rows, a, b and x: two 28-bit slices of the digests added up, a third of 60 bits xored."""
    piece = lambda at, n: F.conv(F.substring(digest, at, n), 16, 10)
    added = lambda at: F.coalesce(F.sum(piece(at, 7).cast("decimal(38,0)")), F.lit(0))
    return [F.count(F.lit(1)).alias("rows"), added(1).alias("a"), added(8).alias("b"), F.coalesce(F.bit_xor(piece(15, 15).cast("long")), F.lit(0)).alias("x")]


def shown(a: Column, b: Column, x: Column) -> Column:
    """The digest of a range from its three numbers."""
    return F.sha2(F.concat_ws(":", a.cast("decimal(38,0)").cast("string"), b.cast("decimal(38,0)").cast("string"), x.cast("string")), 256)


def leaves(df: DataFrame, chunk: str, width: int) -> DataFrame:
    """(range, rows, a, b, x) of each range of ``width`` chunks that has rows."""
    at = F.floor(F.col(chunk) / width).cast("long")
    return df.select(at.alias("range"), row_digest(df).alias("r")).groupBy("range").agg(*sums())


def above(nodes: DataFrame, fan: int = 2) -> DataFrame:
    """The nodes one level up, each of ``fan`` neighbouring ranges."""
    added = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    return nodes.groupBy(F.floor(F.col("range") / fan).cast("long").alias("range")).agg(F.sum("rows").alias("rows"), added("a"), added("b"), F.bit_xor("x").alias("x"))


def rewritten(before: DataFrame, now: DataFrame) -> DataFrame:
    """(range): the nodes of one level that differ, are gone or are new."""
    names = ["rows", "a", "b", "x"]
    a = before.select("range", F.struct(*[F.col(c).cast("decimal(38,0)").alias(c) for c in names]).alias("before"))
    b = now.select("range", F.struct(*[F.col(c).cast("decimal(38,0)").alias(c) for c in names]).alias("now"))
    return a.join(b, "range", "full_outer").filter(~F.col("before").eqNullSafe(F.col("now"))).select("range")


def width_for(most: int | None, ranges: int = RANGES) -> int:
    """The smallest power of two that cuts chunks 0 to ``most`` into ``ranges`` at most."""
    width = 1
    while (most or 0) // width >= ranges:
        width *= 2
    return width


def collected(df: DataFrame, chunk: str, width: int) -> list[Leaf]:
    """The leaves as plain numbers: a checkpoint's share of a table, ``RANGES`` rows at most."""
    return sorted((r["range"], r["rows"], int(r["a"]), int(r["b"]), r["x"]) for r in leaves(df, chunk, width).collect())


def merged(nodes: Iterable[Leaf], factor: int = 1) -> list[Leaf]:
    """Leaves of the same or of ``factor`` neighbouring ranges added up."""
    out: dict[int, tuple[int, int, int, int]] = {}
    for i, rows, a, b, x in nodes:
        n, c, d, y = out.get(i // factor, (0, 0, 0, 0))
        out[i // factor] = (n + rows, c + a, d + b, y ^ x)
    return sorted((i, *v) for i, v in out.items())


def differing(before: list[Leaf], now: list[Leaf], width: int) -> list[tuple[int, int]]:
    """(first, last) chunk of the ranges that differ, found from the root downwards: equal halves aren't entered."""
    levels = [(width, before, now)]
    while max(len(levels[-1][1]), len(levels[-1][2])) > 1:
        w, a, b = levels[-1]
        levels.append((w * 2, merged(a, 2), merged(b, 2)))
        if levels[-1][1:] == levels[-2][1:]:
            break
    suspects: set[int] | None = None
    for w, a, b in reversed(levels):
        a, b = dict((x[0], x) for x in a), dict((x[0], x) for x in b)
        suspects = {i for i in a.keys() | b.keys() if (suspects is None or i // 2 in suspects) and a.get(i) != b.get(i)}
    return [(i * width, (i + 1) * width - 1) for i in sorted(suspects or ())]


def tree_root(blocks: DataFrame, group: str, place: str, digest: str, fan: int = FAN) -> DataFrame:
    """(group, digest): the root over each group's block digests, ``fan`` of them in order hashed to one a level.

    A group's only digest is its root.  No task holds more than ``fan`` digests of a node.
    """
    nodes = blocks.select(group, F.col(place).cast("long").alias("place"), F.col(digest).alias("digest"))
    most = nodes.agg(F.max("place")).first()[0] or 0
    while most > 0:
        listed = F.array_sort(F.collect_list(F.struct("place", "digest")))
        up = nodes.groupBy(group, F.floor(F.col("place") / fan).cast("long").alias("up")).agg(listed.alias("d"))
        alone = (F.size("d") == 1) & (F.col("up") == 0)
        nodes = up.select(group, F.col("up").alias("place"), F.when(alone, F.get("d", F.lit(0))["digest"]).otherwise(F.sha2(F.array_join(F.transform("d", lambda x: x["digest"]), ""), 256)).alias("digest"))
        most //= fan
    return nodes.select(group, "digest")
