"""Expected against present attachments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlake.functions import scalars as S

SHOWN = 100
SKIPPED_MODES = ("hidden_by_limit", "external", "tombstone")


def expected(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(file_id, name, size, mode, mime) of the downloadable files of messages (with
    ``embedded_files``), and one row with the numbers skipped and unsafe.

    Of conflicting records of a file id the first message's is taken, and the conflict counted unsafe.
    """
    items = records.select("ts_us", "channel_id", F.explode("embedded_files").alias("f")).filter(F.col("f.id") != "")
    unnamed = ~F.coalesce("f.is_external", F.lit(False)) & (F.coalesce("f.name", F.lit("")) == "")
    marked = items.select(
        "*", (F.coalesce(F.col("f.mode").isin(*SKIPPED_MODES), F.lit(False)) | unnamed).alias("skip"), F.col("f.id").rlike("^[A-Za-z0-9_-]+$").alias("safe_id"),
    )
    good = marked.filter(~F.col("skip") & F.col("safe_id")).select(
        F.col("f.id").alias("file_id"), "ts_us", "channel_id",
        F.struct(S.safe_filename(F.coalesce(F.nullif("f.name", F.lit("")), F.lit("unnamed_file"))).alias("name"), F.coalesce("f.size", F.lit(0)).alias("size"), F.coalesce("f.mode", F.lit("")).alias("mode"), F.coalesce("f.mimetype", F.lit("")).alias("mime")).alias("r"),
    )
    first = good.groupBy("file_id").agg(F.min_by("r", F.struct("ts_us", "channel_id", "r")).alias("r"))
    clash = good.join(first.withColumnRenamed("r", "kept"), "file_id").filter(F.col("r") != F.col("kept")).agg(F.count(F.lit(1)).alias("conflicts"))
    counts = marked.agg(F.count_if("skip").alias("skipped"), F.count_if(~F.col("skip") & ~F.col("safe_id")).alias("bad_ids"))
    totals = counts.join(F.broadcast(clash)).select("skipped", (F.col("bad_ids") + F.col("conflicts")).alias("unsafe"))
    return first.select("file_id", "r.*"), totals


def reconciled(wanted: DataFrame, present: DataFrame, accepted: DataFrame) -> DataFrame:
    """``wanted`` (file_id, name, size, mode, mime) with served size and class.

    ``present`` is (file_id, name, served and, if known, kind), ``accepted`` (file_id, accepted size).  What is there but no plain
    file is of class unsafe, and nothing is served of it.
    """
    unsafe = F.coalesce(F.col("kind") != "file", F.lit(False)) if "kind" in present.columns else F.lit(False)
    met = wanted.join(present, ["file_id", "name"], "left").join(accepted, "file_id", "left").withColumn("unsafe", unsafe)
    met = met.withColumn("served", F.when(~F.col("unsafe"), F.col("served")))
    kind = S.variance_class(F.col("mode"), F.col("mime"), F.col("size"), F.col("served"), F.col("accepted"))
    return met.withColumn("class", F.when(F.col("unsafe"), "unsafe").otherwise(kind)).drop("unsafe")


def covered(wanted: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """One row: how many of ``wanted`` have a row in ``present``."""
    return wanted.join(present.select(*keys), keys, "left_semi").agg(F.count(F.lit(1)).alias("covered"))


def variance_totals(rows: DataFrame, group: list[str]) -> DataFrame:
    """Of each group of ``reconciled`` rows: files and bytes of accepted variance, and the files as id=bytes."""
    delta = F.abs(F.col("served") - F.col("size"))
    listed = F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "file_id", "served"))), ",")
    return rows.filter("class = 'documented'").groupBy(*group).agg(F.count(F.lit(1)).alias("files"), F.sum(delta).cast("long").alias("bytes"), listed.alias("listed"))


def report(rows: DataFrame, totals: DataFrame | None = None, shown: int = SHOWN) -> DataFrame:
    """One row of counts, sums and lists over ``reconciled`` rows; with ``totals`` (skipped, unsafe) of ``expected``.

    Counts and sums are whole; the two lists hold the first ``shown`` files by id, as they are for people.  With 0 they are
    left out, and the rows are read once.
    """
    kind = F.col("class")
    delta = F.abs(F.col("served") - F.col("size"))
    counted = rows.agg(
        F.count(F.lit(1)).alias("expected_count"), F.count("served").alias("present_count"), F.count_if(kind == "missing").alias("missing_count"), F.count_if(kind == "unsafe").alias("unsafe_here"),
        F.count_if(kind == "mismatch").alias("size_mismatch_count"), F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("expected_bytes"), F.coalesce(F.sum("served"), F.lit(0)).cast("long").alias("present_bytes"),
        F.count_if(kind == "snippet").alias("snippet_variance_count"), F.coalesce(F.sum(F.when(kind == "snippet", delta)), F.lit(0)).cast("long").alias("snippet_variance_bytes"),
        F.count_if(kind == "documented").alias("documented_variance_count"), F.coalesce(F.sum(F.when(kind == "documented", delta)), F.lit(0)).cast("long").alias("documented_variance_bytes"),
    )

    def first(name: str, text: Column) -> DataFrame:
        few = rows.filter(kind == name).select("file_id", text.alias("t")).orderBy("file_id", "t").limit(shown)
        return few.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("file_id", "t"))), lambda x: x["t"]), ",").alias(f"{name}_list"))

    documented = first("documented", F.concat_ws("=", "file_id", "served"))
    mismatched = first("mismatch", F.concat(F.concat_ws("/", "file_id", "name"), F.lit(" "), F.col("size").cast("string"), F.lit(" "), F.col("served").cast("string")))
    if totals is None:
        totals = rows.sparkSession.range(1).select(F.lit(0).cast("long").alias("skipped"), F.lit(0).cast("long").alias("unsafe"))
    counts = [*[c for c in counted.columns if c != "unsafe_here"], F.col("skipped").alias("skipped_count"), (F.col("unsafe") + F.col("unsafe_here")).alias("unsafe_count")]
    one = counted.join(F.broadcast(totals))
    if not shown:
        return one.select(*counts)
    one = one.join(F.broadcast(documented)).join(F.broadcast(mismatched))
    return one.select(*counts, F.col("documented_list").alias("documented_variance_files"), F.col("mismatch_list").alias("mismatched_files"))
