"""The incremental merge as a stream: each micro-batch of appended rows updates a newest-row table in buckets.

Version order (the chunk), not event time, decides which row wins, so no watermark is needed and late rows are harmless.
Keys are dealt to a fixed number of buckets.  A batch reads and writes the buckets of its keys alone, as folders of its
own, and then one log file that names the folder of every bucket; readers follow the newest log file.  A batch whose log
file exists has been applied and is not applied again, and folders that no log file names are overwritten, so a
replay or a failed batch changes nothing.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from chatlake.operators.newest import newest_rows
from chatlake.plans.files import listed, put, read_text
from chatlake.session import remove

BUCKETS = 64


def applied(spark: SparkSession, state: str) -> dict[int, str]:
    """batch to path of the log files."""
    return {int(f.name.split(".")[0]): f.path for f in listed(spark, f"{state}/_log") if f.name[:1].isdigit()}


def entry(spark: SparkSession, path: str) -> tuple[dict[str, str], str]:
    """(bucket to folder, schema) of a log file."""
    held = json.loads(read_text(spark, path))
    return held["folders"], held["schema"]


def merge_batch(batch: DataFrame, n: int, keys: list[str], order: list[Column], state: str, schema: StructType, buckets: int) -> bool:
    """Apply batch ``n``; False if it has been applied already."""
    spark = batch.sparkSession
    log = applied(spark, state)
    if n in log:
        return False
    held = entry(spark, log[max(log)])[0] if log else {}
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    rows = newest_rows(batch, keys, order).withColumn("bucket", bucket).persist()
    try:
        touched = sorted(r["bucket"] for r in rows.select("bucket").distinct().collect())  # ``buckets`` numbers at most
        if touched:
            old = [f"{state}/{held[str(b)]}" for b in touched if str(b) in held]
            both = rows if not old else rows.unionByName(spark.read.schema(schema).parquet(*old).withColumn("bucket", bucket))
            folder = f"{state}/batch={n}"
            newest_rows(both.repartition("bucket"), keys, order).write.mode("overwrite").partitionBy("bucket").parquet(folder)
        new = held | {str(b): f"batch={n}/bucket={b}" for b in touched}
    finally:
        rows.unpersist()
    put(spark, f"{state}/_log/{n:012d}.json", json.dumps({"folders": new, "schema": schema.json()}, sort_keys=True))
    clean(spark, state, log, n)
    return True


def clean(spark: SparkSession, state: str, log: dict[int, str], n: int) -> None:
    """Remove what neither the newest log file nor the one before names."""
    earlier = sorted(log)
    if len(earlier) < 2:
        return
    before, gone = (entry(spark, log[x])[0] for x in (earlier[-1], earlier[-2]))
    for b, folder in gone.items():
        if before.get(b) != folder:
            remove(spark, f"{state}/{folder}")
    for x in earlier[:-1]:
        remove(spark, log[x])


def stream_newest(spark: SparkSession, rows: DataFrame, keys: list[str], order: list[Column], state: str, checkpoint: str, trigger: dict | None = None, on_batch: Callable[[DataFrame, int], None] | None = None, buckets: int = BUCKETS) -> StreamingQuery:
    """Keep ``state`` the newest row of each key of the streaming ``rows``; ``read_newest`` reads it."""
    schema: StructType = rows.schema

    def apply(batch: DataFrame, n: int) -> None:
        merge_batch(batch, n, keys, order, state, schema, buckets)
        if on_batch:
            on_batch(batch, n)

    return rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def read_newest(spark: SparkSession, state: str) -> DataFrame:
    """The state after the last batch."""
    log = applied(spark, state)
    if not log:
        raise ValueError(f"no batch has been applied to {state}")
    held, schema = entry(spark, log[max(log)])
    kind = StructType.fromJson(json.loads(schema))
    return spark.read.schema(kind).parquet(*[f"{state}/{f}" for f in held.values()]) if held else spark.createDataFrame([], kind)
