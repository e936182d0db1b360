"""Session and table helpers shared by queries, tests and the bench."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings that the library relies on (UTC, AQE, Arrow)."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("chatlake")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.python.filterPushdown.enabled", "true")
        .config("spark.sql.codegen.cache.maxEntries", "2000")  # an ingest alone has more plans than the default keeps
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors' Python workers, once a context.

    Jobs then run whatever the workers' search path is; a package that was itself shipped as a zip
    is left as it is.
    """
    sc, root = spark.sparkContext, Path(__file__).resolve().parent
    if getattr(sc, "_chatlake_shipped", False) or not root.is_dir():
        return
    packed = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="chatlake-")), "chatlake_package.zip")
    with zipfile.ZipFile(packed, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(packed)
    sc._chatlake_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; a single Parquet file or a folder of them."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local session without the setting, as in tests, gets a folder of its own on this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return named or tempfile.mkdtemp(prefix="spark-shared-")


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of our own on any file system that Spark reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the context's folder, else in the shared one."""
    spark = df.sparkSession
    ship(spark)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()
