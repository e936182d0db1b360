"""One fingerprint of a file, hashed in byte blocks by parallel tasks.

The path has to be one that executors can open, as for the archive's own source.  Blocks are read once, in pieces of a
megabyte; only their digests are combined, as a tree.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from chatlake.operators.lineage import FAN, tree_root
from chatlake.session import ship

BLOCK, PIECE = 8 << 20, 1 << 20


def _hashed(path: str, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            with open(path, "rb") as f:
                for i in batch.column("id").to_pylist():
                    f.seek(i * block)
                    digest, left = hashlib.sha256(), block
                    while left and (piece := f.read(min(left, PIECE))):
                        digest.update(piece)
                        left -= len(piece)
                    out.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.string())], names=["block", "digest"])

    return run


def block_digests(spark: SparkSession, path: str, block: int = BLOCK) -> DataFrame:
    """(block, digest) of each block of the file; an empty file has one, empty."""
    ship(spark)
    count = max(1, -(-os.stat(path).st_size // block))
    return spark.range(0, count, 1, min(count, 4 * spark.sparkContext.defaultParallelism)).mapInArrow(_hashed(path, block), "block bigint, digest string")


def file_fingerprint(spark: SparkSession, path: str, block: int = BLOCK) -> str:
    """The root over the file's blocks, with its size and block size."""
    size = os.stat(path).st_size
    rows = block_digests(spark, path, block).selectExpr("0 AS file", "block", "digest")
    root = tree_root(rows, "file", "block", "digest").first()["digest"]
    return hashlib.sha256(f"{size}:{block}:{FAN}:{root}".encode()).hexdigest()
