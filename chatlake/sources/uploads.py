"""Attachment files as a Python data source, and accepted sizes from settings text.

    spark.dataSource.register(AttachmentListing)
    spark.read.format("attachment_listing").option("path", uploads).option("root", archive).load()

Partitions are runs of ``FOLDERS`` folders, each listed by one task without following links: a link, or a folder that
leads out of ``root``, is told by its ``kind``.  Contents aren't read.  The path has to be one that executors can open.
"""

from __future__ import annotations

import os
import stat
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from chatlake.session import ship

FOLDERS = 256
LISTING = "file_id string, name string, path string, served bigint, kind string"


@dataclass
class Folders(InputPartition):
    names: tuple[str, ...]


class ListingReader(DataSourceReader):
    def __init__(self, path: str, root: str, folders: int):
        self.path, self.root, self.folders = path, root, folders

    def partitions(self) -> list[Folders]:
        if not os.path.isdir(self.path):
            return []
        names = sorted(e.name for e in os.scandir(self.path) if e.is_symlink() or e.is_dir())
        return [Folders(tuple(names[i : i + self.folders])) for i in range(0, len(names), self.folders)]

    def read(self, partition: Folders | None) -> Iterator[tuple]:
        root = Path(self.root).resolve()
        for name in partition.names if partition else ():
            folder = Path(self.path, name)
            linked = folder.is_symlink()
            try:
                entries = sorted(os.scandir(folder), key=lambda e: e.name)
            except OSError:  # a link to nothing, a folder that is gone
                continue
            outside = not Path(os.path.realpath(folder)).is_relative_to(root)
            for e in entries:
                seen = e.stat(follow_symlinks=False)
                kind = "outside" if outside and not linked else "link" if linked or stat.S_ISLNK(seen.st_mode) else "file" if stat.S_ISREG(seen.st_mode) else "other"
                yield name, e.name, str(folder / e.name), seen.st_size, kind


class AttachmentListing(DataSource):
    @classmethod
    def name(cls) -> str:
        return "attachment_listing"

    def schema(self) -> str:
        return LISTING

    def reader(self, schema) -> DataSourceReader:
        return ListingReader(self.options["path"], self.options.get("root", self.options["path"]), int(self.options.get("folders", str(FOLDERS))))


def present_files(spark: SparkSession, folder: str, root: str | None = None) -> DataFrame:
    """(file_id, name, path, served, kind) of what stands two levels under ``folder``; kind is file, link, outside or other."""
    ship(spark)
    spark.dataSource.register(AttachmentListing)
    return spark.read.format("attachment_listing").option("path", folder).option("root", root or folder).load()


def accepted_sizes(spark: SparkSession, text: str) -> DataFrame:
    """(file_id, accepted) of ``id=bytes,id=bytes``; refuses malformed entries."""
    pairs = []
    for item in filter(None, (x.strip() for x in text.split(","))):
        name, found, size = item.partition("=")
        if not found or not name or not size.isdigit():
            raise ValueError(f"expected id=bytes, got {item!r}")
        pairs.append((name, int(size)))
    return spark.createDataFrame(pairs, "file_id string, accepted bigint")
