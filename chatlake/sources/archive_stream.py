"""Streaming source of one table of a SQLite archive: the rows of new chunks.

    spark.dataSource.register(ArchiveStream)
    spark.readStream.format("sqlite_archive_stream").option("path", p).option("table", "MESSAGE").load()

The offset is the largest chunk that the archive has recorded.  A micro-batch holds the rows of the chunks after the last
offset, in partitions of ``ROWS`` rowids; which rows these are depends on the two offsets alone, so a batch that is
replayed after a restart reads the same rows of an archive that was only appended to.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from chatlake.session import ship
from chatlake.sources.sqlite_archive import ROWS, Reader, SQLiteArchive, connect


@dataclass
class Span(InputPartition):
    low: int
    high: int
    after: int
    last: int


class StreamReader(DataSourceStreamReader):
    def __init__(self, path: str, table: str, schema: T.StructType, rows: int):
        self.path, self.table, self.schema, self.rows = path, table, schema, rows
        self.chunk = "ID" if table == "CHUNK" else "CHUNK_ID"

    def initialOffset(self) -> dict:
        return {"chunk": -1}

    def latestOffset(self) -> dict:
        with connect(self.path) as db:
            most = db.execute("SELECT max(ID) FROM CHUNK").fetchone()[0]
        return {"chunk": -1 if most is None else most}

    def partitions(self, start: dict, end: dict) -> list[Span]:
        after, last = start["chunk"], end["chunk"]
        with connect(self.path) as db:
            low, high = db.execute(f'SELECT min(rowid), max(rowid) FROM "{self.table}" WHERE "{self.chunk}" > ? AND "{self.chunk}" <= ?', [after, last]).fetchone()
        if low is None:
            return [Span(0, 0, after, last)]
        return [Span(at, min(at + self.rows, high + 1), after, last) for at in range(low, high + 1, self.rows)]

    def read(self, partition: Span) -> Iterator[tuple]:
        reader = Reader(self.path, self.table, self.schema, None)
        reader.where = [(f'"{self.chunk}" > ?', partition.after), (f'"{self.chunk}" <= ?', partition.last)]
        return reader.read(partition)

    def commit(self, end: dict) -> None:
        """The archive keeps its rows."""


class ArchiveStream(SQLiteArchive):
    @classmethod
    def name(cls) -> str:
        return "sqlite_archive_stream"

    def reader(self, schema: T.StructType):
        return DataSource.reader(self, schema)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return StreamReader(self.options["path"], self.options["table"].upper(), schema, int(self.options.get("rows", str(ROWS))))


def stream_archive(spark: SparkSession, path: str, table: str, rows: int = ROWS) -> DataFrame:
    """The rows of one archive table as a stream of new chunks."""
    ship(spark)
    spark.dataSource.register(ArchiveStream)
    return spark.readStream.format("sqlite_archive_stream").option("path", path).option("table", table).option("rows", rows).load()
