"""Python data source for one table of a SQLite archive.

    spark.dataSource.register(SQLiteArchive)
    spark.read.format("sqlite_archive").option("path", p).option("table", "MESSAGE").load()

Each partition reads one range of rowids through the standard library's driver, ``ROWS`` of them if
``numPartitions`` isn't set, so a large table is read in parallel; ``CHUNK_ID > n`` and other simple comparisons are pushed into SQLite.  The path has
to be one that executors can open.  ``columns`` narrows the scan; missing optional columns are null.
"""

from __future__ import annotations

import base64
import sqlite3
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from chatlake import schemas
from chatlake.session import ship

ROWS = 100_000
WANTED_BITS, WANTED_KEYS = 20, 100_000  # of the Bloom filter; beyond so many keys it is left out
OPERATORS = {GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<=", EqualTo: "="}


def connect(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"{Path(path).absolute().as_uri()}?mode=ro", uri=True)


def migration_version(path: str, table: str = "goose_db_version") -> int | None:
    """The newest applied migration that the archive records, if it does."""
    with connect(path) as db:
        if not db.execute("SELECT 1 FROM sqlite_master WHERE type = 'table' AND lower(name) = ?", [table.lower()]).fetchone():
            return None
        return db.execute(f'SELECT max(version_id) FROM "{table}" WHERE is_applied').fetchone()[0]


def check_structure(path: str, pages: bool = False) -> None:
    """Refuse an archive that lacks a table or a required column; with ``pages``, one whose pages are damaged too."""
    with connect(path) as db:
        if pages and db.execute("PRAGMA quick_check").fetchone()[0] != "ok":
            raise ValueError("the archive failed its integrity check")
        tables = {r[0].upper() for r in db.execute("SELECT name FROM sqlite_master WHERE type = 'table'")}
        for name, required in schemas.REQUIRED.items():
            if name not in tables:
                raise ValueError(f"archive has no table {name}")
            have = {r[1].upper() for r in db.execute(f'PRAGMA table_info("{name}")')}
            if lacking := sorted(set(required) - have):
                raise ValueError(f"archive table {name} lacks columns: {', '.join(lacking)}")


def snapshot(path: str, to: str) -> str:
    """A coherent copy of a database that may be in use, checked, put in place in one step."""
    source, target = Path(path).resolve(strict=True), Path(to).absolute()
    if target.exists() and source.samefile(target):
        raise ValueError("a snapshot needs a path of its own")
    part = target.with_suffix(".part")
    part.unlink(missing_ok=True)
    with connect(str(source)) as a, sqlite3.connect(part) as b:
        a.backup(b)
        if b.execute("PRAGMA quick_check").fetchone()[0] != "ok":
            raise ValueError("the snapshot failed its integrity check")
    part.replace(target)
    return str(target)


@dataclass
class Rowids(InputPartition):
    low: int
    high: int


def _places(text: str) -> tuple[int, int]:
    """The two bits of a key."""
    return tuple(zlib.crc32(f"{salt}{text}".encode()) & (1 << WANTED_BITS) - 1 for salt in ("a", "b"))


def wanted(keys: DataFrame) -> str | None:
    """The Bloom filter of the rows of ``keys`` (a small set), or None if there are over ``WANTED_KEYS``: 128 KiB at most."""
    if keys.limit(WANTED_KEYS + 1).count() > WANTED_KEYS:
        return None
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in keys.columns])
    place: Column = F.explode(F.array(*[F.crc32(F.concat(F.lit(salt), text)).bitwiseAND((1 << WANTED_BITS) - 1) for salt in ("a", "b")]))
    bits = bytearray(1 << WANTED_BITS - 3)
    for r in keys.select(place.alias("at")).distinct().collect():  # two numbers a key at most
        bits[r["at"] >> 3] |= 1 << (r["at"] & 7)
    return base64.b64encode(zlib.compress(bytes(bits))).decode()


class Reader(DataSourceReader):
    def __init__(self, path: str, table: str, schema: T.StructType, partitions: int | None, wanted: str | None = None, keys: tuple[str, ...] = ()):
        self.path, self.table, self.schema, self.count = path, table, schema, partitions
        self.wanted, self.keys = wanted, keys
        self.where: list[tuple[str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        names = set(self.schema.fieldNames())
        for f in filters:
            if type(f) in OPERATORS and len(f.attribute) == 1 and f.attribute[0] in names and isinstance(f.value, (int, str)):
                self.where.append((f'"{f.attribute[0]}" {OPERATORS[type(f)]} ?', f.value))
            else:
                yield f

    def partitions(self) -> list[Rowids]:
        with connect(self.path) as db:
            low, high = db.execute(f'SELECT min(rowid), max(rowid) FROM "{self.table}"').fetchone()
        if low is None:
            return []
        step = max(1, -(-(high - low + 1) // self.count)) if self.count else ROWS
        return [Rowids(at, min(at + step, high + 1)) for at in range(low, high + 1, step)]

    def read(self, partition: Rowids | None) -> Iterator[tuple]:
        if partition is None:  # an empty table
            return
        with connect(self.path) as db:
            have = {r[1].upper() for r in db.execute(f'PRAGMA table_info("{self.table}")')}
            shown = ", ".join("rowid" if f.name == "rowid" else f'"{f.name}"' if f.name.upper() in have else "NULL" for f in self.schema.fields)
            where = " AND ".join(["rowid >= ? AND rowid < ?", *[w for w, _ in self.where]])
            if self.wanted:
                bits = zlib.decompress(base64.b64decode(self.wanted))

                def seen(*key) -> bool:
                    return all(bits[at >> 3] >> (at & 7) & 1 for at in _places("\x1f".join("" if k is None else str(k) for k in key)))

                db.create_function("wanted", len(self.keys), seen, deterministic=True)
                where += f" AND wanted({', '.join(chr(34) + k + chr(34) for k in self.keys)})"
            binary = [isinstance(f.dataType, T.BinaryType) for f in self.schema.fields]
            for row in db.execute(f'SELECT {shown} FROM "{self.table}" WHERE {where}', [partition.low, partition.high, *[v for _, v in self.where]]):
                yield tuple(v.encode("utf-8") if b and isinstance(v, str) else v for v, b in zip(row, binary, strict=True))


class SQLiteArchive(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite_archive"

    def schema(self) -> str:
        fields = schemas.ARCHIVE_DDL[self.options["table"].upper()].split(", ")
        if wanted := self.options.get("columns"):
            keep = {c.strip() for c in wanted.split(",")}
            fields = [f for f in fields if f.split()[0] in keep]
        return ", ".join([*fields, "rowid bigint"])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        keys = tuple(filter(None, self.options.get("wantedKeys", "").split(",")))
        return Reader(self.options["path"], self.options["table"].upper(), schema, int(self.options.get("numPartitions", "0")) or None, self.options.get("wanted"), keys)


def read_archive(spark: SparkSession, path: str, table: str, columns: list[str] | None = None, partitions: int = 0, keys: DataFrame | None = None) -> DataFrame:
    """One table of an archive with its rowid, in as many partitions, or by its rows; with ``keys``, their rows alone."""
    ship(spark)
    spark.dataSource.register(SQLiteArchive)
    reader = spark.read.format("sqlite_archive").option("path", path).option("table", table).option("numPartitions", partitions)
    if columns:
        reader = reader.option("columns", ",".join(columns))
    if keys is None:
        return reader.load()
    if bits := wanted(keys):
        reader = reader.option("wanted", bits).option("wantedKeys", ",".join(keys.columns))
    return reader.load().join(keys, keys.columns, "left_semi")
