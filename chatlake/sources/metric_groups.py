"""Python data source that writes metric documents, one file a group, all of them or none.

    spark.dataSource.register(MetricGroups)
    documents.write.format("metric_groups").mode("append").option("path", folder).save()

Rows are (path, body).  A task writes its documents beside their places, under a name of its own; only when all tasks
have ended are they put in place, each by one rename, so a scraper never reads half a document and a failed task changes
nothing.  The folder has to be one that driver and executors share.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from chatlake.session import ship

NAME = "metrics.prom"


@dataclass
class Drafts(WriterCommitMessage):
    pairs: list[tuple[str, str]]


class GroupWriter(DataSourceWriter):
    def __init__(self, folder: str):
        self.folder, self.run = folder, uuid.uuid4().hex

    def write(self, rows: Iterator[Row]) -> Drafts:
        pairs = []
        for row in rows:
            place = Path(self.folder, row["path"], NAME)
            if not Path(os.path.abspath(place)).is_relative_to(os.path.abspath(self.folder)):
                raise ValueError(f"{row['path']} leads out of the folder")
            place.parent.mkdir(parents=True, exist_ok=True)
            draft = place.with_name(f".{self.run}-{uuid.uuid4().hex}.draft")
            draft.write_text(row["body"], encoding="utf-8")
            pairs.append((str(draft), str(place)))
        return Drafts(pairs)

    def commit(self, messages: list[Drafts | None]) -> None:
        for m in messages:
            for draft, place in m.pairs if m else ():
                os.replace(draft, place)
        self._clear()

    def abort(self, messages: list[Drafts | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        """Drafts of this run that no task has reported: of tasks that failed or ran twice."""
        for draft in Path(self.folder).rglob(f".{self.run}-*.draft"):
            draft.unlink(missing_ok=True)


class MetricGroups(DataSource):
    @classmethod
    def name(cls) -> str:
        return "metric_groups"

    def schema(self) -> str:
        return "path string, body string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return GroupWriter(self.options["path"])


def write_groups(documents: DataFrame, folder: str) -> None:
    """Put the documents (path, body) in place of older ones; others stay."""
    spark = documents.sparkSession
    ship(spark)
    spark.dataSource.register(MetricGroups)
    documents.select("path", "body").write.format("metric_groups").mode("append").option("path", folder).save()


def remove_groups(stale: DataFrame, folder: str) -> int:
    """Remove the documents of ``stale`` (path), a few groups; returns how many there were."""
    gone = 0
    for row in stale.toLocalIterator():
        place = Path(folder, row["path"], NAME)
        if Path(os.path.abspath(place)).is_relative_to(os.path.abspath(folder)) and place.exists():
            place.unlink()
            gone += 1
    return gone
