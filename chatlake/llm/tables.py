"""Intermediate results as Parquet tables in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from chatlake.session import shared_folder, ship


def written(df: DataFrame) -> DataFrame:
    """``df`` written once and read again: no lineage, and nothing of its plan (a checkpoint keeps the plan's constraints,
    which double from one iteration to the next)."""
    ship(df.sparkSession)
    path = f"{shared_folder(df.sparkSession)}/step-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
