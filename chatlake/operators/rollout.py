"""Which workspaces a rollout covers, and in which order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatlake.functions import scalars as S


def covered(workspaces: DataFrame, apart: DataFrame, id_col: str = "workspace_id") -> DataFrame:
    """``workspaces`` without those that ``apart`` (one column of ids or slugs, in any case) names; all, if none is left."""
    named = apart.select(S.folded(F.col(apart.columns[0])).alias("__apart")).distinct()
    forms = workspaces.select(id_col, F.explode(F.array(S.folded(F.col(id_col)), S.slug(F.col(id_col)))).alias("__apart"))
    solo = forms.join(named, "__apart", "left_semi").select(F.col(id_col).alias("__solo")).distinct()
    marked = workspaces.join(solo, F.col(id_col) == F.col("__solo"), "left")
    rest = marked.agg(F.count_if(F.col("__solo").isNull()).alias("__rest"))
    return marked.join(F.broadcast(rest)).filter(F.col("__solo").isNull() | (F.col("__rest") == 0)).select(*workspaces.columns)


def placed(workspaces: DataFrame, size: str, name: str) -> DataFrame:
    """``workspaces`` with ``place``: the smallest first, by name where sizes tie, those of unknown size last."""
    return workspaces.withColumn("place", F.row_number().over(Window.orderBy(F.col(size).asc_nulls_last(), name)))
