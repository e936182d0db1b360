"""A corpus from raw documents, in five stages, each on what the one before has kept.

Stages take (spark, docs, sf_dir) and return a DataFrame; each result is written as Parquet and read
again as the next one's input, so a lost executor costs one stage's tasks at most.  All but the last
return the columns of ``docs``; an ``n_chars`` column follows a text that a stage changes.

Defined cases
* null and empty texts: the classifier judges them as empty ones; what is kept of them has one empty line, no
  near copies, no leak and no words, so the mix takes none.
* null doc_ids take part in all stages; they are never the keeper of a line or the first of a group where a
  document with an id is.
* ties: the largest doc_id keeps a shared line, the smallest one stays of a group; equal rows are one group.
* very long texts pass all stages whole.
* an empty table, or labels or benchmark without rows, gives stages that drop nothing for it; an empty result is a
  table with the same columns.
* extra columns stay as they are, whatever their names; only the mix replaces size, target and taken.
* stages' results stay in a folder of the run below the shared one, for whoever reads them; nothing removes them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlake.llm import decontaminate, jaccard_join, line_dedup, mixing, quality
from chatlake.session import shared_folder, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    model = quality.train(quality.features(docs), table(spark, sf_dir, "labels"), "quality", 5, 0)
    return docs.filter(quality.score_texts(model) >= quality.THRESHOLD)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the long lines that five documents share, but for one holder's."""
    done = line_dedup.dedup_lines(docs)
    length = {"n_chars": F.when(F.col("n_dropped") > 0, F.char_length("text")).otherwise(F.col("n_chars"))} if "n_chars" in docs.columns else {}
    return done.select(*[length[c].cast(docs.schema[c].dataType).alias(c) if c in length else F.col(f"`{c}`") for c in docs.columns])


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard_join.keep_one(docs)


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that leak benchmark items."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the words taken of each."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_stage),
    ("benchmark decontamination", leak_stage),
    ("mixing sources", mix_stage),
]

#: The classifier, the banding and the tiling are not expressible in SQL; tests hold the stages
#: against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; results between stages go to the cluster's checkpoint folder."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
