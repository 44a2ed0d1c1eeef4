"""The corpus pipeline: operators of ``assayframe.llm`` in a row, each stage's documents written and read again.

language ID        documents without an identified language go;
n-gram Jaccard     one document of each group of near duplicates stays;
decontamination    documents that hold a benchmark passage go;
mixing             documents are sampled by calibrated probabilities;
sharding           every document gets its shard and slot.

All stages but the last return the columns of documents.  Empty tables pass
through; nulls, ties and repeated rows are treated as each operator's
docstring says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from assayframe.llm import decontam, jaccard, langid, mixing, sharding
from assayframe.llm.shared import tidied, unwritten, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Share of the tokens that mixing keeps at most: fewer where the targets can't be met otherwise.
KEEP_SHARE = 0.9
SHARDS = 40


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.sample(docs, at_most=KEEP_SHARE)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(docs, SHARDS)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mix),
    ("sharding", shard),
]

#: SQL can't express the classifier of the first stage; the tests hold run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in a row.  What a stage has written is deleted when its own result is, and that when the next one's is."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with tidied(spark) as keep:
            out = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
            keep.append(out)
        unwritten(docs)
        docs = out
    last = STAGES[-1][1](spark, docs, sf_dir)  # it has written its rows, and reads them only
    unwritten(docs)
    return last
