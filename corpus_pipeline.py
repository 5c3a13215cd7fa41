"""A corpus pipeline of five stages, each calling one operator of dwellrec.llm.

Stages take (spark, docs, sf_dir) and return a DataFrame; between stages it is
written as Parquet to the shared checkpoint folder and read again. All but the
last return the columns of ``documents``; every decision drops rows:

  language_id      texts without a letter, or whose bits spell no learned language, go
  exact_dedup      of equal texts the row with the largest doc_id stays
  simhash_dedup    of near duplicates the row with the smallest doc_id stays
  decontamination  texts that contain a benchmark item go
  packing          buckets, batches and slots of what is left

The language model is learned from the documents themselves, so SQL cannot
express ``run``; the tests hold it against a brute-force version.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from dwellrec.llm import decontam, digest_merge, ecoc_langid, length_buckets, simhash
from dwellrec.llm.common import table
from dwellrec.plans.restart import Stages, table_fingerprint
from dwellrec.session import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ecoc_langid.keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return digest_merge.drop_copies(docs, keep="largest")


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return length_buckets.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, resume: str | None = None) -> DataFrame:
    """All stages over ``documents``. With a shared folder in ``resume`` a run whose
    driver died goes on after its last complete stage, if the tables are the same."""
    docs = table(spark, sf_dir, "documents")
    stages = None
    if resume:
        bench = table_fingerprint(table(spark, sf_dir, "benchmark"))
        stages = Stages(spark, resume, table_fingerprint(docs), [bench, [name for name, _ in STAGES]])
    for name, stage in STAGES:
        if stages:
            docs = stages.table(name, partial(stage, spark, docs, sf_dir))
        else:
            docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
