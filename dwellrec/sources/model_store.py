"""Model store: the ALS model, the visitor index it was trained with, and the
run parameters, saved side by side so a reload never rebuilds the index.

A store keeps versions. Layout under ``path``: ``v00000001-<id>/`` with ``als/``
(Spark ML format), ``user_index/`` (Parquet), ``params/`` (one JSON row) and
``_COMMITTED``, an empty file created last: a version without it does not
exist for readers, so a writer that dies leaves the version before it in
place, never a mixture. The newest committed version is loaded.

User factors are range-partitioned and sorted by id, so that serving a few
visitors (``operators.model.near_ids``) skips files, row groups and pages.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMITTED = "_COMMITTED"
PAGE_ROWS = "2048"      # factors in a Parquet page, the least that serving reads
_VERSION = re.compile(r"v(\d{8})-[0-9a-f]+$")


def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def mark(spark: SparkSession, path: str) -> None:
    """Create the empty file ``path``."""
    fs, hadoop = _fs(spark, path)
    fs.create(hadoop(path), True).close()


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _fs(spark, path)
    return bool(fs.exists(hadoop(path)))


def versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of the committed versions, oldest first."""
    fs, hadoop = _fs(spark, path)
    if not fs.exists(hadoop(path)):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(hadoop(path)) if s.isDirectory()]
    return [f"{path}/{n}" for n in sorted(names)
            if _VERSION.match(n) and exists(spark, f"{path}/{n}/{COMMITTED}")]


def _number(folder: str) -> int:
    return int(_VERSION.search(folder).group(1))


def save_store(path: str, model: ALSModel, user_index: DataFrame, params: dict,
               cuts: list[float] | None = None, mode: str = "errorifexists") -> str:
    """Write and commit a version; returns its folder. ``errorifexists`` refuses
    a store that has one. ``overwrite`` adds a version and removes all but it
    and the one before, which running readers may still scan."""
    if mode not in ("errorifexists", "overwrite"):
        raise ValueError("mode must be 'errorifexists' or 'overwrite'")
    spark = user_index.sparkSession
    old = versions(spark, path)
    if old and mode == "errorifexists":
        raise FileExistsError(f"{path} already holds a model")
    to = f"{path}/v{(_number(old[-1]) if old else 0) + 1:08d}-{uuid.uuid4().hex[:8]}"
    model.write().save(f"{to}/als")
    (model.userFactors.repartitionByRange("id").sortWithinPartitions("id")
     .write.option("parquet.page.row.count.limit", PAGE_ROWS).mode("overwrite")
     .parquet(f"{to}/als/userFactors"))
    user_index.select("visitor_trace", "user").write.parquet(f"{to}/user_index")
    meta = dict(params)
    meta["cuts"] = list(cuts or [])
    (spark.createDataFrame([(json.dumps(meta, sort_keys=True),)], "value STRING")
     .coalesce(1).write.text(f"{to}/params"))
    mark(spark, f"{to}/{COMMITTED}")
    fs, hadoop = _fs(spark, path)
    for folder in old[:-1]:
        fs.delete(hadoop(f"{folder}/{COMMITTED}"), False)
        fs.delete(hadoop(folder), True)
    return to


def load_store(spark: SparkSession, path: str, version: int | None = None):
    """(ALSModel, user_index DataFrame[visitor_trace, user], params dict) of the
    newest committed version, or of ``version``."""
    found = [v for v in versions(spark, path) if version in (None, _number(v))]
    if not found:
        raise FileNotFoundError(f"{path} holds no committed model"
                                + ("" if version is None else f" of version {version}"))
    at = found[-1]
    model = ALSModel.load(f"{at}/als")
    index = spark.read.parquet(f"{at}/user_index").select(
        "visitor_trace", F.col("user").cast("int").alias("user"))
    meta = json.loads(spark.read.text(f"{at}/params").first()["value"])
    return model, index, meta
