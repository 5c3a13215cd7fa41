"""Session construction and shared-folder resolution.

Only settings a job needs are set here; cluster-level settings (executor
sizes, checkpoint folder, ...) come from the cluster. The checkpoint folder is
read from the session (``spark.checkpoint.dir`` or an earlier
``setCheckpointDir``). A folder of our own is created only when none is set
and the master is local, as in tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults for a job session. AQE re-plans joins at run time (broadcast vs
# sort-merge), coalesces small shuffle partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # top-k filters on row_number() get a partial group limit before the shuffle
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    # RDD checkpoints (random_split, ALS) are written with the RDD serializer
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Shuffle and scan sizing for an input of ``input_bytes``.

    Shuffle partitions start at input/target (AQE coalesces small ones and
    splits skewed ones at run time), so a partition of the largest shuffle
    stays near ``target_partition_bytes`` and fits executor memory; scans are
    split at the same size. The visitor hot-key threshold follows the
    partition count (a key above one partition's share is hot).
    """
    parts = max(8, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def input_bytes(df) -> int:
    """Size of the files (or tables) that ``df`` scans, from their statistics."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def size_session(spark: SparkSession, n_bytes: int) -> None:
    """Apply ``scale_conf`` for an input of ``n_bytes`` to a running session."""
    for k, v in scale_conf(n_bytes).items():
        spark.conf.set(k, v)


def build_session(master: str | None = None, app: str = "dwellrec",
                  shuffle_partitions: int | None = None,
                  conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only if unset.

    On a cluster the folder must be shared (``spark.checkpoint.dir``); a
    machine-local temporary folder is used only for a local master.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local-cluster") or not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="dwellrec-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (for model stores etc.)."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex}")


_MATERIALIZED: dict[str, list[str]] = {}
_ON_DROP: list = []


def on_drop(forget) -> None:
    """``forget()`` is called when intermediate tables are removed (memos of
    DataFrames over them must go)."""
    _ON_DROP.append(forget)


def materialize(df, name: str):
    """Write ``df`` as a Parquet table under the shared checkpoint folder and
    read it back: the lineage is cut (a lost executor re-reads files, later
    plans start from a scan) and later reads are columnar and pruned. The
    path is remembered so ``drop_materialized`` can remove it when done."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    _MATERIALIZED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.parquet(path)


def track_materialized(spark: SparkSession, path: str) -> None:
    """Remember an intermediate path written by other means (e.g. a model)."""
    _MATERIALIZED.setdefault(spark.sparkContext.applicationId, []).append(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete one intermediate table (an iteration's state that the next
    iteration's, already written, replaces)."""
    jvm = spark.sparkContext._jvm
    hp = jvm.org.apache.hadoop.fs.Path(path)
    hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hp, True)
    written = _MATERIALIZED.get(spark.sparkContext.applicationId, [])
    if path in written:
        written.remove(path)


def materialized_mark(spark: SparkSession) -> int:
    """A marker for ``drop_materialized(spark, since=...)``."""
    return len(_MATERIALIZED.get(spark.sparkContext.applicationId, []))


def drop_materialized(spark: SparkSession, since: int = 0) -> int:
    """Delete the intermediate tables this application wrote with
    ``materialize`` after the marker ``since`` (all by default); call once
    no DataFrame built on them is needed. Returns how many were removed."""
    written = _MATERIALIZED.get(spark.sparkContext.applicationId, [])
    paths = written[since:]
    del written[since:]
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        hp.getFileSystem(conf).delete(hp, True)
    if paths:
        for forget in _ON_DROP:
            forget()
    return len(paths)
