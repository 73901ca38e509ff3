"""Session construction and shared-storage locations.

On a cluster the session comes from ``spark-submit`` and already carries
``spark.checkpoint.dir`` pointing at shared storage; every operator that needs
scratch space (lineage cuts, streaming checkpoints, versioned upsert targets)
asks :func:`checkpoint_dir` for it.  Only a local/test session that has no such
setting gets a fresh ``mktemp`` folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # runtime (measured) size bound under which AQE turns a shuffle join
    # into a broadcast join; static hints are only used for tables with a
    # bound fixed by definition (region, nation, lookup lists, centroids)
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ledgerlens", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests and benches."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in conf.items():
        if k.startswith("spark.sql.") and spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    checkpoint_dir(spark)
    importable_in_workers(spark)
    return spark


def importable_in_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did
    (clusters without a shared installation take it from ``--py-files``)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and scratch tables.

    Reads ``spark.checkpoint.dir`` from the session; sets a fresh local one
    only when the setting is absent in a local session (tests).  On a cluster
    executors would not see a folder of the driver's machine, so there the
    setting is required."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="ledgerlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, name: str = "stage", **options) -> DataFrame:
    """Write an intermediate result once as a Parquet table under the shared
    checkpoint folder and continue from the files.

    Unlike an RDD checkpoint this computes the data once (a reliable RDD
    checkpoint recomputes it unless cached), survives executor loss (the
    files are on shared storage), gives the optimizer real file sizes for
    join planning, and lets later reads prune columns.  ``options``: the
    writer's."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").options(**options).parquet(path)
    if _PASSING:
        _PASSING[-1].append(path)
    out = spark.read.parquet(path)
    out._stored_at = path
    return out


#: paths of the tables that ``cut_lineage`` writes within each ``passing_tables``
_PASSING: list[list[str]] = []
#: Spark's switch for dropping a job's shuffle files once the job has ended
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def passing_tables(spark: SparkSession):
    """Tables that ``cut_lineage`` writes within are removed at the end, but for
    those given to the yielded function (they pass to the context around, if
    there is one), and each job drops its shuffle files when it has ended: its
    result is stored.  Frames made within must not be read afterwards, unless
    they read kept tables only."""
    old, kept = spark.conf.get(DROP_SHUFFLES, None), []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df._stored_at)
        return df

    spark.conf.set(DROP_SHUFFLES, "true")
    _PASSING.append([])
    try:
        yield keep
    finally:
        mine = _PASSING.pop()
        if _PASSING:
            _PASSING[-1] += [x for x in mine if x in kept]
        for path in mine:
            if path not in kept:
                remove(spark, path)
        spark.conf.unset(DROP_SHUFFLES) if old is None else spark.conf.set(DROP_SHUFFLES, old)


def _file_system(spark: SparkSession, path: str):
    """Spark's own file system for ``path`` (local, HDFS, an object store) and the path in it."""
    jvm = spark.sparkContext._jvm
    there = jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), there


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    fs, there = _file_system(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(there)) if fs.exists(there) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file of the caller's."""
    fs, there = _file_system(spark, path)
    fs.delete(there, True)


def scratch_used(spark: SparkSession) -> set[str]:
    """Names now under the shared checkpoint folder, for ``clear_scratch``."""
    return set(children(spark, checkpoint_dir(spark)))


def clear_scratch(spark: SparkSession, before: set[str]) -> int:
    """Remove scratch tables made since ``before`` was taken, once nothing
    reads them any more; how many.  Not while other jobs use the folder."""
    new = [x for x in children(spark, checkpoint_dir(spark)) if x not in before]
    for name in new:
        remove(spark, f"{checkpoint_dir(spark).rstrip('/')}/{name}")
    return len(new)
