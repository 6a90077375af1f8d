"""Session settings and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Result-affecting settings. Sizes (shuffle partitions, memory) are left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "opinara", **extra: str) -> SparkSession:
    """A session with UTC timestamps, AQE and Arrow; `extra` uses `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: the one the cluster names in `spark.checkpoint.dir`.

    A private folder is made only for a local master that names none, as in tests.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        folder = tempfile.mkdtemp(prefix="opinara-checkpoint-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


_WRITTEN: list[str] = []  # intermediate tables of this process that are not deleted yet


def intermediate_path(spark: SparkSession, kind: str = "opinara") -> str:
    """A new path in the shared folder; `clear_intermediates` deletes what is written there."""
    path = f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def clear_intermediates(spark: SparkSession) -> int:
    """Delete the intermediate tables written so far, through the file system that holds them.

    For the owner of the results: call it once they have been consumed, as results that were
    not yet read or written depend on these tables. Returns the number of paths.
    """
    paths, _WRITTEN[:] = list(_WRITTEN), []
    for path in paths:
        _delete(spark, path)
    return len(paths)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, settings: dict[str, str] | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Cuts lineage, survives lost executors, and gives later joins real sizes to plan with. The
    shuffle files behind it are no longer needed then, and Spark is asked to delete them.
    `settings` hold while it is written.
    """
    spark = df.sparkSession
    path = intermediate_path(spark)
    settings = {CLEANUP: "true"} | (settings or {})
    before = {c: spark.conf.get(c, None) for c in settings}
    for c, value in settings.items():
        spark.conf.set(c, value)
    try:
        df.write.parquet(path)
    finally:
        for c, value in before.items():
            spark.conf.unset(c) if value is None else spark.conf.set(c, value)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that `materialise` wrote and that no result depends on."""
    for table in tables:
        for path in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            mine = [p for p in _WRITTEN if path.rsplit("/", 1)[-1] == p.rsplit("/", 1)[-1]]
            for p in mine:
                _WRITTEN.remove(p)
                _delete(table.sparkSession, p)


def width(df: DataFrame) -> int:
    """Partitions for work that is heavy per row: those of `df`, at least one per core."""
    return max(df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions())


def spread(df: DataFrame) -> DataFrame:
    """Use every core on a small input; an input with enough partitions is left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
