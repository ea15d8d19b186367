"""Session settings the pipeline relies on, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every stage needs. They are session-scoped and safe to
# set on an existing session (the driver's or a notebook's).
RUNTIME_CONF = {
    # Duplicate JSON keys: the last value wins, as in Python's json module.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A Python worker holds a batch several times over (Arrow, strings, result);
    # Spark's 64 MB of 10,000 rows fill up as the input grows.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def ship_code() -> None:
    """Pickle this package's functions and classes by value, so Python
    workers run them without having the package on their path (the same
    effect as --py-files, with no file to distribute)."""
    import sys

    from pyspark import cloudpickle

    pkg = sys.modules[__name__.split(".")[0]]
    try:
        cloudpickle.register_pickle_by_value(pkg)
    except ValueError:
        pass  # already registered


def configure(spark: SparkSession) -> SparkSession:
    ship_code()
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "chunkwright") -> SparkSession:
    """A local session for tests and the bench (UI off, no speculation)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        # Model calls are not repeatable: never run a task twice on purpose.
        .config("spark.speculation", "false")
        .config("spark.sql.python.filterPushdown.enabled", "false")
    )
    for k, v in RUNTIME_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def work_dir(spark: SparkSession) -> str:
    """The shared folder for materialised stages.

    Uses the cluster's ``spark.checkpoint.dir`` (or the checkpoint directory
    already set on the context). Only when neither is set, as in local tests,
    a fresh folder is made and registered as the checkpoint directory.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        d = tempfile.mkdtemp(prefix="chunkwright-ckpt-")
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-path of the shared work folder, grouped per Spark
    application so one run's stages can be found (and removed) together."""
    base = work_dir(spark).rstrip("/")
    app = spark.sparkContext.applicationId
    return f"{base}/chunkwright-{app}/{name}-{uuid.uuid4().hex[:12]}"


def spread(df: DataFrame) -> DataFrame:
    """An input with fewer partitions than the cluster has cores, whatever its
    size, is spread round-robin, so the CPU-heavy stages after it (chunking,
    answer parsing) use every core."""
    par = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(par) if df.rdd.getNumPartitions() < par else df


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a stage as parquet to the shared work folder and read it back.
    Later stages then read only the columns they need, the plan above is
    not run again for each branch, and lost executors cost only a re-read."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def stage_buckets(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Like stage, but dealt by the keys into spark.sql.shuffle.partitions
    buckets: a join or grouping on the keys reads them without a shuffle. The
    table's entry is of this session alone."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys).saveAsTable(table, format="parquet", path=path)
    return spark.read.table(table)


def strip_scheme(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


__all__ = ["configure", "local_session", "work_dir", "scratch_path", "stage", "stage_buckets", "spread", "strip_scheme"]
