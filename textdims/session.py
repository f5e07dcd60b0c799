"""Spark session helpers.

Everything in the library takes a ``SparkSession`` (or DataFrames) as an
argument; this module only builds a session for tests / the bench and
resolves the shared checkpoint folder used to cut lineage in iterative jobs.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(
    master: str | None = None,
    app: str = "textdims",
    shuffle_partitions: int | None = None,
    driver_memory: str = "16g",
    extra: dict | None = None,
) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(os.environ.get("TEXTDIMS_SHUFFLE_PARTITIONS", "16"))
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.files.maxPartitionBytes", str(64 * 1024 * 1024))
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, configuring it if needed.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder (HDFS,
    object store).  Only a local-mode session (tests, bench) gets a fresh
    folder under /tmp when nothing is configured.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; iterative operators need a shared "
            "checkpoint folder on a cluster"
        )
    path = tempfile.mkdtemp(prefix="textdims-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any store that Spark reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


#: Tables written by ``materialize`` in this process, for ``release``.
_WRITTEN: list[str] = []


#: Whether Spark removes an execution's shuffle files as soon as it has ended, not when the driver collects its garbage.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df, name: str = "stage", compression: str | None = None, tidy: bool = False):
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads the files instead of
    recomputing upstream stages) and computes the plan exactly once.
    With ``tidy``, the shuffle files of the write are gone when it returns.
    ``release`` removes the files once the results that read them are done with.
    """
    import uuid

    spark = df.sparkSession
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/textdims/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_TIDY, None)
    if tidy:
        spark.conf.set(_TIDY, "true")
    try:
        df.write.mode("overwrite").parquet(path, compression=compression)
    finally:
        if tidy:
            spark.conf.unset(_TIDY) if before is None else spark.conf.set(_TIDY, before)
    _WRITTEN.append(path)
    return spark.read.parquet(path)


def release(spark: SparkSession) -> None:
    """Remove every table that ``materialize`` has written so far, and the cache; results that still read them end with that."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(conf).delete(path, True)
    spark.catalog.clearCache()
