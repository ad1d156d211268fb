"""Session construction and the few execution helpers shared by operators."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "tessera") -> SparkSession:
    """Local/test session. On a cluster, use the session the platform provides."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    shuffle_partitions = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared ``spark.checkpoint.dir``.  A local session without one gets a
    temporary folder; on a cluster, where tasks could not see it, that is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A new path of its own under the shared checkpoint dir."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}/{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a parquet table under the shared checkpoint dir and
    read it back: cuts lineage, survives executor loss (the files live on the
    cluster's shared storage) and, unlike RDD checkpoints, keeps columnar
    scans with pruning and pushdown for every consumer."""
    path = scratch_path(df.sparkSession, "tables")
    df.write.mode("error").parquet(path)
    out = df.sparkSession.read.parquet(path)
    out._scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that :func:`materialize` wrote, once everything that reads them is itself written,
    and lets Spark drop the shuffle files of the plans that are through."""
    for t in tables:
        jvm, path = t.sparkSession._jvm, t._scratch
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(at, True)
    release(tables[0].sparkSession)


def release(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of plans and fits that nothing refers to any more."""
    import gc
    gc.collect()
    spark._jvm.System.gc()


def per_group(df: DataFrame, most: int = 10_000) -> DataFrame:
    """A table of one row (or a few) per group, written once and counted: up to
    ``most`` rows it is broadcast, so raw rows are never shuffled on a key of
    few values; beyond, the key has many values and an ordinary join deals
    them out."""
    from pyspark.sql import functions as F
    t = materialize(df)
    return F.broadcast(t) if t.limit(most + 1).count() <= most else t


def cpu_partitions(spark: SparkSession) -> int:
    """Task count for CPU-heavy per-row work (tokenising, edit distance).

    AQE sizes post-shuffle partitions by bytes, which leaves a few tasks for
    compact but expensive rows; an explicit repartition with this count keeps
    every core busy.  On a cluster ``spark.sql.shuffle.partitions`` already
    reflects its size.
    """
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(shuffle, 4 * spark.sparkContext.defaultParallelism)


def concurrently(jobs: list, most: int = 4) -> list:
    """Results of the functions ``jobs``, in their order, at most ``most`` running at a time.

    For small fits whose jobs leave most of a cluster idle.  Threads take over the caller's job
    properties (group, pool, description); the first error is raised after the running ones end.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.util import inheritable_thread_target
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    with ThreadPoolExecutor(max_workers=max(1, most)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        try:
            return [r.result() for r in running]
        except BaseException:
            for r in running:
                r.cancel()
            raise
