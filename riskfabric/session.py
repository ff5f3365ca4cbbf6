"""SparkSession construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Sizing defaults for local runs. On a cluster these come from the job's
# spark-defaults; build_session only sets what is missing.
_LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Skip per-call Python call-site capture (one JVM round trip per function call
    # while a plan is built); error messages lose the Python line, plans are unchanged.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # One file split is ~128 MiB; at 100 TB this gives ~800k scan tasks,
    # which is what a 1000-executor cluster wants.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "riskfabric",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session.

    A submitted application (``spark-submit``) or one with an active session keeps its
    master, shuffle partitions, driver memory and every other setting; only ``extra``
    and explicit arguments are added. A plain Python process gets a local session
    with AQE on and the UI off.
    """
    builder = SparkSession.builder.appName(app_name)
    settings = dict(extra or {})
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if not is_submitted():
        cpus = os.environ.get("BENCH_CPUS", "8")
        if not master:
            builder = builder.master(f"local[{cpus}]")
        if (master or "local").startswith("local"):
            settings.setdefault("spark.sql.shuffle.partitions", cpus)
        settings = {**_LOCAL_DEFAULTS, "spark.driver.memory": os.environ.get("RISKFABRIC_DRIVER_MEM", "16g"), **settings}
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def is_submitted() -> bool:
    """Whether the settings come from elsewhere: ``spark-submit`` or a session that is active already."""
    return "PYSPARK_GATEWAY_PORT" in os.environ or SparkSession.getActiveSession() is not None


def _local_folder(master: str) -> str:
    """A scratch folder for a session whose executors share this machine's disk; others must name a shared one."""
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors share (master {master})")
    return tempfile.mkdtemp(prefix="riskfabric-ckpt-")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when none is configured.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/object-store) folder
    and is used as is; without it a session that is not local raises. A local
    session, as in tests, gets a scratch folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 — Spark Connect: read the setting from the session conf
        configured = spark.conf.get("spark.checkpoint.dir", None)
        return configured or _local_folder("remote")
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        configured = _local_folder(sc.master)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/riskfabric/{name}"


#: Whether a SQL execution deletes its shuffle files when it ends, instead of when the driver collects its plan.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Within it, a job's shuffle files go when the job ends: a load of many jobs holds those of one at a time.

    For writes and for frames that are made and collected within it; a frame to be collected again later would compute its shuffles again.
    """
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def materialize(df, name: str, compression: str | None = None):
    """Write ``df`` once as a parquet table under the shared checkpoint folder and
    return a DataFrame reading it back.

    One job computes the rows (a reliable ``checkpoint()`` would compute them
    twice: once for the eager count, once more to write the files). The written
    table cuts the lineage, so a lost executor never forces the upstream scans
    to be recomputed. ``compression`` is the session's unless given.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"tables/{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path, compression=compression)
    return spark.read.parquet(path)


def drop_materialized(df) -> None:
    """Delete the table behind a DataFrame of ``materialize`` that nothing reads any more."""
    spark = df.sparkSession
    ours = scratch_path(spark, "tables/")
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        if path.toUri().getPath().startswith(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ours).toUri().getPath()):
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
