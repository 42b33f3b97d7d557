"""Session helpers: shared scratch/checkpoint folder and scale-out settings.

Library functions never create a session; callers pass one in.  The
checkpoint folder is read from the session (``spark.checkpoint.dir``, which a
cluster points at shared storage); only when it is unset on a local master --
tests -- a fresh ``/tmp/run-XXXXXX`` folder is made.  Elsewhere it must be set.
"""

from __future__ import annotations

import contextlib
import contextvars
import gc
import math
import tempfile
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Settings for a large cluster.  AQE re-plans joins from runtime sizes, merges
# small shuffle partitions and splits skewed ones; partial aggregation and the
# partial WindowGroupLimit shrink hot keys before they are shuffled.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # A task of a partitioned write keeps a file of each outcome open instead of
    # sorting its rows by outcome first.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    "spark.sql.session.timeZone": "UTC",
}


#: Codec of staged tables: they lie on disk until the run ends, so bytes count.
STAGED_CODEC = "zstd"
#: Rows of a staged device table that one task reads, about.
ROWS_PER_BUCKET = 5_000_000
#: Rows that a task compares to find the distinct ones, about.
ROWS_PER_DISTINCT = 1_000_000


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None for a remote (Connect) one."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; set a fresh local one only if unset."""
    sc = _context(spark)
    d = sc.getCheckpointDir() if sc is not None else None
    if d:
        return d
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf and (sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for staged tables")
    if sc is None:
        return conf
    d = conf or tempfile.mkdtemp(prefix="run-", dir="/tmp")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def session_id(spark: SparkSession) -> str:
    sc = _context(spark)
    return sc.applicationId if sc is not None else spark.conf.get("spark.app.id", "remote")


def parallelism(spark: SparkSession) -> int:
    """Task slots of the session (default parallelism)."""
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.default.parallelism", "8"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    base = _run_folder(spark) or checkpoint_dir(spark).rstrip("/")
    return f"{base}/devtrail-{name}-{uuid.uuid4().hex[:12]}"


#: (session, folder) of the run that the current thread works for.
_RUN: contextvars.ContextVar[tuple[str, str] | None] = contextvars.ContextVar("devtrail_run", default=None)
_TABLES: dict[str, list[str]] = {}


def _run_folder(spark: SparkSession) -> str | None:
    run = _RUN.get()
    return run[1] if run and run[0] == session_id(spark) else None


@contextlib.contextmanager
def run_scratch(spark: SparkSession):
    """Within it, staged tables go to one folder of this run, which is dropped
    when the run succeeds (a failed run's stays for a look at it).  Runs in
    several threads of a session, or within each other, have a folder each."""
    path = scratch_path(spark, "run")
    token = _RUN.set((session_id(spark), path))
    try:
        yield path
    finally:
        _RUN.reset(token)
    for table in _TABLES.pop(path, []):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def scale_out(spark: SparkSession) -> SparkSession:
    """Apply ``SCALE_CONF`` to a session that comes from the environment."""
    for k, v in SCALE_CONF.items():
        spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "devtrail") -> SparkSession:
    """A local session for tests and the benchmark (UI off, UTC, AQE on)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for k, v in SCALE_CONF.items():
        if k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"):
            continue
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def buckets(spark: SparkSession, rows: int = 0, per_bucket: int | None = None) -> int:
    """Buckets of device tables: the session's shuffle partitions, so that a
    join needs no exchange on either side; more if ``rows`` would overfill them."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / (per_bucket or ROWS_PER_BUCKET)))


def release(spark: SparkSession) -> None:
    """Have the shuffle files of jobs that have ended deleted, at a point where
    the tables that were staged by them are all that is left to read.  Spark
    deletes them when the driver's JVM finds a shuffle unreachable; a driver that
    does little collects its garbage rarely, and files of steps long done lie
    beside those of the next."""
    sc = _context(spark)
    for _ in range(2 if sc is not None else 0):  # what the first one's end lets go of is found by the second
        gc.collect()  # plans that Python still refers to stay
        sc._jvm.System.gc()
        time.sleep(0.2)


def stage_by_key(df, key: str, name: str = "stage", n: int | None = None):
    """``stage`` as a table bucketed and sorted by ``key`` (G2): tables with the
    same ``n`` join on the key without an exchange.  For tables with one row a
    key or so: a bucket is read by one task.

    The rows of a window or join by the key already lie in ``n`` hash partitions,
    each of which writes its buckets' files; others are dealt by key first.  The
    table has a unique name in the session's catalog; ``run_scratch`` drops it."""
    spark = df.sparkSession
    n = n or buckets(spark)
    path = scratch_path(spark, name)
    table = "devtrail_" + path.rsplit("devtrail-", 1)[1].replace("-", "_")
    if n != int(spark.conf.get("spark.sql.shuffle.partitions")):
        df = df.repartition(n, key)
    df.write.format("parquet").bucketBy(n, key).sortBy(key).options(path=path, compression=STAGED_CODEC).saveAsTable(table)
    if run := _run_folder(spark):
        _TABLES.setdefault(run, []).append(table)
    return spark.table(table)


def together(spark: SparkSession, *builds):
    """The results of functions that do not depend on each other; the jobs that
    they run (staged tables, measures) share the cluster."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(builds)) as pool:
        return [f.result() for f in [pool.submit(contextvars.copy_context().run, inherit(b)) for b in builds]]


def stage(df, name: str = "stage", partition_by: str | None = None):
    """Write ``df`` once as a Parquet table in a new folder under the shared
    checkpoint folder and return the table read back.  ``partition_by`` names a
    column whose values become partitions, so a filter on it reads only those.

    Used for intermediates that several outputs read.  The write runs under
    AQE (coalesced partitions), the re-read splits by file size, and the
    lineage is cut: a lost executor re-reads the table instead of recomputing
    the upstream shuffles."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("errorifexists").option("compression", STAGED_CODEC)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)  # known schema: no inference job

