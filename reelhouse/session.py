"""Session settings and the shared scratch location.

Scratch data (checkpoints, staged tables, export round trips) always goes
under the folder the cluster names in ``spark.checkpoint.dir``.  Only when a
session leaves it unset (unit tests, a laptop) do we set one of our own.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every session of this library relies on: UTC wall clock for the
# epoch <-> timestamp conversions, ANSI kept on (bad casts must be explicit
# try_cast calls), adaptive execution for runtime re-planning and skew joins.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # count(*), min and max of files opened by the V2 reader come from footers
    "spark.sql.parquet.aggregatePushdown": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "reelhouse", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster use the cluster's own builder and
    call :func:`configure` on it instead."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g"))
    for k, v in {**SESSION_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session."""
    for k, v in SESSION_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a running session: leave as is
            pass
    scratch_root(spark)
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for the statements inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def scratch_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session (set one only if unset)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: name a folder shared by the cluster "
                             "(checkpoints and staged tables must survive executor loss)")
        # Local session (tests, a laptop): a private folder is shared by definition.
        conf_dir = tempfile.mkdtemp(prefix="reelhouse-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared scratch root."""
    root = scratch_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def local_path(uri: str) -> str:
    """Strip a ``file:`` scheme (for test assertions on local folders)."""
    return uri[len("file:"):] if uri.startswith("file:") else uri


__all__ = ["build_session", "configure", "scratch_root", "scratch_path",
           "local_path", "SESSION_CONF"]


def reliable_checkpoint(df):
    """Materialise ``df`` in the shared checkpoint folder and cut its
    lineage (survives executor loss, unlike a local checkpoint)."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df, name: str, partition_by=()):
    """``df`` written once as Parquet in the shared scratch folder and read
    back (a layer table without a catalog entry): later plans start from files
    that outlive lost executors, so the shuffle files of the write go when it ends."""
    path = scratch_path(df.sparkSession, name)
    with setting(df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tune_for_input(spark: SparkSession, input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Size shuffles and scans for an input of ``input_bytes``.

    Initial shuffle partitions = input / target (at least 200); AQE then
    coalesces small partitions toward the advisory size and splits skewed
    ones.  Scan splits use the same target so a task reads ~256 MiB.
    """
    parts = max(200, -(-input_bytes // target_partition_bytes))
    conf = {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf
