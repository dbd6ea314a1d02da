"""Shared Spark plumbing of the text operators."""

from __future__ import annotations

import hashlib
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.session import scratch_path, scratch_root

#: Rows and bytes of one Arrow batch between the JVM and Python: a worker
#: holds one batch, so this bounds its memory (one longer row goes alone).
ARROW_ROWS, ARROW_BYTES = 1000, 16 << 20
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tuned(spark: SparkSession) -> SparkSession:
    """Session settings of this package.  Python workers also look for the
    package where the driver found it (a cluster without that path needs the
    package installed, as for any library)."""
    scratch_root(spark)
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), ROOT) if x)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    # Every step is written before the next reads it, so the shuffle files of a
    # finished step need not stay on the executors' disks.
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def keep(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared scratch folder and read
    back: later plans start from the files, which outlive lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: What operators keep in a Python worker between tasks, by operator.
CACHES: dict[str, dict] = {}


def claim(own: str) -> None:
    """Called when a task starts: drops what other operators keep in this
    worker, so one operator's tables are in memory at a time."""
    for name, held in CACHES.items():
        if name != own:
            held.clear()


def fresh(name: str, taken) -> str:
    """``name``, with underscores added until no column has it."""
    while name in taken:
        name += "_"
    return name


def columns(batch: pa.RecordBatch, *names: str) -> list[pa.Array]:
    return [batch.column(batch.schema.get_field_index(n)) for n in names]


def longs(column: pa.Array) -> np.ndarray:
    """Values of an integer column (nulls as 0; see ``column.is_null``)."""
    return column.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b): one row (node, component)
    per node, component the smallest node reached.

    Alternating large-star / small-star rounds.  Every round is a ``min`` per
    node (partial aggregates) and an equi-join on the node; the minima are
    written first, so the join shuffles both of its sides and AQE can split a node of
    very many edges.  Nothing is gathered per component.
    Each round is written to the shared folder and read back.
    """
    edges = keep(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                 "cc")
    seen = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = keep(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "cc-low")
        large = keep(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct(),
                     "cc-large")
        low = keep(large.groupBy("a").agg(F.min("b").alias("m")), "cc-low")
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
                                            F.col("m").alias("b")).distinct()
        edges = keep(small, "cc")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
