"""Bronze waves merged into a deduplicated silver table, as a stream.

Each run takes the bronze files not seen yet (``trigger(availableNow=True)``)
and merges them into the latest-row table by key bucket: a wave reads and
rewrites only the buckets its keys fall into.  A batch that is run again after a failure merges
the same rows again, which changes nothing; a merge that was broken off is
ended first (``tables.recover``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from reelhouse.sources import tables


def merge_to_silver(spark: SparkSession, bronze: str, schema: T.StructType | str, name: str, checkpoint: str, keys: Sequence[str],
                    order: Sequence[str], clean: Callable[[DataFrame], DataFrame] | None = None, buckets: int = 64,
                    max_files_per_trigger: int | None = None) -> int:
    """Merge the new files of the bronze folder into the table ``name``,
    holding the latest row per key by ``order``; ``clean`` types and scrubs a
    wave first.  Returns the number of micro-batches run."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)

    def merge(wave: DataFrame, _: int) -> None:
        tables.recover(wave.sparkSession, name)
        tables.merge_wave(clean(wave) if clean else wave, name, keys, order, buckets)

    q = r.parquet(bronze).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return len(q.recentProgress)
