"""Raw files landing in a folder -> bronze table, incrementally.

The bronze layer stores raw rows untransformed.  Running the ingest as a
file-source stream with ``trigger(availableNow=True)`` processes every file
not yet seen (tracked in the checkpoint) and stops, so the same job serves
the first load and every later top-up; a restarted or failed run resumes
from its checkpoint instead of re-reading the folder.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.schemas import all_strings


def ingest_to_bronze(spark: SparkSession, landing: str, schema: T.StructType, target: str,
                     checkpoint: str, fmt: str = "csv", sep: str = ",",
                     max_files_per_trigger: int | None = None, multiline: bool = False) -> int:
    """Append the declared columns (found by header name) of the new raw files
    under ``landing`` to the parquet folder ``target``.  A file whose header differs
    from the others' fails the run.  Returns the number of micro-batches run."""
    r = spark.readStream
    if fmt == "csv":
        # multiLine makes each file one task; only for sources with quoted newlines
        options = {"sep": sep, "multiLine": multiline, "escape": '"', "header": True}
        names = spark.read.options(**options).csv(landing).columns
        absent = [c for c in schema.fieldNames() if c not in names]
        if absent:
            raise ValueError(f"columns {absent} are not in the header {names} of {landing}")
        r = r.options(enforceSchema=False, **options).schema(all_strings(*names))
    else:
        r = r.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    cells = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields]
    src = r.format(fmt).load(landing).select(*cells, F.col("_metadata.file_path").alias("_source_file"))
    q = (src.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start(target))
    q.awaitTermination()
    return len(q.recentProgress)
