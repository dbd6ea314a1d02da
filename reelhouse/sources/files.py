"""Delimited and JSON files at the edges of the lakehouse.

Every reader takes a declared schema (no inference).  Gzip input is not
splittable, so a gzip scan is one task per file; pass ``repartition`` to
spread the rows before any heavy work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.schemas import all_strings
from reelhouse.session import written


def _by_name(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, options: dict) -> DataFrame:
    """Declared columns of header files, found by name.

    The header names come from the files; every file is then read with them
    (``enforceSchema`` off, so Spark compares each file's own header and fails
    on parts that differ).  All cells are read as strings, the declared columns
    selected and cast (text that does not parse gives NULL).  Further columns
    are dropped; a declared column that no header names is an error."""
    paths = path if isinstance(path, str) else list(path)
    names = spark.read.options(header=True, **options).csv(paths).columns
    absent = [f.name for f in schema.fields if f.name not in names]
    if absent:
        raise ValueError(f"columns {absent} are not in the header {names} of {path}")
    rows = spark.read.options(header=True, enforceSchema=False, **options).schema(all_strings(*names)).csv(paths)
    return rows.select([F.col(f"`{f.name}`") if isinstance(f.dataType, T.StringType)
                        else F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields])


def _struct(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str,
             multiline: bool = False, repartition: int | None = None) -> DataFrame:
    """Header CSV with declared columns (StructType or DDL string), found by
    header name in any order.

    Quoted cells with commas and quotes are handled line by line
    (``escape='"'``).  ``multiline=True`` also keeps quoted newlines inside
    one row, but makes every file a single task (a multi-line file cannot be
    split), so it is only for sources that need it (free-text fields such
    as fetched overviews).
    """
    df = _by_name(spark, path, _struct(schema), {"multiLine": multiline, "escape": '"', "mode": "PERMISSIVE"})
    return df.repartition(repartition) if repartition else df


def read_tsv(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None,
             schema: T.StructType | None = None, repartition: int | None = None) -> DataFrame:
    """Tab-separated dump(s) with declared columns found by header name (all
    strings with ``columns``; a glob reads many parts as one table).  Quotes
    are not special in the dumps, so quoting is off."""
    if schema is None and columns is None:
        raise ValueError("declare the columns or a schema")
    df = _by_name(spark, path, schema if schema is not None else all_strings(*columns), {"sep": "\t", "quote": "\u0000"})
    return df.repartition(repartition) if repartition else df


def export_csv(df: DataFrame, path: str, single_file_rows: int | None = None,
               compression: str | None = None, sep: str = ",", order: Sequence | None = None) -> None:
    """Header CSV export.  ``single_file_rows=n`` writes one file holding at
    most ``n`` rows, the first by ``order`` and in that order: the one-task
    write is only ever given a bounded input.  Without it every task writes
    its own part file (with ``order`` the parts are ranges of it)."""
    out = df if order is None else df.orderBy(*order)
    if single_file_rows is not None:
        # limit after a sort takes the top rows; the one task sorts them again,
        # so the file's order does not depend on how they arrive
        out = out.limit(single_file_rows).coalesce(1)
        out = out if order is None else out.sortWithinPartitions(*order)
    w = out.write.mode("overwrite").option("header", True).option("escape", '"').option("sep", sep)
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


def read_back_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows present on one side only (with multiplicity); empty when equal."""
    cols = expected.columns
    a = actual.select(*cols)
    left = expected.exceptAll(a).withColumn("_side", F.lit("missing"))
    right = a.exceptAll(expected).withColumn("_side", F.lit("unexpected"))
    return left.unionByName(right)


def with_batch_number(df: DataFrame, order: Sequence, size: int, out: str = "batch") -> DataFrame:
    """Consecutive batches of ``size`` rows in ``order`` (1-based), computed
    without a global single-partition window: sort (range partitions), then
    the position inside each partition plus the row count of all earlier
    partitions.  The sorted rows are written once with their partition and
    position, so both passes see the same numbers; the count table has one row
    per partition."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    numbered = written(df.orderBy(*cols).withColumns({
        "_pid": F.spark_partition_id(), "_mid": F.monotonically_increasing_id()}), "batches")
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    counts = numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    pos = numbered.join(offsets, "_pid").withColumn("_pos", F.col("_off") + local)
    return pos.withColumn(out, (F.floor(F.col("_pos") / size) + 1).cast("long")) \
        .drop("_pid", "_mid", "_off", "_pos")


def write_batches(df: DataFrame, order: Sequence, size: int, path: str,
                  partition_by_batch: bool = False) -> None:
    """JSON lines tagged with their batch number; each batch holds only its
    own rows.  ``partition_by_batch`` gives one folder per batch (fine for
    a few thousand batches, not for billions of rows)."""
    out = with_batch_number(df, order, size)
    w = out.write.mode("overwrite")
    if partition_by_batch:
        w = w.partitionBy("batch")
    w.json(path)
