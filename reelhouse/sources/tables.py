"""Layer tables (bronze/silver/gold) in the session catalog.

The storage format is a parameter: ``delta`` where the Delta package is on
the classpath, ``parquet`` otherwise.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.operators.clean import dedup_latest
from reelhouse.operators.joins import SALT, hot_keys, small_side_hashed, with_salt
from reelhouse.session import setting, written


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> str:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")
    return name


def write_layer(df: DataFrame, name: str, fmt: str = "parquet",
                partition_by: Sequence[str] | None = None, recreate: bool = False,
                evolve: bool = False, repartition_by_partition: bool = True,
                bucket_by: tuple[int, Sequence[str]] | None = None) -> None:
    """Overwrite a managed layer table.

    ``recreate`` drops the table first (schema and properties start over).
    ``evolve`` is additive: columns the stored table has and ``df`` lacks are
    kept, as typed NULLs, after the new ones (Delta merges by itself; for
    other formats the overwrite would lose them).  With ``partition_by`` the rows are clustered by the
    partition columns through a REBALANCE hint: adaptive execution then
    groups small partition values into few files and splits a hot value
    (one day holding a large share of all rows) over several writer tasks,
    where a plain ``repartition(col)`` would hand it to a single task.

    ``bucket_by=(n, columns)`` stores ``n`` buckets sorted by the columns: aggregates,
    windows and joins on these columns then read the table without a shuffle.
    The writer tasks are clustered by bucket in the same way, so a hot bucket
    is several files, each sorted.
    """
    spark = df.sparkSession
    if recreate:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    out = df
    if evolve and fmt != "delta" and spark.catalog.tableExists(name):
        kept = [f for f in spark.table(name).schema.fields if f.name not in df.columns]
        out = df.select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in kept))
    if bucket_by:
        # the bucket of a row as Spark's writer numbers it
        bucket = F.pmod(F.hash(*bucket_by[1]), F.lit(bucket_by[0]))
        spread = bucket_number_name(out.columns)
        out = out.withColumn(spread, bucket).hint("rebalance", *(partition_by or ()), spread).drop(spread)
    elif partition_by and repartition_by_partition:
        out = out.hint("rebalance", *partition_by)
    w = out.write.format(fmt).mode("overwrite")
    if evolve and fmt == "delta":
        w = w.option("mergeSchema", "true")
    elif fmt == "delta":
        w = w.option("overwriteSchema", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        w = w.bucketBy(bucket_by[0], *bucket_by[1]).sortBy(*bucket_by[1])
    # Partitions are found in the table's folder, not kept by the catalog, so
    # one change of the table's location changes all of them.
    with setting(spark, "spark.sql.hive.manageFilesourcePartitions", "false"):
        w.saveAsTable(name)


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, spread: Sequence[str], fmt: str = "parquet") -> None:
    """Store a fact in ``buckets`` buckets of ``key``, so what groups or joins
    by the key reads it without a shuffle of the fact.

    Rows of hot keys (:func:`reelhouse.operators.joins.hot_keys`) carry a salt, a hash of the
    ``spread`` columns, and are dealt over several buckets; all other rows have
    salt 0.  Operators that know the salt column (``user_dim``, ``item_stats``,
    ``centre_ratings``, ``enrich_recs``) use (key, salt)."""
    df = written(df, "bucketed")
    salted = with_salt(df, key, spread, hot_keys(df, key))
    write_layer(salted, name, fmt=fmt, bucket_by=(buckets, [key, SALT]))


def bucket_number_name(taken: Sequence[str]) -> str:
    name = "_bucket"
    while name in taken:
        name += "_"
    return name


# ------------------------------------------------------ changes in place --
# A change of a table is first written whole to a stage table beside it.  The
# stage's properties are the manifest of the change: once they say "complete", the
# change is decided and recover() finishes it; before that recover() undoes it.
_STATE, _MANIFEST = "reelhouse.change", "reelhouse.manifest"
_CARRIED = ("transient_", "spark.", "option.", "numFiles", "totalSize", "reelhouse.")


class PendingChange(RuntimeError):
    """An earlier change of the table did not end: call :func:`recover`."""


def _split(name: str) -> tuple[str, str]:
    db, _, base = name.rpartition(".")
    return (f"{db}." if db else ""), base


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def _set_properties(spark: SparkSession, name: str, properties: Mapping[str, str]) -> None:
    quoted = lambda x: "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if properties:
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({', '.join(f'{quoted(k)} = {quoted(v)}' for k, v in properties.items())})")


def table_location(spark: SparkSession, name: str) -> str:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]


def _provider(spark: SparkSession, name: str) -> bool:
    """Whether the catalog keeps the table's partitions (then they have places of their own)."""
    return not spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Partition Provider' and data_type = 'Catalog'").isEmpty()


def _layout(spark: SparkSession, name: str) -> tuple[list[str], tuple[int, list[str]] | None]:
    """(partition columns, buckets) of a table."""
    cols = spark.catalog.listColumns(name)
    count = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Num Buckets'").first()
    buckets = [c.name for c in cols if c.isBucket]
    return [c.name for c in cols if c.isPartition], (int(count["data_type"]), buckets) if buckets and count else None


def _stages(spark: SparkSession, name: str) -> list[str]:
    """Stage tables of ``name``."""
    db, base = _split(name)
    found = spark.sql(f"SHOW TABLES{' IN ' + db[:-1] if db else ''}").select("tableName").collect()
    return sorted(f"{db}{r[0]}" for r in found if r[0].startswith(f"{base.lower()}__change_"))


def _stage(df: DataFrame, name: str, fmt: str) -> str:
    """``df`` written whole to a new stage table with the layout of ``name``."""
    spark = df.sparkSession
    if _stages(spark, name):
        raise PendingChange(f"{name} has a change that did not end: recover('{name}') first")
    db, base = _split(name)
    stage = f"{db}{base.lower()}__change_{uuid.uuid4().hex[:8]}"
    parts, buckets = _layout(spark, name)
    write_layer(df, stage, fmt=fmt, partition_by=parts or None, bucket_by=buckets)
    return stage


def _commit(spark: SparkSession, name: str, stage: str, kind: str, cleared: Sequence[Mapping] = ()) -> None:
    """Decide the change: one update of the stage's properties."""
    manifest = {"kind": kind, "old": table_location(spark, name), "new": table_location(spark, stage), "cleared": list(cleared)}
    carried = {k: v for k, v in _properties(spark, name).items() if not k.startswith(_CARRIED)}
    _set_properties(spark, stage, {**carried, _STATE: "complete", _MANIFEST: json.dumps(manifest)})


def _swappable(spark: SparkSession, name: str, stage: str) -> bool:
    """Whether the table can point to the stage's files: its partitions are found by
    folder and it has all columns of the stage, or can add them."""
    if _provider(spark, name):
        return False
    if _layout(spark, name) != _layout(spark, stage):
        return False
    old, new = spark.table(name).schema, spark.table(stage).schema
    types = {f.name: f.dataType for f in new}
    return all(types.get(f.name) == f.dataType for f in old)


def _point(spark: SparkSession, name: str, stage: str, manifest: dict) -> None:
    """Let the table point to the stage's files: one update of its location.
    Columns that only the stage has are added before (null in the old files)."""
    have = spark.table(name).columns
    more = [f for f in spark.table(stage).schema if f.name not in have]
    if more:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in more)})")
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{manifest['new']}'")
    spark.catalog.refreshTable(name)


def _retire(spark: SparkSession, stage: str, manifest: dict) -> None:
    """Hand the old files to the stage and drop it with them."""
    spark.sql(f"ALTER TABLE {stage} SET LOCATION '{manifest['old']}'")
    spark.sql(f"DROP TABLE {stage}")


def _replace(spark: SparkSession, name: str, stage: str) -> None:
    """Put the stage in the table's place (its columns or kind differ)."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {stage} RENAME TO {name}")
    spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES IF EXISTS ('{_STATE}', '{_MANIFEST}')")


def _literal(value) -> str:
    return "NULL" if value is None else str(value) if isinstance(value, (int, float)) else "'" + str(value).replace("'", "\\'") + "'"


def _clear_partitions(spark: SparkSession, name: str, cleared: Sequence[Mapping]) -> None:
    """Empty the given partitions."""
    parts, _ = _layout(spark, name)
    if not cleared:
        return
    view = f"_none_{uuid.uuid4().hex[:8]}"
    spark.createDataFrame([], T.StructType([f for f in spark.table(name).schema if f.name not in parts])).createOrReplaceTempView(view)
    for values in cleared:
        spec = ", ".join(f"`{c}` = {_literal(values[c])}" for c in parts)
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({spec}) SELECT * FROM {view}")
    spark.catalog.dropTempView(view)


def _put_partitions(spark: SparkSession, name: str, stage: str) -> None:
    """Overwrite just the partitions that the stage holds."""
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        spark.table(stage).select(*spark.table(name).columns).write.mode("overwrite").insertInto(name)
    spark.catalog.refreshTable(name)


def _finish(spark: SparkSession, name: str, stage: str) -> None:
    """Carry out a decided change.  Every step may be repeated."""
    manifest = json.loads(_properties(spark, stage)[_MANIFEST])
    if manifest["kind"] == "partitions":
        _clear_partitions(spark, name, manifest["cleared"])
        _put_partitions(spark, name, stage)
        spark.sql(f"DROP TABLE {stage}")
    elif manifest["kind"] == "swap":
        _point(spark, name, stage, manifest)
        _retire(spark, stage, manifest)
    else:
        _replace(spark, name, stage)


def recover(spark: SparkSession, name: str) -> str:
    """End a change of ``name`` that was broken off: ``finished`` if it was
    decided, ``undone`` if not, ``none`` if there is none."""
    out = "none"
    for stage in _stages(spark, name):
        if _properties(spark, stage).get(_STATE) == "complete":
            _finish(spark, name, stage)
            out = "finished"
        else:
            spark.sql(f"DROP TABLE {stage}")
            out = "undone"
    if spark.catalog.tableExists(name) and _STATE in _properties(spark, name):
        # broken off between the rename and the last step of a replacement
        spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES IF EXISTS ('{_STATE}', '{_MANIFEST}')")
        out = "finished"
    return out


def rewrite_table(spark: SparkSession, name: str, fn: Callable[[DataFrame], DataFrame],
                  fmt: str = "parquet") -> None:
    """Replace a table by a function of itself (e.g. add a column).

    The result is written whole to a stage table with the same partitions and
    buckets; then its manifest decides the change; then the table's location
    moves to the stage's files in one catalog update, so a reader sees the old rows or the
    new ones, never none; then the old files are dropped.  Where a table cannot be
    pointed elsewhere (columns dropped or changed, partitions kept by the
    catalog), the stage takes its name instead.  After a failure anywhere
    :func:`recover` gives the old rows or the new.  Properties are kept.
    """
    stage = _stage(fn(spark.table(name)), name, fmt)
    _commit(spark, name, stage, "swap" if _swappable(spark, name, stage) else "replace")
    _finish(spark, name, stage)


def overwrite_partitions(df: DataFrame, name: str, fmt: str = "parquet", also: DataFrame | None = None) -> None:
    """Replace exactly the partitions of ``name`` that ``df`` has rows for;
    the files of all others stay as they are.  ``df`` may read the table.
    ``also`` names further partitions by their values: those without a row in ``df``
    become empty.  Columns that the table lacks are added to it.  Where no other
    partition is left, the table moves to the new files as in :func:`rewrite_table`."""
    spark = df.sparkSession
    parts, _ = _layout(spark, name)
    if not parts:
        raise ValueError(f"{name} has no partitions")
    have = spark.table(name).columns
    more = [f for f in df.schema if f.name not in have]
    if more:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in more)})")
    missing = [f for f in spark.table(name).schema if f.name not in df.columns]
    df = df.select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in missing))
    stage = _stage(df.select(*spark.table(name).columns), name, fmt)
    cleared = []
    if also is not None:
        gone = also.select(*parts).distinct().exceptAll(spark.table(stage).select(*parts).distinct())
        cleared = [{c: v if v is None or isinstance(v, (int, float)) else str(v) for c, v in r.asDict().items()} for r in gone.collect()]
    whole = _all_replaced(spark, name, stage, parts, also) and _swappable(spark, name, stage)
    _commit(spark, name, stage, "swap" if whole else "partitions", [] if whole else cleared)
    _finish(spark, name, stage)


def _all_replaced(spark: SparkSession, name: str, stage: str, parts: Sequence[str], also: DataFrame | None) -> bool:
    """Whether a change of partitions leaves no other partition: the stage
    is then the new table and its rows need not be written again."""
    stays = spark.table(name).select(*parts).distinct().exceptAll(spark.table(stage).select(*parts).distinct())
    return (stays if also is None else stays.exceptAll(also.select(*parts).distinct())).isEmpty()


def touched(table: DataFrame, rows: DataFrame, parts: Sequence[str]) -> DataFrame:
    """The rows of ``table`` in partitions that ``rows`` falls into.  The partition
    values (as many as partitions are touched) become literals of the filter, so
    the scan lists and reads no other folder."""
    values = [tuple(r) for r in rows.select(*parts).distinct().collect()]
    if len(parts) == 1:
        plain, col = [v for v, in values if v is not None], F.col(parts[0])
        hit = col.isin(plain) if plain else F.lit(False)
        return table.where(hit | col.isNull() if len(plain) < len(values) else hit)
    hit = F.lit(False)
    for value in values:
        hit = hit | reduce(and_, (F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(parts, value)))
    return table.where(hit)


def merge_late(late: DataFrame, name: str, keys: Sequence[str], order: Sequence[str], fmt: str = "parquet") -> None:
    """Merge late rows into a partitioned table: the touched partitions are
    read, deduplicated with the late rows (latest per key by ``order``) and
    overwritten; the rest is neither read nor written.  A key's rows must lie in one
    partition (partition by the key, or by what a key never changes)."""
    spark = late.sparkSession
    parts, _ = _layout(spark, name)
    late = written(late, "late")
    both = touched(spark.table(name), late, parts).unionByName(late, allowMissingColumns=True)
    overwrite_partitions(dedup_latest(both, list(dict.fromkeys([*parts, *keys])), list(order)), name, fmt)


def with_key_bucket(df: DataFrame, keys: Sequence[str], buckets: int, out: str = "key_bucket") -> DataFrame:
    """The change bucket of a row's key: equal keys, equal bucket."""
    return df.withColumn(out, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def merge_wave(wave: DataFrame, name: str, keys: Sequence[str], order: Sequence[str], buckets: int = 64,
               fmt: str = "parquet", latest: bool = False) -> None:
    """Merge a wave of rows into a table that holds the latest row per key,
    partitioned by key bucket: only the buckets the wave falls into are read
    and rewritten.  The first wave creates the table.  A wave that comes
    twice changes nothing.  Choose ``buckets`` so that a usual wave touches few of them.

    ``latest``: the wave holds one row per key already.  So does the table, so its rows
    are joined to the wave's and not deduplicated again."""
    spark = wave.sparkSession
    wave = with_key_bucket(wave if latest else dedup_latest(wave, list(keys), list(order)), keys, buckets)
    if not spark.catalog.tableExists(name):
        write_layer(wave, name, fmt=fmt, partition_by=["key_bucket"])
        _set_properties(spark, name, {"key_buckets": str(buckets)})
        return
    if int(_properties(spark, name)["key_buckets"]) != buckets:
        raise ValueError(f"{name} has {_properties(spark, name)['key_buckets']} key buckets, not {buckets}")
    late = written(wave, "late")
    with small_side_hashed(spark):
        overwrite_partitions(_later(touched(spark.table(name), late, ["key_bucket"]), late, ["key_bucket", *keys], order), name, fmt)


def _later(rows: DataFrame, late: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """What ``dedup_latest`` gives for both together, if each has one row per key."""
    both = rows.limit(0).unionByName(late.limit(0), allowMissingColumns=True).schema
    first = [c for c in order if c not in keys]
    rest = [f.name for f in both if f.name not in keys and f.name not in first]

    def packed(df, prefix):
        cells = [(F.col(f"`{c}`") if c in df.columns else F.lit(None)).cast(both[c].dataType).alias(c) for c in [*first, *rest]]
        return df.select(*(F.col(k).alias(f"{prefix}{k}") for k in keys), F.struct(*cells).alias(f"{prefix}row"))

    same = reduce(and_, (F.col(f"_a_{k}").eqNullSafe(F.col(f"_b_{k}")) for k in keys))
    met = packed(rows, "_a_").join(packed(late, "_b_"), same, "full_outer")
    met = met.select(*(F.coalesce(f"_a_{k}", f"_b_{k}").alias(k) for k in keys), F.greatest("_a_row", "_b_row").alias("_row"))
    return met.select(*(F.col(f.name) if f.name in keys else F.col(f"_row.{f.name}").alias(f.name) for f in both))


def append_run(run: DataFrame, name: str, run_at: str, key: str = "run_id", fmt: str = "parquet") -> None:
    """Append one run's rows to a log table that keeps all runs.

    ``run_at`` is the run's time ('YYYY-MM-DD HH:MM:SS', UTC).  The log is
    partitioned by run id and time, and a commit replaces exactly that partition: repeating
    it (a retry, a rerun of the same step) leaves one copy, other runs are never
    touched."""
    spark = run.sparkSession
    at = F.to_timestamp(F.lit(run_at), "yyyy-MM-dd HH:mm:ss")
    rows = run.withColumn("run_at", at).withColumn("run_key", F.concat_ws("@", F.col(key).cast("string"), F.lit(run_at)))
    if spark.catalog.tableExists(name):
        overwrite_partitions(rows, name, fmt)
    else:
        write_layer(rows, name, fmt=fmt, partition_by=["run_key"])


GRAINS = ("day", "month", "year")


def with_date_partition(df: DataFrame, date_col: str, grain: str = "day") -> tuple[DataFrame, str]:
    """Add the partition column for a date at the chosen grain.

    ``day`` partitions by the date itself; ``month`` / ``year`` add
    ``<date_col>_month`` / ``<date_col>_year`` (first day of the period).
    Pick the grain so a partition holds a sizeable file: one day is right
    when a day holds gigabytes, a month when a day holds a few rows.
    Returns the frame and the partition column name.
    """
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    if grain == "day":
        return df, date_col
    name = f"{date_col}_{grain}"
    return df.withColumn(name, F.trunc(F.col(date_col), "MM" if grain == "month" else "YYYY")), name


def date_range_filter(date_col: str, start: str, end: str, grain: str = "day"):
    """Predicate for ``start <= date <= end`` that also names the partition
    column of the grain, so the read prunes partitions at any grain."""
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    cond = F.col(date_col).between(lo, hi)
    if grain != "day":
        unit = "MM" if grain == "month" else "YYYY"
        cond = cond & F.col(f"{date_col}_{grain}").between(F.trunc(lo, unit), F.trunc(hi, unit))
    return cond
