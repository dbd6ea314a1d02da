"""Catalog reports: tables of a layer, columns, locations, row counts.

Listing tables is catalog metadata (one small driver call); everything that
touches data runs as one Spark job over the union of the tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.session import setting


def layer_tables(spark: SparkSession, prefix: str = "", database: str | None = None,
                 managed: bool = False) -> DataFrame:
    """Tables whose name starts with ``prefix`` (all when empty); with
    ``managed=True`` only managed, non-temporary ones."""
    rows = [(t.name, t.database, t.tableType, bool(t.isTemporary))
            for t in spark.catalog.listTables(database)
            if t.name.startswith(prefix)
            and (not managed or (t.tableType == "MANAGED" and not t.isTemporary))]
    return spark.createDataFrame(
        rows, "table_name string, database string, tableType string, isTemporary boolean")


def _names(spark, prefix, database, managed):
    return sorted(r.table_name for r in layer_tables(spark, prefix, database, managed).collect())


def _qual(database, name):
    return f"{database}.{name}" if database else name


def table_columns(spark: SparkSession, name: str) -> DataFrame:
    """Column names and types of one table (DESCRIBE)."""
    d = spark.sql(f"DESCRIBE TABLE {name}")
    return d.filter(~F.col("col_name").startswith("#") & (F.col("col_name") != "")) \
        .select("col_name", "data_type").dropDuplicates(["col_name"])


def table_locations(spark: SparkSession, prefix: str, database: str | None = None) -> DataFrame:
    """Storage location per table (DESCRIBE TABLE EXTENDED)."""
    rows = []
    for n in _names(spark, prefix, database, True):
        q = _qual(database, n)
        loc = (spark.sql(f"DESCRIBE TABLE EXTENDED {q}").filter(F.col("col_name") == "Location")
               .select("data_type").first())
        rows.append((n, loc[0] if loc else None))
    return spark.createDataFrame(rows, "table_name string, location string")


def row_count(spark: SparkSession, name: str) -> DataFrame:
    """One row, ``row_count``, of a table.  A Parquet table is opened by the
    DataSource V2 reader, which answers count(*) from the file footers
    (``PushedAggregation`` in the plan): no column is read and no row built.
    Other formats are counted by a scan."""
    info = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(
        "col_name in ('Provider', 'Location', 'Type', 'Partition Provider')").collect()}
    table = spark.table(name)
    if info.get("Provider") != "parquet" or info.get("Type") == "VIEW" or info.get("Partition Provider") == "Catalog":
        return table.agg(F.count(F.lit(1)).alias("row_count"))
    with setting(spark, "spark.sql.sources.useV1SourceList", ""):
        files = spark.read.schema(table.schema).parquet(info["Location"])
    # a folder without files has no footers: its count comes as NULL
    return files.agg(F.count("*").alias("row_count")).select(F.coalesce(F.nullif("row_count", F.lit(-1)), F.lit(0)).alias("row_count"))


def table_counts(spark: SparkSession, prefix: str, database: str | None = None) -> DataFrame:
    """Row count per table: one job over the union of per-table counts."""
    return table_report(spark, prefix, database).select("table_name", "row_count")


def table_report(spark: SparkSession, prefix: str, database: str | None = None,
                 managed: bool = False) -> DataFrame:
    """table name, row count and column list of every table of a layer."""
    parts = []
    for n in _names(spark, prefix, database, managed):
        df = spark.table(_qual(database, n))
        cols = F.array(*[F.lit(c) for c in df.columns])
        parts.append(row_count(spark, _qual(database, n))
                     .select(F.lit(n).alias("table_name"), "row_count", cols.alias("columns")))
    if not parts:
        return spark.createDataFrame([], "table_name string, row_count bigint, columns array<string>")
    return reduce(DataFrame.unionByName, parts)
