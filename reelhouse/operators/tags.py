"""Delimited tag lists: explode, count, mean, list-length distribution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.functions.strings import split_list


def explode_tags(df: DataFrame, c: str, sep: str, out: str = "tag") -> DataFrame:
    """One row per tag (rows with a NULL list produce none)."""
    return df.withColumn(out, F.explode(split_list(c, sep)))


def tag_counts(df: DataFrame, c: str, sep: str, out: str = "tag") -> DataFrame:
    """Number of rows carrying each tag."""
    return (explode_tags(df.select(c), c, sep, out)
            .groupBy(out).agg(F.count(F.lit(1)).alias("n")))


def tag_means(df: DataFrame, c: str, sep: str, value: str, out: str = "tag") -> DataFrame:
    """Mean of ``value`` per tag."""
    return (explode_tags(df.select(c, value), c, sep, out)
            .groupBy(out).agg(F.avg(value).alias(f"avg_{value}"),
                              F.count(F.lit(1)).alias("n")))


def tag_count_dist(df: DataFrame, c: str, sep: str) -> DataFrame:
    """How many rows have 1, 2, ... tags (NULL list -> not counted)."""
    sized = df.select(F.size(split_list(c, sep)).alias("tag_count"))
    return (sized.filter(F.col("tag_count").isNotNull())
            .groupBy("tag_count").agg(F.count(F.lit(1)).alias("n")))


def with_tag_count(df: DataFrame, c: str, sep: str, out: str = "tag_count") -> DataFrame:
    return df.withColumn(out, F.size(split_list(c, sep)))


def tag_means_by_key(fact: DataFrame, dim: DataFrame, key: str, c: str, sep: str, value: str,
                     out: str = "tag") -> DataFrame:
    """Mean of a fact ``value`` per tag of the fact's dimension row.

    The fact is first reduced to ``sum``/``count`` per ``key`` (a partial
    aggregate), so only one row per key meets the dimension and is
    exploded; the per-tag mean is ``sum(sums) / sum(counts)``; ``n`` counts
    rows, as in :func:`tag_means`.  Equal to
    joining every fact row to its tags, without multiplying the fact.
    """
    per_key = fact.groupBy(key).agg(F.sum(value).alias("_s"), F.count(value).alias("_n"),
                                      F.count(F.lit(1)).alias("_rows"))
    tagged = per_key.join(dim.select(key, c), key, "inner").select(
        "_s", "_n", "_rows", F.explode(split_list(c, sep)).alias(out))
    return tagged.groupBy(out).agg(F.try_divide(F.sum("_s"), F.sum("_n")).alias(f"avg_{value}"),
                                   F.sum("_rows").alias("n"))
