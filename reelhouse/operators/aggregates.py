"""Grouped and global aggregates (partial + final hash aggregates)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.operators.ranking import top_k
from reelhouse.session import written


def two_level(df: DataFrame, key: str, aggs: dict[str, tuple[str, str]]) -> DataFrame:
    """``count`` and ``avg`` aggregates per key: {output: (kind, column)}.

    A table stored with a salt beside its key (``tables.write_bucketed``) is
    aggregated per (key, salt) where it lies, without a shuffle, and the few rows that
    come out are combined per key; any other table is one ordinary aggregate."""
    if "_salt" not in df.columns:
        plain = {"count": F.count, "avg": F.avg}
        return df.groupBy(key).agg(*(plain[kind](c).alias(out) for out, (kind, c) in aggs.items()))
    parts = []
    for out, (kind, c) in aggs.items():
        parts.append(F.count(c).alias(f"_n_{out}"))
        if kind == "avg":
            parts.append(F.sum(F.col(c).cast("double")).alias(f"_s_{out}"))
    some = df.groupBy(key, "_salt").agg(*parts)
    return some.groupBy(key).agg(*(
        F.sum(f"_n_{out}").alias(out) if kind == "count" else F.try_divide(F.sum(f"_s_{out}"), F.sum(f"_n_{out}")).alias(out)
        for out, (kind, c) in aggs.items()))


def user_dim(ratings: DataFrame, user: str = "userId", item: str = "movieId",
             rating: str = "rating") -> DataFrame:
    """User dimension: number of ratings and average rating per user."""
    return two_level(ratings, user, {"num_ratings": ("count", item), "avg_rating": ("avg", rating)})


def item_stats(ratings: DataFrame, item: str = "movieId", rating: str = "rating") -> DataFrame:
    """Average rating and number of ratings per item."""
    return two_level(ratings, item, {"avg_rating": ("avg", rating), "num_ratings": ("count", rating)})


def top_items(ratings: DataFrame, items: DataFrame, min_count: int, n: int,
              item: str = "movieId", rating: str = "rating",
              title: str = "title") -> DataFrame:
    """Leaderboard: best average among items with at least ``min_count``
    ratings, with titles (items without a title do not compete)."""
    stats = item_stats(ratings, item, rating).filter(F.col("num_ratings") >= min_count)
    named = stats.join(items.select(item, title), item, "inner")
    return top_k(named, [F.col("avg_rating").desc(), F.col("num_ratings").desc(),
                         F.col(item).asc()], n)


def power_users(ratings: DataFrame, user: str = "userId") -> DataFrame:
    """Rows per user, most active first."""
    return (ratings.groupBy(user).agg(F.count(F.lit(1)).alias("rating_count"))
            .orderBy(F.col("rating_count").desc(), F.col(user).asc()))


def rec_popularity(recs: DataFrame, by: Sequence[str] = ("movieId",)) -> DataFrame:
    """How often each item was recommended."""
    return recs.groupBy(*by).agg(F.count(F.lit(1)).alias("recommendation_count"))


INTEGERS = ("tinyint", "smallint", "int", "bigint")
#: Values of one bitmap of Spark's bitmap functions, and its bytes.
BITMAP_VALUES, BITMAP_BYTES = 32768, 4096


def _bitmap_distinct(df: DataFrame, c: str) -> DataFrame:
    """One row: distinct values of an integer column, by one bitmap per bucket
    of 32,768 neighbouring values; bitmaps are or-ed before and after the shuffle."""
    bits = df.where(F.col(c).isNotNull()).select(F.bitmap_bucket_number(F.col(c).cast("long")).alias("bucket"),
                                                 F.bitmap_bit_position(F.col(c).cast("long")).alias("bit"))
    maps = bits.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    return maps.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("n"))


def distinct_of(df: DataFrame, cols: Sequence[str]) -> dict:
    """Exact distinct counts of integer columns, each a scalar of its own scan of
    one column, so no row is multiplied by the number of columns.

    Dense columns (ids) are counted by bitmaps: a bit per value is shuffled,
    not a row.  Where values lie so far apart that bitmaps would be larger
    than the values (random 64-bit keys), the values themselves are deduplicated.
    Both are exact.  ``df`` is read several times: give a written table."""
    if not cols:
        return {}
    edges = df.agg(*(F.struct(F.min(c).alias("lo"), F.max(c).alias("hi"), F.count(c).alias("n")).alias(c) for c in cols)).first()
    out = {}
    for c in cols:
        e = edges[c]
        dense = not e["n"] or ((e["hi"] - e["lo"]) // BITMAP_VALUES + 2) * BITMAP_BYTES <= max(8 * e["n"], 1 << 20)
        one = _bitmap_distinct(df, c) if dense else df.where(F.col(c).isNotNull()).select(c).distinct().agg(F.count(F.lit(1)).alias("n"))
        out[c] = F.coalesce(F.any_value(one.scalar()), F.lit(0))
    return out


def cardinalities(df: DataFrame, cols: Sequence[str], with_rows: bool = True) -> DataFrame:
    """Exact distinct counts of several columns (and the row count)."""
    types = dict(df.dtypes)
    whole = [c for c in cols if types[c] in INTEGERS]
    if whole:
        df = written(df.select(*dict.fromkeys(cols)), "cardinalities")
    scalars = distinct_of(df, whole)
    aggs = [scalars.get(c, F.count_distinct(c)).alias(f"distinct_{c}") for c in cols]
    if with_rows:
        aggs.append(F.count(F.lit(1)).alias("row_count"))
    return df.agg(*aggs)


def count_spread(df: DataFrame, key: str) -> DataFrame:
    """Average, minimum and maximum number of rows per ``key``."""
    per = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.avg("n").alias("avg_per_key"), F.min("n").alias("min_per_key"),
                   F.max("n").alias("max_per_key"), F.count(F.lit(1)).alias("keys"))


def value_counts(df: DataFrame, c: str, name: str = "n") -> DataFrame:
    """Frequency of each value of ``c`` (NULL is not a value)."""
    return df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias(name))


def collect_names(df: DataFrame, key: str, name: str, out: str) -> DataFrame:
    """Names per key as a sorted list (NULL names dropped).  Use only where
    the group is bounded by construction (e.g. the split of one row)."""
    return df.groupBy(key).agg(F.sort_array(F.collect_list(name)).alias(out))
