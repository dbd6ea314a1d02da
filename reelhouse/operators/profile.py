"""Profiling, data quality and descriptive statistics.

Each profile is one aggregate job over the table (no job per column) and
returns a DataFrame, never printed values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.operators.aggregates import INTEGERS, distinct_of, two_level
from reelhouse.operators.joins import SALT, hot_keys, salted_join
from reelhouse.operators.ranking import top_k
from reelhouse.functions.strings import split_list
from reelhouse.session import written


def _long(df: DataFrame, per_col: dict, value_cols: Sequence[str]) -> DataFrame:
    """One aggregate row of ``struct`` per column, unpivoted to one row per column."""
    wide = df.agg(*[v.alias(k) for k, v in per_col.items()])
    longf = wide.unpivot([], list(per_col), "column_name", "_v")
    return longf.select("column_name", *[F.col(f"_v.{c}").alias(c) for c in value_cols])


def _comparable(c: str, dtype: str):
    """The column itself, or for a map (no order, no equality in
    aggregates) its sorted entry list: an exact, orderable proxy."""
    return F.array_sort(F.map_entries(F.col(c))) if dtype.startswith("map") else F.col(c)


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column: (column_name, missing)."""
    per = {c: F.struct(F.count_if(F.col(c).isNull()).alias("missing")) for c in df.columns}
    return _long(df, per, ["missing"])


def _unique(df: DataFrame) -> tuple[DataFrame, dict]:
    """The table, written if it is read again, and the exact distinct count per
    column: scalars from bitmaps for integer columns (see :func:`distinct_of`), the
    others in the one aggregate."""
    types = dict(df.dtypes)
    whole = [c for c, t in df.dtypes if t in INTEGERS]
    if whole:
        df = written(df, "profile")
    scalars = distinct_of(df, whole)
    return df, {c: scalars.get(c, F.count_distinct(_comparable(c, types[c]))) for c in df.columns}


def distinct_counts(df: DataFrame) -> DataFrame:
    """Exact distinct non-NULL values per column: (column_name, unique_values)."""
    df, unique = _unique(df)
    per = {c: F.struct(u.alias("unique_values")) for c, u in unique.items()}
    return _long(df, per, ["unique_values"])


def profile(df: DataFrame) -> DataFrame:
    """Type, missing count, distinct count and a sample (the minimum, so the
    result does not depend on row order) per column."""
    types = dict(df.dtypes)
    df, unique = _unique(df)
    per = {c: F.struct(F.lit(types[c]).alias("dtype"),
                       F.count_if(F.col(c).isNull()).alias("missing_values"),
                       unique[c].alias("unique_values"),
                       F.min(_comparable(c, types[c])).cast("string").alias("sample_value"))
           for c in df.columns}
    return _long(df, per, ["dtype", "missing_values", "unique_values", "sample_value"])


def per_key_counts(ratings: DataFrame, key: str = "userId") -> DataFrame:
    return ratings.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def sparsity(ratings: DataFrame, items: DataFrame, user: str = "userId",
             item: str = "movieId") -> DataFrame:
    """``1 - ratings / (users in ratings x items in the item table)``; NULL
    when there is no user or no item."""
    n_items = items.select(F.count_distinct(item)).scalar()
    return ratings.agg(
        (F.lit(1.0) - F.try_divide(F.count(F.lit(1)), F.count_distinct(user) * n_items)).alias("sparsity"),
        F.count(F.lit(1)).alias("ratings"), F.count_distinct(user).alias("users"),
        n_items.alias("items"))


def top_user(ratings: DataFrame, user: str = "userId") -> DataFrame:
    """The most active user (lowest id among equals), one row."""
    c = per_key_counts(ratings, user)
    return top_k(c, [F.col("n").desc(), F.col(user).asc()], 1)


def user_vs_global(ratings: DataFrame, user_id=None, user: str = "userId",
                   rating: str = "rating") -> DataFrame:
    """Average of one user (default: the most active) next to the global one."""
    uid = top_user(ratings, user).select(user).scalar() if user_id is None else F.lit(user_id)
    return ratings.agg(
        F.any_value(uid).alias(user),
        F.avg(rating).alias("global_avg"),
        F.avg(F.when(F.col(user) == uid, F.col(rating))).alias("user_avg"),
    ).withColumn("difference", F.col("user_avg") - F.col("global_avg"))


def top_gap(ratings: DataFrame, user: str = "userId") -> DataFrame:
    """The two most active users, their gap and percent gap."""
    c = per_key_counts(ratings, user)
    two = top_k(c, [F.col("n").desc(), F.col(user).asc()], 2)
    key = F.struct(F.col("n"), -F.col(user))
    out = two.agg(F.max_by(F.col(user), key).alias("top_user"),
                  F.max("n").alias("top_count"),
                  F.min_by(F.col(user), key).alias("second_user"),
                  F.min("n").alias("second_count"))
    return out.withColumns({
        "difference": F.col("top_count") - F.col("second_count"),
        "percent_diff": F.try_divide((F.col("top_count") - F.col("second_count")) * 100.0,
                                     F.col("second_count"))})


def count_zscore(ratings: DataFrame, user: str = "userId") -> DataFrame:
    """z-score of the top user's count among per-user counts (sample std)."""
    c = per_key_counts(ratings, user)
    return c.agg(F.max("n").alias("top_count"), F.avg("n").alias("mean_count"),
                 F.stddev_samp("n").alias("std_count")).withColumn(
        "z_score", F.try_divide(F.col("top_count") - F.col("mean_count"), F.col("std_count")))


def centre_ratings(ratings: DataFrame, key: str = "userId", rating: str = "rating",
                   out: str = "normalized_rating", spread: Sequence[str] | None = None) -> DataFrame:
    """Rating minus the key's mean rating.  Mean per key is a partial/final
    aggregate joined back on the key (no window buffering a whole group); the
    join is salted for hot keys by the other columns (or ``spread``), because an aggregate's
    side cannot be split when one key holds very many ratings."""
    if SALT not in ratings.columns:
        ratings = written(ratings, "ratings")  # read for the means, the hot keys and the join
        hot = hot_keys(ratings, key)
    else:
        hot = None
    means = two_level(ratings, key, {"_mean": ("avg", rating)})
    spread = spread or [c for c in ratings.columns if c not in (key, rating)]
    return salted_join(ratings, means, key, spread, hot=hot).withColumn(out, F.col(rating) - F.col("_mean")) \
        .select(*(c for c in ratings.columns if c != SALT), out)


def histogram(df: DataFrame, c: str, bins: int) -> DataFrame:
    """Equal-width histogram over [min, max]; the maximum falls in the last
    bin; empty bins are reported with count 0.  Edges come from scalar
    subqueries; the value side is one aggregate by bin."""
    vals = df.select(F.col(c).cast("double").alias("x")).filter(F.col("x").isNotNull())
    edges = vals.select(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar()
    lo, hi = edges["lo"], edges["hi"]
    width = (hi - lo) / F.lit(float(bins))
    idx = F.least(F.coalesce(F.floor(F.try_divide((F.col("x") - lo) * bins, hi - lo)), F.lit(0)),
                  F.lit(bins - 1)).cast("int")
    counts = vals.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (grid.join(counts, "bin", "left")
            .select("bin", (lo + F.col("bin") * width).alias("lower"),
                    (lo + (F.col("bin") + 1) * width).alias("upper"),
                    F.coalesce("n", F.lit(0)).alias("count")))


def user_tag_profile(ratings: DataFrame, items: DataFrame, tags_col: str, sep: str,
                     user_id=None, user: str = "userId", item: str = "movieId",
                     rating: str = "rating") -> DataFrame:
    """Tags of one user's rated items (default: most active user): count and
    mean rating per tag."""
    uid = top_user(ratings, user).select(user).scalar() if user_id is None else F.lit(user_id)
    mine = ratings.filter(F.col(user) == uid).join(items.select(item, tags_col), item, "left")
    ex = mine.select(rating, F.explode(split_list(tags_col, sep)).alias("tag"))
    return ex.groupBy("tag").agg(F.count(F.lit(1)).alias("n"), F.avg(rating).alias("avg_rating"))
