"""Join helpers.

Broadcast policy: dimension tables whose size grows with the data (items,
links, users) get no broadcast hint.  Adaptive execution measures the real
size of each join side after its shuffle stage and turns the join into a
broadcast only when that measured size is under
``spark.sql.adaptive.autoBroadcastJoinThreshold``; otherwise the sort-merge
join stays (with skew splitting where both inputs are plain shuffles; see
:func:`salted_join` for the other case).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.session import setting, written


#: Size up to which a partition of a join's smaller side is hashed.
HASHED_PARTITION = "64MB"


def small_side_hashed(spark: SparkSession):
    """For statements that join much to little: adaptive execution measures the
    shuffled sides, and where each partition of the smaller one is little, it is hashed
    and the larger side is not sorted; otherwise the sort-merge join stays."""
    return setting(spark, "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", HASHED_PARTITION)


def orphans(fact: DataFrame, dim: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Fact rows whose key has no match in the dimension (left anti)."""
    keys = [key] if isinstance(key, str) else list(key)
    return fact.join(dim.select(*keys), keys, "left_anti")


def without_seen(candidates: DataFrame, seen: DataFrame,
                 keys: Sequence[str] = ("userId", "movieId")) -> DataFrame:
    """Candidate pairs minus the pairs already present in ``seen``."""
    keys = list(keys)
    return candidates.join(seen.select(*keys), keys, "left_anti")


def with_titles(recs: DataFrame, dim: DataFrame, key: str = "movieId",
                cols: Sequence[str] = ("title",)) -> DataFrame:
    """Recommendations with item attributes; unmatched rows kept."""
    return recs.join(dim.select(key, *cols), key, "left")


#: Tasks that one hot key's rows go to, and the share that makes a key hot.
SALTS, HOT_SHARE = 16, 500
SALT = "_salt"


def hot_keys(facts: DataFrame, key: str, share: int = HOT_SHARE) -> DataFrame:
    """Keys that hold more than one row in ``share``: exact counts, reduced
    before their shuffle.  There are fewer than ``share`` such keys whatever
    the data, so the written result may be broadcast."""
    counts = facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).scalar()
    return written(counts.where(F.col("_n") * share > total).select(key), "hot_keys")


def with_salt(facts: DataFrame, key: str, spread: Sequence[str], hot: DataFrame, salts: int = SALTS, out: str = SALT) -> DataFrame:
    """``facts`` with a salt: a hash of the ``spread`` columns for hot keys, 0 for all others."""
    flag = F.broadcast(hot.select(F.col(key).alias("_hot")))  # fewer than HOT_SHARE rows
    salt = F.when(F.col("_hot").isNotNull(), F.pmod(F.xxhash64(*spread), F.lit(salts))).otherwise(0).cast("int")
    return facts.join(flag, F.col(key) == F.col("_hot"), "left").withColumn(out, salt).drop("_hot")


def with_salts(dim: DataFrame, key: str, hot: DataFrame, salts: int = SALTS, out: str = SALT) -> DataFrame:
    """``dim`` with one row per salt of its key: ``salts`` for hot keys, one for all others."""
    flag = F.broadcast(hot.select(F.col(key).alias("_hot")))
    each = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return dim.join(flag, F.col(key) == F.col("_hot"), "left").withColumn(out, F.explode(each)).drop("_hot")


def salted_join(facts: DataFrame, dim: DataFrame, key: str, spread: Sequence[str], how: str = "inner",
                salts: int = SALTS, hot: DataFrame | None = None) -> DataFrame:
    """Join in which a hot key's fact rows go to up to ``salts`` tasks.

    For dimensions that come straight from an aggregate or another join: their
    rows already sit on the key's hash partitions, so adaptive execution has no
    shuffle to split there and a hot key would be one task.  Hot keys are found
    by a first pass over the key column (``hot``, if they are known); only
    their dimension rows are replicated, so the dimension grows by at most
    ``HOT_SHARE`` times ``salts`` rows.  Facts that carry a stored salt
    (:func:`reelhouse.sources.tables.write_bucketed`) are joined by it, without a shuffle of their own."""
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    stored = SALT in facts.columns
    if hot is None:
        if stored:
            hot = written(facts.where(F.col(SALT) > 0).select(key).distinct(), "hot_keys")
        else:
            facts = written(facts, "facts")  # read twice: for the counts, then for the join
            hot = hot_keys(facts, key)
    salted = facts if stored else with_salt(facts, key, spread, hot, salts)
    out = salted.join(with_salts(dim, key, hot, salts), [key, SALT], how)
    return out.select(*facts.columns, *(c for c in dim.columns if c != key)) if stored else out.drop(SALT)


def enrich_recs(recs: DataFrame, dim: DataFrame, key: str = "movieId",
                how: str = "inner", spread: Sequence[str] | None = None) -> DataFrame:
    """Recommendations joined to the enriched item dimension: ``left`` keeps
    every recommendation, ``inner`` only those with metadata.  ``spread``
    names the columns that salt the join when ``dim`` is not a plain table
    (popular items are the hot keys of a recommendation table)."""
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    return salted_join(recs, dim, key, spread, how) if spread else recs.join(dim, key, how)


def lookup_attrs(bounded: DataFrame, dim: DataFrame, key: str, cols: Sequence[str],
                 how: str = "left") -> DataFrame:
    """Attach dimension attributes to a result that is small by construction
    (the output of a top-k or a point lookup).

    The bounded result is written once; its keys filter the dimension in a
    semi join before the few matching rows are joined back.  No hint: Spark
    sees the written rows' size and picks the broadcast (the dimension then
    streams past unshuffled), or a shuffle if the result is larger than its
    threshold.  A plain ``bounded LEFT JOIN dim`` would have to build on the
    dimension side, i.e. shuffle or broadcast it whole.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    small = written(bounded, "lookup")
    attrs = dim.select(key, *cols).join(small.select(key).distinct(), key, "left_semi")
    return small.join(attrs, key, how).select(*bounded.columns, *cols)
