"""Bronze scrubs, deduplication and row filters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scrub_header_rows(df: DataFrame, key: str, keep_null_keys: bool = False) -> DataFrame:
    """Drop header lines repeated inside multi-part dumps (``key == 'key'``).

    By SQL three-valued logic the plain inequality also drops NULL keys;
    ``keep_null_keys=True`` keeps them.
    """
    cond = F.col(key) != F.lit(key)
    if keep_null_keys:
        cond = cond | F.col(key).isNull()
    return df.filter(cond)


def scrub_null_token(df: DataFrame, token: str = "\\N") -> DataFrame:
    """Replace the NULL sentinel in every column, in one projection."""
    return df.select([F.nullif(F.col(c), F.lit(token)).alias(c) for c in df.columns])


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order`` (compared left to right,
    all descending), remaining columns as a final tie-break.

    Runs as a partial + final aggregate of ``max(struct(order..., rest...))``
    (Spark executes a struct max as a sort-based aggregate, spilling as
    needed): the map side keeps one row per key before the shuffle, so a key
    holding a large share of all rows costs one row per input partition, not
    a sort of the whole group in one task.  NULL sorts lowest, so it only
    wins alone.
    """
    keys = list(keys)
    order = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      *[F.col(c) for c in rest])
    best = df.groupBy(*keys).agg(F.max(packed).alias("_best"))
    out = [F.col(k) for k in keys]
    out += [F.col(f"_best._o{i}").alias(c) for i, c in enumerate(order)]
    out += [F.col(f"_best.{c}").alias(c) for c in rest]
    return best.select(*out).select(*df.columns)


def drop_existing(df: DataFrame, *cols: str) -> DataFrame:
    """Drop columns if present (before a join that brings them back)."""
    return df.drop(*[c for c in cols if c in df.columns])


def not_future(c, as_of_year: int) -> Column:
    """Year column not after ``as_of_year`` (passed in, never the wall clock)."""
    col = F.col(c) if isinstance(c, str) else c
    return col <= F.lit(as_of_year)


def any_null(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def missing_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows where any of ``cols`` is NULL (metadata gaps)."""
    return df.filter(any_null(cols))
