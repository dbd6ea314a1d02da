"""Sorts, global top-k, top-n per group and best row per key.

Every ranking ends in a unique key so results never depend on the row
layout (row_number ties are otherwise arbitrary).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def top_k(df: DataFrame, order: Sequence, k: int) -> DataFrame:
    """Global top-k: plans as TakeOrderedAndProject (k rows per partition,
    then a k-row merge), never a full sort."""
    return df.orderBy(*_cols(order)).limit(k)


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence, n: int,
                    rank_col: str | None = None) -> DataFrame:
    """First ``n`` rows per group under ``order`` (``row_number <= n``).

    The filter sits directly on ``row_number``, so Catalyst inserts a
    WindowGroupLimit before the shuffle: each map partition forwards at most
    ``n`` rows per group, which bounds a hot group's shuffle and sort.
    """
    name = rank_col or "_rn"
    w = Window.partitionBy(*group).orderBy(*_cols(order))
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)
    return out if rank_col else out.drop(name)


def best_row_window(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Best row per key under an arbitrary mixed-direction order."""
    return top_n_per_group(df, keys, order, 1)


def best_row(df: DataFrame, keys: Sequence[str], desc: Sequence[str]) -> DataFrame:
    """Best row per key, ``desc`` columns compared descending left to right,
    the other columns as a final tie-break.  A partial/final aggregate
    (see :func:`reelhouse.operators.clean.dedup_latest`)."""
    from reelhouse.operators.clean import dedup_latest
    return dedup_latest(df, keys, desc)


def rows_at_max(df: DataFrame, c: str) -> DataFrame:
    """Rows whose ``c`` equals the column maximum (scalar subquery, no
    driver round trip, no join)."""
    return df.filter(F.col(c) == df.select(F.max(c)).scalar())
