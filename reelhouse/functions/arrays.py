"""Array helpers: tag-set membership, folds, nested-field access."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tag_set_flag(arr, tags: Sequence[str]) -> Column:
    """True when the list holds any tag of the set; NULL list -> false."""
    wanted = F.array(*[F.lit(t) for t in tags])
    return F.coalesce(F.arrays_overlap(_c(arr), wanted), F.lit(False))


def tag_set_count(arr, tags: Sequence[str]) -> Column:
    """How many list elements belong to the tag set; NULL list -> 0."""
    members = F.filter(_c(arr), lambda x: x.isin(list(tags)))
    return F.coalesce(F.size(members), F.lit(0))


def first_k(arr, k: int, elem_type: str = "string") -> Column:
    """First ``k`` elements; NULL list -> empty list of ``elem_type``."""
    return F.coalesce(F.slice(_c(arr), 1, k), F.array().cast(f"array<{elem_type}>"))


def field_of_each(arr, field: str) -> Column:
    """``[x.field for x in arr]``."""
    return F.transform(_c(arr), lambda x: x[field])


def first_match(arr, field: str, value: str, out: str) -> Column:
    """``out`` field of the first element whose ``field`` equals ``value``."""
    hit = F.filter(_c(arr), lambda x: x[field] == F.lit(value))
    return F.try_element_at(hit, F.lit(1))[out]
