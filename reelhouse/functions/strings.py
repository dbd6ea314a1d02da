"""String helpers: delimited lists, null tokens, external ids, URLs."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_list(c, sep: str) -> Column:
    """Split a delimited tag list on a literal separator (``|`` or ``,``)."""
    return F.split(_c(c), re.escape(sep))


def trimmed_list(c, sep: str) -> Column:
    """Split, trim every element; NULL text gives an empty list."""
    parts = F.transform(split_list(c, sep), lambda x: F.trim(x))
    return F.coalesce(parts, F.array().cast("array<string>"))


def null_if_token(c, token: str = "\\N") -> Column:
    """Replace a NULL sentinel token with a real NULL."""
    return F.nullif(_c(c), F.lit(token))


def external_id(c, prefix: str = "tt", width: int = 7) -> Column:
    """Zero-padded external id (``tt0114709``); NULL stays NULL and ids
    longer than ``width`` digits are kept whole, never truncated."""
    n = _c(c).try_cast("long")
    return F.when(n.isNotNull(), F.format_string(f"{prefix}%0{width}d", n))


def poster_url(path, base: str) -> Column:
    """Full image URL from a path; NULL when the path is NULL or empty."""
    p = _c(path)
    return F.when(p.isNotNull() & (p != F.lit("")), F.concat(F.lit(base), p))


def parse_list_text(c, elem_type: str = "string") -> Column:
    """List written as Python/JSON text (``['Drama', "Kid's"]``) to an
    array; single-quoted items are accepted by the JSON reader."""
    return F.from_json(_c(c), f"array<{elem_type}>", {"allowSingleQuotes": "true"})
