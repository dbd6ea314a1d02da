"""Casts that never raise on dirty text (ANSI stays on for everything else)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_cast(c, to: str) -> Column:
    """``try_cast``: NULL for text that does not parse or overflows."""
    return _c(c).try_cast(to)


def id_from_text(c, to: str = "int") -> Column:
    """Integer id from text that may be written as a float (``'862.0'``).

    Goes through double first, so ``'862.0'`` gives 862, ``'x'`` and ids
    above the target range give NULL.
    """
    return _c(c).try_cast("double").try_cast(to)


def epoch_to_ts(c) -> Column:
    """Epoch seconds (number or text) to a timestamp, without a trip
    through a zone-local string, so repeated DST hours stay distinct."""
    return F.timestamp_seconds(_c(c).try_cast("long"))


def to_day(c) -> Column:
    """Calendar day of a timestamp in the session zone (UTC)."""
    return F.to_date(_c(c))
