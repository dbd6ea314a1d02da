"""Landed payloads parsed once.

``land`` parses every response a single time into a VARIANT column and keeps
its status beside it; details, credits, the alternate source and the gap report
are then read from the stored variants by path, without touching the text
again.  A new field needs a new path, not a new parse of all payloads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.functions.arrays import field_of_each, first_k, first_match
from reelhouse.functions.strings import poster_url, trimmed_list
from reelhouse.operators.enrich import ACTORS_KEPT, CAST_KEPT, POSTER_BASE

#: Paths that tell a usable response of each kind, and its error mark.
KINDS = {"details": ("$.id", "$.status_code", None), "credits": ("$.id", None, None), "alt": ("$.Response", "$.Response", "False")}


def field(path: str, kind: str = "string", doc: str = "doc") -> Column:
    """One field of the variant, NULL where it is missing or not of that type."""
    return F.try_variant_get(F.col(doc), path, kind)


def land(payloads: DataFrame, kind: str, text: str = "payload") -> DataFrame:
    """``payloads`` with ``doc`` (VARIANT) and ``status`` instead of the text;
    the text is kept, as ``raw``, only where it is not a JSON object.

    Statuses: ``missing`` (no text), ``malformed`` (no JSON, or without its
    mark), ``error`` (an error response), ``ok``."""
    mark, error, is_error = KINDS[kind]
    parsed = payloads.withColumn("doc", F.try_parse_json(F.col(text)))
    bad = F.lit(False) if error is None else field(error).isNotNull() if is_error is None else F.coalesce(field(error) == is_error, F.lit(False))
    status = (F.when(F.col(text).isNull(), "missing").when(bad, "error")
              .when(field(mark).isNull(), "malformed").otherwise("ok"))
    return parsed.select(*(c for c in payloads.columns if c != text), "doc", status.alias("status"),
                         F.when(F.col("doc").isNull(), F.col(text)).alias("raw"))


def details(landed: DataFrame) -> DataFrame:
    """Movie details, as :func:`reelhouse.operators.enrich.flatten_details`."""
    return landed.where("status = 'ok'").select(
        field("$.id", "bigint").cast("int").alias("tmdbId"), field("$.title").alias("title"),
        field_of_each(field("$.genres", "array<struct<name:string>>"), "name").alias("genres"),
        field("$.release_date").alias("release_date"), field("$.overview").alias("overview"),
        field("$.runtime", "int").alias("runtime"), field("$.vote_average", "double").alias("vote_average"),
        field("$.poster_path").alias("poster_path"))


def credits(landed: DataFrame, base: str = POSTER_BASE, cast_kept: int = CAST_KEPT) -> DataFrame:
    """Credits, as :func:`reelhouse.operators.enrich.flatten_credits`."""
    names = field_of_each(field("$.cast", "array<struct<name:string>>"), "name")
    return landed.where("status = 'ok'").select(
        field("$.id", "bigint").cast("int").alias("tmdbId"), poster_url(field("$.poster_path"), base).alias("poster_url"),
        first_match(field("$.crew", "array<struct<name:string,job:string>>"), "job", "Director", "name").alias("director"),
        first_k(names, cast_kept).alias("top_cast"))


def alternate(landed: DataFrame, actors_kept: int = ACTORS_KEPT) -> DataFrame:
    """Alternate source, as :func:`reelhouse.operators.enrich.flatten_alt`."""
    actors = trimmed_list(field("$.Actors"), ",")
    keep = [c for c in landed.columns if c not in ("doc", "status", "raw")]
    return landed.where("status = 'ok'").select(
        *keep, field("$.Title").alias("title"), field("$.Director").alias("director"), actors.alias("actors"),
        first_k(actors, actors_kept).alias("top_actors"), field("$.Poster").alias("poster"))
