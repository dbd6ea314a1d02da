"""Metadata enrichment from landed JSON payloads.

Instead of one HTTP call per id from a driver loop, responses are landed as
JSON lines (``id, payload``) and parsed here in parallel with ``from_json``
against declared schemas.  Malformed text parses to an all-NULL struct and
error responses carry an error marker; both are reported, not lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse import schemas
from reelhouse.functions.arrays import field_of_each, first_k, first_match
from reelhouse.functions.strings import external_id, poster_url, trimmed_list
from reelhouse.operators.clean import dedup_latest

# Fixed values of the reference enrichment step.
POSTER_BASE = "https://image.tmdb.org/t/p/w500"
CAST_KEPT = 5
ACTORS_KEPT = 3


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Landed responses, one JSON document per line, kept as text so that
    malformed lines survive to be reported."""
    return spark.read.text(path).withColumnRenamed("value", "payload")


def _status(text: str, parsed: str, id_field: str, error_cond) -> F.Column:
    p = F.col(parsed)
    return (F.when(F.col(text).isNull(), "missing")
            .when(error_cond, "error")
            .when(p[id_field].isNull(), "malformed")
            .otherwise("ok"))


def parse_details(payloads: DataFrame, text: str = "payload") -> DataFrame:
    """Parse movie-detail payloads; adds ``d`` (struct) and ``status``."""
    d = payloads.withColumn("d", F.from_json(F.col(text), schemas.DETAILS_PAYLOAD))
    return d.withColumn("status", _status(text, "d", "id", F.col("d.status_code").isNotNull()))


def flatten_details(payloads: DataFrame, text: str = "payload") -> DataFrame:
    """Movie details: title, genre names, release date, overview, runtime,
    vote average, poster path (missing attributes are NULL)."""
    d = parse_details(payloads, text).filter(F.col("status") == "ok")
    return d.select(F.col("d.id").cast("int").alias("tmdbId"), F.col("d.title").alias("title"),
                    field_of_each(F.col("d.genres"), "name").alias("genres"),
                    F.col("d.release_date").alias("release_date"), F.col("d.overview").alias("overview"),
                    F.col("d.runtime").alias("runtime"), F.col("d.vote_average").alias("vote_average"),
                    F.col("d.poster_path").alias("poster_path"))


def flatten_credits(payloads: DataFrame, text: str = "payload", base: str = POSTER_BASE,
                    cast_kept: int = CAST_KEPT) -> DataFrame:
    """Credits: poster URL (NULL for an empty path), first director, first
    ``cast_kept`` cast names (empty list when there is no cast)."""
    c = payloads.withColumn("c", F.from_json(F.col(text), schemas.CREDITS_PAYLOAD))
    c = c.filter(F.col("c.id").isNotNull())
    names = field_of_each(F.col("c.cast"), "name")
    return c.select(F.col("c.id").cast("int").alias("tmdbId"),
                    poster_url(F.col("c.poster_path"), base).alias("poster_url"),
                    first_match(F.col("c.crew"), "job", "Director", "name").alias("director"),
                    first_k(names, cast_kept).alias("top_cast"))


def flatten_alt(payloads: DataFrame, text: str = "payload", actors_kept: int = ACTORS_KEPT) -> DataFrame:
    """Alternate source (title, director, comma list of actors, poster);
    error responses (``Response == "False"``) and malformed text dropped.
    Actor names are trimmed; a missing actor list gives an empty list."""
    a = payloads.withColumn("a", F.from_json(F.col(text), schemas.ALT_PAYLOAD))
    ok = a.filter(F.col("a.Response").isNotNull() & (F.col("a.Response") != "False"))
    actors = trimmed_list(F.col("a.Actors"), ",")
    keep = [c for c in payloads.columns if c != text]
    return ok.select(*keep, F.col("a.Title").alias("title"), F.col("a.Director").alias("director"),
                     actors.alias("actors"), first_k(actors, actors_kept).alias("top_actors"),
                     F.col("a.Poster").alias("poster"))


# Statuses from best to worst: a retried id counts as its best response.
STATUSES = ("ok", "error", "malformed", "missing")


def missing_payloads(ids: DataFrame, key: str, parsed_status: DataFrame) -> DataFrame:
    """Ids without a usable payload, one row each: never landed (``missing``),
    error response (``error``) or unparsable text (``malformed``).  An id with
    several responses takes its best status."""
    best = parsed_status.groupBy(key).agg(*(F.count_if(F.col("status") == s).alias(f"_{s}") for s in STATUSES))
    status = F.lit(STATUSES[-1])
    for s in STATUSES[-2::-1]:
        status = F.when(F.col(f"_{s}") > 0, s).otherwise(status)
    return ids.select(key).join(best, key, "left").select(key, status.alias("status")).filter(F.col("status") != "ok")


def with_external_id(items: DataFrame, links: DataFrame, key: str = "movieId",
                     raw: str = "imdbId", out: str = "external_id") -> DataFrame:
    """Items with the zero-padded external id of their link (left join)."""
    return items.join(links.select(key, raw), key, "left").withColumn(out, external_id(raw))


def movie_dim(links: DataFrame, metadata: DataFrame, key: str = "tmdbId") -> DataFrame:
    """Enriched movie dimension: links joined to fetched metadata on the
    external key (inner; links without the key cannot match).  An id fetched
    more than once keeps one payload (the greatest by its columns)."""
    l2 = links.filter(F.col(key).isNotNull())
    return l2.join(dedup_latest(metadata, [key], [c for c in metadata.columns if c != key]), key, "inner")
