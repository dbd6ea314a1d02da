"""Registered enrichment queries: landed JSON payloads parsed in Spark; the
oracle derives the same fields directly from the base columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelhouse.operators import enrich, payloads
from reelhouse.plans import standins as S
from reelhouse.plans.queries import ORACLES, L, query, with_ctes
from reelhouse.session import scratch_path, written

_OK_PARTS = "FROM part WHERE p_type <> 'PROMO' AND p_size > 6"


@query("json_fields", """
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def q_json_fields(spark, sf_dir):
    """Fields of the JSON column of the events table."""
    e = S.table(spark, sf_dir, "events").select("event_id", "event_type", "props")
    return e.select("event_id", "event_type", F.from_json("props", "k int")["k"].alias("k"))


@query("details_flat", f"""
SELECT CAST(p_partkey + 100000 AS INTEGER) AS tmdbId, p_name AS title,
       replace(p_name || ' ' || p_type, ' ', ',') AS genres,
       CAST(p_size + 1990 AS VARCHAR) || '-01-15' AS release_date,
       'Says "' || p_name || '", then, a comma' || chr(10) || 'and a second line' AS overview,
       p_size * 3 AS runtime, p_retailprice / 100 AS vote_average,
       CASE WHEN p_size > 40 THEN '' ELSE '/' || CAST(p_partkey AS VARCHAR) || '.jpg' END AS poster_path
{_OK_PARTS}""")
def q_details_flat(spark, sf_dir):
    """Details payloads landed as JSON lines files, read back as text and
    flattened (malformed and error payloads do not reach the output)."""
    path = scratch_path(spark, "payloads")
    S.landed_details(spark, sf_dir).select("payload").write.mode("overwrite").text(path)
    d = enrich.flatten_details(enrich.read_payloads(spark, path))
    return d.withColumn("genres", F.array_join("genres", ","))


@query("credits_flat", f"""
SELECT CAST(p_partkey + 100000 AS INTEGER) AS tmdbId,
       CASE WHEN p_size > 40 THEN NULL ELSE 'https://image.tmdb.org/t/p/w500/' || CAST(p_partkey AS VARCHAR) || '.jpg' END
         AS poster_url,
       CASE WHEN p_size >= 44 THEN NULL ELSE 'Director of ' || p_brand END AS director,
       array_to_string(list_transform(range(1, least(p_size, 5) + 1), lambda i: p_name || ' actor ' || CAST(i AS VARCHAR)), '|')
         AS top_cast
FROM part WHERE p_type <> 'PROMO' AND p_size > 2""")
def q_credits_flat(spark, sf_dir):
    c = enrich.flatten_credits(S.landed_credits(spark, sf_dir))
    return c.withColumn("top_cast", F.array_join("top_cast", "|"))


@query("alt_flat", """
SELECT printf('tt%07d', p_partkey * 997) AS external_id, p_name AS title,
       CASE WHEN p_size > 45 THEN NULL ELSE 'Director of ' || p_brand END AS director,
       array_to_string(list_transform(range(1, least(p_size, 5) + 1), lambda i: 'Actor ' || CAST(i AS VARCHAR) || ' of ' || p_brand), '|')
         AS actors,
       array_to_string(list_transform(range(1, least(p_size, 3) + 1), lambda i: 'Actor ' || CAST(i AS VARCHAR) || ' of ' || p_brand), '|')
         AS top_actors,
       'poster-' || CAST(p_partkey AS VARCHAR) AS poster
FROM part WHERE p_type <> 'PROMO' AND p_size > 2""")
def q_alt_flat(spark, sf_dir):
    a = enrich.flatten_alt(S.landed_alt(spark, sf_dir))
    return a.select("external_id", "title", "director", F.array_join("actors", "|").alias("actors"),
                    F.array_join("top_actors", "|").alias("top_actors"), "poster")


@query("missing_payloads", with_ctes(L) + """
SELECT k.tmdbId, CASE WHEN p.p_size BETWEEN 3 AND 4 THEN 'error' WHEN p.p_size = 5 THEN 'malformed'
                      ELSE 'missing' END AS status
FROM links k JOIN part p ON k.movieId = p.p_partkey
WHERE k.tmdbId IS NOT NULL AND p.p_size BETWEEN 3 AND 6""")
def q_missing_payloads(spark, sf_dir):
    ids = S.links(spark, sf_dir).filter(F.col("tmdbId").isNotNull())
    landed = S.landed_details(spark, sf_dir)
    return enrich.missing_payloads(ids, "tmdbId", enrich.parse_details(landed))


@query("movie_dim", with_ctes(L) + f"""
SELECT k.movieId, k.imdbId, k.tmdbId, p.p_name AS title,
       replace(p.p_name || ' ' || p.p_type, ' ', ',') AS genres, p.p_size * 3 AS runtime
FROM links k JOIN (SELECT * {_OK_PARTS}) p ON k.tmdbId = p.p_partkey + 100000""")
def q_movie_dim(spark, sf_dir):
    meta = enrich.flatten_details(S.landed_details(spark, sf_dir))
    d = enrich.movie_dim(S.links(spark, sf_dir), meta)
    return d.select("movieId", "imdbId", "tmdbId", "title", F.array_join("genres", ",").alias("genres"), "runtime")


@query("external_id", with_ctes(L) + """
SELECT m.p_partkey AS movieId, k.imdbId, CASE WHEN k.imdbId IS NULL THEN NULL
       ELSE printf('tt%07d', CAST(k.imdbId AS BIGINT)) END AS external_id
FROM part m LEFT JOIN links k ON m.p_partkey = k.movieId""")
def q_external_id(spark, sf_dir):
    items = S.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("movieId"))
    links = S.links(spark, sf_dir).withColumn("movieId", F.col("movieId").cast("long"))
    return enrich.with_external_id(items, links)


@query("details_csv_export", f"""
SELECT CAST(p_partkey + 100000 AS INTEGER) AS tmdbId, p_name AS title,
       replace(p_name || ' ' || p_type, ' ', ',') AS genres,
       'Says "' || p_name || '", then, a comma' || chr(10) || 'and a second line' AS overview
{_OK_PARTS}""")
def q_details_csv_export(spark, sf_dir):
    """Fetched metadata written as CSV (genre list as JSON text, overviews
    with quotes, commas and newlines), read back and decoded."""
    from reelhouse.functions.strings import parse_list_text
    from reelhouse.sources import files
    path = scratch_path(spark, "details_csv")
    d = enrich.flatten_details(S.landed_details(spark, sf_dir))
    files.export_csv(d.select("tmdbId", "title", F.to_json("genres").alias("genres"), "overview"), path)
    back = files.read_csv(spark, path, "tmdbId int, title string, genres string, overview string",
                          multiline=True)
    return back.withColumn("genres", F.array_join(parse_list_text("genres"), ","))


# ------------------------------------------------- payloads parsed once --
def _landed(spark, sf_dir, kind):
    """The payloads of one kind, parsed once when they land."""
    made = {"details": S.landed_details, "credits": S.landed_credits, "alt": S.landed_alt}[kind]
    return written(payloads.land(made(spark, sf_dir), kind), f"landed_{kind}")


@query("landed_details", ORACLES["details_flat"])
def q_landed_details(spark, sf_dir):
    """Details by path from the stored variants."""
    return payloads.details(_landed(spark, sf_dir, "details")).withColumn("genres", F.array_join("genres", ","))


@query("landed_credits", ORACLES["credits_flat"])
def q_landed_credits(spark, sf_dir):
    return payloads.credits(_landed(spark, sf_dir, "credits")).withColumn("top_cast", F.array_join("top_cast", "|"))


@query("landed_alt", ORACLES["alt_flat"])
def q_landed_alt(spark, sf_dir):
    a = payloads.alternate(_landed(spark, sf_dir, "alt"))
    return a.select("external_id", "title", "director", F.array_join("actors", "|").alias("actors"),
                    F.array_join("top_actors", "|").alias("top_actors"), "poster")


@query("landed_gaps", ORACLES["missing_payloads"])
def q_landed_gaps(spark, sf_dir):
    """Ids without a usable payload, from the stored statuses."""
    ids = S.links(spark, sf_dir).filter(F.col("tmdbId").isNotNull())
    return enrich.missing_payloads(ids, "tmdbId", _landed(spark, sf_dir, "details"))


@query("landed_movie_dim", ORACLES["movie_dim"])
def q_landed_movie_dim(spark, sf_dir):
    d = enrich.movie_dim(S.links(spark, sf_dir), payloads.details(_landed(spark, sf_dir, "details")))
    return d.select("movieId", "imdbId", "tmdbId", "title", F.array_join("genres", ",").alias("genres"), "runtime")
