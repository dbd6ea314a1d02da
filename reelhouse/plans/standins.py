"""Stand-in tables built from the driver's parquet tables.

The reference works on movie ratings and title dumps; the test data is a
TPC-H-like star schema.  Each stand-in is a pure projection/aggregate of the
given tables, so its size grows with them.  Every builder has a DuckDB twin
(``*_SQL``) used only by the oracle queries.

Mapping:
  ratings      userId = o_custkey, movieId = l_partkey, rating = l_quantity,
               timestamp = epoch seconds of l_shipdate; one row per lineitem,
               so (user, item) pairs repeat and dedup has real work
  movies       movieId = p_partkey, title = p_name, pipe list of genres made
               of the name words and the type (brand added for larger
               sizes); size 50 -> NULL genres, 49 -> "(no genres listed)"
  links        every part that is not a PROMO type; imdbId = partkey*997 as
               text, tmdbId = partkey + 100000 (NULL for sizes 1-2)
  title_*      tab-dump shaped tables (all strings) for the title pipeline
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.operators.clean import dedup_latest


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- ratings --
def ratings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-like ratings, one row per lineitem (duplicated pairs)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    return j.select(
        F.col("o_custkey").cast("int").alias("userId"),
        F.col("l_partkey").cast("int").alias("movieId"),
        F.col("l_quantity").cast("float").alias("rating"),
        F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("timestamp"),
        F.col("l_orderkey"), F.col("l_linenumber"))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver ratings: latest row per (userId, movieId)."""
    raw = ratings_raw(spark, sf_dir)
    d = dedup_latest(raw, ["userId", "movieId"], ["timestamp", "l_orderkey", "l_linenumber", "rating"])
    return d.select("userId", "movieId", "rating", "timestamp")


RATINGS_RAW_SQL = """ratings_raw AS (
  SELECT CAST(o.o_custkey AS INTEGER) AS userId, CAST(l.l_partkey AS INTEGER) AS movieId,
         CAST(l.l_quantity AS FLOAT) AS rating, CAST(epoch(l.l_shipdate) AS BIGINT) AS "timestamp",
         l.l_orderkey, l.l_linenumber
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

RATINGS_SQL = RATINGS_RAW_SQL + """,
ratings AS (
  SELECT userId, movieId, rating, "timestamp" FROM (
    SELECT *, row_number() OVER (PARTITION BY userId, movieId
      ORDER BY "timestamp" DESC, l_orderkey DESC, l_linenumber DESC, rating DESC) AS rn
    FROM ratings_raw) WHERE rn = 1)"""


# ----------------------------------------------------------------- movies --
def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    base = F.concat(F.regexp_replace("p_name", " ", "|"), F.lit("|"), F.col("p_type"))
    genres = (F.when(F.col("p_size") == 50, F.lit(None).cast("string"))
              .when(F.col("p_size") == 49, F.lit("(no genres listed)"))
              .when(F.col("p_size") > 25, F.concat(base, F.lit("|"), F.col("p_brand")))
              .otherwise(base))
    return p.select(F.col("p_partkey").cast("int").alias("movieId"),
                    F.col("p_name").alias("title"), genres.alias("genres"))


MOVIES_SQL = """movies AS (
  SELECT CAST(p_partkey AS INTEGER) AS movieId, p_name AS title,
         CASE WHEN p_size = 50 THEN NULL
              WHEN p_size = 49 THEN '(no genres listed)'
              WHEN p_size > 25 THEN replace(p_name, ' ', '|') || '|' || p_type || '|' || p_brand
              ELSE replace(p_name, ' ', '|') || '|' || p_type END AS genres
  FROM part)"""


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").filter(F.col("p_type") != "PROMO")
    return p.select(F.col("p_partkey").cast("int").alias("movieId"),
                    (F.col("p_partkey") * 997).cast("string").alias("imdbId"),
                    F.when(F.col("p_size") > 2, F.col("p_partkey") + 100000).cast("int").alias("tmdbId"))


LINKS_SQL = """links AS (
  SELECT CAST(p_partkey AS INTEGER) AS movieId, CAST(p_partkey * 997 AS VARCHAR) AS imdbId,
         CAST(CASE WHEN p_size > 2 THEN p_partkey + 100000 END AS INTEGER) AS tmdbId
  FROM part WHERE p_type <> 'PROMO')"""


# ------------------------------------------------------- title pipeline --
def _tconst(c):
    """Zero-padded title id; longer ids stay whole (no lpad truncation)."""
    return F.format_string("tt%07d", F.col(c))


# All strings, shaped like the tab-separated dumps (after the bronze scrub).
def title_basics(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        _tconst("p_partkey").alias("tconst"),
        F.when(F.col("p_type") == "PROMO", F.lit("short")).otherwise(F.lit("movie")).alias("titleType"),
        F.col("p_name").alias("primaryTitle"),
        (F.col("p_size") + 1990).cast("string").alias("startYear"),
        (F.col("p_size") * 3).cast("string").alias("runtimeMinutes"),
        F.concat(F.regexp_replace("p_name", " ", ","), F.lit(","), F.col("p_type")).alias("genres"))




def title_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-title average (0-10 scale, floored to one decimal) and vote count."""
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity")
    agg = li.groupBy("l_partkey").agg(F.avg("l_quantity").alias("q"), F.count(F.lit(1)).alias("v"))
    return agg.select(_tconst("l_partkey").alias("tconst"),
                      (F.floor(F.col("q") * 2) / 10).cast("string").alias("averageRating"),
                      F.col("v").cast("string").alias("numVotes"))


def title_akas(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        _tconst("l_partkey").alias("titleId"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("ordering"),
        F.when(F.col("l_returnflag") == "A", "en").when(F.col("l_returnflag") == "N", "nl").alias("language"),
        F.when(F.col("l_linestatus") == "O", "US").otherwise("DE").alias("region"))


def title_crew(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two directors per title (lowest and highest supplier on its lines)."""
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")
    agg = li.groupBy("l_partkey").agg(F.min("l_suppkey").alias("a"), F.max("l_suppkey").alias("b"))
    return agg.select(_tconst("l_partkey").alias("tconst"),
                      F.concat_ws(",", F.concat(F.lit("nm"), F.col("a").cast("string")),
                                  F.concat(F.lit("nm"), F.col("b").cast("string"))).alias("directors"))


def title_principals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line: the supplier of a title's line, numbered by line
    (text columns, rows repeat)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(_tconst("l_partkey").alias("tconst"), F.concat(F.lit("nm"), F.col("l_suppkey").cast("string")).alias("nconst"),
                     F.col("l_linenumber").cast("string").alias("ordering"))


def name_basics(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(F.concat(F.lit("nm"), F.col("s_suppkey").cast("string")).alias("nconst"),
                    F.col("s_name").alias("primaryName"))


TITLE_SQL = """title_basics AS (
  SELECT printf('tt%07d', p_partkey) AS tconst,
         CASE WHEN p_type = 'PROMO' THEN 'short' ELSE 'movie' END AS titleType,
         p_name AS primaryTitle, CAST(p_size + 1990 AS VARCHAR) AS startYear,
         CAST(p_size * 3 AS VARCHAR) AS runtimeMinutes,
         replace(p_name, ' ', ',') || ',' || p_type AS genres
  FROM part),
title_ratings AS (
  SELECT printf('tt%07d', l_partkey) AS tconst,
         CAST(floor(avg(l_quantity) * 2) / 10 AS VARCHAR) AS averageRating,
         CAST(count(*) AS VARCHAR) AS numVotes
  FROM lineitem GROUP BY l_partkey),
title_akas AS (
  SELECT printf('tt%07d', l_partkey) AS titleId,
         CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS ordering,
         CASE l_returnflag WHEN 'A' THEN 'en' WHEN 'N' THEN 'nl' END AS language,
         CASE WHEN l_linestatus = 'O' THEN 'US' ELSE 'DE' END AS region
  FROM lineitem),
title_crew AS (
  SELECT printf('tt%07d', l_partkey) AS tconst,
         'nm' || CAST(min(l_suppkey) AS VARCHAR) || ',nm' || CAST(max(l_suppkey) AS VARCHAR) AS directors
  FROM lineitem GROUP BY l_partkey),
title_principals AS (
  SELECT printf('tt%07d', l_partkey) AS tconst, 'nm' || CAST(l_suppkey AS VARCHAR) AS nconst,
         CAST(l_linenumber AS VARCHAR) AS ordering FROM lineitem),
name_basics AS (
  SELECT 'nm' || CAST(s_suppkey AS VARCHAR) AS nconst, s_name AS primaryName FROM supplier)"""


# ------------------------------------------------------ landed payloads --
# One JSON response per external id, built per part row (no grouping), with
# error responses, malformed text and ids that were never landed:
#   size 3-4 error response, 5 malformed (cut off), 6 not landed, else ok.
def _details_json():
    genres = F.transform(F.split(F.concat_ws(" ", "p_name", "p_type"), " "),
                         lambda x, i: F.struct(i.cast("long").alias("id"), x.alias("name")))
    ok = F.to_json(F.struct(
        (F.col("p_partkey") + 100000).alias("id"), F.col("p_name").alias("title"), genres.alias("genres"),
        F.concat((F.col("p_size") + 1990).cast("string"), F.lit("-01-15")).alias("release_date"),
        F.concat(F.lit('Says "'), F.col("p_name"), F.lit('", then, a comma\nand a second line')).alias("overview"),
        (F.col("p_size") * 3).alias("runtime"), (F.col("p_retailprice") / 100).alias("vote_average"),
        F.when(F.col("p_size") > 40, F.lit("")).otherwise(
            F.concat(F.lit("/"), F.col("p_partkey").cast("string"), F.lit(".jpg"))).alias("poster_path")))
    err = F.lit('{"success": false, "status_code": 34, "status_message": "not found"}')
    cut = F.concat(F.lit('{"id": '), (F.col("p_partkey") + 100000).cast("string"), F.lit(', "title": "'))
    return (F.when(F.col("p_size").between(3, 4), err).when(F.col("p_size") == 5, cut).otherwise(ok))


def _credits_json():
    director = F.struct(F.concat(F.lit("Director of "), F.col("p_brand")).alias("name"), F.lit("Director").alias("job"))
    writer = F.struct(F.concat(F.lit("Writer of "), F.col("p_brand")).alias("name"), F.lit("Writer").alias("job"))
    crew = (F.when(F.col("p_size") == 44, F.array().cast("array<struct<name:string,job:string>>"))
            .when(F.col("p_size") > 44, F.array(writer)).otherwise(F.array(writer, director)))
    cast = F.transform(F.sequence(F.lit(1), F.least(F.col("p_size"), F.lit(8))),
                       lambda i: F.struct(F.concat(F.col("p_name"), F.lit(" actor "), i.cast("string")).alias("name"),
                                          i.alias("order")))
    return F.to_json(F.struct((F.col("p_partkey") + 100000).alias("id"),
                              F.when(F.col("p_size") > 40, F.lit("")).otherwise(
                                  F.concat(F.lit("/"), F.col("p_partkey").cast("string"), F.lit(".jpg"))).alias("poster_path"),
                              crew.alias("crew"), cast.alias("cast")))


def landed_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").filter((F.col("p_type") != "PROMO") & (F.col("p_size") > 2)
                                            & (F.col("p_size") != 6))
    return p.select((F.col("p_partkey") + 100000).cast("int").alias("tmdbId"), _details_json().alias("payload"))


def landed_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").filter((F.col("p_type") != "PROMO") & (F.col("p_size") > 2))
    return p.select((F.col("p_partkey") + 100000).cast("int").alias("tmdbId"), _credits_json().alias("payload"))


def landed_alt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alternate-source responses keyed by the external id text."""
    p = table(spark, sf_dir, "part").filter(F.col("p_type") != "PROMO")
    actors = F.concat_ws(", ", F.transform(F.sequence(F.lit(1), F.least(F.col("p_size"), F.lit(5))),
                                            lambda i: F.concat(F.lit("Actor "), i.cast("string"), F.lit(" of "),
                                                               F.col("p_brand"))))
    ok = F.to_json(F.struct(F.lit("True").alias("Response"), F.col("p_name").alias("Title"),
                            F.when(F.col("p_size") > 45, F.lit(None)).otherwise(
                                F.concat(F.lit("Director of "), F.col("p_brand"))).alias("Director"),
                            actors.alias("Actors"), F.concat(F.lit("poster-"), F.col("p_partkey").cast("string")).alias("Poster")))
    err = F.lit('{"Response": "False", "Error": "Incorrect id."}')
    return p.select(F.format_string("tt%07d", F.col("p_partkey") * 997).alias("external_id"),
                    F.when(F.col("p_size") <= 2, err).otherwise(ok).alias("payload"))
