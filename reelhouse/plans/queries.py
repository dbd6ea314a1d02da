"""Query registry: every operator exercised over the whole driver tables.

Each entry is a Spark function ``(spark, sf_dir) -> DataFrame`` and, where
SQL can express it, a DuckDB oracle over the same parquet views.  Computed
columns carry the same alias on both sides; doubles that depend on the
summation order are rounded on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.functions.strings import external_id, split_list
from reelhouse.functions.casts import epoch_to_ts, to_day
from reelhouse.operators import aggregates as agg
from reelhouse.operators import ranking, tags
from reelhouse.operators.joins import lookup_attrs, orphans, with_titles, without_seen
from reelhouse.plans import standins as S

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


R = S.RATINGS_SQL
M = S.MOVIES_SQL
L = S.LINKS_SQL
T = S.TITLE_SQL

# Parameters of the registered queries (arguments of the operators).
LEADERBOARD_MIN_COUNT = 30
LEADERBOARD_SIZE = 10
RECS_PER_USER = 10
LOOKUP_USER = 1


# ------------------------------------------------------- minimum slice ----
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top items by average rating among items with enough ratings."""
    out = agg.top_items(S.ratings(spark, sf_dir), S.movies(spark, sf_dir),
                        LEADERBOARD_MIN_COUNT, LEADERBOARD_SIZE)
    return out.select("movieId", "title", F.round("avg_rating", 6).alias("avg_rating"), "num_ratings")


query("top_items_min_count", with_ctes(R, M) + f"""
SELECT movieId, title, round(avg_rating, 6) AS avg_rating, num_ratings FROM (
  SELECT r.movieId, m.title, avg(r.rating) AS avg_rating, count(r.rating) AS num_ratings
  FROM ratings r JOIN movies m ON r.movieId = m.movieId
  GROUP BY r.movieId, m.title HAVING count(r.rating) >= {LEADERBOARD_MIN_COUNT})
ORDER BY avg_rating DESC, num_ratings DESC, movieId ASC LIMIT {LEADERBOARD_SIZE}""")(flagship)


# ------------------------------------------------- cleaning, dedup, dates ----
@query("ratings_dedup_latest", with_ctes(R) + "SELECT * FROM ratings")
def q_ratings_dedup_latest(spark, sf_dir):
    return S.ratings(spark, sf_dir)


@query("ratings_epoch_date", with_ctes(R) + """
SELECT userId, movieId, rating, "timestamp",
       strftime(make_timestamp("timestamp" * 1000000), '%Y-%m-%d %H:%M:%S') AS timestamp_ts,
       CAST(make_timestamp("timestamp" * 1000000) AS DATE) AS rating_date
FROM ratings""")
def q_ratings_epoch_date(spark, sf_dir):
    r = S.ratings(spark, sf_dir).withColumn("ts", epoch_to_ts("timestamp"))
    return r.select("userId", "movieId", "rating", "timestamp",
                    F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp_ts"),
                    to_day("ts").alias("rating_date"))


# ------------------------------------------------------- aggregations -------
@query("user_dim", with_ctes(R) + """
SELECT userId, count(movieId) AS num_ratings, round(avg(rating), 6) AS avg_rating
FROM ratings GROUP BY userId""")
def q_user_dim(spark, sf_dir):
    d = agg.user_dim(S.ratings(spark, sf_dir))
    return d.select("userId", "num_ratings", F.round("avg_rating", 6).alias("avg_rating"))


@query("item_stats", with_ctes(R) + """
SELECT movieId, round(avg(rating), 6) AS avg_rating, count(rating) AS num_ratings
FROM ratings GROUP BY movieId""")
def q_item_stats(spark, sf_dir):
    d = agg.item_stats(S.ratings(spark, sf_dir))
    return d.select("movieId", F.round("avg_rating", 6).alias("avg_rating"), "num_ratings")


@query("power_users", with_ctes(R) + """
SELECT userId, count(*) AS rating_count FROM ratings GROUP BY userId""")
def q_power_users(spark, sf_dir):
    return agg.power_users(S.ratings(spark, sf_dir))


@query("cardinalities", with_ctes(R) + """
SELECT count(DISTINCT userId) AS distinct_userId, count(DISTINCT movieId) AS distinct_movieId,
       count(*) AS row_count FROM ratings""")
def q_cardinalities(spark, sf_dir):
    return agg.cardinalities(S.ratings(spark, sf_dir), ["userId", "movieId"])


def _spread_sql(key: str) -> str:
    return with_ctes(R) + f"""
SELECT round(avg(n), 6) AS avg_per_key, min(n) AS min_per_key, max(n) AS max_per_key,
       count(*) AS keys
FROM (SELECT {key}, count(*) AS n FROM ratings GROUP BY {key})"""


def _spread(key: str) -> QueryFn:
    def run(spark, sf_dir):
        d = agg.count_spread(S.ratings(spark, sf_dir), key)
        return d.withColumn("avg_per_key", F.round("avg_per_key", 6))
    return run


query("count_spread_user", _spread_sql("userId"))(_spread("userId"))
query("count_spread_item", _spread_sql("movieId"))(_spread("movieId"))


@query("global_mean", with_ctes(R) + """
SELECT round(avg(rating), 6) AS global_mean, count(*) AS row_count FROM ratings""")
def q_global_mean(spark, sf_dir):
    return S.ratings(spark, sf_dir).agg(F.round(F.avg("rating"), 6).alias("global_mean"),
                                        F.count(F.lit(1)).alias("row_count"))


@query("rating_value_counts", with_ctes(R) + """
SELECT rating, count(*) AS n FROM ratings WHERE rating IS NOT NULL GROUP BY rating""")
def q_rating_value_counts(spark, sf_dir):
    return agg.value_counts(S.ratings(spark, sf_dir), "rating")


# ------------------------------------------------------------- joins --------
@query("orphan_ratings", with_ctes(R, L) + """
SELECT r.* FROM ratings r WHERE NOT EXISTS (SELECT 1 FROM links k WHERE k.movieId = r.movieId)""")
def q_orphan_ratings(spark, sf_dir):
    return orphans(S.ratings(spark, sf_dir), S.links(spark, sf_dir), "movieId")


@query("movies_with_links", with_ctes(M, L) + """
SELECT m.movieId, m.title, m.genres,
       array_to_string(string_split(m.genres, '|'), ',') AS genres_list,
       CAST(len(string_split(m.genres, '|')) AS INTEGER) AS genre_count,
       k.imdbId, k.tmdbId, printf('tt%07d', CAST(k.imdbId AS BIGINT)) AS imdb_ext
FROM movies m LEFT JOIN links k ON m.movieId = k.movieId""")
def q_movies_with_links(spark, sf_dir):
    m = S.movies(spark, sf_dir).withColumn("genres_array", split_list("genres", "|"))
    j = m.join(S.links(spark, sf_dir), "movieId", "left")
    return j.select("movieId", "title", "genres",
                    F.array_join("genres_array", ",").alias("genres_list"),
                    F.size("genres_array").alias("genre_count"),
                    "imdbId", "tmdbId", external_id("imdbId").alias("imdb_ext"))


@query("item_titles_join", with_ctes(R, M) + """
SELECT s.movieId, m.title, s.avg_rating, s.num_ratings FROM (
  SELECT movieId, round(avg(rating), 6) AS avg_rating, count(rating) AS num_ratings
  FROM ratings GROUP BY movieId) s JOIN movies m ON s.movieId = m.movieId""")
def q_item_titles_join(spark, sf_dir):
    s = agg.item_stats(S.ratings(spark, sf_dir)).withColumn("avg_rating", F.round("avg_rating", 6))
    return s.join(S.movies(spark, sf_dir).select("movieId", "title"), "movieId", "inner") \
        .select("movieId", "title", "avg_rating", "num_ratings")


# --------------------------------------------------------------- tags -------
@query("genre_counts", with_ctes(M) + """
SELECT tag, count(*) AS n FROM (SELECT unnest(string_split(genres, '|')) AS tag FROM movies
  WHERE genres IS NOT NULL) GROUP BY tag""")
def q_genre_counts(spark, sf_dir):
    return tags.tag_counts(S.movies(spark, sf_dir), "genres", "|")


@query("genre_mean_rating", with_ctes(R, M) + """
SELECT tag, round(avg(rating), 6) AS avg_rating, count(*) AS n FROM (
  SELECT r.rating, unnest(string_split(m.genres, '|')) AS tag
  FROM ratings r JOIN movies m ON r.movieId = m.movieId WHERE m.genres IS NOT NULL)
GROUP BY tag""")
def q_genre_mean_rating(spark, sf_dir):
    t = tags.tag_means_by_key(S.ratings(spark, sf_dir), S.movies(spark, sf_dir), "movieId", "genres", "|", "rating")
    return t.select("tag", F.round("avg_rating", 6).alias("avg_rating"), "n")


@query("genre_count_dist", with_ctes(M) + """
SELECT CAST(len(string_split(genres, '|')) AS INTEGER) AS tag_count, count(*) AS n FROM movies
WHERE genres IS NOT NULL GROUP BY 1""")
def q_genre_count_dist(spark, sf_dir):
    return tags.tag_count_dist(S.movies(spark, sf_dir), "genres", "|")


@query("distinct_genres", with_ctes(M) + """
SELECT DISTINCT unnest(string_split(genres, '|')) AS genre FROM movies WHERE genres IS NOT NULL""")
def q_distinct_genres(spark, sf_dir):
    return (tags.explode_tags(S.movies(spark, sf_dir), "genres", "|", "genre")
            .select("genre").distinct().orderBy("genre"))


@query("max_genres", with_ctes(M) + """
SELECT movieId, title, genres, CAST(len(string_split(genres, '|')) AS INTEGER) AS genre_count FROM movies
WHERE len(string_split(genres, '|')) = (SELECT max(len(string_split(genres, '|'))) FROM movies)""")
def q_max_genres(spark, sf_dir):
    m = tags.with_tag_count(S.movies(spark, sf_dir), "genres", "|", "genre_count")
    return ranking.rows_at_max(m, "genre_count")


@query("no_genres", with_ctes(M) + """
SELECT movieId, title, genres FROM movies WHERE genres = '(no genres listed)'""")
def q_no_genres(spark, sf_dir):
    return S.movies(spark, sf_dir).filter(F.col("genres") == "(no genres listed)")


# ------------------------------------------------------------ windows -------
RECS_CTE = f"""recs AS (
  SELECT userId, movieId, rating, CAST(rnk AS INTEGER) AS "rank" FROM (
    SELECT *, row_number() OVER (PARTITION BY userId
      ORDER BY rating DESC, "timestamp" DESC, movieId ASC) AS rnk FROM ratings)
  WHERE rnk <= {RECS_PER_USER})"""
TOPN_SQL = with_ctes(R, RECS_CTE) + "SELECT * FROM recs"


def rating_ranked_list(spark, sf_dir) -> DataFrame:
    """Stand-in recommendation list: each user's top items by own rating."""
    r = S.ratings(spark, sf_dir)
    top = ranking.top_n_per_group(r, ["userId"], [F.col("rating").desc(), F.col("timestamp").desc(),
                                                  F.col("movieId").asc()], RECS_PER_USER, rank_col="rank")
    return top.select("userId", "movieId", "rating", "rank")


query("top_n_per_user", TOPN_SQL)(rating_ranked_list)


@query("item_leaderboard_join_titles", with_ctes(R, M) + f"""
SELECT s.movieId, m.title, round(s.avg_rating, 6) AS avg_rating, s.num_ratings FROM (
  SELECT movieId, avg(rating) AS avg_rating, count(*) AS num_ratings FROM ratings GROUP BY movieId) s
LEFT JOIN movies m ON s.movieId = m.movieId
ORDER BY s.avg_rating DESC, s.num_ratings DESC, s.movieId LIMIT 20""")
def q_item_leaderboard(spark, sf_dir):
    s = agg.item_stats(S.ratings(spark, sf_dir))
    top = ranking.top_k(s, [F.col("avg_rating").desc(), F.col("num_ratings").desc(),
                            F.col("movieId").asc()], 20)
    return lookup_attrs(top, S.movies(spark, sf_dir), "movieId", ["title"]).select(
        "movieId", "title", F.round("avg_rating", 6).alias("avg_rating"), "num_ratings")


# ------------------------------------------------------ title pipeline -----
from reelhouse.operators import scoring  # noqa: E402
from reelhouse.operators import profile as prof  # noqa: E402

AS_OF_YEAR = 2025
# Tag set of the registered tag-set queries (words that occur in the stand-in
# genre lists); the library default is scoring.DEFAULT_TAG_SET.
STANDIN_TAG_SET = ("red", "blue", "SMALL", "LARGE", "widget")
_TAGS_SQL = ", ".join(f"'{t}'" for t in STANDIN_TAG_SET)

def silver_sql(k: int | None = None, director_k: int | None = None) -> str:
    """CTEs of the title pipeline; ``k`` / ``director_k`` as in the operators."""
    order = "ORDER BY averageRating DESC, numVotes DESC, tconst"
    cut, director_cut = (f"{order} LIMIT {n}" if n else "" for n in (k, director_k))
    return T + f""",
tb AS (SELECT tconst, titleType, primaryTitle, TRY_CAST(startYear AS INTEGER) AS startYear,
              TRY_CAST(runtimeMinutes AS INTEGER) AS runtimeMinutes, genres FROM title_basics),
b AS (SELECT * FROM tb WHERE titleType = 'movie' AND startYear >= 2000 AND startYear <= {AS_OF_YEAR}),
a AS (SELECT titleId, language, region FROM title_akas
      WHERE language IS NOT NULL AND language IN ('en', 'nl') AND region IN ('US', 'GB', 'NL', 'BE', 'AU')),
r AS (SELECT tconst, TRY_CAST(averageRating AS FLOAT) AS averageRating,
             TRY_CAST(numVotes AS INTEGER) AS numVotes FROM title_ratings
      WHERE TRY_CAST(numVotes AS INTEGER) >= 5),
j AS (SELECT b.*, a.language, a.region, r.averageRating, r.numVotes
      FROM b JOIN a ON b.tconst = a.titleId JOIN r ON b.tconst = r.tconst),
one AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY tconst
          ORDER BY averageRating DESC, numVotes DESC, language DESC, region DESC) AS rn FROM j)
        WHERE rn = 1),
silver AS (SELECT * FROM one {cut}),
fact AS (SELECT tconst, CAST(averageRating AS DOUBLE) AS averageRating, numVotes FROM silver),
weighted AS (SELECT *, CAST(numVotes AS DOUBLE) / (CAST(numVotes AS DOUBLE) + 50.0) * averageRating
                 + 50.0 / (CAST(numVotes AS DOUBLE) + 50.0) * (SELECT avg(averageRating) FROM fact)
                 AS weightedRating FROM fact),
dimw AS (SELECT s.* REPLACE (CAST(s.averageRating AS DOUBLE) AS averageRating),
                CAST(s.numVotes AS DOUBLE) / (CAST(s.numVotes AS DOUBLE) + 50.0) * CAST(s.averageRating AS DOUBLE)
                + 50.0 / (CAST(s.numVotes AS DOUBLE) + 50.0)
                  * (SELECT avg(CAST(averageRating AS DOUBLE)) FROM silver) AS weightedRating
         FROM silver s),
topd AS (SELECT * FROM dimw {director_cut}),
dirs AS (SELECT c.tconst, string_agg(n.primaryName, ',' ORDER BY n.primaryName) AS directorNames
         FROM (SELECT tconst, unnest(string_split(directors, ',')) AS directorId
               FROM title_crew WHERE tconst IN (SELECT tconst FROM topd)) c
         LEFT JOIN name_basics n ON c.directorId = n.nconst GROUP BY c.tconst),
dim AS (SELECT t.*, d.directorNames,
               coalesce(list_has_any(string_split(t.genres, ','), [{_TAGS_SQL}]), false) AS tag_set_flag,
               CAST(coalesce(len(list_filter(string_split(t.genres, ','), lambda x: x IN ({_TAGS_SQL}))), 0)
                 AS INTEGER) AS tag_set_count
        FROM dimw t LEFT JOIN dirs d ON t.tconst = d.tconst),
genre_rows AS (SELECT *, unnest(string_split(genres, ',')) AS genre FROM dim)"""


SILVER_SQL = silver_sql()


def _silver(spark, sf_dir, k: int | None = None):
    """Silver titles, written once like the layer table they stand for, so the
    branches that read them do not each re-run the joins."""
    from reelhouse.session import written
    return written(scoring.silver_titles(S.title_basics(spark, sf_dir), S.title_akas(spark, sf_dir),
                                         S.title_ratings(spark, sf_dir), as_of_year=AS_OF_YEAR, k=k), "silver_titles")


def _title_dim(spark, sf_dir):
    return scoring.title_dim(_silver(spark, sf_dir), S.title_crew(spark, sf_dir),
                             S.name_basics(spark, sf_dir), tags=STANDIN_TAG_SET)


@query("title_silver", with_ctes(silver_sql(scoring.DEFAULT_SILVER_TOP)) + "SELECT * FROM silver")
def q_title_silver(spark, sf_dir):
    """The top-title table: its cut is the feature."""
    return _silver(spark, sf_dir, scoring.DEFAULT_SILVER_TOP)


@query("weighted_rating", with_ctes(SILVER_SQL) + """
SELECT tconst, averageRating, numVotes, round(weightedRating, 6) AS weightedRating FROM weighted""")
def q_weighted_rating(spark, sf_dir):
    w = scoring.weighted_rating(scoring.title_fact(_silver(spark, sf_dir)))
    return w.withColumn("weightedRating", F.round("weightedRating", 6))


@query("weighted_top20", with_ctes(SILVER_SQL) + """
SELECT tconst, averageRating, numVotes, round(weightedRating, 6) AS weightedRating FROM weighted
ORDER BY weightedRating DESC, tconst LIMIT 20""")
def q_weighted_top20(spark, sf_dir):
    w = scoring.weighted_rating(scoring.title_fact(_silver(spark, sf_dir)))
    top = ranking.top_k(w, [F.col("weightedRating").desc(), F.col("tconst").asc()], 20)
    return top.withColumn("weightedRating", F.round("weightedRating", 6))


@query("title_dim", with_ctes(SILVER_SQL) + """
SELECT tconst, primaryTitle, genres, averageRating, numVotes, round(weightedRating, 6) AS weightedRating,
       directorNames, tag_set_flag, tag_set_count FROM dim""")
def q_title_dim(spark, sf_dir):
    d = _title_dim(spark, sf_dir)
    return d.select("tconst", "primaryTitle", "genres", "averageRating", "numVotes",
                    F.round("weightedRating", 6).alias("weightedRating"),
                    F.when(F.size("directorNames") > 0, F.array_join("directorNames", ","))
                    .alias("directorNames"), "tag_set_flag", "tag_set_count")


@query("director_names", with_ctes(SILVER_SQL) + "SELECT tconst, directorNames FROM dirs")
def q_director_names(spark, sf_dir):
    d = scoring.director_names(S.title_crew(spark, sf_dir), S.name_basics(spark, sf_dir), _silver(spark, sf_dir))
    return d.select("tconst", F.when(F.size("directorNames") > 0, F.array_join("directorNames", ","))
                    .alias("directorNames"))


@query("tag_set_flag_count", with_ctes(SILVER_SQL) + """
SELECT tconst, genres, tag_set_flag, tag_set_count FROM dim""")
def q_tag_set_flag_count(spark, sf_dir):
    return _title_dim(spark, sf_dir).select("tconst", "genres", "tag_set_flag", "tag_set_count")


@query("top20_per_genre", with_ctes(SILVER_SQL) + """
SELECT genre, tconst, round(weightedRating, 6) AS weightedRating, rank_in_genre FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY genre ORDER BY weightedRating DESC, tconst) AS INTEGER)
    AS rank_in_genre FROM genre_rows) WHERE rank_in_genre <= 20""")
def q_top20_per_genre(spark, sf_dir):
    t = scoring.top_per_genre(_title_dim(spark, sf_dir), 20)
    return t.select("genre", "tconst", F.round("weightedRating", 6).alias("weightedRating"),
                    "rank_in_genre")


_TAGSET_RANK = """(SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY genre
    ORDER BY tag_set_count DESC, weightedRating DESC, tconst) AS rk FROM genre_rows) WHERE rk <= 20)"""


@query("top20_per_genre_tagset", with_ctes(SILVER_SQL) + f"""
SELECT genre, tconst, tag_set_count, round(weightedRating, 6) AS weightedRating FROM {_TAGSET_RANK}""")
def q_top20_per_genre_tagset(spark, sf_dir):
    t = scoring.top_per_genre_tagset(_title_dim(spark, sf_dir), 20)
    return t.select("genre", "tconst", "tag_set_count", F.round("weightedRating", 6).alias("weightedRating"))


@query("top20_unique", with_ctes(SILVER_SQL) + f"""
SELECT genre, tconst, tag_set_count, round(weightedRating, 6) AS weightedRating FROM (
  SELECT *, row_number() OVER (PARTITION BY tconst
    ORDER BY tag_set_count DESC, weightedRating DESC, genre ASC) AS rn FROM {_TAGSET_RANK})
WHERE rn = 1""")
def q_top20_unique(spark, sf_dir):
    t = scoring.top_per_genre_unique(_title_dim(spark, sf_dir), 20)
    return t.select("genre", "tconst", "tag_set_count", F.round("weightedRating", 6).alias("weightedRating"))


# ---------------------------------------------------------- profiling ------
def _union_per_column(table: str, cols: list[str], expr: str, alias: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, {expr.format(c=c)} AS {alias} FROM {table}" for c in cols)


@query("null_counts", with_ctes(L) + _union_per_column(
    "links", ["movieId", "imdbId", "tmdbId"], 'CAST(count(*) - count("{c}") AS BIGINT)', "missing"))
def q_null_counts(spark, sf_dir):
    return prof.null_counts(S.links(spark, sf_dir))


@query("distinct_counts", with_ctes(M) + _union_per_column(
    "movies", ["movieId", "title", "genres"], 'count(DISTINCT "{c}")', "unique_values"))
def q_distinct_counts(spark, sf_dir):
    return prof.distinct_counts(S.movies(spark, sf_dir))


_PROFILE_TYPES = {"userId": "int", "movieId": "int", "rating": "float", "timestamp": "bigint"}


@query("profile_ratings", with_ctes(R) + "\nUNION ALL ".join(
    f"""SELECT '{c}' AS column_name, '{t}' AS dtype, CAST(count(*) - count("{c}") AS BIGINT) AS missing_values,
       count(DISTINCT "{c}") AS unique_values, CAST(min("{c}") AS VARCHAR) AS sample_value FROM ratings"""
    for c, t in _PROFILE_TYPES.items()))
def q_profile_ratings(spark, sf_dir):
    return prof.profile(S.ratings(spark, sf_dir))


@query("sparsity", with_ctes(R, M) + """
SELECT round(1.0 - count(*) / (count(DISTINCT userId) * (SELECT count(DISTINCT movieId) FROM movies)), 6)
         AS sparsity, count(*) AS ratings, count(DISTINCT userId) AS users,
       (SELECT count(DISTINCT movieId) FROM movies) AS items FROM ratings""")
def q_sparsity(spark, sf_dir):
    s = prof.sparsity(S.ratings(spark, sf_dir), S.movies(spark, sf_dir))
    return s.withColumn("sparsity", F.round("sparsity", 6))


_TOPUSER_SQL = """counts AS (SELECT userId, count(*) AS n FROM ratings GROUP BY userId),
tu AS (SELECT userId FROM counts ORDER BY n DESC, userId ASC LIMIT 1)"""


@query("user_vs_global", with_ctes(R, _TOPUSER_SQL) + """
SELECT (SELECT userId FROM tu) AS userId, round(avg(rating), 6) AS global_avg,
       round(avg(CASE WHEN userId = (SELECT userId FROM tu) THEN rating END), 6) AS user_avg,
       round(avg(CASE WHEN userId = (SELECT userId FROM tu) THEN rating END) - avg(rating), 6) AS difference
FROM ratings""")
def q_user_vs_global(spark, sf_dir):
    u = prof.user_vs_global(S.ratings(spark, sf_dir))
    return u.select("userId", *[F.round(c, 6).alias(c) for c in ("global_avg", "user_avg", "difference")])


@query("top_gap", with_ctes(R, _TOPUSER_SQL) + """,
two AS (SELECT userId, n, row_number() OVER (ORDER BY n DESC, userId ASC) AS pos FROM counts
        ORDER BY n DESC, userId ASC LIMIT 2)
SELECT max(CASE WHEN pos = 1 THEN userId END) AS top_user, max(CASE WHEN pos = 1 THEN n END) AS top_count,
       max(CASE WHEN pos = 2 THEN userId END) AS second_user,
       max(CASE WHEN pos = 2 THEN n END) AS second_count,
       max(CASE WHEN pos = 1 THEN n END) - max(CASE WHEN pos = 2 THEN n END) AS difference,
       round((max(CASE WHEN pos = 1 THEN n END) - max(CASE WHEN pos = 2 THEN n END)) * 100.0
             / max(CASE WHEN pos = 2 THEN n END), 6) AS percent_diff
FROM two""")
def q_top_gap(spark, sf_dir):
    return prof.top_gap(S.ratings(spark, sf_dir)).withColumn("percent_diff", F.round("percent_diff", 6))


@query("count_zscore", with_ctes(R, _TOPUSER_SQL) + """
SELECT max(n) AS top_count, round(avg(n), 6) AS mean_count, round(stddev_samp(n), 6) AS std_count,
       round((max(n) - avg(n)) / stddev_samp(n), 6) AS z_score FROM counts""")
def q_count_zscore(spark, sf_dir):
    z = prof.count_zscore(S.ratings(spark, sf_dir))
    return z.select("top_count", *[F.round(c, 6).alias(c) for c in ("mean_count", "std_count", "z_score")])


@query("centre_ratings", with_ctes(R) + """
SELECT userId, movieId, rating, "timestamp",
       round(rating - avg(rating) OVER (PARTITION BY userId), 6) AS normalized_rating FROM ratings""")
def q_centre_ratings(spark, sf_dir):
    c = prof.centre_ratings(S.ratings(spark, sf_dir))
    return c.withColumn("normalized_rating", F.round("normalized_rating", 6))


def _hist_sql(src: str, bins: int) -> str:
    return f"""
mm AS (SELECT min(x) AS lo, max(x) AS hi FROM {src}),
cnt AS (SELECT CAST(least(coalesce(floor((x - lo) * {bins} / nullif(hi - lo, 0)), 0), {bins - 1}) AS INTEGER)
          AS bin, count(*) AS n FROM {src}, mm GROUP BY 1)
SELECT g.bin, round(lo + g.bin * (hi - lo) / {float(bins)}, 6) AS lower,
       round(lo + (g.bin + 1) * (hi - lo) / {float(bins)}, 6) AS upper, coalesce(n, 0) AS "count"
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range({bins})) g CROSS JOIN mm
LEFT JOIN cnt ON g.bin = cnt.bin"""


def _round_hist(h: DataFrame) -> DataFrame:
    return h.withColumns({"lower": F.round("lower", 6), "upper": F.round("upper", 6)})


@query("histogram_ratings", with_ctes(R, "vals AS (SELECT CAST(rating AS DOUBLE) AS x FROM ratings "
                                         "WHERE rating IS NOT NULL)", _hist_sql("vals", 10)))
def q_histogram_ratings(spark, sf_dir):
    return _round_hist(prof.histogram(S.ratings(spark, sf_dir), "rating", 10))


@query("histogram_user_counts", with_ctes(
    R, "vals AS (SELECT CAST(count(*) AS DOUBLE) AS x FROM ratings GROUP BY userId)", _hist_sql("vals", 30)))
def q_histogram_user_counts(spark, sf_dir):
    return _round_hist(prof.histogram(prof.per_key_counts(S.ratings(spark, sf_dir)), "n", 30))


@query("user_tag_profile", with_ctes(R, M, _TOPUSER_SQL) + """
SELECT tag, count(*) AS n, round(avg(rating), 6) AS avg_rating FROM (
  SELECT r.rating, unnest(string_split(m.genres, '|')) AS tag
  FROM ratings r LEFT JOIN movies m ON r.movieId = m.movieId
  WHERE r.userId = (SELECT userId FROM tu) AND m.genres IS NOT NULL) GROUP BY tag""")
def q_user_tag_profile(spark, sf_dir):
    p = prof.user_tag_profile(S.ratings(spark, sf_dir), S.movies(spark, sf_dir), "genres", "|")
    return p.withColumn("avg_rating", F.round("avg_rating", 6))


# ------------------------------------------- recommendation list reports ----
# The rating-ranked list stands in for model output so SQL can check every
# report built on recommendations; the ALS queries use the same operators.
@query("rec_popularity", with_ctes(R, RECS_CTE) + """
SELECT movieId, count(*) AS recommendation_count FROM recs GROUP BY movieId""")
def q_rec_popularity(spark, sf_dir):
    return agg.rec_popularity(rating_ranked_list(spark, sf_dir))


@query("rec_popularity_titles", with_ctes(R, M, RECS_CTE) + """
SELECT r.movieId, m.title, count(*) AS recommendation_count
FROM recs r JOIN movies m ON r.movieId = m.movieId GROUP BY r.movieId, m.title""")
def q_rec_popularity_titles(spark, sf_dir):
    # Count per item first, then attach the title (the dimension is keyed by
    # movieId), so only one row per item meets the dimension.
    pop = agg.rec_popularity(rating_ranked_list(spark, sf_dir))
    return pop.join(S.movies(spark, sf_dir).select("movieId", "title"), "movieId", "inner") \
        .select("movieId", "title", "recommendation_count")


@query("rec_popularity_by_title", with_ctes(R, M, RECS_CTE) + """
SELECT r.movieId, m.title, count(*) AS recommendation_count
FROM recs r LEFT JOIN movies m ON r.movieId = m.movieId GROUP BY r.movieId, m.title""")
def q_rec_popularity_by_title(spark, sf_dir):
    return agg.rec_popularity(with_titles(rating_ranked_list(spark, sf_dir), S.movies(spark, sf_dir)), by=["movieId", "title"])


@query("candidates_minus_seen", with_ctes(R) + """
SELECT c.userId, c.movieId FROM (SELECT userId, movieId + 1 AS movieId FROM ratings) c
WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.userId = c.userId AND r.movieId = c.movieId)""")
def q_candidates_minus_seen(spark, sf_dir):
    """Candidate pairs (the item after each rated one) without rated pairs."""
    r = S.ratings(spark, sf_dir).select("userId", "movieId")
    return without_seen(r.select("userId", (F.col("movieId") + 1).alias("movieId")), r)


@query("metadata_gaps", with_ctes(M, L) + """
SELECT m.movieId, m.genres, k.tmdbId FROM movies m LEFT JOIN links k ON m.movieId = k.movieId
WHERE m.genres IS NULL OR k.tmdbId IS NULL""")
def q_metadata_gaps(spark, sf_dir):
    from reelhouse.operators.clean import missing_rows
    return missing_rows(_dim(spark, sf_dir), ["genres", "tmdbId"]).select("movieId", "genres", "tmdbId")


@query("user_recs_lookup", with_ctes(R, M, RECS_CTE) + f"""
SELECT r.userId, r.movieId, m.title, m.genres, r.rating FROM recs r LEFT JOIN movies m ON r.movieId = m.movieId
WHERE r.userId = {LOOKUP_USER} ORDER BY r.rating DESC, r.movieId LIMIT 10""")
def q_user_recs_lookup(spark, sf_dir):
    recs = rating_ranked_list(spark, sf_dir).filter(F.col("userId") == LOOKUP_USER)
    top = ranking.top_k(recs, [F.col("rating").desc(), F.col("movieId").asc()], 10)
    return lookup_attrs(top, S.movies(spark, sf_dir), "movieId", ["title", "genres"]) \
        .select("userId", "movieId", "title", "genres", "rating")


_ENRICHED = """enriched AS (
  SELECT r.userId, r.movieId, r.rating, m.title, m.genres, k.tmdbId
  FROM recs r LEFT JOIN movies m ON r.movieId = m.movieId LEFT JOIN links k ON r.movieId = k.movieId)"""


def _dim(spark, sf_dir):
    return S.movies(spark, sf_dir).join(S.links(spark, sf_dir).select("movieId", "tmdbId"), "movieId", "left")


@query("recs_enriched", with_ctes(R, M, L, RECS_CTE) + """
SELECT r.userId, r.movieId, r.rating, m.title, m.genres, k.tmdbId
FROM recs r JOIN movies m ON r.movieId = m.movieId JOIN links k ON r.movieId = k.movieId
WHERE k.tmdbId IS NOT NULL""")
def q_recs_enriched(spark, sf_dir):
    from reelhouse.operators.joins import enrich_recs
    dim = S.movies(spark, sf_dir).join(
        S.links(spark, sf_dir).filter(F.col("tmdbId").isNotNull()).select("movieId", "tmdbId"), "movieId", "inner")
    recs = rating_ranked_list(spark, sf_dir).select("userId", "movieId", "rating")
    return enrich_recs(recs, dim, how="inner", spread=["userId"]) \
        .select("userId", "movieId", "rating", "title", "genres", "tmdbId")


@query("missing_metadata", with_ctes(R, M, L, RECS_CTE, _ENRICHED) + """
SELECT count(*) AS total, count(*) FILTER (WHERE tmdbId IS NULL OR genres IS NULL) AS missing FROM enriched""")
def q_missing_metadata(spark, sf_dir):
    from reelhouse.operators.clean import any_null
    # Gap count of the left-enriched list (before any inner join), computed
    # from per-item counts: the dimension meets one row per item.
    per_item = agg.rec_popularity(rating_ranked_list(spark, sf_dir))
    e = per_item.join(_dim(spark, sf_dir), "movieId", "left")
    n = F.col("recommendation_count")
    return e.agg(F.sum(n).alias("total"),
                 F.coalesce(F.sum(F.when(any_null(["tmdbId", "genres"]), n)), F.lit(0)).alias("missing"))


@query("rec_coverage", with_ctes(R, M, L, RECS_CTE, _ENRICHED) + """
SELECT userId, count(*) AS recs, count(*) FILTER (WHERE tmdbId IS NOT NULL) AS enriched
FROM enriched GROUP BY userId""")
def q_rec_coverage(spark, sf_dir):
    from reelhouse.operators.joins import enrich_recs
    e = enrich_recs(rating_ranked_list(spark, sf_dir).select("userId", "movieId", "rating"),
                    _dim(spark, sf_dir), how="left", spread=["userId"])
    return e.groupBy("userId").agg(F.count(F.lit(1)).alias("recs"),
                                   F.count_if(F.col("tmdbId").isNotNull()).alias("enriched"))


TOP_EXPORT = 500
EXPORT_SQL = with_ctes(R, M, L, RECS_CTE) + f"""
SELECT p.movieId, m.title, k.tmdbId, p.recommendation_count FROM (
  SELECT movieId, count(*) AS recommendation_count FROM recs GROUP BY movieId) p
LEFT JOIN movies m ON p.movieId = m.movieId LEFT JOIN links k ON p.movieId = k.movieId
ORDER BY p.recommendation_count DESC, p.movieId LIMIT {TOP_EXPORT}"""


def most_recommended(spark, sf_dir, k: int = TOP_EXPORT):
    pop = agg.rec_popularity(rating_ranked_list(spark, sf_dir))
    top = ranking.top_k(pop, [F.col("recommendation_count").desc(), F.col("movieId").asc()], k)
    named = lookup_attrs(top, S.movies(spark, sf_dir), "movieId", ["title"])
    return lookup_attrs(named, S.links(spark, sf_dir), "movieId", ["tmdbId"]) \
        .select("movieId", "title", "tmdbId", "recommendation_count")


# ------------------------------------------------- SQL-string entry points --
# The same reports issued as SQL text against views, the way a notebook user
# queries the gold tables.
def _register(df: DataFrame, name: str) -> str:
    view = f"{name}_{abs(hash((name, id(df)))) % 10**8}"
    df.createOrReplaceTempView(view)
    return view


@query("user_recs_lookup_sql", with_ctes(R, M, RECS_CTE) + f"""
SELECT r.userId, m.title, m.genres, r.rating AS prediction FROM recs r LEFT JOIN movies m ON r.movieId = m.movieId
WHERE r.userId = {LOOKUP_USER} ORDER BY prediction DESC, r.movieId LIMIT 10""")
def q_user_recs_lookup_sql(spark, sf_dir):
    recs = rating_ranked_list(spark, sf_dir).select("userId", "movieId", F.col("rating").alias("prediction"))
    v = _register(with_titles(recs, S.movies(spark, sf_dir), cols=("title", "genres")), "gold_user_recommendations_enriched")
    return spark.sql(f"""SELECT userId, title, genres, prediction FROM {v}
                         WHERE userId = {LOOKUP_USER} ORDER BY prediction DESC, movieId LIMIT 10""")


@query("distinct_genres_sql", with_ctes(SILVER_SQL) + """
SELECT DISTINCT genre FROM (SELECT genre, row_number() OVER (PARTITION BY genre ORDER BY weightedRating DESC, tconst)
  AS rank_in_genre FROM genre_rows) WHERE rank_in_genre <= 20 ORDER BY genre""")
def q_distinct_genres_sql(spark, sf_dir):
    v = _register(scoring.top_per_genre(_title_dim(spark, sf_dir), 20), "gold_top20_per_genre")
    return spark.sql(f"SELECT DISTINCT genre FROM {v} ORDER BY genre")


GENRE_LOOKUP = "red"


@query("genre_lookup_sql", with_ctes(SILVER_SQL) + f"""
SELECT primaryTitle, round(weightedRating, 6) AS weightedRating, averageRating, numVotes, rank_in_genre FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY genre ORDER BY weightedRating DESC, tconst) AS INTEGER)
    AS rank_in_genre FROM genre_rows) WHERE rank_in_genre <= 20 AND genre = '{GENRE_LOOKUP}'""")
def q_genre_lookup_sql(spark, sf_dir):
    v = _register(scoring.top_per_genre(_title_dim(spark, sf_dir), 20), "gold_top20_per_genre")
    return spark.sql(f"""SELECT primaryTitle, round(weightedRating, 6) AS weightedRating, averageRating, numVotes,
                                rank_in_genre FROM {v} WHERE genre = '{GENRE_LOOKUP}' ORDER BY rank_in_genre""")
