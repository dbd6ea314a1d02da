"""Declared table contracts (no schema inference anywhere).

Bronze tables are all strings; the typed contracts are what the silver and
gold layers produce.
"""

from __future__ import annotations

from pyspark.sql import types as T


def all_strings(*names: str) -> T.StructType:
    """Bronze contract: every column a nullable string."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# --- ratings pipeline, raw (bronze) ----------------------------------------
RATINGS_RAW = all_strings("userId", "movieId", "rating", "timestamp")
MOVIES_RAW = all_strings("movieId", "title", "genres")
LINKS_RAW = all_strings("movieId", "imdbId", "tmdbId")

# --- ratings pipeline, typed -----------------------------------------------
RATINGS = T.StructType([
    T.StructField("userId", T.IntegerType(), True),
    T.StructField("movieId", T.IntegerType(), True),
    T.StructField("rating", T.FloatType(), True),
    T.StructField("timestamp", T.LongType(), True),
])
MOVIES = T.StructType([
    T.StructField("movieId", T.IntegerType(), True),
    T.StructField("title", T.StringType(), True),
    T.StructField("genres", T.StringType(), True),
])
LINKS = T.StructType([
    T.StructField("movieId", T.IntegerType(), True),
    T.StructField("imdbId", T.StringType(), True),
    T.StructField("tmdbId", T.IntegerType(), True),
])
USER_DIM = T.StructType([
    T.StructField("userId", T.IntegerType(), True),
    T.StructField("num_ratings", T.LongType(), False),
    T.StructField("avg_rating", T.DoubleType(), True),
])
REC = T.StructType([
    T.StructField("userId", T.IntegerType(), True),
    T.StructField("movieId", T.IntegerType(), True),
    T.StructField("prediction", T.FloatType(), True),
])
NESTED_RECS = T.StructType([
    T.StructField("userId", T.IntegerType(), True),
    T.StructField("recommendations", T.ArrayType(T.StructType([
        T.StructField("movieId", T.IntegerType(), True),
        T.StructField("rating", T.FloatType(), True),
    ])), True),
])
RUN_METRICS = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("rank", T.IntegerType(), False),
    T.StructField("maxIter", T.IntegerType(), False),
    T.StructField("regParam", T.DoubleType(), False),
    T.StructField("nonnegative", T.BooleanType(), False),
    T.StructField("rmse", T.DoubleType(), True),
])

# --- metadata payloads (landed JSON, parsed with from_json) ----------------
NAMED = T.StructType([T.StructField("id", T.LongType(), True),
                      T.StructField("name", T.StringType(), True)])
DETAILS_PAYLOAD = T.StructType([
    T.StructField("id", T.LongType(), True),
    T.StructField("title", T.StringType(), True),
    T.StructField("genres", T.ArrayType(NAMED), True),
    T.StructField("release_date", T.StringType(), True),
    T.StructField("overview", T.StringType(), True),
    T.StructField("runtime", T.IntegerType(), True),
    T.StructField("vote_average", T.DoubleType(), True),
    T.StructField("poster_path", T.StringType(), True),
    T.StructField("status_code", T.IntegerType(), True),
])
CREDITS_PAYLOAD = T.StructType([
    T.StructField("id", T.LongType(), True),
    T.StructField("poster_path", T.StringType(), True),
    T.StructField("crew", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType(), True),
        T.StructField("job", T.StringType(), True),
    ])), True),
    T.StructField("cast", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType(), True),
        T.StructField("order", T.IntegerType(), True),
    ])), True),
])
ALT_PAYLOAD = T.StructType([
    T.StructField("Response", T.StringType(), True),
    T.StructField("Title", T.StringType(), True),
    T.StructField("Director", T.StringType(), True),
    T.StructField("Actors", T.StringType(), True),
    T.StructField("Poster", T.StringType(), True),
    T.StructField("Error", T.StringType(), True),
])

# --- title pipeline, raw (tab separated, all strings) ----------------------
TITLE_BASICS_RAW = all_strings("tconst", "titleType", "primaryTitle", "startYear",
                               "runtimeMinutes", "genres")
NAME_BASICS_RAW = all_strings("nconst", "primaryName")
TITLE_RATINGS_RAW = all_strings("tconst", "averageRating", "numVotes")
TITLE_PRINCIPALS_RAW = all_strings("tconst", "nconst", "ordering")
TITLE_CREW_RAW = all_strings("tconst", "directors")
TITLE_AKAS_RAW = all_strings("titleId", "ordering", "language", "region")
