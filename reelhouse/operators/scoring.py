"""Vote-weighted scores and the title-pipeline rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.functions.arrays import tag_set_count, tag_set_flag
from reelhouse.functions.casts import safe_cast
from reelhouse.functions.strings import split_list
from reelhouse.operators.aggregates import collect_names
from reelhouse.operators.clean import dedup_latest, not_future
from reelhouse.operators.ranking import best_row_window, top_k, top_n_per_group

# Fixed values of the reference pipeline, kept as defaults.
DEFAULT_PRIOR_VOTES = 50
DEFAULT_TITLE_TYPE = "movie"
DEFAULT_FIRST_YEAR = 2000
DEFAULT_LANGUAGES = ("en", "nl")
DEFAULT_REGIONS = ("US", "GB", "NL", "BE", "AU")
DEFAULT_MIN_VOTES = 5
DEFAULT_SILVER_TOP = 1000
DEFAULT_TOP = 20
DEFAULT_TAG_SET = ("Romance", "Comedy", "Family", "Musical", "Drama", "Biography", "History")


def weighted_rating(df: DataFrame, rating: str = "averageRating", votes: str = "numVotes",
                    m: float = DEFAULT_PRIOR_VOTES, out: str = "weightedRating") -> DataFrame:
    """Bayesian average ``v/(v+m)*R + m/(v+m)*C``, ``C`` the mean rating of
    ``df``.  ``C`` is a scalar subquery evaluated inside the plan: no
    driver collect, no join."""
    c = df.select(F.avg(F.col(rating).cast("double"))).scalar()
    v = F.col(votes).cast("double")
    r = F.col(rating).cast("double")
    both = v + F.lit(float(m))  # 0 when m = 0 and nobody voted: no score
    return df.withColumn(out, F.try_divide(v, both) * r + F.try_divide(F.lit(float(m)), both) * c)


def typed_title_basics(basics: DataFrame) -> DataFrame:
    return basics.withColumns({"startYear": safe_cast("startYear", "int"),
                               "runtimeMinutes": safe_cast("runtimeMinutes", "int")})


def typed_title_ratings(ratings: DataFrame) -> DataFrame:
    return ratings.withColumns({"averageRating": safe_cast("averageRating", "float"),
                                "numVotes": safe_cast("numVotes", "int")})


def silver_titles(basics: DataFrame, akas: DataFrame, ratings: DataFrame, as_of_year: int,
                  title_type: str = DEFAULT_TITLE_TYPE, first_year: int = DEFAULT_FIRST_YEAR,
                  languages: Sequence[str] = DEFAULT_LANGUAGES,
                  regions: Sequence[str] = DEFAULT_REGIONS,
                  min_votes: int = DEFAULT_MIN_VOTES, k: int | None = None) -> DataFrame:
    """Titles of a type, year window, language and region set; with ``k``
    only the top ``k`` by rating (``DEFAULT_SILVER_TOP`` for the top-title
    table), without it all of them.

    Filters run before the joins (they reach the scans), one row is kept per
    title (best rating, then votes, then language/region, so the kept aka is
    fixed; the akas are reduced to that row before the joins) and only then
    an ordered top-``k`` is taken.  ``min_votes=0`` disables the vote floor.
    """
    b = typed_title_basics(basics).filter(
        (F.col("titleType") == title_type) & (F.col("startYear") >= first_year)
        & not_future("startYear", as_of_year))
    a = (akas.filter(F.col("language").isNotNull() & F.col("language").isin(list(languages))
                     & F.col("region").isin(list(regions)))
         .select(F.col("titleId"), "language", "region"))
    # The kept aka of a title is its greatest (language, region): reduce the
    # akas (many rows per title) to that one row with a partial aggregate
    # before joining, so the joins see one row per title.
    a = dedup_latest(a, ["titleId"], ["language", "region"])
    r = typed_title_ratings(ratings).select("tconst", "averageRating", "numVotes")
    if min_votes:
        r = r.filter(F.col("numVotes") >= min_votes)
    joined = (b.join(a, b["tconst"] == a["titleId"], "inner").drop("titleId")
              .join(r, "tconst", "inner"))
    one = dedup_latest(joined, ["tconst"], ["averageRating", "numVotes", "language", "region"])
    return one if k is None else top_titles(one, k)


def top_titles(df: DataFrame, k: int) -> DataFrame:
    """The ``k`` best titles by rating, then votes, then id."""
    return top_k(df, [F.col("averageRating").desc(), F.col("numVotes").desc(), F.col("tconst").asc()], k)


def title_fact(silver: DataFrame) -> DataFrame:
    """Gold fact of the title pipeline: id, rating (double), votes (int)."""
    return silver.select("tconst", safe_cast("averageRating", "double").alias("averageRating"),
                         safe_cast("numVotes", "int").alias("numVotes"))


def director_names(crew: DataFrame, names: DataFrame, titles: DataFrame) -> DataFrame:
    """Director names per title (sorted list) for the given titles.

    The list is the split of one crew row, so the grouped collect is bounded
    by that row's length; unknown ids give no name.
    """
    crew1 = crew.join(titles.select("tconst"), "tconst", "inner")
    exploded = crew1.select("tconst", F.explode(split_list("directors", ",")).alias("directorId"))
    named = exploded.join(names.select("nconst", "primaryName"),
                          exploded["directorId"] == names["nconst"], "left")
    return collect_names(named.select("tconst", F.col("primaryName").alias("directorName")),
                         "tconst", "directorName", "directorNames")


def title_dim(silver: DataFrame, crew: DataFrame, names: DataFrame,
              m: float = DEFAULT_PRIOR_VOTES, director_k: int | None = None,
              tags: Sequence[str] = DEFAULT_TAG_SET) -> DataFrame:
    """Every silver title + weighted rating + director list + tag-set flag
    and count (``genres`` is a comma list).

    ``director_k`` bounds the director lookup to the best titles (the others
    get a NULL list); no title is dropped.  ``silver`` is read by three
    branches (the mean C, the rows and the director lookup): pass a written
    layer table, not a chain of joins.
    """
    dim = weighted_rating(silver.withColumns({
        "averageRating": safe_cast("averageRating", "double"),
        "numVotes": safe_cast("numVotes", "int")}), m=m)
    dirs = director_names(crew, names, dim if director_k is None else top_titles(dim, director_k))
    arr = split_list("genres", ",")
    return (dim.join(dirs, "tconst", "left")
            .withColumn("genres_array", arr)
            .withColumn("tag_set_flag", tag_set_flag("genres_array", tags))
            .withColumn("tag_set_count", tag_set_count("genres_array", tags)))


def top_per_genre(dim: DataFrame, n: int = DEFAULT_TOP) -> DataFrame:
    """Top ``n`` titles per genre by weighted rating, rank kept."""
    g = dim.withColumn("genre", F.explode(split_list("genres", ",")))
    return top_n_per_group(g, ["genre"], [F.col("weightedRating").desc(), F.col("tconst").asc()],
                           n, rank_col="rank_in_genre")


def top_per_genre_tagset(dim: DataFrame, n: int = DEFAULT_TOP) -> DataFrame:
    """Top ``n`` per genre by (tag-set count, weighted rating)."""
    g = dim.withColumn("genre", F.explode(split_list("genres", ",")))
    return top_n_per_group(g, ["genre"], [F.col("tag_set_count").desc(),
                                          F.col("weightedRating").desc(), F.col("tconst").asc()], n)


def top_per_genre_unique(dim: DataFrame, n: int = DEFAULT_TOP) -> DataFrame:
    """:func:`top_per_genre_tagset`, then one row per title; the genre name
    breaks the tie between a title's genre copies."""
    per = top_per_genre_tagset(dim, n)
    return best_row_window(per, ["tconst"], [F.col("tag_set_count").desc(),
                                            F.col("weightedRating").desc(), F.col("genre").asc()])
