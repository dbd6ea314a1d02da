from pyspark.sql import functions as F

from reelhouse.functions.arrays import first_k, tag_set_count, tag_set_flag
from reelhouse.functions.strings import split_list
from reelhouse.operators.scoring import (director_names, silver_titles, top_per_genre,
                                         top_per_genre_unique, weighted_rating)
from reelhouse.operators.tags import tag_count_dist, tag_counts
from tests.conftest import rows

GENRES = [(1, "Drama"), (2, "Action|Comedy|Drama|Romance|War"), (3, None), (4, ""), (5, "(no genres listed)")]


def test_tag_counts_and_distribution(spark):
    df = spark.createDataFrame(GENRES, "movieId int, genres string")
    counts = dict(rows(tag_counts(df, "genres", "|")))
    assert counts["Drama"] == 2 and counts[""] == 1 and counts["(no genres listed)"] == 1 and None not in counts
    assert rows(tag_count_dist(df, "genres", "|")) == [(1, 3), (5, 1)]


def test_tag_set_flag_and_count_null_safe(spark):
    df = spark.createDataFrame(GENRES, "movieId int, genres string").withColumn("a", split_list("genres", "|"))
    out = df.select("movieId", tag_set_flag("a", ["Drama", "War"]).alias("f"),
                    tag_set_count("a", ["Drama", "War"]).alias("c"), first_k("a", 2).alias("k")).collect()
    got = {r.movieId: (r.f, r.c, r.k) for r in out}
    assert got[1] == (True, 1, ["Drama"]) and got[2] == (True, 2, ["Action", "Comedy"])
    assert got[3] == (False, 0, [])


def test_weighted_rating_bounds_zero_votes_and_single_title(spark):
    df = spark.createDataFrame([("a", 9.0, 1000), ("b", 5.0, 0), ("c", 7.0, 50)], "t string, averageRating double, numVotes int")
    out = {r.t: r.weightedRating for r in weighted_rating(df, m=50).collect()}
    c = 7.0
    assert abs(out["b"] - c) < 1e-12
    assert c <= out["a"] <= 9.0 and abs(out["c"] - 7.0) < 1e-12
    one = spark.createDataFrame([("x", 6.5, 3)], "t string, averageRating double, numVotes int")
    assert abs(weighted_rating(one).first().weightedRating - 6.5) < 1e-12


def _title_fixture(spark):
    basics = spark.createDataFrame([
        ("tt1", "movie", "One", "2005", "90", "Drama,Romance,Comedy"),
        ("tt2", "movie", "Two", "2031", "80", "Drama"),          # start year in the future
        ("tt3", "short", "Three", "2010", "5", "Drama"),         # wrong type
        ("tt4", "movie", "Four", "2012", "\\N", "Comedy,Drama"),
        ("tt5", "movie", "Five", "2015", "100", "Drama"),        # votes below minimum
    ], "tconst string, titleType string, primaryTitle string, startYear string, runtimeMinutes string, genres string")
    akas = spark.createDataFrame([
        ("tt1", "1", "en", "US"), ("tt1", "2", "nl", "BE"), ("tt2", "1", "en", "US"),
        ("tt3", "1", "en", "US"), ("tt4", "1", None, "US"), ("tt4", "2", "en", "FR"), ("tt4", "3", "nl", "NL"),
        ("tt5", "1", "en", "GB")], "titleId string, ordering string, language string, region string")
    ratings = spark.createDataFrame([("tt1", "8.1", "100"), ("tt2", "9.0", "100"), ("tt3", "7", "10"),
                                     ("tt4", "6.0", "20"), ("tt5", "9.9", "2")],
                                    "tconst string, averageRating string, numVotes string")
    return basics, akas, ratings


def test_silver_titles_filters_and_one_row_per_title(spark):
    b, a, r = _title_fixture(spark)
    s = silver_titles(b, a, r, as_of_year=2025)
    got = {x.tconst: (x.language, x.region) for x in s.collect()}
    assert got == {"tt1": ("nl", "BE"), "tt4": ("nl", "NL")}
    assert silver_titles(b, a, r, as_of_year=2025, min_votes=0).count() == 3


def test_director_names_two_unknown_null(spark):
    crew = spark.createDataFrame([("tt1", "nm1,nm2"), ("tt2", "nm1,nm9"), ("tt3", None)], "tconst string, directors string")
    names = spark.createDataFrame([("nm1", "Ann"), ("nm2", "Bob")], "nconst string, primaryName string")
    titles = spark.createDataFrame([("tt1",), ("tt2",), ("tt3",)], "tconst string")
    got = {r.tconst: r.directorNames for r in director_names(crew, names, titles).collect()}
    assert got == {"tt1": ["Ann", "Bob"], "tt2": ["Ann"]}


def test_per_genre_rank_and_unique_tiebreak(spark):
    dim = spark.createDataFrame([("t1", "A,B,C", 8.0, 1), ("t2", "A", 7.0, 0), ("t3", "B", 9.0, 0)],
                                "tconst string, genres string, weightedRating double, tag_set_count int")
    per = {(r.genre, r.tconst): r.rank_in_genre for r in top_per_genre(dim, 1).collect()}
    assert per == {("A", "t1"): 1, ("B", "t3"): 1, ("C", "t1"): 1}
    uniq = {r.tconst: r.genre for r in top_per_genre_unique(dim, 20).collect()}
    assert uniq["t1"] == "A"  # same scores in A, B, C: genre name breaks the tie


def test_title_results_do_not_depend_on_layout(spark):
    b, a, r = _title_fixture(spark)
    base = sorted(map(tuple, silver_titles(b, a, r, as_of_year=2025).collect()))
    for n in (1, 7):
        got = silver_titles(b.repartition(n), a.repartition(n), r.repartition(n), as_of_year=2025)
        assert sorted(map(tuple, got.collect())) == base
    dim = spark.createDataFrame([("t1", "A,B,C", 8.0, 1), ("t2", "A,B", 8.0, 1), ("t3", "B", 9.0, 0)],
                                "tconst string, genres string, weightedRating double, tag_set_count int")
    ref = sorted(map(tuple, top_per_genre_unique(dim, 20).collect()))
    for n in (1, 7):
        assert sorted(map(tuple, top_per_genre_unique(dim.repartition(n), 20).collect())) == ref


def test_tag_means_by_key_equals_row_level(spark):
    from reelhouse.operators.tags import tag_means, tag_means_by_key
    fact = spark.createDataFrame([(1, 4.0), (1, 2.0), (2, 5.0), (3, 1.0), (9, 3.0)], "movieId int, rating double")
    dim = spark.createDataFrame([(1, "A|B"), (2, "B"), (3, None)], "movieId int, genres string")
    row_level = {r.tag: (r.avg_rating, r.n) for r in tag_means(fact.join(dim, "movieId"), "genres", "|", "rating").collect()}
    pre = {r.tag: (r.avg_rating, r.n) for r in tag_means_by_key(fact, dim, "movieId", "genres", "|", "rating").collect()}
    assert row_level == pre == {"A": (3.0, 2), "B": (11.0 / 3, 3)}
