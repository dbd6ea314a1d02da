import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from reelhouse.operators.profile import (centre_ratings, count_zscore, histogram, null_counts, profile,
                                         sparsity, top_gap, user_vs_global)


def _ratings(spark):
    data = [(1, 1, 4.0), (1, 2, 5.0), (1, 3, 3.0), (2, 1, 2.0), (2, 2, 4.0), (3, 1, 1.0)]
    return spark.createDataFrame(data, "userId int, movieId int, rating double"), data


def test_histogram_max_on_last_edge_and_bins_sum(spark):
    df = spark.createDataFrame([(None if x is None else float(x),) for x in [0, 1, 2, 3, 10, 10, None]], "v double")
    h = histogram(df, "v", 5).orderBy("bin").collect()
    assert [r["count"] for r in h] == [2, 2, 0, 0, 2]
    assert sum(r["count"] for r in h) == 6
    counts, edges = np.histogram([0, 1, 2, 3, 10, 10], bins=5)
    assert [r["count"] for r in h] == list(counts)
    assert np.allclose([r.lower for r in h], edges[:-1])


def test_null_counts_and_profile(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "x", None), (3, "x", None)], "a int, b string, c string")
    assert {r.column_name: r.missing for r in null_counts(df).collect()} == {"a": 0, "b": 1, "c": 2}
    p = {r.column_name: (r.dtype, r.missing_values, r.unique_values, r.sample_value) for r in profile(df).collect()}
    assert p == {"a": ("int", 0, 3, "1"), "b": ("string", 1, 1, "x"), "c": ("string", 2, 1, "a")}


def test_stats_match_pandas(spark):
    df, data = _ratings(spark)
    pdf = pd.DataFrame(data, columns=["userId", "movieId", "rating"])
    per = pdf.groupby("userId").size().sort_values(ascending=False)
    z = count_zscore(df).first()
    assert abs(z.z_score - (per.iloc[0] - per.mean()) / per.std()) < 1e-12
    g = top_gap(df).first()
    assert (g.top_user, g.top_count, g.second_user, g.second_count, g.difference) == (1, 3, 2, 2, 1)
    assert abs(g.percent_diff - 50.0) < 1e-12
    u = user_vs_global(df).first()
    assert u.userId == 1 and abs(u.global_avg - pdf.rating.mean()) < 1e-12 and abs(u.user_avg - 4.0) < 1e-12
    items = spark.createDataFrame([(i,) for i in range(1, 5)], "movieId int")
    assert abs(sparsity(df, items).first().sparsity - (1 - 6 / 12)) < 1e-12
    c = {(r.userId, r.movieId): r.normalized_rating for r in centre_ratings(df).collect()}
    assert abs(c[(1, 2)] - 1.0) < 1e-12 and abs(c[(3, 1)]) < 1e-12


def test_profile_handles_nested_and_map_columns(spark):
    df = spark.sql("SELECT 1 AS id, array('a', 'b') AS arr, map('k', 1) AS m, named_struct('x', 2) AS s "
                   "UNION ALL SELECT 2, NULL, NULL, NULL")
    p = {r.column_name: r for r in profile(df).collect()}
    assert p["arr"].missing_values == 1 and p["arr"].unique_values == 1
    assert p["m"].dtype.startswith("map") and p["m"].unique_values == 1 and p["m"].sample_value == "[{k, 1}]"


def test_layer_tables_managed_excludes_temp_views(spark):
    import uuid

    from reelhouse.session import scratch_path
    from reelhouse.sources.catalog import layer_tables
    from reelhouse.sources.tables import ensure_database, write_layer
    db = ensure_database(spark, f"rh_cat_{uuid.uuid4().hex[:6]}", scratch_path(spark, "cat_db"))
    write_layer(spark.range(3), f"{db}.gold_a")
    spark.range(2).createOrReplaceTempView("gold_tmp_view")
    every = {r.table_name for r in layer_tables(spark, "gold_", db).collect()}
    managed = {r.table_name for r in layer_tables(spark, "gold_", db, managed=True).collect()}
    assert "gold_tmp_view" in every and managed == {"gold_a"}


def test_distinct_counts_maps(spark):
    from reelhouse.operators.profile import distinct_counts
    df = spark.sql("SELECT map('a', 1, 'b', 2) AS m UNION ALL SELECT map('b', 2, 'a', 1) UNION ALL SELECT map('a', 3)")
    assert distinct_counts(df).first().unique_values == 2
