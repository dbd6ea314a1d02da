"""The plans we rely on at scale: pushdown, pruning, bounded top-k, partial aggregates."""

from pyspark.sql import functions as F

from reelhouse.operators.aggregates import user_dim
from reelhouse.operators.clean import dedup_latest
from reelhouse.plans import standins as S
from reelhouse.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_point_lookup_pushes_filter_and_prunes_columns(spark):
    li = S.table(spark, SF, "lineitem").filter(F.col("l_partkey") == 1).select("l_orderkey")
    p = _plan(li)
    assert "PushedFilters: [IsNotNull(l_partkey), EqualTo(l_partkey,1)]" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in p


def test_dedup_is_partial_aggregate(spark):
    p = _plan(S.ratings(spark, SF))
    assert "partial_max" in p
    assert "Window" not in p and "RoundRobinPartitioning" not in p


def test_global_top_k_is_take_ordered(spark):
    p = _plan(QUERIES["top_items_min_count"](spark, SF))
    assert "TakeOrderedAndProject" in p


def test_user_dim_has_partial_aggregate(spark):
    p = _plan(user_dim(S.ratings(spark, SF)))
    assert "partial_count" in p and "partial_avg" in p


def test_bounded_lookup_filters_dimension_with_broadcast_keys(spark):
    p = _plan(QUERIES["item_leaderboard_join_titles"](spark, SF))
    assert "LeftSemi" in p and "BroadcastExchange" in p


def test_partitioned_fact_read_prunes_partitions(spark):
    import uuid

    from reelhouse.session import scratch_path
    from reelhouse.sources.tables import ensure_database, write_layer
    db = ensure_database(spark, f"rh_plan_{uuid.uuid4().hex[:6]}", scratch_path(spark, "plan_db"))
    df = spark.range(100).select(F.col("id"), F.date_add(F.lit("2020-01-01").cast("date"),
                                                         (F.col("id") % 10).cast("int")).alias("d"))
    write_layer(df, f"{db}.f", partition_by=["d"])
    q = spark.table(f"{db}.f").filter(F.col("d") == F.lit("2020-01-03").cast("date"))
    assert "PartitionFilters: [isnotnull(d" in _plan(q) and q.count() == 10


def test_month_grain_read_prunes_partitions(spark):
    import uuid

    from reelhouse.session import scratch_path
    from reelhouse.sources.tables import date_range_filter, ensure_database, with_date_partition, write_layer
    db = ensure_database(spark, f"rh_plan_{uuid.uuid4().hex[:6]}", scratch_path(spark, "plan_db"))
    df = spark.range(400).select(F.col("id"), F.date_add(F.lit("2020-01-01").cast("date"),
                                                         F.col("id").cast("int")).alias("d"))
    df, part = with_date_partition(df, "d", "month")
    write_layer(df, f"{db}.m", partition_by=[part])
    q = spark.table(f"{db}.m").filter(date_range_filter("d", "2020-02-10", "2020-03-05", "month"))
    assert "PartitionFilters: [isnotnull(d_month" in _plan(q)
    assert q.count() == 25  # Feb 10 .. Mar 5 2020 (leap year)


def test_lookup_streams_the_dimension_past_the_bounded_keys(spark):
    from reelhouse.operators.joins import lookup_attrs
    big = spark.range(50).select(F.col("id").cast("int").alias("movieId"))
    dim = spark.range(100).select(F.col("id").cast("int").alias("movieId"), F.col("id").cast("string").alias("t"))
    out = lookup_attrs(big, dim, "movieId", ["t"])
    assert "LeftSemi" in _plan(out) and out.count() == 50
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:  # no hint: beyond the threshold the same plan shuffles
        assert "BroadcastExchange" not in _plan(lookup_attrs(big, dim, "movieId", ["t"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_uncut_title_dim_and_small_cut(spark):
    """The top-title table and the director lookup at a cut below every test scale."""
    import duckdb

    from reelhouse.operators import scoring
    from reelhouse.plans import queries as Q
    top, directors = 60, 25
    full = QUERIES["title_dim"](spark, SF)
    small = scoring.title_dim(Q._silver(spark, SF, top), S.title_crew(spark, SF), S.name_basics(spark, SF), director_k=directors)
    small = small.select("tconst", F.round("weightedRating", 6).alias("weightedRating"),
                         F.when(F.size("directorNames") > 0, F.array_join("directorNames", ",")).alias("directorNames"))
    con = duckdb.connect()
    for t in ("part", "lineitem", "supplier", "partsupp", "orders", "customer"):
        try:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
        except duckdb.IOException:
            pass
    want = con.execute(Q.with_ctes(Q.silver_sql(top, directors)) + "SELECT tconst, round(weightedRating, 6), directorNames FROM dim").fetchall()
    assert sorted(map(tuple, small.collect())) == sorted(want)
    assert full.count() > top == small.count()
    assert 0 < small.where("directorNames is not null").count() <= directors
    assert "TakeOrderedAndProject" not in _plan(full)
    assert "WindowGroupLimit" in _plan(QUERIES["top20_per_genre"](spark, SF))
