import uuid

from pyspark.sql import functions as F

from reelhouse import schemas
from reelhouse.plans import pipelines as P
from reelhouse.plans import standins as S
from reelhouse.session import scratch_path
from reelhouse.sources import files
from reelhouse.sources.catalog import table_report
from reelhouse.sources.tables import ensure_database
from reelhouse.streaming import ingest_to_bronze

SF = "/root/testdata/sf0.001"


def _db(spark):
    name = f"rh_pipe_{uuid.uuid4().hex[:8]}"
    return ensure_database(spark, name, scratch_path(spark, name))


def test_stream_ingest_is_incremental(spark):
    root = scratch_path(spark, "t_stream")
    df = spark.createDataFrame([("1", "A", "x|y"), ("2", "B", None)], schemas.MOVIES_RAW)
    files.export_csv(df, f"{root}/landing/w1")
    ingest_to_bronze(spark, f"{root}/landing/*", schemas.MOVIES_RAW, f"{root}/bronze", f"{root}/ckpt")
    assert spark.read.parquet(f"{root}/bronze").count() == 2
    files.export_csv(df.limit(1), f"{root}/landing/w2")
    ingest_to_bronze(spark, f"{root}/landing/*", schemas.MOVIES_RAW, f"{root}/bronze", f"{root}/ckpt")
    assert spark.read.parquet(f"{root}/bronze").count() == 3
    ingest_to_bronze(spark, f"{root}/landing/*", schemas.MOVIES_RAW, f"{root}/bronze", f"{root}/ckpt")
    assert spark.read.parquet(f"{root}/bronze").count() == 3  # nothing new, nothing re-read


def test_ratings_pipeline_end_to_end(spark):
    db = _db(spark)
    raw = {"ratings": S.ratings_raw(spark, SF).select("userId", "movieId", "rating", "timestamp"),
           "movies": S.movies(spark, SF), "links": S.links(spark, SF)}
    cfg = P.RatingsPipelineConfig(date_partitions=False)
    metrics = P.ratings_pipeline(spark, raw, db, cfg)
    assert len(metrics) == 2 and all(v is not None and v > 0 for v in metrics.values())
    rep = {r.table_name: r.row_count for r in table_report(spark, "", db).collect()}
    silver = rep["silver_fact_ratings"]
    assert silver == S.ratings(spark, SF).count() == rep["gold_fact_ratings"]
    assert rep["silver_dim_users"] == rep["gold_dim_users"] == rep["gold_power_users"]
    recs = spark.table(f"{db}.gold_user_recommendations")
    assert recs.groupBy("userId").count().agg(F.max("count")).first()[0] == 10
    seen = spark.table(f"{db}.gold_fact_ratings").select("userId", "movieId")
    assert recs.join(seen, ["userId", "movieId"]).count() == 0
    assert rep["gold_user_recommendations_enriched"] <= rep["gold_user_recommendations_flat"]


def test_title_pipeline_end_to_end(spark):
    db = _db(spark)
    raw = {"title_basics": S.title_basics(spark, SF), "title_akas": S.title_akas(spark, SF),
           "title_ratings": S.title_ratings(spark, SF), "title_crew": S.title_crew(spark, SF),
           "name_basics": S.name_basics(spark, SF)}
    P.title_pipeline(spark, raw, db, as_of_year=2025)
    top = spark.table(f"{db}.gold_top_recommendations").collect()
    assert len(top) == 20
    per = spark.table(f"{db}.gold_top20_per_genre")
    assert per.groupBy("genre").count().agg(F.max("count")).first()[0] <= 20
    uniq = spark.table(f"{db}.gold_top20_per_genre_unique")
    assert uniq.count() == uniq.select("tconst").distinct().count()


def test_gold_titles_are_not_cut_by_the_top_title_table(spark):
    db = _db(spark)
    raw = {"title_basics": S.title_basics(spark, SF), "title_akas": S.title_akas(spark, SF),
           "title_ratings": S.title_ratings(spark, SF), "title_crew": S.title_crew(spark, SF),
           "name_basics": S.name_basics(spark, SF)}
    P.title_pipeline(spark, raw, db, as_of_year=2025, silver_top=5)
    n = {t: spark.table(f"{db}.{t}").count() for t in ("silver_movies_top", "silver_movies", "gold_title_fact_ratings", "gold_fact_weighted",
                                                       "gold_dim_titles_enriched", "gold_top_recommendations")}
    assert n["silver_movies_top"] == 5 and n["gold_top_recommendations"] == 20 and n["silver_movies"] > 20
    assert n["silver_movies"] == n["gold_title_fact_ratings"] == n["gold_fact_weighted"] == n["gold_dim_titles_enriched"]


def test_title_pipeline_from_gzip_dumps(spark):
    import importlib.util
    import os
    spec = importlib.util.spec_from_file_location(
        "run_pipeline", os.path.join(os.path.dirname(os.path.dirname(__file__)), "scripts", "run_pipeline.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    root = scratch_path(spark, "t_dumps")
    _, dumps = mod.land_raw(spark, SF, root)
    db = _db(spark)
    P.title_pipeline_from_dumps(spark, dumps, db, as_of_year=2025, repartition=4)
    basics = spark.table(f"{db}.bronze_title_basics")
    assert basics.count() == S.title_basics(spark, SF).count()        # header lines scrubbed, keys unique
    assert basics.filter(F.col("tconst") == "tconst").count() == 0
    direct = _db(spark)
    P.title_pipeline(spark, {"title_basics": S.title_basics(spark, SF), "title_akas": S.title_akas(spark, SF),
                             "title_ratings": S.title_ratings(spark, SF), "title_crew": S.title_crew(spark, SF),
                             "name_basics": S.name_basics(spark, SF)}, direct, as_of_year=2025)
    a = sorted(map(tuple, spark.table(f"{db}.gold_top20_per_genre_unique").select("tconst", "genre").collect()))
    b = sorted(map(tuple, spark.table(f"{direct}.gold_top20_per_genre_unique").select("tconst", "genre").collect()))
    assert a == b


def test_ratings_pipeline_with_dirty_rows(spark):
    db = _db(spark)
    good = S.ratings_raw(spark, SF).select("userId", "movieId", "rating", "timestamp")
    good = good.select([F.col(c).cast("string") for c in good.columns])
    dirty = spark.createDataFrame([("x", "1", "4.0", "1130632200"), ("3", "862.0", "", "1130635800"),
                                   ("99999999999", "2", "3.5", None)], "userId string, movieId string, rating string, timestamp string")
    raw = {"ratings": good.unionByName(dirty), "movies": S.movies(spark, SF), "links": S.links(spark, SF)}
    cfg = P.RatingsPipelineConfig(date_partitions=False)
    cfg.als = cfg.als.__class__(max_iter=2)
    cfg.publish_als = cfg.publish_als.__class__(max_iter=2, nonnegative=False)
    metrics = P.ratings_pipeline(spark, raw, db, cfg)
    assert len(metrics) == 2
    silver = spark.table(f"{db}.silver_fact_ratings")
    assert silver.filter(F.col("userId").isNull()).count() == 2      # 'x' and the overflow: keys (NULL, 1), (NULL, 2)
    assert silver.filter((F.col("userId") == 3) & (F.col("movieId") == 862)).first().rating is None
