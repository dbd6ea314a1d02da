"""The two layer pipelines as ordinary function chains.

Every step reads the previous layer's table (written once), so each layer
is computed once and later steps never re-run its lineage.  Table names
follow the reference's layers; ``db`` is the catalog database to write to.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.functions.casts import epoch_to_ts, id_from_text, safe_cast, to_day
from reelhouse.functions.strings import split_list
from reelhouse.operators import aggregates as agg
from reelhouse.operators import recsys, scoring
from reelhouse.operators.clean import any_null, dedup_latest, scrub_header_rows, scrub_null_token
from reelhouse.operators.joins import enrich_recs, lookup_attrs, small_side_hashed
from reelhouse.operators.ranking import top_k
from reelhouse.session import scratch_path, written
from reelhouse.sources import files
from reelhouse.sources.tables import (append_run, merge_wave, overwrite_partitions, recover, touched, with_date_partition, with_key_bucket,
                                      write_layer)


@dataclass
class RatingsPipelineConfig:
    fmt: str = "parquet"
    recs_per_user: int = 10
    export_top: int = 500
    date_partitions: bool = True
    date_grain: str = "day"
    #: Key buckets of the silver fact: set it when later waves are to be merged (``ratings_top_up``).
    key_buckets: int | None = None
    als: recsys.AlsConfig = field(default_factory=recsys.AlsConfig)
    publish_als: recsys.AlsConfig = field(default_factory=lambda: recsys.AlsConfig(nonnegative=False))
    exclude_seen_published: bool = True
    export_dir: str | None = None
    model_dir: str | None = None
    #: Time of the run (UTC): names its rows in the run log, so a step that
    #: is run again for the same time does not log twice.
    run_at: str = field(default_factory=lambda: datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S"))


def _t(db: str, name: str) -> str:
    return f"{db}.{name}" if db else name


def ratings_bronze(spark: SparkSession, raw: Mapping[str, DataFrame], db: str, fmt: str = "parquet") -> None:
    """Raw ratings/movies/links (all strings) stored untransformed."""
    for name in ("ratings", "movies", "links"):
        df = raw[name]
        write_layer(df.select([F.col(c).cast("string") for c in df.columns]), _t(db, f"bronze_{name}_csv"), fmt=fmt)


KEYS, LATEST = ["userId", "movieId"], ["timestamp", "rating"]


def _typed_ratings(raw: DataFrame) -> DataFrame:
    """Bronze rating rows, typed, one per key."""
    typed = raw.select(id_from_text("userId").alias("userId"), id_from_text("movieId").alias("movieId"),
                       safe_cast("rating", "float").alias("rating"),
                       safe_cast("timestamp", "long").alias("timestamp"))
    return dedup_latest(typed, KEYS, LATEST).withColumn("timestamp_ts", epoch_to_ts("timestamp"))


def ratings_silver(spark: SparkSession, db: str, fmt: str = "parquet", key_buckets: int | None = None) -> None:
    """Silver tables; with ``key_buckets`` the fact is kept by key bucket, so
    that :func:`ratings_top_up` can merge later waves."""
    fact, name = _typed_ratings(spark.table(_t(db, "bronze_ratings_csv"))), _t(db, "silver_fact_ratings")
    if key_buckets:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        merge_wave(fact, name, KEYS, LATEST, key_buckets, fmt, True)
    else:
        write_layer(fact, name, fmt=fmt)
    m = spark.table(_t(db, "bronze_movies_csv"))
    movies = dedup_latest(m.select(id_from_text("movieId").alias("movieId"), "title", "genres"),
                          ["movieId"], ["title", "genres"]).withColumn("genres_array", split_list("genres", "|"))
    links = spark.table(_t(db, "bronze_links_csv")).select(
        id_from_text("movieId").alias("movieId"), "imdbId", id_from_text("tmdbId").alias("tmdbId"))
    links = dedup_latest(links, ["movieId"], ["tmdbId", "imdbId"])
    write_layer(movies.join(links, "movieId", "left"), _t(db, "silver_dim_movies_enriched"), fmt=fmt)
    users = agg.user_dim(spark.table(_t(db, "silver_fact_ratings")))
    write_layer(users, _t(db, "silver_dim_users"), fmt=fmt)


def ratings_gold(spark: SparkSession, db: str, cfg: RatingsPipelineConfig) -> None:
    f = spark.table(_t(db, "silver_fact_ratings")).drop("key_bucket").withColumn("rating_date", to_day("timestamp_ts"))
    f, part = with_date_partition(f, "rating_date", cfg.date_grain)
    write_layer(f, _t(db, "gold_fact_ratings"), fmt=cfg.fmt,
                partition_by=[part] if cfg.date_partitions else None, recreate=True)
    write_layer(spark.table(_t(db, "silver_dim_users")), _t(db, "gold_dim_users"), fmt=cfg.fmt)


def ratings_top_up(spark: SparkSession, raw: DataFrame, db: str, cfg: RatingsPipelineConfig) -> None:
    """Merge a later wave of raw ratings into bronze, gold and silver.

    Only the key buckets of the wave's keys are read from silver, and only the
    days that a changed rating leaves or enters are rewritten in gold (a rating
    given anew moves to its new day; a day it was alone in becomes empty).
    Gold goes first: until silver is merged the same wave gives the same change, so
    a wave broken off anywhere may simply be run again, and one that comes twice changes
    nothing but bronze.  The user dimension is refreshed from the merged fact."""
    if not (cfg.key_buckets and cfg.date_partitions):
        raise ValueError("top-ups need key_buckets and date_partitions")
    silver, gold = _t(db, "silver_fact_ratings"), _t(db, "gold_fact_ratings")
    for name in (silver, gold):
        recover(spark, name)
    raw = written(raw.select(*(F.col(c).cast("string") for c in ("userId", "movieId", "rating", "timestamp"))), "wave")
    wave = written(with_key_bucket(_typed_ratings(raw), KEYS, cfg.key_buckets), "wave_typed")
    keys = wave.select(*(F.col(k).alias(f"_{k}") for k in KEYS))
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEYS))
    with small_side_hashed(spark):
        before = written(touched(spark.table(silver), wave, ["key_bucket"]).join(keys, same, "left_semi"), "wave_before")
    after = dedup_latest(before.unionByName(wave), KEYS, LATEST)

    def by_day(rows):
        return with_date_partition(rows.drop("key_bucket").withColumn("rating_date", to_day("timestamp_ts")), "rating_date", cfg.date_grain)

    (old, part), new = by_day(before), by_day(after)[0]
    days = written(old.select(part).unionByName(new.select(part)).distinct(), "wave_days")
    stay = touched(spark.table(gold), days, [part]).join(keys, same, "left_anti")
    with small_side_hashed(spark):
        overwrite_partitions(stay.unionByName(new), gold, cfg.fmt, also=days)
    merge_wave(wave.drop("key_bucket"), silver, KEYS, LATEST, cfg.key_buckets, cfg.fmt, True)
    raw.write.format(cfg.fmt).mode("append").saveAsTable(_t(db, "bronze_ratings_csv"))
    users = agg.user_dim(spark.table(silver))
    write_layer(users, _t(db, "silver_dim_users"), fmt=cfg.fmt)
    write_layer(spark.table(_t(db, "silver_dim_users")), _t(db, "gold_dim_users"), fmt=cfg.fmt)


def ratings_ml(spark: SparkSession, db: str, cfg: RatingsPipelineConfig) -> dict:
    """Fit, evaluate, recommend, report and export.  Returns the run metrics."""
    # The model takes complete rows only; rows whose ids or rating did not
    # parse stay in the fact table for the quality reports.
    fact = (spark.table(_t(db, "gold_fact_ratings")).select("userId", "movieId", "rating")
            .filter(F.col("userId").isNotNull() & F.col("movieId").isNotNull() & F.col("rating").isNotNull()))
    movies = spark.table(_t(db, "silver_dim_movies_enriched"))
    train, test = recsys.split_ratings(fact, seed=cfg.als.seed)

    model = recsys.fit_als(train, cfg.als)
    if cfg.model_dir:
        recsys.save_model(model, cfg.model_dir)
    recs = recsys.recommend(model, fact, cfg.recs_per_user, exclude_seen=True, rank_col=None)
    write_layer(recs, _t(db, "gold_user_recommendations"), fmt=cfg.fmt)
    write_layer(agg.power_users(fact), _t(db, "gold_power_users"), fmt=cfg.fmt)

    pop = agg.rec_popularity(spark.table(_t(db, "gold_user_recommendations")))
    top = top_k(pop, [F.col("recommendation_count").desc(), F.col("movieId").asc()], cfg.export_top)
    top = lookup_attrs(top, movies, "movieId", ["title", "tmdbId"])
    by_count = [F.col("recommendation_count").desc(), F.col("movieId").asc()]
    if cfg.export_dir:
        files.export_csv(top.select("movieId", "title", "tmdbId", "recommendation_count"), f"{cfg.export_dir}/top_movies",
                         single_file_rows=cfg.export_top, order=by_count)
        full = pop.join(movies.select("movieId", "title", "tmdbId"), "movieId", "left")
        files.export_csv(full.select("movieId", "title", "tmdbId", "recommendation_count"), f"{cfg.export_dir}/popularity",
                         order=by_count)

    metrics = recsys.run_metrics(cfg.als, recsys.rmse(model.transform(test)))
    pub = recsys.fit_als(train, cfg.publish_als)
    metrics = metrics.unionByName(recsys.run_metrics(cfg.publish_als, recsys.rmse(pub.transform(test))))
    append_run(metrics, _t(db, "gold_run_metrics"), cfg.run_at, fmt=cfg.fmt)
    flat = recsys.recommend(pub, fact, cfg.recs_per_user, exclude_seen=cfg.exclude_seen_published, rank_col=None)
    write_layer(flat, _t(db, "gold_user_recommendations_flat"), fmt=cfg.fmt)
    flat = spark.table(_t(db, "gold_user_recommendations_flat"))
    dim = movies.select("movieId", "title", "genres", "tmdbId")
    # Gap count of the left-enriched table (taken before the inner join),
    # from per-item counts so the dimension meets one row per item.
    left = enrich_recs(agg.rec_popularity(flat), dim, how="left")
    n = F.col("recommendation_count")
    gaps = left.agg(F.sum(n).alias("total"),
                    F.coalesce(F.sum(F.when(any_null(["title", "genres"]), n)), F.lit(0)).alias("missing"))
    write_layer(gaps, _t(db, "gold_recommendation_gaps"), fmt=cfg.fmt)
    write_layer(enrich_recs(flat, dim.filter(F.col("title").isNotNull()), how="inner"),
                _t(db, "gold_user_recommendations_enriched"), fmt=cfg.fmt)
    if cfg.export_dir:
        files.export_csv(spark.table(_t(db, "gold_user_recommendations_enriched"))
                         .select("userId", "movieId", "title", "genres", "prediction"),
                         f"{cfg.export_dir}/recommendations")
    now = spark.table(_t(db, "gold_run_metrics")).where(F.col("run_at") == F.to_timestamp(F.lit(cfg.run_at), "yyyy-MM-dd HH:mm:ss"))
    return {r.run_id: r.rmse for r in now.collect()}


def ratings_pipeline(spark: SparkSession, raw: Mapping[str, DataFrame], db: str,
                     cfg: RatingsPipelineConfig | None = None) -> dict:
    cfg = cfg or RatingsPipelineConfig()
    if cfg.export_dir is None:
        cfg.export_dir = scratch_path(spark, "exports")
    ratings_bronze(spark, raw, db, cfg.fmt)
    ratings_silver(spark, db, cfg.fmt, cfg.key_buckets)
    ratings_gold(spark, db, cfg)
    return ratings_ml(spark, db, cfg)


# ---------------------------------------------------------- title pipeline --
TITLE_DUMPS = {
    "title_basics": ("tconst", ["tconst"]),
    "name_basics": ("nconst", ["nconst"]),
    "title_ratings": ("tconst", ["tconst"]),
    "title_crew": ("tconst", ["tconst"]),
    "title_akas": ("titleId", ["titleId", "ordering"]),
    "title_principals": ("tconst", ["tconst", "nconst", "ordering"]),
}


def title_bronze(spark: SparkSession, raw: Mapping[str, DataFrame], db: str, fmt: str = "parquet") -> None:
    """Scrub the dumps (repeated headers, ``\\N`` tokens, duplicate keys)."""
    for name, (header_key, keys) in TITLE_DUMPS.items():
        if name not in raw:  # the gold tables do not need the principals
            continue
        df = scrub_null_token(scrub_header_rows(raw[name], header_key))
        rest = [c for c in df.columns if c not in keys]
        write_layer(dedup_latest(df, keys, rest), _t(db, f"bronze_{name}"), fmt=fmt, recreate=True)


def title_silver_gold(spark: SparkSession, db: str, as_of_year: int, fmt: str = "parquet",
                      tags=scoring.DEFAULT_TAG_SET, top: int = scoring.DEFAULT_TOP,
                      silver_top: int | None = scoring.DEFAULT_SILVER_TOP) -> None:
    """Silver to gold.  Gold is built from all silver titles; the top-title table
    beside them holds the first ``silver_top`` (None: all)."""
    b = lambda n: spark.table(_t(db, f"bronze_{n}"))
    silver = scoring.silver_titles(b("title_basics"), b("title_akas"), b("title_ratings"), as_of_year)
    write_layer(silver, _t(db, "silver_movies"), fmt=fmt, evolve=True)
    silver = spark.table(_t(db, "silver_movies"))
    write_layer(silver if silver_top is None else scoring.top_titles(silver, silver_top), _t(db, "silver_movies_top"), fmt=fmt, evolve=True)
    write_layer(scoring.title_fact(silver), _t(db, "gold_title_fact_ratings"), fmt=fmt, recreate=True)
    weighted = scoring.weighted_rating(spark.table(_t(db, "gold_title_fact_ratings")))
    write_layer(weighted, _t(db, "gold_fact_weighted"), fmt=fmt, recreate=True)
    w = spark.table(_t(db, "gold_fact_weighted"))
    write_layer(top_k(w, [F.col("weightedRating").desc(), F.col("tconst").asc()], top),
                _t(db, "gold_top_recommendations"), fmt=fmt, recreate=True)
    dim = scoring.title_dim(silver, b("title_crew"), b("name_basics"), tags=tags)
    write_layer(dim, _t(db, "gold_dim_titles_enriched"), fmt=fmt, recreate=True, evolve=True)
    d = spark.table(_t(db, "gold_dim_titles_enriched"))
    write_layer(scoring.top_per_genre(d, top), _t(db, "gold_top20_per_genre"), fmt=fmt, recreate=True)
    write_layer(scoring.top_per_genre_unique(d, top), _t(db, "gold_top20_per_genre_unique"), fmt=fmt, recreate=True)


def title_pipeline(spark: SparkSession, raw: Mapping[str, DataFrame], db: str, as_of_year: int,
                   fmt: str = "parquet", silver_top: int | None = scoring.DEFAULT_SILVER_TOP) -> None:
    title_bronze(spark, raw, db, fmt)
    title_silver_gold(spark, db, as_of_year, fmt, silver_top=silver_top)


# ------------------------------------------------------- from raw files --
def ratings_pipeline_from_files(spark: SparkSession, ratings_csv: str, movies_csv: str, links_csv: str,
                                db: str, cfg: RatingsPipelineConfig | None = None) -> dict:
    """Run the ratings pipeline from raw header CSV dumps (read as strings)."""
    from reelhouse import schemas
    raw = {"ratings": files.read_csv(spark, ratings_csv, schemas.RATINGS_RAW),
           "movies": files.read_csv(spark, movies_csv, schemas.MOVIES_RAW),
           "links": files.read_csv(spark, links_csv, schemas.LINKS_RAW)}
    return ratings_pipeline(spark, raw, db, cfg)


def title_pipeline_from_dumps(spark: SparkSession, dumps: Mapping[str, str], db: str, as_of_year: int,
                              fmt: str = "parquet", repartition: int | None = None,
                              silver_top: int | None = scoring.DEFAULT_SILVER_TOP) -> None:
    """Run the title pipeline from tab-separated dumps (globs of plain or
    gzip parts; ``repartition`` spreads unsplittable gzip input)."""
    from reelhouse import schemas
    contracts = {"title_principals": schemas.TITLE_PRINCIPALS_RAW, "title_basics": schemas.TITLE_BASICS_RAW, "name_basics": schemas.NAME_BASICS_RAW,
                 "title_ratings": schemas.TITLE_RATINGS_RAW, "title_crew": schemas.TITLE_CREW_RAW,
                 "title_akas": schemas.TITLE_AKAS_RAW}
    raw = {n: files.read_tsv(spark, dumps[n], schema=contracts[n], repartition=repartition) for n in contracts if n in dumps}
    title_pipeline(spark, raw, db, as_of_year, fmt, silver_top)
