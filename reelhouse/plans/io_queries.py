"""Registered queries for sources, sinks, layer tables and the catalog.

Each writes stand-in tables to a fresh folder under the shared scratch root
(``spark.checkpoint.dir``), reads them back through the operator under test
and returns the read-back rows; the oracle is the source table itself.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from reelhouse import schemas
from reelhouse.functions.casts import epoch_to_ts, id_from_text, to_day
from reelhouse.operators.aggregates import rec_popularity, user_dim
from reelhouse.operators.clean import dedup_latest, scrub_header_rows, scrub_null_token
from reelhouse.plans import standins as S
from reelhouse.plans.queries import (EXPORT_SQL, RECS_CTE, TOP_EXPORT, L, M, R, most_recommended, query,
                                     rating_ranked_list, with_ctes)
from reelhouse.session import scratch_path, written
from reelhouse.sources import catalog, files, tables


def _scratch_db(spark):
    name = f"rh_{uuid.uuid4().hex[:10]}"
    return tables.ensure_database(spark, name, scratch_path(spark, name))


@query("csv_roundtrip", with_ctes(M) + "SELECT * FROM movies")
def q_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    files.export_csv(S.movies(spark, sf_dir), path)
    return files.read_csv(spark, path, schemas.MOVIES)


@query("tsv_gz_roundtrip", with_ctes(M) + "SELECT * FROM movies")
def q_tsv_gz_roundtrip(spark, sf_dir):
    """Bronze ingest: gzip TSV parts (two copies of every row, NULLs written
    as the \\N token, a header line repeated inside the data) -> glob read ->
    scrub header rows and tokens -> dedup by key -> typed silver rows."""
    path = scratch_path(spark, "tsv")
    m = S.movies(spark, sf_dir)
    as_text = m.select([F.coalesce(F.col(c).cast("string"), F.lit("\\N")).alias(c) for c in m.columns])
    header = spark.range(1).select([F.lit(c).alias(c) for c in m.columns])
    for part in ("a", "b"):
        files.export_csv(as_text.unionByName(header), f"{path}/part_{part}",
                         compression="gzip", sep="\t")
    raw = files.read_tsv(spark, f"{path}/part_*/*.csv.gz", columns=m.columns,
                         repartition=spark.sparkContext.defaultParallelism)
    clean = scrub_null_token(scrub_header_rows(raw, "movieId"))
    one = dedup_latest(clean, ["movieId"], ["title", "genres"])
    return one.select(id_from_text("movieId").alias("movieId"), "title", "genres")


@query("safe_cast", with_ctes(L) + """
SELECT movieId, imdbId, TRY_CAST(imdbId AS INTEGER) AS imdb_int,
       TRY_CAST(TRY_CAST(CAST(tmdbId AS VARCHAR) || '.0' AS DOUBLE) AS INTEGER) AS tmdb_from_float_text,
       TRY_CAST('x' || imdbId AS INTEGER) AS bad_text FROM links""")
def q_safe_cast(spark, sf_dir):
    k = S.links(spark, sf_dir)
    return k.select("movieId", "imdbId", F.col("imdbId").try_cast("int").alias("imdb_int"),
                    id_from_text(F.concat(F.col("tmdbId").cast("string"), F.lit(".0"))).alias(
                        "tmdb_from_float_text"),
                    F.concat(F.lit("x"), F.col("imdbId")).try_cast("int").alias("bad_text"))




@query("single_file_export", f"SELECT *, row_number() OVER (ORDER BY recommendation_count DESC, movieId) AS position FROM ({EXPORT_SQL})")
def q_single_file_export(spark, sf_dir):
    """Most recommended items, exported as one CSV file (bounded by the
    top-k), then read back."""
    path = scratch_path(spark, "top_export")
    files.export_csv(most_recommended(spark, sf_dir), path, single_file_rows=TOP_EXPORT,
                     order=[F.col("recommendation_count").desc(), F.col("movieId").asc()])
    back = files.read_csv(spark, path, "movieId int, title string, tmdbId int, recommendation_count bigint")
    # one file is read in order by one task, so this is the row's place in it
    return back.withColumn("position", F.monotonically_increasing_id() + 1)


@query("popularity_export", with_ctes(R, M, L, RECS_CTE) + """
SELECT p.movieId, m.title, k.tmdbId, p.recommendation_count FROM (
  SELECT movieId, count(*) AS recommendation_count FROM recs GROUP BY movieId) p
LEFT JOIN movies m ON p.movieId = m.movieId LEFT JOIN links k ON p.movieId = k.movieId""")
def q_popularity_export(spark, sf_dir):
    """The full popularity list with titles and external keys, exported in
    order by as many tasks as it needs and read back."""
    path = scratch_path(spark, "popularity")
    pop = rec_popularity(rating_ranked_list(spark, sf_dir))
    dim = S.movies(spark, sf_dir).select("movieId", "title").join(S.links(spark, sf_dir).select("movieId", "tmdbId"), "movieId", "left")
    files.export_csv(pop.join(dim, "movieId", "left").select("movieId", "title", "tmdbId", "recommendation_count"), path,
                     order=[F.col("recommendation_count").desc(), F.col("movieId").asc()])
    return files.read_csv(spark, path, "movieId int, title string, tmdbId int, recommendation_count bigint")


@query("export_read_back", "SELECT CAST(0 AS BIGINT) AS differing, count(*) AS exported FROM part")
def q_export_read_back(spark, sf_dir):
    """Export the movies, read them back and count rows on one side only."""
    path = scratch_path(spark, "read_back")
    m = S.movies(spark, sf_dir)
    files.export_csv(m, path)
    back = files.read_csv(spark, path, schemas.MOVIES)
    diff = files.read_back_diff(m, back).agg(F.count("*").alias("differing"))
    return diff.select("differing", back.agg(F.count("*")).scalar().alias("exported"))


@query("columns_by_name", with_ctes(S.TITLE_SQL) + "SELECT titleId, ordering, language, region FROM title_akas")
def q_columns_by_name(spark, sf_dir):
    """Dumps with further columns, in another order, over two glob parts: the
    declared columns are found by their header names."""
    path = scratch_path(spark, "reordered")
    akas = S.title_akas(spark, sf_dir)
    wide = akas.select([F.coalesce(F.col(c), F.lit("\\N")).alias(c) for c in akas.columns]).select(
        "region", "titleId", F.concat(F.lit("title of "), "titleId").alias("title"), "language", F.lit("0").alias("isOriginalTitle"), "ordering")
    half = F.pmod(F.xxhash64("titleId"), F.lit(2))
    for k in (0, 1):
        files.export_csv(wide.where(half == k), f"{path}/part_{k}", compression="gzip", sep="\t")
    return scrub_null_token(files.read_tsv(spark, f"{path}/part_*/*.csv.gz", schema=schemas.TITLE_AKAS_RAW))


@query("bronze_principals", with_ctes(S.TITLE_SQL) + "SELECT DISTINCT tconst, nconst, ordering FROM title_principals")
def q_bronze_principals(spark, sf_dir):
    """Principals dump -> bronze table keyed by (tconst, nconst, ordering)."""
    from reelhouse.plans.pipelines import title_bronze
    path = scratch_path(spark, "principals")
    p = S.title_principals(spark, sf_dir)
    files.export_csv(p.select("ordering", "tconst", F.lit("actor").alias("category"), "nconst"), path, sep="\t")
    db = _scratch_db(spark)
    title_bronze(spark, {"title_principals": files.read_tsv(spark, path, schema=schemas.TITLE_PRINCIPALS_RAW)}, db)
    return spark.table(f"{db}.bronze_title_principals")


def _gold_fact(spark, sf_dir):
    r = S.ratings(spark, sf_dir).withColumn("timestamp_ts", epoch_to_ts("timestamp"))
    return r.withColumn("rating_date", to_day("timestamp_ts"))


RANGE_FROM, RANGE_TO = "1996-01-01", "1996-03-31"
FACT_GRAIN = "month"


@query("fact_date_range", with_ctes(R) + f"""
SELECT userId, movieId, rating, "timestamp", CAST(make_timestamp("timestamp" * 1000000) AS DATE) AS rating_date
FROM ratings WHERE CAST(make_timestamp("timestamp" * 1000000) AS DATE)
  BETWEEN DATE '{RANGE_FROM}' AND DATE '{RANGE_TO}'""")
def q_fact_date_range(spark, sf_dir):
    """Gold fact written partitioned by rating period, then a date-range
    read that prunes partitions (PartitionFilters).  At the driver scales a
    day holds a few dozen rows, so the period is a month here (thousands of
    tiny day folders would be the wrong layout); the pipeline default is the
    day, which suits a fact of many gigabytes per day."""
    db = _scratch_db(spark)
    fact, part = tables.with_date_partition(_gold_fact(spark, sf_dir).drop("timestamp_ts"), "rating_date",
                                            FACT_GRAIN)
    tables.write_layer(fact, f"{db}.gold_fact_ratings", partition_by=[part], recreate=True)
    t = spark.table(f"{db}.gold_fact_ratings")
    return t.filter(tables.date_range_filter("rating_date", RANGE_FROM, RANGE_TO, FACT_GRAIN)) \
        .select("userId", "movieId", "rating", "timestamp", "rating_date")


@query("layer_rewrite", with_ctes(R) + """
SELECT userId, count(movieId) AS num_ratings, round(avg(rating), 6) AS avg_rating,
       count(movieId) >= 40 AS power_user FROM ratings GROUP BY userId""")
def q_layer_rewrite(spark, sf_dir):
    """Silver user dim: overwrite twice, then add a column in place."""
    db = _scratch_db(spark)
    name = f"{db}.silver_dim_users"
    d = user_dim(S.ratings(spark, sf_dir)).withColumn("avg_rating", F.round("avg_rating", 6))
    tables.write_layer(d, name, recreate=True)
    tables.write_layer(d, name)  # plain overwrite of an existing table
    tables.rewrite_table(spark, name, lambda t: t.withColumn("power_user", F.col("num_ratings") >= 40))
    return spark.table(name)


@query("partitioned_rewrite", with_ctes(M) + """
SELECT movieId, title, genres, movieId % 4 AS bucket, length(title) AS title_length, true AS still_partitioned FROM movies""")
def q_partitioned_rewrite(spark, sf_dir):
    """An in-place rewrite keeps the table's partition columns."""
    name = f"{_scratch_db(spark)}.silver_movies"
    tables.write_layer(S.movies(spark, sf_dir).withColumn("bucket", F.col("movieId") % 4), name, partition_by=["bucket"])
    tables.rewrite_table(spark, name, lambda t: t.withColumn("title_length", F.length("title").cast("bigint")))
    kept = [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == ["bucket"]
    return spark.table(name).withColumn("still_partitioned", F.lit(kept))


@query("evolved_layer", with_ctes(M, L) + """
SELECT m.movieId, m.title, CAST(NULL AS VARCHAR) AS genres, k.tmdbId FROM movies m LEFT JOIN links k ON m.movieId = k.movieId""")
def q_evolved_layer(spark, sf_dir):
    """An additive overwrite: a new column arrives, an absent one stays."""
    name = f"{_scratch_db(spark)}.gold_movies"
    m = S.movies(spark, sf_dir)
    tables.write_layer(m, name)
    new = m.select("movieId", "title").join(S.links(spark, sf_dir).select("movieId", "tmdbId"), "movieId", "left")
    tables.write_layer(new, name, evolve=True)
    return spark.table(name)


def _small_layer(spark, sf_dir):
    db = _scratch_db(spark)
    tables.write_layer(S.movies(spark, sf_dir), f"{db}.bronze_movies")
    tables.write_layer(S.links(spark, sf_dir), f"{db}.silver_links")
    return db


@query("catalog_all_tables", "SELECT 'bronze_movies' AS table_name, 'MANAGED' AS tableType UNION ALL SELECT 'silver_links', 'MANAGED'")
def q_catalog_all_tables(spark, sf_dir):
    db = _small_layer(spark, sf_dir)
    return catalog.layer_tables(spark, "", db).where("not isTemporary").select("table_name", "tableType")


@query("table_counts", with_ctes(M, L) + """
SELECT 'silver_links' AS table_name, count(*) AS row_count FROM links""")
def q_table_counts(spark, sf_dir):
    return catalog.table_counts(spark, "silver_", _small_layer(spark, sf_dir))


@query("table_locations", "SELECT 'bronze_movies' AS table_name, true AS located, count(*) AS rows_there FROM part")
def q_table_locations(spark, sf_dir):
    """Location report, checked by reading the files it names."""
    loc = catalog.table_locations(spark, "bronze_", _small_layer(spark, sf_dir)).first()
    there = spark.read.parquet(loc["location"]).agg(F.count("*").alias("rows_there"))
    return there.select(F.lit(loc["table_name"]).alias("table_name"), F.lit(loc["location"].endswith("bronze_movies")).alias("located"), "rows_there")


@query("drop_existing_join", with_ctes(M, L) + """
SELECT m.movieId, m.title, m.genres, k.tmdbId FROM movies m LEFT JOIN links k ON m.movieId = k.movieId""")
def q_drop_existing_join(spark, sf_dir):
    """A column that a join brings back is dropped first (absent ones are no error)."""
    from reelhouse.operators.clean import drop_existing
    stale = S.movies(spark, sf_dir).withColumn("tmdbId", F.lit(-1))
    return drop_existing(stale, "tmdbId", "not_there").join(S.links(spark, sf_dir).select("movieId", "tmdbId"), "movieId", "left")


@query("table_report", with_ctes(R, M, L) + """
SELECT 'bronze_links' AS table_name, (SELECT count(*) FROM links) AS row_count, 'movieId,imdbId,tmdbId' AS columns
UNION ALL SELECT 'bronze_movies', (SELECT count(*) FROM movies), 'movieId,title,genres'
UNION ALL SELECT 'bronze_ratings', (SELECT count(*) FROM ratings_raw), 'userId,movieId,rating,timestamp'""")
def q_table_report(spark, sf_dir):
    """Write a bronze layer, list it and report rows and columns per table."""
    db = _scratch_db(spark)
    raw = S.ratings_raw(spark, sf_dir).select("userId", "movieId", "rating", "timestamp")
    for name, df in (("bronze_ratings", raw), ("bronze_movies", S.movies(spark, sf_dir)),
                     ("bronze_links", S.links(spark, sf_dir)), ("silver_other", S.links(spark, sf_dir))):
        tables.write_layer(df.select([F.col(c).cast("string") for c in df.columns]), f"{db}.{name}")
    rep = catalog.table_report(spark, "bronze_", database=db, managed=True)
    return rep.select("table_name", "row_count", F.array_join("columns", ",").alias("columns"))


@query("json_batches", with_ctes(R, M, L, RECS_CTE) + f"""
SELECT CAST(floor((rn - 1) / 50) + 1 AS BIGINT) AS batch, count(*) AS n, min(movieId) AS first_id,
       max(movieId) AS last_id FROM (
  SELECT movieId, row_number() OVER (ORDER BY recommendation_count DESC, movieId) AS rn FROM (
    SELECT p.movieId, p.recommendation_count FROM (
      SELECT movieId, count(*) AS recommendation_count FROM recs GROUP BY movieId) p))
GROUP BY 1""")
def q_json_batches(spark, sf_dir):
    """Items in numbered batches of 50 (popularity order) written as JSON
    lines, read back and summarised per batch."""
    path = scratch_path(spark, "batches")
    pop = rec_popularity(rating_ranked_list(spark, sf_dir))
    files.write_batches(pop, [F.col("recommendation_count").desc(), F.col("movieId").asc()], 50, path)
    back = spark.read.schema("movieId int, recommendation_count bigint, batch bigint").json(path)
    return back.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.min("movieId").alias("first_id"),
                                     F.max("movieId").alias("last_id"))


@query("bronze_stream_ingest", with_ctes(M) + "SELECT * FROM movies")
def q_bronze_stream_ingest(spark, sf_dir):
    """Raw CSV parts landing in two waves, ingested incrementally into a
    bronze folder by a file-source stream, then typed and deduplicated."""
    from reelhouse.streaming import ingest_to_bronze
    root = scratch_path(spark, "stream")
    m = S.movies(spark, sf_dir)
    raw = m.select([F.col(c).cast("string").alias(c) for c in m.columns])
    files.export_csv(raw, f"{root}/landing/wave1")
    ingest_to_bronze(spark, f"{root}/landing/*", schemas.MOVIES_RAW, f"{root}/bronze", f"{root}/ckpt")
    files.export_csv(raw, f"{root}/landing/wave2")  # the same rows again: dedup must absorb them
    ingest_to_bronze(spark, f"{root}/landing/*", schemas.MOVIES_RAW, f"{root}/bronze", f"{root}/ckpt")
    bronze = spark.read.parquet(f"{root}/bronze")
    one = dedup_latest(bronze.drop("_source_file"), ["movieId"], ["title", "genres"])
    return one.select(id_from_text("movieId").alias("movieId"), "title", "genres")


@query("table_columns", """
SELECT * FROM (VALUES ('userId', 'int'), ('num_ratings', 'bigint'), ('avg_rating', 'double')) AS t(col_name, data_type)""")
def q_table_columns(spark, sf_dir):
    """Columns and types of a written silver table (DESCRIBE)."""
    db = _scratch_db(spark)
    tables.write_layer(user_dim(S.ratings(spark, sf_dir)), f"{db}.silver_dim_users")
    return catalog.table_columns(spark, f"{db}.silver_dim_users")


# ------------------------------------------------------ changes in place --
@query("rewrite_recovery", with_ctes(M) + """
SELECT movieId, title, genres, CAST(length(title) AS INTEGER) AS title_length, 'undone' AS first_end, 'finished' AS second_end,
       (SELECT count(*) FROM movies) AS rows_between FROM movies""")
def q_rewrite_recovery(spark, sf_dir):
    """A rewrite broken off before it is decided is undone (all old rows stay); broken off
    after, it is finished: the table then has the new column."""
    name = f"{_scratch_db(spark)}.silver_movies"
    tables.write_layer(S.movies(spark, sf_dir), name)
    longer = lambda t: t.withColumn("title_length", F.length("title"))
    tables._stage(longer(spark.table(name)), name, "parquet")
    first = tables.recover(spark, name)
    between = spark.table(name).agg(F.count("*")).first()[0]
    stage = tables._stage(longer(spark.table(name)), name, "parquet")
    tables._commit(spark, name, stage, "swap")
    second = tables.recover(spark, name)
    return spark.table(name).withColumns({"first_end": F.lit(first), "second_end": F.lit(second), "rows_between": F.lit(between).cast("long")})


LATE_FROM, LATE_TO = "1996-01-01", "1996-02-29"


@query("late_partitions", with_ctes(R) + """
SELECT userId, movieId, rating, "timestamp", CAST(make_timestamp("timestamp" * 1000000) AS DATE) AS rating_date FROM ratings""")
def q_late_partitions(spark, sf_dir):
    """The gold fact without a part of two months, whose rows come late: only
    their partitions are read again and overwritten."""
    name = f"{_scratch_db(spark)}.gold_fact_ratings"
    fact, part = tables.with_date_partition(_gold_fact(spark, sf_dir).drop("timestamp_ts"), "rating_date", FACT_GRAIN)
    fact = written(fact, "fact")
    late = F.col("rating_date").between(LATE_FROM, LATE_TO) & (F.col("movieId") % 3 == 0)
    tables.write_layer(fact.where(~late), name, partition_by=[part])
    tables.merge_late(fact.where(late), name, ["userId", "movieId"], ["timestamp", "rating"])
    return spark.table(name).select("userId", "movieId", "rating", "timestamp", "rating_date")


@query("merged_waves", with_ctes(R) + "SELECT * FROM ratings")
def q_merged_waves(spark, sf_dir):
    """Raw ratings in a large and two small waves, merged into the silver fact by key
    bucket; equal to deduplicating all of bronze at once."""
    name = f"{_scratch_db(spark)}.silver_fact_ratings"
    raw = written(S.ratings_raw(spark, sf_dir).select("userId", "movieId", "rating", "timestamp"), "bronze")
    wave = F.when(F.pmod(F.xxhash64("userId"), F.lit(50)) > 1, 0).otherwise(F.pmod(F.xxhash64("userId", "movieId", "timestamp"), F.lit(3)))
    for k in range(3):
        tables.merge_wave(raw.where(wave == k), name, ["userId", "movieId"], ["timestamp", "rating"], buckets=16)
    return spark.table(name).drop("key_bucket")


# ------------------------------------------------------ bucketed layers --
BUCKETS = 16


def _bucketed(spark, sf_dir, key, spread):
    name = f"{_scratch_db(spark)}.gold_fact_by_{key.lower()}"
    tables.write_bucketed(S.ratings(spark, sf_dir).select("userId", "movieId", "rating"), name, key, BUCKETS, [spread])
    return spark.table(name)


@query("bucketed_user_dim", with_ctes(R) + """
SELECT userId, count(movieId) AS num_ratings, round(avg(rating), 6) AS avg_rating FROM ratings GROUP BY userId""")
def q_bucketed_user_dim(spark, sf_dir):
    """User dimension from a fact stored in buckets of userId."""
    return user_dim(_bucketed(spark, sf_dir, "userId", "movieId")).withColumn("avg_rating", F.round("avg_rating", 6))


@query("bucketed_item_stats", with_ctes(R) + """
SELECT movieId, round(avg(rating), 6) AS avg_rating, count(rating) AS num_ratings FROM ratings GROUP BY movieId""")
def q_bucketed_item_stats(spark, sf_dir):
    from reelhouse.operators.aggregates import item_stats
    return item_stats(_bucketed(spark, sf_dir, "movieId", "userId")).withColumn("avg_rating", F.round("avg_rating", 6))


@query("bucketed_centred", with_ctes(R) + """
SELECT userId, movieId, rating, round(rating - avg(rating) OVER (PARTITION BY userId), 6) AS normalized_rating FROM ratings""")
def q_bucketed_centred(spark, sf_dir):
    from reelhouse.operators.profile import centre_ratings
    c = centre_ratings(_bucketed(spark, sf_dir, "userId", "movieId"))
    return c.withColumn("normalized_rating", F.round("normalized_rating", 6))


@query("bucketed_enriched", with_ctes(R, M, L) + """
SELECT r.userId, r.movieId, r.rating, m.title, k.tmdbId FROM ratings r JOIN movies m ON r.movieId = m.movieId
JOIN links k ON r.movieId = k.movieId WHERE k.tmdbId IS NOT NULL""")
def q_bucketed_enriched(spark, sf_dir):
    """Facts in buckets of movieId joined to the enriched dimension: the facts stay where they lie."""
    from reelhouse.operators.joins import enrich_recs
    dim = S.movies(spark, sf_dir).select("movieId", "title").join(
        S.links(spark, sf_dir).where("tmdbId is not null").select("movieId", "tmdbId"), "movieId")
    return enrich_recs(_bucketed(spark, sf_dir, "movieId", "userId"), dim, spread=["userId"]).drop("_salt")


@query("footer_counts", with_ctes(R, M) + """
SELECT 'bronze_movies' AS table_name, (SELECT count(*) FROM movies) AS row_count
UNION ALL SELECT 'bronze_ratings', (SELECT count(*) FROM ratings_raw)""")
def q_footer_counts(spark, sf_dir):
    """Row counts of a plain and a partitioned layer table from the file footers."""
    db = _scratch_db(spark)
    tables.write_layer(S.movies(spark, sf_dir), f"{db}.bronze_movies")
    raw = S.ratings_raw(spark, sf_dir).select("userId", "movieId", (F.col("movieId") % 5).alias("part"))
    tables.write_layer(raw, f"{db}.bronze_ratings", partition_by=["part"])
    return catalog.table_counts(spark, "bronze_", db)


@query("streamed_waves", with_ctes(R) + "SELECT * FROM ratings")
def q_streamed_waves(spark, sf_dir):
    """Raw ratings land in two waves; each is ingested into bronze and merged
    into the silver fact as a stream, which reads the new bronze files only."""
    from reelhouse.streaming import ingest_to_bronze, merge_to_silver
    root, name = scratch_path(spark, "waves"), f"{_scratch_db(spark)}.silver_fact_ratings"
    raw = written(S.ratings_raw(spark, sf_dir).select("userId", "movieId", "rating", "timestamp"), "raw")
    types = raw.dtypes
    bronze = schemas.all_strings(*raw.columns)
    late = F.pmod(F.xxhash64("userId", "movieId", "timestamp"), F.lit(10)) == 0

    def clean(wave):
        return wave.select(*(F.col(c).cast(t).alias(c) for c, t in types))

    for k, wave in enumerate((raw.where(~late), raw.where(late))):
        files.export_csv(wave.select(*(F.col(c).cast("string").alias(c) for c in raw.columns)), f"{root}/landing/wave{k}")
        ingest_to_bronze(spark, f"{root}/landing/*", schemas.RATINGS_RAW, f"{root}/bronze", f"{root}/ckpt-bronze")
        merge_to_silver(spark, f"{root}/bronze", bronze, name, f"{root}/ckpt-silver", ["userId", "movieId"],
                        ["timestamp", "rating"], clean, buckets=8)
    return spark.table(name).drop("key_bucket")


@query("topped_up_gold", with_ctes(R) + """
SELECT userId, movieId, CAST(rating AS FLOAT) AS rating, "timestamp", CAST(make_timestamp("timestamp" * 1000000) AS DATE) AS rating_date FROM ratings""")
def q_topped_up_gold(spark, sf_dir):
    """The gold fact of the ratings pipeline after a first load and two later
    waves, in which ratings change and move to other months."""
    from reelhouse.plans import pipelines as P
    db, cfg = _scratch_db(spark), P.RatingsPipelineConfig(key_buckets=8, date_grain="month")
    raw = S.ratings_raw(spark, sf_dir).select("userId", "movieId", "rating", "timestamp")
    part = F.pmod(F.xxhash64("userId", "movieId", "timestamp"), F.lit(60)).cast("int")
    raw = written(raw.withColumn("wave", F.when(part < 2, part).otherwise(-1)), "raw", ["wave"])  # a wave reads its own files
    wave = lambda k: raw.where(F.col("wave") == k).drop("wave")
    P.ratings_bronze(spark, {"ratings": wave(-1), "movies": S.movies(spark, sf_dir), "links": S.links(spark, sf_dir)}, db)
    P.ratings_silver(spark, db, key_buckets=cfg.key_buckets)
    P.ratings_gold(spark, db, cfg)
    for k in (0, 1):
        P.ratings_top_up(spark, wave(k), db, cfg)
    return spark.table(f"{db}.gold_fact_ratings").select("userId", "movieId", "rating", "timestamp", "rating_date")
