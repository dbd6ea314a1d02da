import glob
import os

from pyspark.sql import functions as F

from reelhouse import schemas
from reelhouse.functions.strings import external_id, parse_list_text
from reelhouse.operators import enrich
from reelhouse.session import local_path, scratch_path
from reelhouse.sources import catalog, files, tables


def test_details_payload_variants(spark):
    p = spark.createDataFrame([
        (1, '{"id": 1, "title": "A", "genres": [{"id": 1, "name": "Drama"}], "runtime": 90}'),  # fields missing
        (2, '{"success": false, "status_code": 34, "status_message": "nope"}'),
        (3, '{"id": 3, "title": "B'),
        (4, None)], "tmdbId int, payload string")
    flat = enrich.flatten_details(p).collect()
    assert len(flat) == 1 and flat[0].genres == ["Drama"] and flat[0].overview is None
    status = {r.tmdbId: r.status for r in enrich.parse_details(p).collect()}
    assert status == {1: "ok", 2: "error", 3: "malformed", 4: "missing"}
    ids = spark.createDataFrame([(1,), (2,), (3,), (9,)], "tmdbId int")
    miss = {r.tmdbId: r.status for r in enrich.missing_payloads(ids, "tmdbId", enrich.parse_details(p)).collect()}
    assert miss == {2: "error", 3: "malformed", 9: "missing"}


def test_retried_ids_and_other_text_columns(spark):
    ok = '{"id": 1, "title": "A", "runtime": 90}'
    p = spark.createDataFrame([(1, '{"status_code": 34}'), (1, ok), (1, ok), (2, '{"id": 2, "ti'), (2, '{"status_code": 34}'), (3, None)],
                              "tmdbId int, body string")
    ids = spark.createDataFrame([(1,), (2,), (3,), (4,)], "tmdbId int")
    parsed = enrich.parse_details(p, text="body")
    got = sorted((r.tmdbId, r.status) for r in enrich.missing_payloads(ids, "tmdbId", parsed).collect())
    assert got == [(2, "error"), (3, "missing"), (4, "missing")]
    meta = enrich.flatten_details(p, text="body")
    links = spark.createDataFrame([(10, 1), (11, 2), (12, None)], "movieId int, tmdbId int")
    assert meta.count() == 2 and [r.movieId for r in enrich.movie_dim(links, meta).collect()] == [10]


def test_credits_empty_crew_no_director_many_cast(spark):
    cast = ",".join(f'{{"name": "c{i}", "order": {i}}}' for i in range(8))
    p = spark.createDataFrame([
        ('{"id": 1, "poster_path": "/x.jpg", "crew": [{"name": "W", "job": "Writer"}, {"name": "D", "job": "Director"}], '
         f'"cast": [{cast}]}}',),
        ('{"id": 2, "poster_path": "", "crew": [], "cast": []}',),
        ('{"id": 3, "crew": [{"name": "W", "job": "Writer"}]}',)], "payload string")
    got = {r.tmdbId: r for r in enrich.flatten_credits(p).collect()}
    assert got[1].director == "D" and got[1].top_cast == ["c0", "c1", "c2", "c3", "c4"]
    assert got[1].poster_url == enrich.POSTER_BASE + "/x.jpg"
    assert got[2].poster_url is None and got[2].director is None and got[2].top_cast == []
    assert got[3].director is None and got[3].top_cast == []


def test_alt_payload_and_external_ids(spark):
    p = spark.createDataFrame([("a", '{"Response": "True", "Title": "T", "Actors": "A, B , C, D"}'),
                               ("b", '{"Response": "False", "Error": "x"}'), ("c", '{"Response": "True"}')],
                              "k string, payload string")
    got = {r.k: r for r in enrich.flatten_alt(p).collect()}
    assert set(got) == {"a", "c"} and got["a"].top_actors == ["A", "B", "C"] and got["c"].actors == []
    ids = spark.createDataFrame([("114709",), ("1234567",), ("12345678",), (None,)], "i string")
    assert [r[0] for r in ids.select(external_id("i")).collect()] == ["tt0114709", "tt1234567", "tt12345678", None]


def test_csv_roundtrip_quotes_commas_newlines(spark):
    df = spark.createDataFrame([(1, 'He said "hi", then\nleft', "['Drama', \"Kid's\"]")],
                               "tmdbId int, overview string, genres string")
    path = scratch_path(spark, "t_csv")
    files.export_csv(df, path)
    back = files.read_csv(spark, path, df.schema, multiline=True)
    assert back.collect() == df.collect()
    parsed = back.select(parse_list_text("genres")).first()[0]
    assert parsed == ["Drama", "Kid's"]
    assert files.read_back_diff(df, back).count() == 0


def test_tsv_header_repeat_and_null_token(spark):
    path = scratch_path(spark, "t_tsv")
    lp = local_path(path)
    os.makedirs(lp)
    with open(f"{lp}/part_1.tsv", "w") as f:
        f.write("tconst\tgenres\ntt1\tDrama\ntconst\tgenres\ntt2\t\\N\n")
    with open(f"{lp}/part_2.tsv", "w") as f:
        f.write("tconst\tgenres\ntt3\tA \"quoted\" name\n")
    from reelhouse.operators.clean import scrub_header_rows, scrub_null_token
    df = scrub_null_token(scrub_header_rows(files.read_tsv(spark, f"{path}/part_*.tsv",
                                                           columns=["tconst", "genres"]), "tconst"))
    assert sorted(map(tuple, df.collect())) == [("tt1", "Drama"), ("tt2", None), ("tt3", 'A "quoted" name')]


def test_single_file_export_and_batches(spark):
    df = spark.range(230).select(F.col("id").cast("int").alias("movieId"), (F.col("id") % 7).alias("c"))
    path = scratch_path(spark, "t_single")
    files.export_csv(df.orderBy("movieId"), path, single_file_rows=100)
    parts = glob.glob(local_path(path) + "/part-*")
    assert len(parts) == 1
    b = files.with_batch_number(df.repartition(5), [F.col("movieId").asc()], 50).collect()
    got = {r.movieId: r.batch for r in b}
    assert all(got[i] == i // 50 + 1 for i in range(230))


def test_layer_tables_rewrite_and_report(spark):
    db = tables.ensure_database(spark, "rh_test_db", scratch_path(spark, "db"))
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    tables.write_layer(df, f"{db}.bronze_a", recreate=True)
    tables.write_layer(df.limit(1), f"{db}.bronze_b")
    tables.rewrite_table(spark, f"{db}.bronze_a", lambda t: t.withColumn("w", F.col("id") * 2))
    assert sorted(map(tuple, spark.table(f"{db}.bronze_a").collect())) == [(1, "a", 2), (2, "b", 4)]
    rep = {r.table_name: (r.row_count, r.columns) for r in catalog.table_report(spark, "bronze_", db).collect()}
    assert rep == {"bronze_a": (2, ["id", "v", "w"]), "bronze_b": (1, ["id", "v"])}
    assert {r.col_name for r in catalog.table_columns(spark, f"{db}.bronze_a").collect()} == {"id", "v", "w"}
    locs = catalog.table_locations(spark, "bronze_", db).collect()
    assert len(locs) == 2 and all(r.location for r in locs)


def test_links_gaps_and_orphans(spark):
    from reelhouse.operators.joins import orphans
    movies = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "movieId int, title string")
    links = spark.createDataFrame([(1, "114709", 862), (2, "113497", None)], "movieId int, imdbId string, tmdbId int")
    ratings = spark.createDataFrame([(7, 1, 4.0), (7, 99, 3.0)], "userId int, movieId int, rating float")
    j = {r.movieId: (r.imdbId, r.tmdbId) for r in movies.join(links, "movieId", "left").collect()}
    assert j == {1: ("114709", 862), 2: ("113497", None), 3: (None, None)}  # no links / no tmdbId
    assert [r.movieId for r in orphans(ratings, movies, "movieId").collect()] == [99]
    meta = spark.createDataFrame([(862, "Toy")], "tmdbId int, mtitle string")
    assert [r.movieId for r in enrich.movie_dim(links, meta).collect()] == [1]


def test_batch_numbers_any_layout(spark):
    df = spark.range(537).select(F.col("id").cast("int").alias("k"), (F.col("id") * 7 % 13).alias("v"))
    for parts in (1, 3, 11):
        got = {r.k: r.batch for r in files.with_batch_number(df.repartition(parts), [F.col("v").desc(), F.col("k")], 50)
               .collect()}
        order = sorted(range(537), key=lambda k: (-(k * 7 % 13), k))
        assert all(got[k] == i // 50 + 1 for i, k in enumerate(order))


def test_columns_are_found_by_header_name(spark, tmp_path):
    import pytest

    def part(name, text):
        (tmp_path / name).write_text(text)

    part("a.tsv", "titleId\tordering\ttitle\tregion\tlanguage\nt1\t1\tHello\tUS\ten\n")
    part("b.tsv", "titleId\tordering\ttitle\tregion\tlanguage\nt2\t1\tBye\tNL\tnl\n")
    got = files.read_tsv(spark, f"{tmp_path}/*.tsv", schema=schemas.TITLE_AKAS_RAW).orderBy("titleId").collect()
    assert [tuple(r) for r in got] == [("t1", "1", "en", "US"), ("t2", "1", "nl", "NL")]
    part("m.csv", "title,movieId\nA,1\nB,x\n")
    assert [tuple(r) for r in files.read_csv(spark, f"{tmp_path}/m.csv", "movieId int, title string").collect()] == [(1, "A"), (None, "B")]
    with pytest.raises(ValueError, match="genres"):
        files.read_csv(spark, f"{tmp_path}/m.csv", schemas.MOVIES)
    part("c.tsv", "ordering\ttitleId\ttitle\tregion\tlanguage\n1\tt3\tX\tUS\ten\n")  # a part in another order fails
    with pytest.raises(Exception, match="(?i)header"):
        files.read_tsv(spark, f"{tmp_path}/*.tsv", schema=schemas.TITLE_AKAS_RAW).collect()


def test_stream_ingest_by_name_and_absent_column(spark, tmp_path):
    import pytest

    from reelhouse.streaming import ingest_to_bronze
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("title,extra,movieId,genres\nA,z,1,g\n")
    ingest_to_bronze(spark, f"{tmp_path}/in", schemas.MOVIES_RAW, f"{tmp_path}/out", f"{tmp_path}/ckpt")
    r = spark.read.parquet(f"{tmp_path}/out").first()
    assert (r.movieId, r.title, r.genres) == ("1", "A", "g")
    with pytest.raises(ValueError, match="rating"):
        ingest_to_bronze(spark, f"{tmp_path}/in", schemas.RATINGS_RAW, f"{tmp_path}/out2", f"{tmp_path}/ckpt2")


def test_rewrite_keeps_partitions_and_properties_and_evolve_is_additive(spark):
    import uuid
    db = tables.ensure_database(spark, f"rh_t_{uuid.uuid4().hex[:6]}", scratch_path(spark, "t_rewrite"))
    name = f"{db}.t"
    tables.write_layer(spark.range(20).selectExpr("id", "id % 3 AS p", "'x' AS b"), name, partition_by=["p"])
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('owner_team' = 'films')")
    tables.rewrite_table(spark, name, lambda t: t.withColumn("w", F.col("id") * 2))
    assert [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == ["p"]
    assert {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}["owner_team"] == "films"
    assert spark.table(name).where("w = 2 * id").count() == 20
    assert [t.name for t in spark.catalog.listTables(db)] == ["t"]
    tables.write_layer(spark.range(5).selectExpr("id", "'n' AS c"), f"{db}.e")
    tables.write_layer(spark.range(7).selectExpr("id", "1.5D AS d"), f"{db}.e", evolve=True)
    t = spark.table(f"{db}.e")
    assert t.dtypes == [("id", "bigint"), ("d", "double"), ("c", "string")] and t.where("c is null").count() == 7


def test_rewrite_failure_leaves_the_table(spark):
    import uuid

    import pytest
    db = tables.ensure_database(spark, f"rh_t_{uuid.uuid4().hex[:6]}", scratch_path(spark, "t_rewrite"))
    tables.write_layer(spark.range(4), f"{db}.t")
    with pytest.raises(Exception):
        tables.rewrite_table(spark, f"{db}.t", lambda t: t.select(F.raise_error(F.lit("no"))))
    assert spark.table(f"{db}.t").count() == 4


def test_export_order_is_kept_in_one_file(spark):
    path = scratch_path(spark, "t_order")
    df = spark.range(200).select(F.col("id"), F.pmod(F.xxhash64("id"), F.lit(1000)).alias("v")).repartition(7)
    files.export_csv(df, path, single_file_rows=50, order=[F.col("v").desc(), "id"])
    got = [(r.id, r.v) for r in files.read_csv(spark, path, "id long, v long").collect()]
    assert got == [(r.id, r.v) for r in df.orderBy(F.col("v").desc(), "id").limit(50).collect()]


def test_division_by_nothing_is_null(spark):
    from reelhouse.operators.profile import sparsity
    from reelhouse.operators.scoring import weighted_rating
    from reelhouse.operators.tags import tag_means, tag_means_by_key
    df = spark.createDataFrame([("a", 9.0, 0), ("b", 5.0, 10)], "t string, averageRating double, numVotes int")
    assert {r.t: r.weightedRating for r in weighted_rating(df, m=0).collect()} == {"a": None, "b": 5.0}
    none = spark.createDataFrame([], "userId int, movieId int")
    assert sparsity(none, none).first().sparsity is None
    fact = spark.createDataFrame([(1, None), (1, 4.0), (2, None)], "movieId int, rating double")
    dim = spark.createDataFrame([(1, "x|y"), (2, "z")], "movieId int, genres string")
    a = {r.tag: (r.avg_rating, r.n) for r in tag_means_by_key(fact, dim, "movieId", "genres", "|", "rating").collect()}
    b = {r.tag: (r.avg_rating, r.n) for r in tag_means(fact.join(dim, "movieId"), "genres", "|", "rating").collect()}
    assert a == b == {"x": (4.0, 2), "y": (4.0, 2), "z": (None, 1)}
