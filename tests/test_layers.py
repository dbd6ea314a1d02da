"""Heavy keys, bucketed layers, bitmap counts, stored variants, footer counts: values and plans."""

import uuid

import pytest
from pyspark.sql import functions as F

from reelhouse.operators import aggregates as agg
from reelhouse.operators import enrich, joins, payloads, profile
from reelhouse.plans import standins as S
from reelhouse.session import scratch_path, written
from reelhouse.sources import catalog, tables

SF = "/root/testdata/sf0.001"


@pytest.fixture
def db(spark):
    name = f"rh_l_{uuid.uuid4().hex[:8]}"
    return tables.ensure_database(spark, name, scratch_path(spark, name))


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def facts(spark, rows=30_000):
    """User 7 holds a third of all rows, user -1 none but nulls follow."""
    return spark.range(rows).selectExpr("int(CASE WHEN id % 3 = 0 THEN 7 WHEN id % 1001 = 5 THEN NULL ELSE id % 2000 END) AS userId",
                                        "int(id % 307) AS movieId", "float(id % 10) / 2 AS rating")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)


def test_only_hot_keys_are_replicated(spark):
    f = facts(spark)
    hot = joins.hot_keys(f, "userId")
    assert [r.userId for r in hot.collect()] == [7]
    dim = spark.range(-5, 2500).selectExpr("int(id) AS userId", "id * 2 AS v")
    many = joins.with_salts(dim, "userId", hot)
    assert many.count() == 2505 + joins.SALTS - 1
    per = {r._salt: r["count"] for r in joins.with_salt(f, "userId", ["movieId"], hot).where("userId = 7").groupBy("_salt").count().collect()}
    assert len(per) == joins.SALTS and max(per.values()) < 3 * 10_000 / joins.SALTS
    assert joins.with_salt(f, "userId", ["movieId"], hot).where("userId <> 7 OR userId IS NULL").select("_salt").distinct().collect()[0][0] == 0
    for how in ("inner", "left"):
        assert rows(joins.salted_join(f, dim, "userId", ["movieId"], how)) == rows(f.join(dim, "userId", how).select("userId", "movieId", "rating", "v"))
    assert joins.hot_keys(f.where("false"), "userId").count() == 0


def test_no_key_is_hot_in_even_data(spark):
    even = spark.range(10_000).selectExpr("int(id % 5000) AS k", "id AS x")
    assert joins.hot_keys(even, "k").count() == 0
    skewed = spark.range(10_000).selectExpr("int(id % 10) AS k", "id AS x")
    assert joins.hot_keys(skewed, "k").count() == 10 < joins.HOT_SHARE


def test_bucketed_facts_are_read_without_a_shuffle(spark, db, no_broadcast):
    f = facts(spark).where("userId IS NOT NULL")
    tables.write_bucketed(f, f"{db}.f", "userId", 8, ["movieId"])
    t = spark.table(f"{db}.f")
    assert rows(t.drop("_salt")) == rows(f)
    assert rows(agg.user_dim(t)) == rows(agg.user_dim(f))
    p = plan(agg.user_dim(t))
    per_salt = p[p.index("_salt"):p.index("FileScan")]  # from the (key, salt) aggregates down to the scan
    assert "Bucketed: true" in p and "Exchange" not in per_salt
    assert rows(profile.centre_ratings(t)) == rows(profile.centre_ratings(f))
    assert "Exchange" not in fact_side(profile.centre_ratings(t))
    dim = S.movies(spark, SF).select(F.col("movieId").alias("userId"), "title")
    dim = dim.join(dim.select("userId", F.length("title").alias("n")), "userId")
    got = joins.enrich_recs(t, dim, "userId", "left", ["movieId"])
    assert rows(got.drop("_salt")) == rows(f.join(dim, "userId", "left"))
    assert "Exchange" not in fact_side(got)
    tables.write_bucketed(f, f"{db}.m", "movieId", 8, ["userId"])
    assert rows(agg.item_stats(spark.table(f"{db}.m"))) == rows(agg.item_stats(f))


def fact_side(df):
    """The part of the plan that reads the facts of the outermost join."""
    lines = plan(df).split("\n")
    k = next(i for i, line in enumerate(lines) if "Join" in line)
    bar = lines[k].index("SortMergeJoin" if "SortMergeJoin" in lines[k] else "BroadcastHashJoin")
    side = [lines[k + 1]]
    for line in lines[k + 2:]:
        if line[bar:bar + 2] in (":-", "+-"):
            break
        side.append(line)
    assert "FileScan" in "".join(side)
    return "".join(side)


def test_bitmap_counts_equal_distinct_counts(spark):
    values = [(None, None, None, "a"), (-1, -2 ** 63, 5, "b"), (-32768, 2 ** 63 - 1, 5, None), (0, 0, None, "a"), (1, 32768, 7, "c"),
              (32768, 32769, 7, "c"), (-32769, -32768, 8, "c"), (1, 0, 5, "a"), (65536, 1, -5, "")]
    df = spark.createDataFrame(values * 3, "a int, b long, c short, s string").repartition(3)
    want = {c: df.where(F.col(c).isNotNull()).select(c).distinct().count() for c in df.columns}
    assert {r.column_name: r.unique_values for r in profile.distinct_counts(df).collect()} == want
    one = agg.cardinalities(df, ["a", "b", "c", "s"]).first().asDict()
    assert one == {**{f"distinct_{c}": n for c, n in want.items()}, "row_count": 27}
    none = agg.cardinalities(df.where("false"), ["a", "s"]).first().asDict()
    assert none == {"distinct_a": 0, "distinct_s": 0, "row_count": 0}
    assert {r.unique_values for r in profile.profile(df.where("false")).collect()} == {0}


def test_integer_columns_are_not_expanded(spark):
    df = spark.range(50_000).selectExpr("id AS a", "int(id % 900) - 450 AS b", "int(id / 7) AS c")
    for out in (agg.cardinalities(df, ["a", "b", "c"]), profile.distinct_counts(df), profile.profile(df)):
        # an Expand of count(distinct) numbers its copies with gid (profiles turn their one result row by another)
        assert "gid#" not in plan(out) and "bitmap_construct_agg" in plan(out)
    assert tuple(agg.cardinalities(df, ["a", "b", "c"]).first()) == (50_000, 900, 7143, 50_000)
    far = df.select(F.xxhash64("a").alias("h"))
    assert "bitmap_construct_agg" not in plan(agg.cardinalities(far, ["h"])) and agg.cardinalities(far, ["h"]).first()[0] == 50_000


def test_stored_variants_equal_parsed_texts(spark):
    texts = ['{"id": 1, "title": "A", "genres": [{"id": 3, "name": "x"}, {"name": null}], "runtime": 5, "vote_average": 7.5}',
             '{"id": 2, "title": null, "poster_path": "/p.jpg"}', '{"status_code": 34, "id": 9}', "{broken", "", None, "[1]", '"text"', "{}"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, payload string")
    kept = written(payloads.land(docs, "details"), "t_landed")
    assert dict(kept.dtypes)["doc"] == "variant"
    assert rows(payloads.details(kept)) == rows(enrich.flatten_details(docs))
    assert rows(kept.select("k", "status")) == rows(enrich.parse_details(docs).select("k", "status"))
    assert {r.k for r in kept.where("raw is not null").collect()} == {3, 4}
    credits = ['{"id": 5, "poster_path": "", "crew": [{"name": "N", "job": "Editor"}, {"name": "D", "job": "Director"}], "cast": [{"name": "c1"}]}',
               '{"id": 6, "cast": []}', '{"cast": []}', "no"]
    c = spark.createDataFrame([(t,) for t in credits], "payload string")
    assert rows(payloads.credits(written(payloads.land(c, "credits"), "t_credits"))) == rows(enrich.flatten_credits(c))
    alt = ['{"Response": "True", "Title": "T", "Actors": "a , b,c,d", "Poster": "p"}', '{"Response": "False", "Error": "x"}', '{"Response": "True"}', "-"]
    a = spark.createDataFrame([(f"tt{k}", t) for k, t in enumerate(alt)], "external_id string, payload string")
    assert rows(payloads.alternate(written(payloads.land(a, "alt"), "t_alt"))) == rows(enrich.flatten_alt(a))


def test_texts_are_parsed_when_landing_only(spark):
    landed = payloads.land(S.landed_details(spark, SF), "details")
    assert plan(landed).count("parse_json") >= 1 or "parseJson" in plan(landed)
    kept = written(landed, "t_landed")
    for out in (payloads.details(kept), enrich.missing_payloads(S.links(spark, SF), "tmdbId", kept)):
        assert not any(x in plan(out).lower() for x in ("parse_json", "parsejson", "from_json", "jsontostructs"))
    gaps = plan(enrich.missing_payloads(S.links(spark, SF), "tmdbId", kept))
    assert "doc#" not in gaps  # the status column alone is read


def test_row_counts_come_from_footers(spark, db):
    tables.write_layer(spark.range(1234).selectExpr("id", "id % 4 AS p"), f"{db}.t", partition_by=["p"])
    tables.write_layer(spark.range(0), f"{db}.none")
    tables.write_layer(spark.range(9), f"{db}.j", fmt="json")
    out = catalog.row_count(spark, f"{db}.t")
    assert "BatchScan" in plan(out) and "[count(*)#" in plan(out) and "PushedAggregation: [COUNT(*)]" in \
        spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    assert [catalog.row_count(spark, f"{db}.{n}").first()[0] for n in ("t", "none", "j")] == [1234, 0, 9]
    tables.rewrite_table(spark, f"{db}.t", lambda t: t.where("id < 1000"))
    assert {r.table_name: r.row_count for r in catalog.table_counts(spark, "", db).collect()} == {"t": 1000, "none": 0, "j": 9}
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""
