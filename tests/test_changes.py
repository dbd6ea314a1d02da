"""Changes of stored tables: broken off after every step, then recovered; partitions and runs."""

import glob
import hashlib
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from reelhouse.operators.clean import dedup_latest
from reelhouse.session import local_path, scratch_path
from reelhouse.sources import tables


class Broken(Exception):
    pass


@pytest.fixture
def db(spark):
    name = f"rh_c_{uuid.uuid4().hex[:8]}"
    return tables.ensure_database(spark, name, scratch_path(spark, name))


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [str(x) for x in r])


def content(spark, name):
    t = spark.table(name)
    return in_order(t.select(*sorted(t.columns)).collect())


def files_of(spark, name):
    """Digest of every data file, by its path under the table."""
    root = local_path(tables.table_location(spark, name))
    return {os.path.relpath(p, root): hashlib.sha256(open(p, "rb").read()).hexdigest()
            for p in glob.glob(f"{root}/**/*.parquet", recursive=True)}


def stop(monkeypatch, step, after):
    """Let ``tables.<step>`` fail, before or after its work."""
    real = getattr(tables, step)

    def broken(*args):
        if after:
            real(*args)
        raise Broken
    monkeypatch.setattr(tables, step, broken)


CHANGES = {
    "add": lambda t: t.withColumn("w", F.col("id") * 2),
    "same": lambda t: t.withColumn("b", F.concat("b", F.lit("!"))),
    "drop": lambda t: t.drop("b"),
    "retype": lambda t: t.withColumn("b", F.length("b")),
}
STEPS = [("_commit", False), ("_commit", True), ("_point", False), ("_point", True), ("_retire", False), ("_retire", True),
         ("_replace", False), ("_replace", True)]


@pytest.mark.parametrize("change,parts", [("add", ["p"]), ("same", None), ("drop", ["p"]), ("retype", None)])
def test_a_broken_rewrite_recovers_to_old_or_new_rows(spark, db, monkeypatch, change, parts):
    def made(name):
        tables.write_layer(spark.range(30).selectExpr("id", "id % 3 AS p", "'x' AS b"), name, partition_by=parts)
        tables._set_properties(spark, name, {"team": "o'x \\ y"})
        return name

    name = made(f"{db}.whole")
    old = content(spark, name)
    tables.rewrite_table(spark, name, CHANGES[change])
    new = content(spark, name)
    assert new != old and tables.recover(spark, name) == "none"
    swapped = change in ("add", "same")
    for k, (step, after) in enumerate(STEPS):
        if step in ("_point", "_retire") and not swapped or step == "_replace" and swapped:
            continue
        name = made(f"{db}.t{k}")
        with monkeypatch.context() as m:
            stop(m, step, after)
            with pytest.raises(Broken):
                tables.rewrite_table(spark, name, CHANGES[change])
        decided = step != "_commit" or after
        if swapped:  # a reader meets whole rows at any time
            seen = content(spark, name)
            assert seen == (new if step == "_retire" or step == "_point" and after else old), step
        if not (step == "_replace" and after) and not (step == "_retire" and after):
            with pytest.raises(tables.PendingChange):
                tables.rewrite_table(spark, name, CHANGES[change])
        want = "none" if after and step in ("_replace", "_retire") else "finished" if decided else "undone"
        assert tables.recover(spark, name) == want, (step, after)
        assert content(spark, name) == (new if decided else old)
        assert tables.recover(spark, name) == "none"
        tables.rewrite_table(spark, name, lambda t: t.withColumn("again", F.lit(1)))
        assert spark.table(name).where("again = 1").count() == 30
        assert [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == (parts or [])
        assert tables._properties(spark, name)["team"] == "o'x \\ y"
        assert not [t.name for t in spark.catalog.listTables(db) if "__change_" in t.name]
        spark.sql(f"DROP TABLE {name}")


def test_a_replacement_broken_between_drop_and_rename_recovers(spark, db):
    name = f"{db}.t"
    tables.write_layer(spark.range(9).selectExpr("id", "'x' AS b"), name)
    stage = tables._stage(spark.table(name).drop("b"), name, "parquet")
    tables._commit(spark, name, stage, "replace")
    spark.sql(f"DROP TABLE {name}")
    assert tables.recover(spark, name) == "finished" and content(spark, name) == in_order((k,) for k in range(9))
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{tables._STATE}' = 'complete')")  # after the rename
    assert tables.recover(spark, name) == "finished" and tables._STATE not in tables._properties(spark, name)


def test_a_table_with_catalog_partitions_is_replaced(spark, db):
    name = f"{db}.t"
    spark.range(12).selectExpr("id", "id % 2 AS p").write.partitionBy("p").saveAsTable(name)
    tables.rewrite_table(spark, name, lambda t: t.withColumn("w", F.col("id") + 1))
    assert spark.table(name).where("w = id + 1").count() == 12
    assert [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == ["p"]


def test_a_rewritten_table_can_be_overwritten_and_keeps_buckets(spark, db):
    name = f"{db}.t"
    tables.write_layer(spark.range(40).selectExpr("id", "id % 5 AS k"), name, bucket_by=(4, ["k"]))
    tables.rewrite_table(spark, name, lambda t: t.withColumn("w", F.lit(1)))
    assert tables._layout(spark, name) == ([], (4, ["k"]))
    plan = spark.table(name).groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and spark.table(name).groupBy("k").count().count() == 5
    tables.write_layer(spark.range(3), name)
    assert content(spark, name) == [(0,), (1,), (2,)]


def test_other_partitions_keep_their_files(spark, db):
    name = f"{db}.fact"
    rows = spark.range(100).selectExpr("id", "date_add(date'2024-01-01', int(id % 10)) AS day", "id * 10 AS v")
    tables.write_layer(rows, name, partition_by=["day"])
    before = files_of(spark, name)
    late = spark.createDataFrame([(3, 1), (103, 1), (104, 9)], "id long, v long").selectExpr(
        "id", "CASE WHEN id = 104 THEN date'2024-02-02' ELSE date'2024-01-04' END AS day", "v", "'late' AS note")
    tables.merge_late(late, name, ["id"], ["note", "v"])
    after = files_of(spark, name)
    changed = {p.split("/")[0] for p in before.keys() ^ after.keys()} | {p.split("/")[0] for p in before.keys() & after.keys() if before[p] != after[p]}
    assert changed == {"day=2024-01-04", "day=2024-02-02"}
    t = spark.table(name)
    assert t.count() == 102 and {(r.id, r.v, r.note) for r in t.where("note is not null").collect()} == {(3, 1, "late"), (103, 1, "late"), (104, 9, "late")}
    tables.merge_late(late, name, ["id"], ["note", "v"])  # delivered again
    assert spark.table(name).count() == 102
    tables.overwrite_partitions(spark.table(name).where("day = '2024-01-04' and id <> 3"), name)
    assert spark.table(name).count() == 101
    with pytest.raises(ValueError):
        tables.write_layer(spark.range(2), f"{db}.plain")
        tables.overwrite_partitions(spark.range(2), f"{db}.plain")


@pytest.mark.parametrize("step,after", [("_commit", False), ("_commit", True), ("_put_partitions", False), ("_put_partitions", True)])
def test_a_broken_partition_overwrite_recovers(spark, db, monkeypatch, step, after):
    name = f"{db}.fact"
    tables.write_layer(spark.range(20).selectExpr("id", "id % 4 AS p"), name, partition_by=["p"])
    old = content(spark, name)
    with monkeypatch.context() as m:
        stop(m, step, after)
        with pytest.raises(Broken):
            tables.overwrite_partitions(spark.createDataFrame([(500, 1)], "id long, p long"), name)
    decided = step != "_commit" or after
    assert tables.recover(spark, name) == ("finished" if decided else "undone")
    assert content(spark, name) == (in_order([r for r in old if r[1] != 1] + [(500, 1)]) if decided else old)


def test_waves_equal_a_full_dedup_and_read_touched_buckets_only(spark, db):
    rng = random.Random(4)
    name, seen = f"{db}.silver", []
    for wave in range(5):
        size = [400, 3, 1, 0, 60][wave]
        rows = [(rng.randrange(300), rng.randrange(3), wave * 10 + rng.randrange(10), rng.choice([None, 1.0, 2.0])) for _ in range(size)]
        rows += rows[:2]
        seen += rows
        df = spark.createDataFrame(rows, "userId int, movieId int, ts long, rating double")
        before = files_of(spark, name) if wave else {}
        tables.merge_wave(df, name, ["userId", "movieId"], ["ts", "rating"], buckets=16)
        after = files_of(spark, name)
        hit = {f"key_bucket={r[0]}" for r in tables.with_key_bucket(df, ["userId", "movieId"], 16).select("key_bucket").distinct().collect()}
        if wave:
            assert all(after.get(p) == d for p, d in before.items() if p.split("/")[0] not in hit)
        full = dedup_latest(spark.createDataFrame(seen, df.schema), ["userId", "movieId"], ["ts", "rating"])
        assert content(spark, name) == in_order(tables.with_key_bucket(full, ["userId", "movieId"], 16).select(
            *sorted([*full.columns, "key_bucket"])).collect())
    some = tables.touched(spark.table(name), spark.createDataFrame([(3,), (5,)], "key_bucket int"), ["key_bucket"])
    assert "PartitionFilters: [key_bucket" in some._jdf.queryExecution().executedPlan().toString()
    read = {f"key_bucket={r[0]}" for r in some.select("key_bucket").distinct().collect()}
    assert read == {"key_bucket=3", "key_bucket=5"} & {p.split("/")[0] for p in after}
    two = spark.createDataFrame([(1, None), (1, 2), (2, 2)], "a int, b int")
    assert tables.touched(two, two.where("a = 1"), ["a", "b"]).count() == 2
    assert tables.touched(two, two.where("a = 1"), ["b"]).count() == 3 and tables.touched(two, two.where("a = 9"), ["b"]).count() == 0
    with pytest.raises(ValueError):
        tables.merge_wave(df, name, ["userId", "movieId"], ["ts", "rating"], buckets=8)


def test_runs_are_appended_once(spark, db):
    name = f"{db}.gold_run_metrics"

    def run(rmse, run_id="als", **more):
        return spark.createDataFrame([(run_id, rmse)], "run_id string, rmse double").withColumns({k: F.lit(v) for k, v in more.items()})

    tables.append_run(run(0.9), name, "2024-01-01 10:00:00")
    tables.append_run(run(0.8), name, "2024-01-02 10:00:00")
    tables.append_run(run(0.7, "other"), name, "2024-01-02 10:00:00")
    tables.append_run(run(0.8), name, "2024-01-02 10:00:00")  # the same commit again
    got = sorted((r.run_id, str(r.run_at), r.rmse) for r in spark.table(name).collect())
    assert got == [("als", "2024-01-01 10:00:00", 0.9), ("als", "2024-01-02 10:00:00", 0.8), ("other", "2024-01-02 10:00:00", 0.7)]
    tables.append_run(run(0.6, mae=0.1), name, "2024-01-03 00:00:00")  # a log may gain columns
    assert sorted((r.rmse, r.mae) for r in spark.table(name).where("run_id = 'als'").collect())[0] == (0.6, 0.1)
    assert spark.table(name).count() == 4


def test_top_ups_equal_a_rebuild(spark, db, monkeypatch):
    """Later waves, ratings that move to another day, days that become empty,
    waves broken off and run again: silver and gold equal a rebuild from all of bronze."""
    from reelhouse.plans import pipelines as P
    rng = random.Random(8)

    def wave(n, day_from, days, users=40):
        return [(str(rng.choice([*range(users), "x"])), str(rng.randrange(30)), str(rng.choice([1, 2.5, 4])),
                 str(86_400 * (day_from + rng.randrange(days)) + rng.randrange(50))) for _ in range(n)]

    base = wave(300, 0, 5) + [("77", "1", "3", str(86_400 * 50))]  # alone on its day
    waves = [[("77", "1", "5", str(86_400 * 60 + 7)), ("0", "0", "1", "bad")], wave(12, 3, 4), wave(1, 2, 1)]
    frame = lambda rows: spark.createDataFrame(rows, "userId string, movieId string, rating string, timestamp string")
    cfg = P.RatingsPipelineConfig(key_buckets=8)

    def build(name, rows):
        tables.ensure_database(spark, name, scratch_path(spark, name))
        none = spark.createDataFrame([], "movieId string, title string, genres string, imdbId string, tmdbId string")
        P.ratings_bronze(spark, {"ratings": frame(rows), "movies": none.select("movieId", "title", "genres"),
                                 "links": none.select("movieId", "imdbId", "tmdbId")}, name)
        P.ratings_silver(spark, name, key_buckets=8)
        P.ratings_gold(spark, name, cfg)
        return name

    build(db, base)
    untouched = {p: d for p, d in files_of(spark, f"{db}.gold_fact_ratings").items() if "1970-01-01" in p}
    rows = list(base)
    for k, extra in enumerate(waves):
        if k == 1:  # broken off after gold, then run again
            with monkeypatch.context() as m:
                m.setattr(P, "merge_wave", lambda *a: (_ for _ in ()).throw(Broken()))
                with pytest.raises(Broken):
                    P.ratings_top_up(spark, frame(extra), db, cfg)
        P.ratings_top_up(spark, frame(extra), db, cfg)
        if k == 0:
            assert {p: d for p, d in files_of(spark, f"{db}.gold_fact_ratings").items() if "1970-01-01" in p} == untouched
            P.ratings_top_up(spark, frame(extra), db, cfg)  # delivered twice
            rows += extra
        rows += extra
    again = build(f"{db}_again", rows)
    for name in ("silver_fact_ratings", "gold_fact_ratings", "silver_dim_users", "gold_dim_users", "bronze_ratings_csv"):
        assert content(spark, f"{db}.{name}") == content(spark, f"{again}.{name}"), name
    assert spark.table(f"{db}.gold_fact_ratings").where("rating_date = '1970-02-20'").isEmpty()
    with pytest.raises(ValueError):
        P.ratings_top_up(spark, frame(waves[0]), db, P.RatingsPipelineConfig())


def test_a_change_of_all_partitions_is_written_once(spark, db, monkeypatch):
    """No other partition is left: the table moves to the new files, and one
    that ends empty is gone.  Broken off, it recovers."""
    name = f"{db}.fact"
    tables.write_layer(spark.range(20).selectExpr("id", "id % 4 AS p"), name, partition_by=["p"])
    monkeypatch.setattr(tables, "_put_partitions", lambda *a: (_ for _ in ()).throw(Broken()))
    new = spark.table(name).where("p <> 3").selectExpr("id + 100 AS id", "p")
    tables.overwrite_partitions(new, name, also=spark.createDataFrame([(3,)], "p long"))
    want = in_order([(i + 100, i % 4) for i in range(20) if i % 4 != 3])
    assert content(spark, name) == want and not tables._stages(spark, name)
    with monkeypatch.context() as m:
        stop(m, "_point", False)
        with pytest.raises(Broken):
            tables.overwrite_partitions(spark.table(name).where("id > 110"), name)
    assert content(spark, name) == want
    assert tables.recover(spark, name) == "finished" and content(spark, name) == [r for r in want if r[0] > 110]
    with pytest.raises(Broken):  # partition 9 is new, the others stay
        tables.overwrite_partitions(spark.createDataFrame([(1, 9)], "id long, p long"), name)


def test_a_wave_is_joined_to_the_latest_rows(spark, db, monkeypatch):
    """The table is not deduplicated again: null keys and values, keys that are
    older, newer or new, and a column that only the wave has."""
    name, keys, order = f"{db}.silver", ["a", "b"], ["ts", "v"]
    old = spark.createDataFrame([(a, b, t, v, "old") for a, b, t, v in [(1, None, 5, 1.0), (None, None, 5, None), (1, 1, None, 2.0), (2, 1, 7, 3.0),
                                                                         (3, 3, 7, 0.5), (4, 4, 4, None)]], "a int, b int, ts long, v double, note string")
    new = spark.createDataFrame([(a, b, t, v, "new", 1) for a, b, t, v in [(1, None, 6, 0.0), (None, None, 5, 0.0), (1, 1, None, None), (2, 1, 6, 9.0),
                                                                           (3, 3, 7, 0.5), (None, 8, None, None)]], "a int, b int, ts long, v double, note string, w int")
    tables.merge_wave(old, name, keys, order, 2)
    seen = []
    monkeypatch.setattr(tables, "dedup_latest", lambda df, *a: seen.append(df) or dedup_latest(df, *a))
    tables.merge_wave(new, name, keys, order, 2, "parquet", True)
    assert not seen
    full = tables.with_key_bucket(dedup_latest(old.unionByName(new, allowMissingColumns=True), keys, order), keys, 2)
    assert content(spark, name) == in_order(full.select(*sorted(full.columns)).collect())
