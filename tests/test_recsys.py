import numpy as np
from pyspark.sql import functions as F

from reelhouse.operators import recsys


def _planted(spark, users=40, items=30, rank=3, seed=7):
    rng = np.random.default_rng(seed)
    u = rng.uniform(0.2, 1.0, (users, rank))
    v = rng.uniform(0.2, 1.0, (items, rank))
    full = u @ v.T * 2
    rows = []
    for i in range(users):
        for j in range(items):
            if rng.random() < 0.5 or i == 0:  # user 0 rated every item
                rows.append((i, j, float(full[i, j])))
    return spark.createDataFrame(rows, "userId int, movieId int, rating float"), rows


def test_split_is_layout_independent(spark):
    df = spark.range(2000).select((F.col("id") % 50).cast("int").alias("userId"),
                                  (F.col("id") / 50).cast("int").alias("movieId"))
    a, _ = recsys.split_ratings(df)
    b, _ = recsys.split_ratings(df.repartition(7))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert 0.75 < a.count() / 2000 < 0.85


def test_als_quality_nonnegative_and_roundtrip(spark, tmp_path):
    df, rows = _planted(spark)
    train, test = recsys.split_ratings(df)
    cfg = recsys.AlsConfig(rank=3, max_iter=15, reg_param=0.01)
    m = recsys.fit_als(train, cfg)
    err = recsys.rmse(m.transform(test)).first().rmse
    mean = train.agg(F.avg("rating")).first()[0]
    base = test.agg(F.sqrt(F.avg(F.pow(F.col("rating") - mean, 2)))).first()[0]
    assert err < 0.5 * base
    assert min(min(r.features) for r in m.userFactors.collect()) >= 0.0
    path = str(tmp_path / "model")
    recsys.save_model(m, path)
    back = recsys.load_model(path)
    p1 = {(r.userId, r.movieId): r.prediction for r in m.transform(test).collect()}
    p2 = {(r.userId, r.movieId): r.prediction for r in back.transform(test).collect()}
    assert p1 == p2


def test_recommend_unseen_equals_brute_force(spark):
    df, rows = _planted(spark)
    m = recsys.fit_als(df, recsys.AlsConfig(rank=3, max_iter=5, nonnegative=False))
    uf = {r.id: np.array(r.features) for r in m.userFactors.collect()}
    vf = {r.id: np.array(r.features) for r in m.itemFactors.collect()}
    seen = {}
    for u, i, _ in rows:
        seen.setdefault(u, set()).add(i)
    n = 5
    got = recsys.recommend(m, df, n=n, exclude_seen=True).collect()
    by_user = {}
    for r in got:
        by_user.setdefault(r.userId, []).append((r["rank"], r.movieId))
    for u, s in seen.items():
        scores = sorted(((-float(np.float32(uf[u] @ vf[i])), i) for i in vf if i not in s))[:n]
        exp = [i for _, i in scores]
        assert [i for _, i in sorted(by_user.get(u, []))] == exp, u
    assert 0 not in by_user  # user 0 rated every item: no unseen candidates
    # disjoint from the ratings
    assert not {(r.userId, r.movieId) for r in got} & {(u, i) for u, i, _ in rows}
    allrecs = recsys.recommend(m, df, n=n, exclude_seen=False)
    assert allrecs.groupBy("userId").count().agg(F.max("count")).first()[0] == n


def test_cold_start_user_and_item_are_dropped(spark):
    train = spark.createDataFrame([(1, 1, 4.0), (1, 2, 3.0), (2, 1, 5.0), (2, 2, 2.0)],
                                  "userId int, movieId int, rating float")
    test = spark.createDataFrame([(1, 1, 4.0), (3, 1, 1.0), (1, 9, 2.0)], "userId int, movieId int, rating float")
    m = recsys.fit_als(train, recsys.AlsConfig(rank=2, max_iter=3))
    scored = m.transform(test).collect()
    assert [(r.userId, r.movieId) for r in scored] == [(1, 1)]
    assert recsys.rmse(m.transform(test)).first().predicted == 1


def test_recommend_subset_includes_user_without_history(spark):
    df, rows = _planted(spark, users=10, items=12)
    m = recsys.fit_als(df, recsys.AlsConfig(rank=2, max_iter=3))
    some = df.filter("userId <> 3")  # user 3 is known to the model but has no rows here
    users = spark.createDataFrame([(3,), (4,)], "userId int")
    got = recsys.recommend(m, some, n=4, users=users).collect()
    per = {}
    for r in got:
        per.setdefault(r.userId, []).append(r.movieId)
    assert sorted(per) == [3, 4] and len(per[3]) == 4


class _Factors:
    """Stand-in model: only its factors are read."""

    def __init__(self, spark, users, items):
        kind = "id int, features array<float>"
        self.userFactors, self.itemFactors = spark.createDataFrame(users, kind), spark.createDataFrame(items, kind)


def _brute(users, items, seen, n):
    out = {}
    for u, f in users:
        score = sorted((-float(np.float32(np.dot(np.float32(f).astype(float), np.float32(g).astype(float)))), i)
                       for i, g in items if i not in seen.get(u, ()))
        out[u] = [i for _, i in score[:n]]
    return {u: x for u, x in out.items() if x}


def test_ties_take_the_smallest_items(spark):
    """All-zero factors (usual with nonnegative models) tie on every item."""
    m = _Factors(spark, [(1, [0.0, 0.0])], [(i, [float(i), 1.0]) for i in range(100)])
    ratings = spark.createDataFrame([(1, 200, 0.0)], "userId int, movieId int, rating float")
    for exclude in (True, False):
        got = recsys.recommend(m, ratings, 10, exclude_seen=exclude).orderBy("rank").collect()
        assert [r.movieId for r in got] == list(range(10)) and [r["rank"] for r in got] == list(range(1, 11))


def test_zero_and_duplicate_factors_and_hot_user_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    items = [(i, [float(x) for x in np.round(rng.uniform(0, 1, 3), 1)]) for i in range(70)]
    items += [(100 + i, items[i % 3][1]) for i in range(40)] + [(200 + i, [0.0] * 3) for i in range(10)]
    users = [(u, [float(x) for x in np.round(rng.uniform(0, 1, 3), 1)]) for u in range(12)] + [(20, [0.0] * 3), (21, [0.5] * 3)]
    users += [(22, users[3][1])]
    seen = {u: {int(i) for i in rng.choice([i for i, _ in items], 15, replace=False)} for u, _ in users}
    seen[5] = {i for i, _ in items} - {3, 104, 205}  # has seen almost every item
    seen[6] = {i for i, _ in items}
    rows = [(u, i, 1.0) for u, x in seen.items() for i in x] + [(99, 1, 1.0), (3, None, 1.0), (None, 4, 1.0)]
    ratings = spark.createDataFrame(rows, "userId int, movieId int, rating float")
    m = _Factors(spark, users, items)
    for block in ({}, {"slab_bytes": 1, "block": 17}):
        got = {}
        for r in recsys.recommend(m, ratings, 5, **block).orderBy("userId", "rank").collect():
            got.setdefault(r.userId, []).append(r.movieId)
        assert got == _brute(users, items, seen, 5)
        assert sorted(got[5]) == [3, 104, 205] and 6 not in got and 99 not in got
        every = {}
        for r in recsys.recommend(m, ratings, 5, exclude_seen=False, **block).orderBy("userId", "rank").collect():
            every.setdefault(r.userId, []).append(r.movieId)
        assert every == _brute(users, items, {}, 5)


def test_recommend_plan_has_no_cross_join(spark):
    m = _Factors(spark, [(1, [1.0])], [(1, [1.0])])
    ratings = spark.createDataFrame([(1, 2, 1.0)], "userId int, movieId int, rating float")
    plan = recsys.recommend(m, ratings, 5)._jdf.queryExecution().toString()
    assert "Cross" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def _scored(best):
    return best.agg(F.sum("scored")).first()[0]


def test_falling_norms_stop_the_scan(spark):
    """Lists equal brute force while few of all pairs are multiplied, over one slab or many."""
    rng = np.random.default_rng(11)
    items = [(i, [float(np.float32(x)) for x in rng.normal(0, 1, 4) * 30 / (1 + i % 997) + 0.05]) for i in range(3000)]
    users = [(u, [float(np.float32(x)) for x in rng.normal(0.4, 0.6, 4)]) for u in range(300)] + [(900, [0.0] * 4)]
    seen = {u: {int(x) for x in rng.choice(3000, 150, replace=False)} for u, _ in users}
    pairs = spark.createDataFrame([(u, i) for u, x in seen.items() for i in x] * 2, "u int, i int")
    m = _Factors(spark, users, items)
    for sizes in ({"block": 64}, {"slab_bytes": 64 * 8 * 32, "block": 50}, {"slab_bytes": 1, "block": 64}):
        best = recsys.pruned_top_n(m.userFactors, m.itemFactors, pairs, 10, **sizes).persist()
        assert {r.u: r["item"] for r in best.collect()} == _brute(users, items, seen, 10)
        assert _scored(best.where("u < 900")) < 0.2 * 300 * 3000
        assert best.where("u = 900").first().scored == 3000  # all tie: the smallest unseen ids
        best.unpersist()
    flat = recsys.pruned_top_n(m.userFactors, m.itemFactors.select("id", F.expr("transform(features, x -> float(1))").alias("features")),
                               pairs, 10)
    assert _scored(flat) == 301 * 3000  # equal norms: nothing can be left out


def test_bounds_hold_for_negative_scores_and_short_lists(spark):
    rng = np.random.default_rng(3)
    items = [(i, [float(np.float32(x)) for x in -rng.uniform(0, 5, 2)]) for i in range(200)]
    users = [(u, [float(np.float32(x)) for x in rng.uniform(0, 1, 2)]) for u in range(20)]
    m = _Factors(spark, users, items)
    best = recsys.pruned_top_n(m.userFactors, m.itemFactors, None, 300, slab_bytes=1, block=16)
    assert {r.u: r["item"] for r in best.collect()} == _brute(users, items, {}, 300)
    none = recsys.pruned_top_n(m.userFactors, m.itemFactors.limit(0), None, 3).collect()
    assert len(none) == 20 and not any(r["item"] for r in none)


def test_cells_stop_the_scan_where_norms_cannot(spark):
    """Items of one norm in many directions: lists equal brute force, most pairs are ruled out."""
    rng = np.random.default_rng(5)
    turn = rng.normal(0, 1, (6000, 3))
    turn /= np.sqrt((turn ** 2).sum(1))[:, None]
    items = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(turn)]
    users = [(u, [float(np.float32(x)) for x in rng.normal(0, 1, 3)]) for u in range(200)]
    seen = {u: {int(x) for x in rng.choice(6000, 100, replace=False)} for u, _ in users}
    pairs = spark.createDataFrame([(u, i) for u, x in seen.items() for i in x], "u int, i int")
    m = _Factors(spark, users, items)
    for given, left_out in ((pairs, seen), (None, {})):
        best = recsys.pruned_top_n(m.userFactors, m.itemFactors, given, 10, block=64).persist()
        assert {r.u: r["item"] for r in best.collect()} == _brute(users, items, left_out, 10)
        assert _scored(best) < 0.2 * 200 * 6000
        best.unpersist()


def test_factors_with_a_null_element_take_no_part(spark):
    m = _Factors(spark, [(1, [1.0, 2.0]), (2, [None, 1.0])], [(1, [3.0, None]), (2, [0.5, 0.25]), (3, [-1.0, -1.0])])
    best = {r.u: (r["item"], r["score"]) for r in recsys.pruned_top_n(m.userFactors, m.itemFactors, None, 5).collect()}
    assert best == {1: ([2, 3], [1.0, -3.0]), 2: ([], [])}


def test_nested_lists_cross_no_blocks_and_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    items = [(i, [float(np.float32(x)) for x in rng.normal(0, 1, 4)]) for i in range(300)]
    users = [(u, [float(np.float32(x)) for x in rng.normal(0, 1, 4)]) for u in range(30)]
    m = _Factors(spark, users, items)
    some = spark.createDataFrame([(3,), (3,), (7,), (99,), (None,)], "userId int")
    for given, ids in ((None, range(30)), (some, (3, 7))):
        got = recsys.recommend_nested(m, 5, given)
        assert got.schema["recommendations"].dataType.simpleString() == "array<struct<movieId:int,rating:float>>"
        plan = got._jdf.queryExecution().toString()
        assert "Cross" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
        assert {r.userId: [x.movieId for x in r.recommendations] for r in got.collect()} == \
            _brute([users[u] for u in ids], items, {}, 5)


def test_nested_queries_cross_no_blocks(spark):
    import __spark_entry__ as E
    for name in ("als_recs_subset", "als_recs_nested_all", "als_nested_check"):
        plan = E.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_users_are_dealt_to_tasks_by_their_number_not_bytes(spark):
    m = _Factors(spark, [(u, [1.0]) for u in range(100)], [(1, [1.0])])
    plan = recsys.pruned_top_n(m.userFactors.coalesce(1), m.itemFactors, None, 5)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan[plan.index("MapInArrow"):]


def test_factors_are_not_copied_and_seen_items_are_bitmaps(spark):
    m = _Factors(spark, [(1, [1.0])], [(1, [1.0])])
    ratings = spark.createDataFrame([(1, 2, 1.0)], "userId int, movieId int, rating float")
    plan = recsys.recommend(m, ratings, 5)._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("MapInArrow"):]
    assert "Generate" not in before and "partial_bit_or" in before and "FlatMapCoGroups" not in plan


def test_wrong_rmse_is_noticed_and_values_are_registered(spark, monkeypatch):
    import __spark_entry__ as E
    from reelhouse.plans import ml_queries
    run = lambda name: E.queries()[name](spark, "/root/testdata/sf0.001").collect()
    value = run("als_rmse_value")[0]
    log = run("als_run_metrics_values")
    assert value.predicted > 0 and 0 < value.rmse and abs(log[0].rmse - value.rmse) < 1e-4 and log[1].rmse > 0
    real = ml_queries.recsys.rmse
    monkeypatch.setattr(ml_queries.recsys, "rmse", lambda p: real(p).withColumn("rmse", F.col("rmse") + 1))
    assert not any(r.evaluated for r in run("als_run_metrics"))


def test_both_runs_of_the_log_read_one_gold_fact(spark, monkeypatch):
    from reelhouse.plans import ml_queries
    real, calls = ml_queries.gold_ratings, []
    monkeypatch.setattr(ml_queries, "gold_ratings", lambda *a: calls.append(1) or real(*a))
    rows = ml_queries.q_als_run_metrics_values(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 2 and len(calls) == 1


def test_a_null_factor_takes_no_other_item_with_it(spark):
    """Items without a score share a block with others, which stay candidates."""
    items = [(i, [float(i % 7), 1.0]) for i in range(40)] + [(100 + i, [None, 1.0]) for i in range(12)]
    m = _Factors(spark, [(1, [1.0, 1.0])], items)
    best = recsys.pruned_top_n(m.userFactors, m.itemFactors, None, 10).first()
    assert best["item"] == _brute([(1, [1.0, 1.0])], items[:40], {}, 10)[1]


def test_the_side_of_the_split_is_hashed_once(spark, monkeypatch):
    """Fit and scoring read the side stored with the gold fact; it is the side of the split."""
    from reelhouse.plans import ml_queries
    rows = spark.createDataFrame([(u, i, float((u * i) % 5 + 1), 7) for u in range(12) for i in range(15)],
                                 "userId int, movieId int, rating float, timestamp long")
    monkeypatch.setattr(ml_queries.S, "ratings", lambda *a: rows)
    fits = []
    monkeypatch.setattr(ml_queries.recsys, "fit_als", lambda train, cfg: fits.append(train))
    fact, test, _ = ml_queries._fitted(spark, "", ml_queries.FIRST)
    train, want = recsys.split_ratings(rows)
    assert sorted(fits[0].collect()) == sorted(train.collect()) and sorted(test.collect()) == sorted(want.collect())
    assert fact.columns == rows.columns and fact.count() == rows.count()
    for side in (fits[0], test):
        assert "md5" not in side._jdf.queryExecution().executedPlan().toString()


def test_a_fit_drops_the_files_of_past_iterations(spark):
    """A model in use pins the lineage of its fit; the exchanged files of past iterations are gone all the same."""
    df, _ = _planted(spark)
    held = lambda: spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()
    before = held()
    m = recsys.fit_als(df, recsys.AlsConfig(rank=2, max_iter=10))
    assert held() - before < 10  # 20 half steps were exchanged
    assert m.userFactors.count() == 40 and m.itemFactors.count() == 30


def test_fewer_item_blocks_send_less_and_give_the_same_model(spark, monkeypatch):
    """First factors are drawn per user block; item blocks only decide how often a user's factor is sent."""
    df, _ = _planted(spark)
    cfg = recsys.AlsConfig(rank=3, max_iter=6, num_blocks=4)
    real, fits = recsys.ALS.fit, []
    monkeypatch.setattr(recsys.ALS, "fit", lambda self, train: fits.append(self) or real(self, train))
    few = recsys.fit_als(df, cfg)
    monkeypatch.setattr(recsys, "ITEM_BLOCKS", 1)
    even = recsys.fit_als(df, cfg)
    assert [(a.getNumUserBlocks(), a.getNumItemBlocks()) for a in fits] == [(4, 2), (4, 4)]
    for side in ("userFactors", "itemFactors"):
        a, b = ({r.id: np.array(r.features) for r in getattr(m, side).collect()} for m in (few, even))
        assert a.keys() == b.keys() and all(np.allclose(a[i], b[i], rtol=1e-4, atol=1e-5) for i in a)


def test_users_are_dealt_once_and_a_pass_meets_several_slabs(spark, monkeypatch):
    """Nine slabs are met in passes of 1, 2, 4 and 2: users are written between passes, not per slab,
    with what they have seen, and shuffled before the first pass only."""
    rng = np.random.default_rng(13)
    items = [(7 * i - 900, [float(np.float32(x)) for x in rng.normal(0, 1, 3)]) for i in range(64 * 9 - 10)]
    users = [(u, [float(np.float32(x)) for x in rng.normal(0, 1, 3)]) for u in range(620)]
    ids = [i for i, _ in items]
    seen = {u: {int(x) for x in rng.choice(ids, 12, replace=False)} | {5000} for u, _ in users}
    seen[9] = set(ids) - {ids[5], ids[50], ids[500]}  # more than one pair in 500: hot
    pairs = spark.createDataFrame([(u, i) for u, x in seen.items() for i in x] * 2, "u int, i int")
    m = _Factors(spark, users, items)
    real, names = recsys.written, []
    monkeypatch.setattr(recsys, "written", lambda df, name, *a: names.append((name, df)) or real(df, name, *a))
    best = recsys.pruned_top_n(m.userFactors, m.itemFactors, pairs, 10, slab_bytes=1, block=32)
    assert {r.u: r["item"] for r in best.collect()} == _brute(users, items, seen, 10)
    states = [df._jdf.queryExecution().executedPlan().toString() for name, df in names if name == "top_n"]
    assert len(states) == 3 and [name for name, _ in names].count("item_slabs") == 1
    assert "REPARTITION_BY_NUM" in states[0] and not any("Exchange" in plan for plan in states[1:])


def test_seen_pairs_are_shuffled_once_and_items_are_not_joined(spark):
    """Pairs meet neither the items nor a second shuffle; a hot user's go as bitmap words."""
    rows = spark.range(4000).selectExpr("cast(if(id % 4 = 0, 7, id % 997) as int) as u", "cast(id % 2000 - 500 as int) as i")
    got = {r.u: r["seen"] for r in recsys._bitmaps(rows, 5).collect()}
    want = {}
    for r in rows.collect():
        want.setdefault(r.u, set()).add(r.i)
    assert {u: {w.word * 64 + b for w in ws for b in range(64) if w.bits >> b & 1} for u, ws in got.items()} == want
    assert len(got[7]) == len({i >> 6 for i in want[7]})
    plan = recsys._bitmaps(rows, 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(u") == 2 and "SortMergeJoin" not in plan
    assert "partial_bit_or" in plan[plan.index("Union"):]  # hot users: before the shuffle


def test_written_rows_leave_no_shuffle_files(spark):
    import time

    from reelhouse.session import written
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: {x for x in files.getAllFiles().mkString("\n").split("\n") if "shuffle_" in x}
    df = spark.range(1000).repartition(7).groupBy((F.col("id") % 10).alias("k")).count()
    before = held()
    back = written(df, "kept")
    until = time.time() + 20
    while held() - before and time.time() < until:  # they go in the background
        time.sleep(0.2)
    assert not held() - before
    assert back.count() == 10 and df.count() == 10  # its shuffles are made anew for another action
