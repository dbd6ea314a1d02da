"""One user holds a third of all rows: results stay exact, plans stay partial."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from reelhouse.operators import recsys
from reelhouse.operators.clean import dedup_latest
from reelhouse.operators.ranking import top_n_per_group


def _skewed(spark, items=300, users=60, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for j in range(items):                      # the hot user: every item, twice
        for t in (1, 2):
            rows.append((0, j, float(rng.integers(1, 6)), t))
    for u in range(1, users):
        for j in rng.choice(items, size=5, replace=False):
            rows.append((u, int(j), float(rng.integers(1, 6)), 1))
    return spark.createDataFrame(rows, "userId int, movieId int, rating double, ts long"), rows


def test_hot_key_dedup_and_top_n(spark):
    df, rows = _skewed(spark)
    assert sum(1 for r in rows if r[0] == 0) * 3 >= len(rows)
    d = dedup_latest(df.repartition(8), ["userId", "movieId"], ["ts", "rating"])
    pdf = pd.DataFrame(rows, columns=["userId", "movieId", "rating", "ts"])
    exp = pdf.sort_values(["ts", "rating"]).groupby(["userId", "movieId"]).tail(1)
    assert d.count() == len(exp)
    got = {(r.userId, r.movieId): r.rating for r in d.collect()}
    assert got == {(a, b): c for a, b, c, _ in exp.itertuples(index=False)}
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "SinglePartition" not in plan
    top = top_n_per_group(d, ["userId"], [F.col("rating").desc(), F.col("movieId").asc()], 10)
    hot = [r.movieId for r in top.filter("userId = 0").collect()]
    exp_hot = exp[exp.userId == 0].sort_values(["rating", "movieId"], ascending=[False, True]).movieId.head(10)
    assert sorted(hot) == sorted(exp_hot.tolist())


def test_hot_user_recommend_exact(spark):
    df, rows = _skewed(spark, items=120, users=40)
    d = dedup_latest(df, ["userId", "movieId"], ["ts", "rating"]).select("userId", "movieId", "rating")
    m = recsys.fit_als(d, recsys.AlsConfig(rank=4, max_iter=5, nonnegative=False))
    uf = {r.id: np.array(r.features) for r in m.userFactors.collect()}
    vf = {r.id: np.array(r.features) for r in m.itemFactors.collect()}
    seen = {}
    for r in d.collect():
        seen.setdefault(r.userId, set()).add(r.movieId)
    got = {}
    for r in recsys.recommend(m, d, n=10).collect():
        got.setdefault(r.userId, []).append((r["rank"], r.movieId))
    for u in (1, 2, 3):
        exp = [i for _, i in sorted((-float(np.float32(uf[u] @ vf[i])), i) for i in vf if i not in seen[u])[:10]]
        assert [i for _, i in sorted(got[u])] == exp
    assert 0 not in got  # the hot user has seen every item


def test_hot_key_centring_and_tag_means(spark):
    from reelhouse.operators.profile import centre_ratings
    from reelhouse.operators.tags import tag_means_by_key
    df, rows = _skewed(spark)
    d = dedup_latest(df.repartition(8), ["userId", "movieId"], ["ts", "rating"]).select("userId", "movieId", "rating")
    pdf = pd.DataFrame([tuple(r) for r in d.collect()], columns=["userId", "movieId", "rating"])
    exp = pdf.assign(n=pdf.rating - pdf.groupby("userId").rating.transform("mean"))
    got = {(r.userId, r.movieId): r.normalized_rating for r in centre_ratings(d).collect()}
    assert len(got) == len(exp)
    assert all(abs(got[(u, m)] - n) < 1e-9 for u, m, _, n in exp.itertuples(index=False))
    # a hot item: item 0 carries a tag shared with no other item
    dim = spark.createDataFrame([(j, "hot|all" if j == 0 else "all") for j in range(300)], "movieId int, genres string")
    means = {r.tag: r.avg_rating for r in tag_means_by_key(d, dim, "movieId", "genres", "|", "rating").collect()}
    assert abs(means["all"] - pdf.rating.mean()) < 1e-9
    assert abs(means["hot"] - pdf[pdf.movieId == 0].rating.mean()) < 1e-9


def _split_plan(spark, make):
    """Executed plan with broadcasts off and low skew thresholds."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = make()
        df.write.format("noop").mode("overwrite").save()
        return df, df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_hot_keys_are_salted_in_joins_with_aggregates(spark):
    from reelhouse.operators.joins import SALTS, enrich_recs
    from reelhouse.operators.profile import centre_ratings
    df, _ = _skewed(spark)
    _, plan = _split_plan(spark, lambda: centre_ratings(df))
    assert "hashpartitioning(userId" in plan and "_salt" in plan
    hot = df.where("userId = 0").selectExpr("pmod(xxhash64(movieId, ts), 16) AS s").groupBy("s").count().collect()
    assert len(hot) == SALTS and max(r["count"] for r in hot) < 3 * 600 / SALTS
    dim = spark.createDataFrame([(j, f"t{j}") for j in range(250)], "movieId int, title string")
    dim = dim.join(dim.select("movieId", dim.title.alias("again")), "movieId")
    recs = df.select(F.col("movieId").alias("userId"), F.col("userId").alias("movieId"))  # one hot item
    for how, rows in (("left", df.count()), ("inner", df.where("userId < 250").count())):
        out, plan = _split_plan(spark, lambda: enrich_recs(recs, dim, how=how, spread=["userId"]))
        assert "_salt" in plan and out.count() == rows and out.columns == ["movieId", "userId", "title", "again"]
