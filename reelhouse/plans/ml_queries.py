"""Registered ALS queries.

Model output itself has no SQL form, so six raw outputs (``als_recs_*``,
``als_rmse_value``, ``als_run_metrics_values``) have no oracle.  The others report what SQL can derive about a run: the split rows,
how many items each user must get, which pairs can be scored, that
recomputed errors agree.  Every query writes its own gold fact and fits its
own model; nothing is kept between queries.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from reelhouse.operators import recsys
from reelhouse.plans import standins as S
from reelhouse.plans.queries import R, RECS_PER_USER, query, with_ctes
from reelhouse.session import scratch_path, written
from reelhouse.sources import tables

FIRST = recsys.AlsConfig()  # nonnegative model
SECOND = recsys.AlsConfig(nonnegative=False)  # publication model

SPLIT_SQL = f"""sided AS (SELECT userId, movieId, rating,
  substr(md5(CAST(userId AS VARCHAR) || '-' || CAST(movieId AS VARCHAR) || '-{FIRST.seed}'), 1, 8) < 'cccccccc' AS in_train
  FROM ratings),
train AS (SELECT userId, movieId, rating FROM sided WHERE in_train),
test AS (SELECT userId, movieId, rating FROM sided WHERE NOT in_train),
model_users AS (SELECT DISTINCT userId FROM train),
model_items AS (SELECT DISTINCT movieId FROM train),
scored AS (SELECT t.* FROM test t JOIN model_users USING (userId) JOIN model_items USING (movieId))"""
P = with_ctes(R, SPLIT_SQL)


def gold_ratings(spark, sf_dir, seed=None):
    """The deduplicated ratings written once (the gold fact the model reads),
    so the fit, the split and the seen pairs do not each rebuild it.  With
    ``seed`` the side of the split is stored beside them."""
    rows = S.ratings(spark, sf_dir)
    return written(rows if seed is None else recsys.with_side(rows, seed=seed), "gold_fact_ratings")


def _fitted(spark, sf_dir, cfg, fact=None):
    """(gold fact, test side, model) of one run (``fact``: written before, with the sides of its seed)."""
    fact = gold_ratings(spark, sf_dir, cfg.seed) if fact is None else fact
    train, test = recsys.stored_split(fact)
    return fact.drop(recsys.SIDE), test, recsys.fit_als(train, cfg)


@query("als_split", P + "SELECT userId, movieId, rating, in_train FROM sided")
def q_als_split(spark, sf_dir):
    train, test = recsys.split_ratings(S.ratings(spark, sf_dir).select("userId", "movieId", "rating"), seed=FIRST.seed)
    return train.withColumn("in_train", F.lit(True)).unionByName(test.withColumn("in_train", F.lit(False)))


@query("rmse_user_mean", P + """, means AS (SELECT userId, avg(rating) AS prediction FROM train GROUP BY userId)
SELECT round(sqrt(avg((t.rating - m.prediction) * (t.rating - m.prediction))), 6) AS rmse, count(*) AS predicted
FROM test t JOIN means m USING (userId)""")
def q_rmse_user_mean(spark, sf_dir):
    """The RMSE operator over a predictor that SQL can compute too."""
    train, test = recsys.split_ratings(gold_ratings(spark, sf_dir), seed=FIRST.seed)
    means = train.groupBy("userId").agg(F.avg("rating").alias("prediction"))
    return recsys.rmse(test.join(means, "userId", "left")).withColumn("rmse", F.round("rmse", 6))


@query("als_recs_unseen")
def q_als_recs_unseen(spark, sf_dir):
    fact, _, m = _fitted(spark, sf_dir, FIRST)
    return recsys.recommend(m, fact, RECS_PER_USER, exclude_seen=True)


# Whole-number factors from given columns: products are exact in every engine,
# many of them tie, and SQL can score all pairs.
FACTORS_SQL = """user_factors AS (
  SELECT CAST(c_custkey AS INTEGER) AS userId, c_custkey % 11 AS f0, c_nationkey % 5 AS f1, c_custkey % 3 - 1 AS f2, 1 AS f3 FROM customer),
item_factors AS (
  SELECT CAST(p_partkey AS INTEGER) AS movieId, p_size * (CASE WHEN p_partkey % 29 = 0 THEN 20 ELSE 1 END) AS g0, p_partkey % 13 AS g1,
         p_partkey % 7 - 3 AS g2, length(p_name) % 5 AS g3 FROM part),
pairs AS (SELECT userId, movieId, CAST(f0 * g0 + f1 * g1 + f2 * g2 + f3 * g3 AS FLOAT) AS prediction FROM user_factors, item_factors)"""
_BEST_SQL = f"""SELECT userId, movieId, prediction, CAST(rk AS INTEGER) AS "rank" FROM (
  SELECT *, row_number() OVER (PARTITION BY userId ORDER BY prediction DESC, movieId) AS rk FROM scored) WHERE rk <= {RECS_PER_USER}"""


class WholeFactors:
    """Stand-in model over :data:`FACTORS_SQL`."""

    def __init__(self, spark, sf_dir):
        def made(name, key, *factors):
            return S.table(spark, sf_dir, name).select(F.expr(f"int({key})").alias("id"), F.array(
                *(F.expr(f).cast("float") for f in factors)).alias("features"))

        self.userFactors = made("customer", "c_custkey", "c_custkey % 11", "c_nationkey % 5", "c_custkey % 3 - 1", "1")
        self.itemFactors = made("part", "p_partkey", "p_size * (CASE WHEN p_partkey % 29 = 0 THEN 20 ELSE 1 END)",
                                "p_partkey % 13", "p_partkey % 7 - 3", "length(p_name) % 5")


def _whole_top(spark, sf_dir, exclude_seen):
    m = WholeFactors(spark, sf_dir)
    return recsys.recommend(m, gold_ratings(spark, sf_dir), RECS_PER_USER, exclude_seen=exclude_seen,
                            users=m.userFactors.select(F.col("id").alias("userId")))


@query("pruned_top_unseen", with_ctes(R, FACTORS_SQL, """scored AS (
  SELECT p.* FROM pairs p LEFT JOIN ratings r ON p.userId = r.userId AND p.movieId = r.movieId WHERE r.movieId IS NULL)""") + _BEST_SQL)
def q_pruned_top_unseen(spark, sf_dir):
    """The exact bound-pruned top n of unseen items, against scoring all pairs."""
    return _whole_top(spark, sf_dir, True)


@query("pruned_top_all", with_ctes(FACTORS_SQL, "scored AS (SELECT * FROM pairs)") + _BEST_SQL)
def q_pruned_top_all(spark, sf_dir):
    return _whole_top(spark, sf_dir, False)


def _report(recs, seen):
    """Per user: items, distinct items, last rank, pairs already seen."""
    hits = seen.select("userId", "movieId").withColumn("hit", F.lit(1))
    return recs.join(hits, ["userId", "movieId"], "left").groupBy("userId").agg(
        F.count("*").alias("items"), F.countDistinct("movieId").alias("distinct_items"),
        F.max("rank").cast("int").alias("last_rank"), F.count("hit").alias("seen_items"))


@query("als_unseen_check", P + f""", due AS (
  SELECT u.userId, (SELECT count(*) FROM model_items) - count(i.movieId) AS unseen
  FROM model_users u LEFT JOIN ratings r USING (userId) LEFT JOIN model_items i ON r.movieId = i.movieId GROUP BY u.userId)
SELECT userId, least({RECS_PER_USER}, unseen) AS items, least({RECS_PER_USER}, unseen) AS distinct_items,
       CAST(least({RECS_PER_USER}, unseen) AS INTEGER) AS last_rank, CAST(0 AS BIGINT) AS seen_items FROM due WHERE unseen > 0""")
def q_als_unseen_check(spark, sf_dir):
    fact, _, m = _fitted(spark, sf_dir, FIRST)
    return _report(recsys.recommend(m, fact, RECS_PER_USER, exclude_seen=True), fact)


@query("als_recs_all")
def q_als_recs_all(spark, sf_dir):
    fact, _, m = _fitted(spark, sf_dir, SECOND)
    return recsys.recommend(m, fact, RECS_PER_USER, exclude_seen=False)


@query("als_all_check", P + f"""
SELECT userId, least({RECS_PER_USER}, (SELECT count(*) FROM model_items)) AS items FROM model_users""")
def q_als_all_check(spark, sf_dir):
    fact, _, m = _fitted(spark, sf_dir, SECOND)
    return recsys.recommend(m, fact, RECS_PER_USER, exclude_seen=False).groupBy("userId").agg(F.count("*").alias("items"))


@query("als_recs_subset")
def q_als_recs_subset(spark, sf_dir):
    fact, _, m = _fitted(spark, sf_dir, SECOND)
    return recsys.recommend_nested(m, RECS_PER_USER, fact.select("userId"))


@query("als_recs_nested_all")
def q_als_recs_nested_all(spark, sf_dir):
    return recsys.recommend_nested(_fitted(spark, sf_dir, SECOND)[2], RECS_PER_USER)


@query("als_nested_check", P + f"""
SELECT userId, least({RECS_PER_USER}, (SELECT count(*) FROM model_items)) AS items, true AS subset_agrees FROM model_users""")
def q_als_nested_check(spark, sf_dir):
    """Both nested forms flattened: sizes, and the same predictions."""
    fact, _, m = _fitted(spark, sf_dir, SECOND)

    def per_user(nested):
        return recsys.flatten_recs(nested).groupBy("userId").agg(
            F.count("*").alias("items"), F.array_sort(F.collect_list("prediction")).alias("p"))

    every = per_user(recsys.recommend_nested(m, RECS_PER_USER))
    some = per_user(recsys.recommend_nested(m, RECS_PER_USER, fact.select("userId"))).select("userId", F.col("p").alias("q"))
    return every.join(some, "userId", "left").select("userId", "items", F.coalesce(F.col("p") == F.col("q"), F.lit(False)).alias("subset_agrees"))


def _recomputed(test, m):
    """RMSE and rows scored, from the factors themselves."""
    dot = F.aggregate(F.zip_with("f", "g", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, x: s + x)
    rows = test.join(m.userFactors.select(F.col("id").alias("userId"), F.col("features").alias("f")), "userId") \
        .join(m.itemFactors.select(F.col("id").alias("movieId"), F.col("features").alias("g")), "movieId")
    return rows.agg(F.count("*").alias("predicted"), F.sqrt(F.avg(F.pow(F.col("rating") - dot, 2))).alias("rmse"))


@query("als_rmse_value")
def q_als_rmse_value(spark, sf_dir):
    """RMSE of the first model and the rows scored."""
    _, test, m = _fitted(spark, sf_dir, FIRST)
    return recsys.rmse(m.transform(test))


@query("als_rmse", P + "SELECT count(*) AS predicted, true AS agrees FROM scored")
def q_als_rmse(spark, sf_dir):
    """RMSE of the first model: rows scored, and agreement with the error
    recomputed from the factors themselves."""
    _, test, m = _fitted(spark, sf_dir, FIRST)
    own = recsys.rmse(m.transform(test)).first()
    return _recomputed(test, m).select("predicted", (F.abs(F.col("rmse") - F.lit(own["rmse"])) < 1e-4).alias("agrees"))


@query("als_run_metrics_values")
def q_als_run_metrics_values(spark, sf_dir):
    """The run log of both models, with the RMSE."""
    out, fact = [], gold_ratings(spark, sf_dir, FIRST.seed)  # SECOND has the same seed
    for cfg in (FIRST, SECOND):
        _, test, m = _fitted(spark, sf_dir, cfg, fact)
        out.append(recsys.run_metrics(cfg, recsys.rmse(m.transform(test))))
    return out[0].unionByName(out[1])


@query("als_run_metrics", f"""SELECT * FROM (VALUES ('{FIRST.run_id()}', 10, 10, CAST(0.1 AS DOUBLE), true, true),
  ('{SECOND.run_id()}', 10, 10, CAST(0.1 AS DOUBLE), false, true)) AS t(run_id, "rank", maxIter, regParam, nonnegative, evaluated)""")
def q_als_run_metrics(spark, sf_dir):
    """The run log of both models; ``evaluated``: its RMSE agrees with the
    error recomputed from the factors."""
    out, fact = [], gold_ratings(spark, sf_dir, FIRST.seed)  # SECOND has the same seed
    for cfg in (FIRST, SECOND):
        _, test, m = _fitted(spark, sf_dir, cfg, fact)
        again = _recomputed(test, m).first()["rmse"]
        agrees = F.coalesce(F.abs(F.col("rmse") - F.lit(again).cast("double")) < 1e-4, F.lit(False))
        out.append(recsys.run_metrics(cfg, recsys.rmse(m.transform(test))).withColumn("evaluated", agrees).drop("rmse"))
    return out[0].unionByName(out[1])


@query("als_model_roundtrip", P + "SELECT count(*) AS scored, CAST(0 AS FLOAT) AS max_gap FROM scored")
def q_als_model_roundtrip(spark, sf_dir):
    """Save, load, score the test split with both; report the largest gap."""
    _, test, m = _fitted(spark, sf_dir, FIRST)
    path = scratch_path(spark, "als_model")
    recsys.save_model(m, path)
    back = recsys.load_model(path)
    a = m.transform(test).select("userId", "movieId", F.col("prediction").alias("p1"))
    b = back.transform(test).select("userId", "movieId", F.col("prediction").alias("p2"))
    j = a.join(b, ["userId", "movieId"], "inner")
    return j.agg(F.count(F.lit(1)).alias("scored"), F.max(F.abs(F.col("p1") - F.col("p2"))).alias("max_gap"))


RUN_TIMES = ("2024-05-01 06:00:00", "2024-05-02 06:00:00")


@query("run_log_append", P + f""", means AS (SELECT userId, avg(rating) AS prediction FROM train GROUP BY userId),
overall AS (SELECT avg(rating) AS prediction FROM train),
by_user AS (SELECT round(sqrt(avg((t.rating - m.prediction) * (t.rating - m.prediction))), 6) AS rmse FROM test t JOIN means m USING (userId)),
by_all AS (SELECT round(sqrt(avg((t.rating - m.prediction) * (t.rating - m.prediction))), 6) AS rmse FROM test t, overall m)
SELECT '{FIRST.run_id()}' AS run_id, '{RUN_TIMES[0]}' AS run_at, rmse FROM by_user
UNION ALL SELECT '{FIRST.run_id()}', '{RUN_TIMES[1]}', rmse FROM by_all
UNION ALL SELECT '{SECOND.run_id()}', '{RUN_TIMES[1]}', rmse FROM by_all""")
def q_run_log_append(spark, sf_dir):
    """The run log keeps every run: two runs of one configuration, one of
    another, the last of them committed twice.  Predictors are means, which SQL has too."""
    train, test = recsys.split_ratings(gold_ratings(spark, sf_dir), seed=FIRST.seed)
    means = train.groupBy("userId").agg(F.avg("rating").alias("prediction"))
    by_user = recsys.rmse(test.join(means, "userId", "left"))
    by_all = recsys.rmse(test.withColumn("prediction", train.agg(F.avg("rating")).scalar()))
    name = f"{tables.ensure_database(spark, f'rh_{uuid.uuid4().hex[:10]}', scratch_path(spark, 'runs'))}.gold_run_metrics"
    for cfg, rmse, at in ((FIRST, by_user, 0), (FIRST, by_all, 1), (SECOND, by_all, 1), (SECOND, by_all, 1)):
        tables.append_run(recsys.run_metrics(cfg, rmse), name, RUN_TIMES[at])
    return spark.table(name).select("run_id", F.date_format("run_at", "yyyy-MM-dd HH:mm:ss").alias("run_at"), F.round("rmse", 6).alias("rmse"))
