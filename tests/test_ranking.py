import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reelhouse.operators.ranking import best_row, rows_at_max, top_k, top_n_per_group
from tests.conftest import rows


def test_top_n_ties_at_cut_use_id(spark):
    df = spark.createDataFrame([(1, i, 5.0) for i in range(15)] + [(2, 1, 1.0)],
                               "userId int, movieId int, prediction double")
    out = top_n_per_group(df, ["userId"], [F.col("prediction").desc(), F.col("movieId").asc()], 10, "rank")
    got = rows(out)
    assert sorted(r[1] for r in got if r[0] == 1) == list(range(10))
    assert len([r for r in got if r[0] == 2]) == 1


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 30), st.integers(0, 5)), min_size=1, max_size=60),
       st.integers(1, 4))
def test_top_n_matches_pandas(spark, data, n):
    data = list({(g, i): (g, i, s) for g, i, s in data}.values())
    df = spark.createDataFrame(data, "g int, i int, s int")
    got = rows(top_n_per_group(df.repartition(3), ["g"], [F.col("s").desc(), F.col("i").asc()], n))
    pdf = pd.DataFrame(data, columns=["g", "i", "s"]).sort_values(["g", "s", "i"], ascending=[True, False, True])
    exp = sorted(tuple(int(x) for x in t) for t in pdf.groupby("g").head(n).itertuples(index=False))
    assert sorted(got) == exp


def test_best_row_and_top_k_and_rows_at_max(spark):
    df = spark.createDataFrame([("a", 1.0, 5), ("a", 2.0, 1), ("b", 2.0, 7), ("c", 2.0, 7)],
                               "k string, r double, v int")
    assert rows(best_row(df, ["k"], ["r", "v"])) == [("a", 2.0, 1), ("b", 2.0, 7), ("c", 2.0, 7)]
    assert rows(top_k(df, [F.col("v").desc(), F.col("k").asc()], 2), order=True) == [("b", 2.0, 7), ("c", 2.0, 7)]
    assert [r.k for r in rows_at_max(df, "v").orderBy("k").collect()] == ["b", "c"]


def test_window_group_limit_in_plan(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), F.col("id"))
    out = top_n_per_group(df, ["g"], [F.col("id").desc()], 3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
