from pyspark.sql import functions as F

from reelhouse.functions.casts import epoch_to_ts, id_from_text, safe_cast, to_day
from reelhouse.operators.clean import (dedup_latest, drop_existing, missing_rows, scrub_header_rows,
                                       scrub_null_token)
from tests.conftest import rows


def test_scrub_header_rows_drops_repeated_header_and_null_keys(spark):
    df = spark.createDataFrame([("tconst", "primaryTitle"), ("tt1", "A"), (None, "B"), ("tt2", "\\N")],
                               "tconst string, primaryTitle string")
    assert rows(scrub_header_rows(df, "tconst")) == [("tt1", "A"), ("tt2", "\\N")]
    assert len(rows(scrub_header_rows(df, "tconst", keep_null_keys=True))) == 3


def test_scrub_null_token_every_column(spark):
    df = spark.createDataFrame([("\\N", "x", "\\N"), ("a", "\\N", "b")], "a string, b string, c string")
    got = scrub_null_token(df).collect()
    assert [tuple(r) for r in got] == [(None, "x", None), ("a", None, "b")]


def test_dedup_latest_keeps_latest_and_is_layout_independent(spark):
    data = [(1, 10, 4.0, 100, 1), (1, 10, 5.0, 200, 1),   # later timestamp wins
            (1, 11, 3.0, 50, 2), (1, 11, 2.0, 50, 1),     # equal timestamps: next key decides
            (2, 10, 1.0, None, 1), (2, 10, 2.0, 10, 1)]   # NULL timestamp only wins alone
    df = spark.createDataFrame(data, "userId int, movieId int, rating double, ts long, line int")
    expect = [(1, 10, 5.0, 200, 1), (1, 11, 3.0, 50, 2), (2, 10, 2.0, 10, 1)]
    for layout in (df, df.repartition(1), df.repartition(7, "rating")):
        assert rows(dedup_latest(layout, ["userId", "movieId"], ["ts", "line"])) == expect


def test_dedup_full_tie_is_deterministic(spark):
    df = spark.createDataFrame([(1, 1, 3.0, 5), (1, 1, 4.0, 5), (1, 1, 4.0, 5)],
                               "userId int, movieId int, rating double, ts long")
    assert rows(dedup_latest(df, ["userId", "movieId"], ["ts"])) == [(1, 1, 4.0, 5)]


def test_number_text_casts(spark):
    df = spark.createDataFrame([("4.5",), ("x",), ("",), ("862.0",), ("99999999999",), (None,)], "v string")
    got = [tuple(r) for r in df.select(safe_cast("v", "double").alias("f"), id_from_text("v").alias("i"),
                                       safe_cast("v", "int").alias("plain")).collect()]
    assert got == [(4.5, 4, None), (None, None, None), (None, None, None), (862.0, 862, None),
                   (99999999999.0, None, None), (None, None, None)]


def test_epoch_keeps_repeated_dst_hour_and_utc_day(spark):
    df = spark.createDataFrame([("1130632200",), ("1130635800",), ("946684799",)], "e string")
    out = df.select(F.unix_seconds(epoch_to_ts("e")).alias("back"), to_day(epoch_to_ts("e")).alias("d")).collect()
    assert [r.back for r in out] == [1130632200, 1130635800, 946684799]
    assert str(out[2].d) == "1999-12-31"


def test_missing_rows_and_drop_existing(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, "g"), (3, "c", "g")], "id int, title string, genres string")
    assert [r.id for r in missing_rows(df, ["title", "genres"]).collect()] == [1, 2]
    assert drop_existing(df, "genres", "nope").columns == ["id", "title"]


def test_tune_for_input_sizes_shuffles(spark):
    from reelhouse.session import tune_for_input
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes",
                                              "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    try:
        conf = tune_for_input(spark, 100 * 2**40)  # 100 TiB
        assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 << 20)
        assert tune_for_input(spark, 10 << 20)["spark.sql.shuffle.partitions"] == "200"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
