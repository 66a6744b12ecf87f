"""Exactly one row per key, whatever ties there are; sums of large and fine amounts."""

import datetime as dt

from pyspark.sql import functions as F

from eventide.operators import ranking as R
from eventide.plans.windowing import as_double, exact


def test_equal_positions_give_one_row(spark):
    df = spark.createDataFrame(
        [(1, 5, "a"), (1, 5, "b"), (1, 4, "c"), (2, 1, "d"), (2, 1, "d"), (None, 3, "e"),
         (None, 3, "f"), (3, None, "g")], "k int, at long, v string")
    for pick, at in ((R.dedup_last, {1: 5, 2: 1, None: 3, 3: None}),
                     (R.dedup_first, {1: 4, 2: 1, None: 3, 3: None})):
        got = pick(df, ["k"], ["at"]).collect()
        assert len(got) == 4 and {r.k: r["at"] for r in got} == at
        assert got == pick(df.repartition(7, "v"), ["k"], ["at"]).orderBy(
            F.col("k").asc()).collect() or {tuple(r) for r in got} == {
                tuple(r) for r in pick(df.repartition(7, "v"), ["k"], ["at"]).collect()}


def test_map_columns_are_allowed(spark):
    df = spark.createDataFrame([(1, 1, {"a": 1}), (1, 1, {"b": 2})],
                               "k int, at int, m map<string,int>")
    assert R.dedup_last(df, ["k"], ["at"]).count() == 1


def test_rows_of_a_hot_key_are_not_shuffled_twice(spark):
    """With broadcast off: the aggregate, both sides of the join, and what is left of the rows."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("at"))
        out = R.dedup_last(df, ["k"], ["at"])
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        assert "WindowGroupLimit" in final
        assert final.count("Exchange hashpartitioning") <= 4
    finally:
        spark.conf.set(key, before)


def test_sums_beyond_the_long_range_and_fine_amounts(spark):
    df = spark.createDataFrame([(1e13,), (2.5,), (0.123456789012,)], "value double")
    total = df.agg(as_double(F.sum(exact()))).first()[0]
    assert total == 10000000000002.62345679
    assert spark.createDataFrame([(1e19,)] * 5, "value double").agg(
        as_double(F.sum(exact()))).first()[0] == 5e19


def test_window_dedup_takes_one_of_equal_rows(spark):
    t = dt.datetime(2024, 1, 1, 3)
    df = spark.createDataFrame([(1, t, 1, "x"), (1, t, 1, "y")],
                               "u int, ts timestamp_ntz, id long, v string")
    assert R.window_dedup(df, "ts", "1 day", ["u"], ["ts", "id"]).count() == 1
