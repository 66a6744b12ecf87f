"""The reference's windowing SQL run in Spark SQL over TVF-style views."""

from eventide.operators.sqlviews import drop_view, register_window_view
from eventide.plans import REGISTRY
from tests.conftest import SF001


def _setup(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    ev.selectExpr("user_id", "event_id AS item_id", "event_type AS behavior", "ts") \
      .createOrReplaceTempView("user_behavior")


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_tumbling_hopping_cumulative_sql(spark):
    _setup(spark)
    checks = [("tumble", ("1 hour",), "tumble_1h"),
              ("hop", ("5 minutes", "1 hour"), "hop_5m_1h"),
              ("cumulate", ("10 minutes", "1 hour"), "cumulate_10m_1h")]
    for kind, durations, key in checks:
        view = register_window_view(spark, "user_behavior", kind, "ts", *durations)
        got = spark.sql(f"""
            SELECT window_start, window_end, COUNT(*) AS buy_cnt
            FROM {view} WHERE behavior = 'purchase'
            GROUP BY window_start, window_end""")
        want = REGISTRY[key].fn(spark, SF001).select("window_start", "window_end", "buy_cnt")
        assert _rows(got) == _rows(want), kind
        drop_view(spark, view)
    assert not spark.catalog.tableExists("user_behavior_tumble")


def test_filter_reaches_the_scan_through_the_view(spark):
    import contextlib
    import io
    _setup(spark)
    view = register_window_view(spark, "user_behavior", "hop", "ts", "10 seconds", "30 seconds")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        spark.sql(f"SELECT COUNT(*) FROM {view} WHERE behavior = 'purchase'").explain()
    pushed = [ln for ln in buf.getvalue().splitlines() if "PushedFilters" in ln]
    assert pushed and "EqualTo(event_type,purchase)" in pushed[0]
