"""Topic-shaped connectors with a file format standing in for the broker."""

import os
import tempfile

from pyspark.sql import functions as F

from eventide.sources import connectors as K
from eventide.streaming.sinks import json_value
from eventide.sources.tables import read_table
from tests.conftest import SF001


def test_topic_round_trip_and_bounded_peek(spark):
    topic = os.path.join(tempfile.mkdtemp(prefix="eventide-topic-"), "clicks")
    ev = read_table(spark, SF001, "events").select("event_id", "user_id", "event_type")
    K.write_topic(json_value(ev, key="user_id"), topic, fmt="json")
    back = K.read_topic(spark, topic, fmt="json", stream=False)
    assert back.count() == ev.count()
    decoded = back.select(F.from_json("value", "event_id long, event_type string").alias("r"))
    assert decoded.where(F.col("r.event_id").isNull()).count() == 0
    assert K.bounded_peek(spark, topic, 7, fmt="json").count() == 7


def test_topic_stream_source(spark):
    from tests.streamutil import run_to_end, write_batches
    folder = write_batches([[{"key": "a", "value": '{"x": 1}'}], [{"key": "b", "value": '{"x": 2}'}]])
    src = K.read_topic(spark, folder, fmt="json", stream=True)
    got = run_to_end(src.select("key", F.get_json_object("value", "$.x").alias("x")))
    assert sorted((r.key, r.x) for r in got) == [("a", "1"), ("b", "2")]
