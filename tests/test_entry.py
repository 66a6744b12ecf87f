"""The driver contract: entry(), queries() and oracle_sql() on the smallest tables."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF001


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["window_end_ms", "driver_id", "tips"]
    assert df.count() > 0


def test_oracle_keys_are_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    # every query of the library itself has an oracle
    own = {n for n in q if n != "pipeline" and not n.startswith("op")}
    assert len(own) >= 65 and own <= set(o)


OWN = sorted(n for n in E.queries() if n != "pipeline" and not n.startswith("op"))


@pytest.mark.parametrize("name", OWN)
def test_every_query_runs_with_stable_schema(spark, name):
    df = E.queries()[name](spark, SF001)
    schema = df.schema
    df.write.format("noop").mode("overwrite").save()
    assert E.queries()[name](spark, SF001).schema == schema
