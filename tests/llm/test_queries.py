"""Registered text queries against their oracle SQL, and their plans."""

import os

import duckdb
import pytest

from eventide.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF001, SF01


def oracle(sf_dir, sql):
    c = duckdb.connect()
    for f in os.listdir(sf_dir):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf_dir}/{f}'")
    return c.execute(sql).df()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    want = oracle(SF01, ORACLE_SQL[name])
    got = QUERIES[name](spark, SF01).toPandas()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    a, b = (x[cols].sort_values(cols).reset_index(drop=True) for x in (got, want))
    assert (a == b).all().all()


@pytest.mark.parametrize("name", ["op6_decontamination", "op7_exact_dedup", "op8_chat_format"])
def test_native_plans_hold_no_python(spark, name):
    plan = QUERIES[name](spark, SF001)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "InArrow", "CartesianProduct"))


def test_one_query_per_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 11))
