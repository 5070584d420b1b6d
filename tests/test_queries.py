"""Every registered query against its SQL on the smallest tables."""

import pytest

from oracle import compare, connect
from driftwell.plans.registered import QUERIES

WITH_SQL = sorted(n for n, q in QUERIES.items() if q.sql)
WITHOUT_SQL = sorted(n for n, q in QUERIES.items() if not q.sql)


@pytest.fixture(scope="module")
def con(data_dir):
    return connect(data_dir)


@pytest.mark.parametrize("name", WITH_SQL)
def test_matches_sql(name, spark, con, data_dir):
    verdict, _ = compare(con, QUERIES[name], spark, data_dir)
    assert verdict.startswith("ok ("), verdict


@pytest.mark.parametrize("name", WITHOUT_SQL)
def test_runs(name, spark, con, data_dir):
    verdict, _ = compare(con, QUERIES[name], spark, data_dir)
    assert verdict.startswith("rows only") and not verdict.endswith(": 0"), verdict


@pytest.mark.parametrize("name", ["psi", "jensen_shannon", "missingness", "ks_whole_slices", "duplicate_rows"])
def test_few_scans(name, spark, data_dir):
    df = QUERIES[name].job(spark, data_dir)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert 1 <= plan.count("FileScan") <= 2


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 5


def test_names():
    assert not any(n.startswith("op") and n[2:3].isdigit() or "pipeline" in n for n in QUERIES)
