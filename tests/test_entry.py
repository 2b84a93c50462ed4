"""The driver contract: entry() runs, every query has an oracle."""

from __future__ import annotations

from __spark_entry__ import entry, oracle_sql, queries


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["uid", "cmp", "mapped", "shard"]
    assert df.count() == 150


def test_every_query_has_oracle():
    from stellate.plans.catalog import ORACLE_SQL, QUERIES

    assert set(QUERIES) == set(ORACLE_SQL) <= set(oracle_sql()) <= set(queries())
    from stellate.plans import stored

    assert set(stored.QUERIES) == set(stored.ORACLE_SQL) <= set(oracle_sql())
    assert not set(stored.QUERIES) & set(QUERIES)


def test_rounds_split_equals_one_shot_on_lineitem(spark):
    from __spark_entry__ import queries

    q = queries()
    d = "/root/testdata/sf0.001"
    a = sorted(map(tuple, q["merge_rounds"](spark, d).collect()))
    b = sorted(map(tuple, q["components_order_part"](spark, d).collect()))
    assert a == b and len(a) > 0
