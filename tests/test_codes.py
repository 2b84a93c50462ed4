"""Digit-code functions and the closed-form oracle on full code domains."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from stellate.functions.codes import (code_of_number, code_string, digit_sum, digits, is_valid,
                                      shard_name, shard_names, shard_of)
from stellate.operators.components import connected_components
from stellate.operators.neighbors import neighbor_edges, neighbors, stored_neighbors
from stellate.operators.table import relabel
from stellate.sources.codes import enumerate_codes


def one(spark, expr, uid):
    return spark.createDataFrame([(uid,)], "uid string").select(expr.alias("x")).first()["x"]


def test_scalar_functions(spark):
    assert one(spark, digits("uid"), "09999") == [0, 9, 9, 9, 9]
    assert one(spark, digit_sum(digits("uid")), "09999") == 36
    assert one(spark, shard_of("uid"), "09999") == 0
    assert one(spark, code_string(digits("uid")), "09999") == "09999"
    assert one(spark, is_valid(digits("uid")), "0a9") is False
    assert one(spark, is_valid(digits("uid")), "019") is True
    assert one(spark, shard_name(shard_of("uid")), "31") == "connector_3"
    assert one(spark, shard_names(3, "p"), "0") == ["p_0", "p_1", "p_2"]
    df = spark.createDataFrame([(7,), (123456,)], "n bigint")
    assert [r[0] for r in df.select(code_of_number("n", 5)).collect()] == ["00007", None]


def test_neighbor_cases(spark):
    codes = spark.createDataFrame([("00",), ("01",), ("10",), ("5",)], "uid string")
    got = {(r.uid, r.nbr) for r in neighbors(codes).collect()}
    assert got == {("01", "10"), ("10", "01")}  # '00' and one-digit codes have none


def slow_neighbors(code):
    d = [int(c) for c in code]
    out = []
    for x in range(len(d)):
        for y in range(len(d)):
            if x != y and d[x] < 9 and d[y] > 0:
                n = list(d)
                n[x] += 1
                n[y] -= 1
                out.append("".join(map(str, n)))
    return out


def test_neighbors_match_brute_force(spark):
    codes = ["09999", "12345", "90000", "55555", "00001"]
    df = spark.createDataFrame([(c,) for c in codes], "uid string")
    got = sorted((r.uid, r.nbr) for r in neighbors(df).collect())
    exp = sorted((c, n) for c in codes for n in slow_neighbors(c))
    assert got == exp


@pytest.mark.parametrize("length", [1, 2, 3, 4])
def test_full_domain_closed_form(spark, length):
    t = enumerate_codes(spark, length)
    assert t.count() == 10 ** length
    e = neighbor_edges(t)
    if length >= 2:
        # each unordered pair once: L(L-1)*81*10^(L-2) directed edges / 2
        assert e.count() * 2 == length * (length - 1) * 81 * 10 ** (length - 2)
    out = relabel(t, connected_components(e))
    # components are the digit-sum classes, label = least code of the class
    chk = out.withColumn("s", digit_sum(digits("uid")))
    per_class = chk.groupBy("s").agg(F.countDistinct("cmp").alias("k"),
                                     F.min("cmp").alias("c"), F.min(F.col("uid").cast("bigint")).alias("m"))
    rows = per_class.collect()
    assert len(rows) == 9 * length + 1
    assert all(r.k == 1 and r.c == r.m for r in rows)


def test_stored_neighbors_and_shard_view(spark):
    t = enumerate_codes(spark, 3).where(F.col("uid").isin("100", "010", "001", "200"))
    codes = spark.createDataFrame([("100",)], "uid string")
    every = {r.nbr for r in stored_neighbors(codes, t).collect()}
    assert every == {"010", "001"}
    assert stored_neighbors(codes, t, within_shard=True).count() == 0


def test_within_shard_takes_the_stored_shard(spark):
    """Shards that were given with the items, not computed from them."""
    from stellate.operators.neighbors import stored_neighbors

    t = spark.createDataFrame([("12", 0, False, 7), ("21", 1, False, 7), ("30", 2, False, 8), ("03", 3, False, None)],
                              "uid string, cmp bigint, mapped boolean, shard int")
    got = {(r.uid, r.nbr) for r in stored_neighbors(t, t, within_shard=True).collect()}
    assert got == {("12", "21"), ("21", "12")}
    by_rule = {(r.uid, r.nbr) for r in stored_neighbors(t.select("uid"), t, within_shard=True).collect()}
    assert by_rule == set()  # the first digits name no stored shard
