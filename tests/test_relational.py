"""Relational operators against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from punctual.operators import relational as op


@pytest.mark.parametrize("few", [100_000, 0])
def test_as_of_takes_the_latest_up_to_each_moment(spark, monkeypatch, few):
    monkeypatch.setattr(op, "few", lambda df, rows=few: few > 0)
    rng = random.Random(3)
    marks = [(rng.randrange(1000), f"v{rng.randrange(99):02d}") for _ in range(60)] + [(None, "zz")]
    moments = [(i, rng.randrange(-50, 1100)) for i in range(300)] + [(1000, 5), (1001, 5), (1002, None)]
    got = op.as_of(spark.createDataFrame(moments, "i int, at int"), spark.createDataFrame(marks, "since int, label string"), "at", "since", "label", "pick", stretches=7)
    best = {}
    for s, v in marks:
        if s is not None:
            best[s] = max(v, best.get(s, ""))
    first = min((s, v) for s, v in marks if s is not None)[1]
    want = {}
    for i, at in moments:
        known = [s for s in best if at is not None and s <= at]
        want[i] = (best[max(known)], False) if known else (first, True)
    assert {r.i: (r.pick, r.pick_borrowed) for r in got.collect()} == want


def test_previous_row_across_stretches(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), rng.randrange(500), i) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, at int, i int").withColumn("hour", F.floor(F.col("at") / 60))
    got = {r.i: r.before for r in op.previous(df, ["k"], "hour", "at", "i", "before").collect()}
    want = {}
    for k in "ab":
        own = sorted((at, i) for x, at, i in rows if x == k)
        want |= {i: (own[n - 1][0] if n else None) for n, (_, i) in enumerate(own)}
    assert got == want


def test_weighted_quantiles_of_repeated_values(spark):
    rng = random.Random(6)
    rows = [(rng.choice("xy"), float(rng.randrange(8)), rng.randrange(1, 5)) for _ in range(200)]
    got = {r.k: r for r in op.weighted_quantiles(spark.createDataFrame(rows, "k string, v double, w int"), ["k"], "v", "w", {"half": 0.5, "most": 0.9}).collect()}
    for k in "xy":
        spread = sorted(v for x, v, w in rows if x == k for _ in range(w))
        at = lambda share, s=spread: s[max(0, -(-int(share * 1000) * len(s) // 1000) - 1)]
        assert (got[k].half, got[k].most) == (at(0.5), at(0.9)) and got[k]["mean"] == pytest.approx(sum(spread) / len(spread))


@pytest.mark.parametrize("rows", [10, 0])
def test_tables_are_broadcast_by_their_size(spark, rows):
    small = spark.createDataFrame([(1, 2.0), (2, 5.0)], "c int, x double")
    assert op.few(small, 2) and not op.few(small, 1)
    left = spark.createDataFrame([(i, float(i)) for i in range(8)], "i int, y double")
    plan = left.crossJoin(op.bounded(small, rows))._jdf.queryExecution().optimizedPlan().toString()
    assert ("broadcast" in plan) == (rows == 10)
    got = {r.i: r.c for r in op.nearest_one(left, small, ["i"], F.abs(F.col("x") - F.col("y")), ["c"]).collect()}
    assert got == {i: 1 if i <= 3 else 2 for i in range(8)}
