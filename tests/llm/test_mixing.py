import pytest
from pyspark.sql import functions as F

from punctual.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string"


def water(sizes, share=1.5, limit=2.0):
    """Targets by the rule as told: deal, cap, deal the excess again."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, full = share * sum(sizes.values()), set()
    while True:
        left = total - sum(limit * sizes[s] for s in full)
        open_ = [s for s in order if s not in full]
        target = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if target[s] > limit * sizes[s] + 1e-9}
        if not over:
            return target | {s: limit * sizes[s] for s in full}
        full |= over


def rows():
    out = [(i, " ".join(["w"] * (i * 7 % 83 + 1)), f"s{i % 9}" if i % 11 else "big", "") for i in range(4000)]
    return [*out, (9000, None, None, ""), (9001, "a b c", None, None), (9002, "", "empty", ""), (9003, "x" * 100_000, "é", ""), (None, "a b", "s1", "")]


def test_targets_and_words_taken(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 50)
    got = mixing.plan(spark.createDataFrame(rows(), SCHEMA)).collect()
    assert len(got) == len(rows())
    sizes = {}
    for r in got:
        assert r.size == len((r.text or "").split()) and 0 <= r.taken <= 2 * r.size
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    want = water(sizes)
    for s in sizes:
        own = [r for r in got if r.source == s]
        assert own[0].target == pytest.approx(want[s]) and own[0].source_size == sizes[s]
        assert abs(sum(r.taken for r in own) - want[s]) <= 2 * max(r.size for r in own)


def test_reruns_agree_and_copies_come_out(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    runs = [mixing.plan(docs.repartition(n)).groupBy("doc_id").agg(F.sum("copies").alias("c")).collect() for n in (1, 6)]
    assert sorted(map(str, runs[0])) == sorted(map(str, runs[1]))
    assert mixing.mixed(docs).count() == sum(r.c for r in runs[0])


def test_empty_table(spark):
    assert mixing.plan(spark.createDataFrame([], SCHEMA)).count() == 0


def test_documents_without_id_are_spread_and_reruns_agree(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 20)
    docs = spark.createDataFrame([(None, " ".join(["w"] * (i % 60)), "a" if i % 3 else None, "") for i in range(900)], SCHEMA)
    runs = [sorted(map(str, mixing.plan(docs.repartition(n)).select("source", "size", "taken").collect())) for n in (1, 5)]
    assert runs[0] == runs[1]
