import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from punctual.llm import graph
from punctual.llm.graph import components


def brute(edges):
    label = {}

    def top(x):
        label.setdefault(x, x)
        while label[x] != x:
            x = label[x]
        return x

    for a, b in edges:
        x, y = top(a), top(b)
        if a != b:
            label[max(x, y)] = min(x, y)
    return {x: top(x) for e in edges if e[0] != e[1] for x in e}


def found(spark, edges):
    return {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}


def test_paths_stars_and_copies(spark):
    rng = random.Random(0)
    path = [(i, i + 1) for i in range(60)]
    star = [(100, 100 + i) for i in range(1, 50)]
    edges = [*path, *star, (7, 7), (500, 499), (500, 499), (499, 500)]
    rng.shuffle(edges)
    assert found(spark, edges) == brute(edges)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), min_size=1, max_size=40))
def test_any_graph(spark, edges):
    assert found(spark, edges) == brute(edges)


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_many_edges_go_through_joins(spark, monkeypatch):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(40)] + [(-(2**60), 2**60), (300, None)]
    want = brute([e for e in edges if None not in e])
    assert found(spark, edges) == want
    monkeypatch.setattr(graph, "FEW", 0)
    assert found(spark, edges) == want


def test_few_edges_take_few_jobs(spark):
    # A round of joins costs its jobs however few edges there are: with many shuffle partitions that took minutes.
    edges, sc = [(i, i + 1) for i in range(200)], spark.sparkContext
    sc.setJobGroup("few edges", "few edges")
    try:
        assert found(spark, edges) == brute(edges)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc.statusTracker().getJobIdsForGroup("few edges")) <= 8
