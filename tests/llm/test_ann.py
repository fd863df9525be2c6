import numpy as np
import pytest
from pyspark.sql import functions as F

from punctual.llm import ann

SCHEMA = "vec_id long, embedding array<float>, score double, rank string"


def brute(rows, step, k=5):
    good = {}
    for i, v, *_ in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v) and len(v) == 8:
            good[i] = np.array(v, np.float32).astype(np.float64)
    ids = np.array(sorted(good))
    x = np.array([good[i] for i in ids])
    out = {}
    for i in ids[ids % step == 0]:
        s = ann.cosines(np.broadcast_to(good[i], x.shape), x)
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
        out[int(i)] = [(int(ids[j]), s[j]) for j in order]
    return out


def vectors(n, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 8))
    return [(i, [float(z) for z in (centres[i % 12] + 0.4 * rng.normal(size=8)).astype(np.float32)], 0.0, "") for i in range(n)]


def found(spark, rows, step, **options):
    out = {}
    for r in ann.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % step == 0, **options).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_recall_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ann, "LEAF", 40)
    monkeypatch.setattr(ann, "BLOCK", 16)
    monkeypatch.setattr(ann, "ASKED", 8)
    rows = vectors(1500)
    got, want = found(spark, rows, 10), brute(rows, 10)
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want]
    assert np.sum(hits) / (5 * len(want)) >= 0.9


def test_the_tree_grows_beyond_its_first_sample(spark, monkeypatch):
    monkeypatch.setattr(ann, "SAMPLE", 100)
    monkeypatch.setattr(ann, "LEAF", 25)
    rows, seen = vectors(2000, seed=3), []
    deepened = ann._deepened
    monkeypatch.setattr(ann, "_deepened", lambda *a: seen.append((a[3], deepened(*a))) or seen[-1][1])
    got, want = found(spark, rows, 10), brute(rows, 10)
    assert seen and seen[0][1] > 5 * seen[0][0]
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want]
    assert np.sum(hits) / (5 * len(want)) >= 0.9


def test_flattened_trees_are_the_same_again():
    rng = np.random.default_rng(5)
    x = ann.unit(rng.normal(size=(400, 6)))
    root, n = ann.grow(x, 20)
    again = ann.Node()
    ann.grafted(again, ann.flat(root))
    for i, leaf in enumerate(ann.leaves(root)):
        leaf.leaf = i
    for i, leaf in enumerate(ann.leaves(again)):
        leaf.leaf = i
    assert n == len(ann.leaves(again)) and (ann.place(root, x) == ann.place(again, x)).all()


def test_copies_ties_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(ann, "FAN", 7)
    same, nan = [float(x) for x in range(1, 9)], float("nan")
    rows = vectors(60) + [(100 + i, same, 0.0, "") for i in range(80)] + [(110, same, 1.0, "again")]
    rows += [(500, None, 0.0, ""), (510, [0.0] * 8, 0.0, ""), (520, [nan] * 8, 0.0, ""), (530, [None] * 8, 0.0, ""), (540, [1.0], 0.0, ""), (550, [], 0.0, ""), (None, same, 0.0, "")]
    got, want = found(spark, rows, 10), brute(rows, 10)
    assert set(got) == set(want)
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=1e-12)


def test_few_candidates(spark):
    assert found(spark, vectors(3), 1) == {q: [(i, pytest.approx(s)) for i, s in v] for q, v in brute(vectors(3), 1).items()}
    assert found(spark, vectors(1), 1) == {}
    assert found(spark, [], 1) == {}


def test_share_asked_by_default():
    assert ann.RECALL >= 0.97
