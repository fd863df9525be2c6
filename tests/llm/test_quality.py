import numpy as np

from punctual.llm import quality

DOCS, LABELS = "doc_id long, text string, quality int, score double", "doc_id long, quality int, toxic int"


def rows(n=600):
    rng = np.random.default_rng(4)
    out, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice(list("abcdefg"), 5)) for _ in range(int(rng.integers(5, 200)))]
        bad = bool(rng.random() < 0.2)
        if bad:
            words = [w + "%%%" if k % 2 else w.upper() + "!!" for k, w in enumerate(words)]
        out.append((i, " ".join(words), 0, 0.0))
        if i % 5:
            labels.append((i, int(not bad), 0))
    return out, labels, {i: int(not out[i][1].isupper() and "%" not in out[i][1] and "!" not in out[i][1]) for i in range(n)}


def test_held_out_accuracy_and_edge_cases(spark):
    docs, labels, truth = rows()
    odd = [(9000, None, None, None), (9001, "", 0, 0.0), (9002, "y" * 200_000, 0, 0.0), (None, "a b", 0, 0.0), (3, docs[3][1], 0, 0.0)]
    labels += [(1, 0, 0), (1, 1, 0), (None, 1, 0), (2, None, 1)]
    got = quality.score(spark.createDataFrame(docs + odd, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == 605 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "a", 0, 0.0)], DOCS)
    assert quality.score(docs, spark.createDataFrame([], LABELS)).first().score == 0.5
    assert quality.score(docs.limit(0), spark.createDataFrame([], LABELS)).count() == 0


def test_pairs_give_back_a_known_order():
    rng = np.random.default_rng(0)
    x, w = rng.normal(size=(2000, 3)), np.array([2.0, -1.0, 0.0])
    good = x @ w > 0.3
    s = quality.bradley_terry(x[good], x[~good])
    assert np.corrcoef(s.raw(x), x @ w)[0, 1] > 0.98


def test_threshold_is_the_quantile_of_the_rejected_share(spark):
    # Labels with noise: the scores of good and bad texts overlap, and as many fall below the line as the labels reject.
    docs, _, truth = rows(900)
    rng = np.random.default_rng(8)
    labels = {i: int(truth[i] if rng.random() < 0.85 else not truth[i]) for i in range(900) if i % 3}
    got = quality.score(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(i, q, 0) for i, q in labels.items()], LABELS)).collect()
    train = [r for r in got if not r.held_out and r.doc_id in labels]
    rejected = sum(1 - labels[r.doc_id] for r in train)
    below = sum(1 - r.predicted for r in train)
    assert rejected > 50 and abs(below - rejected) <= 3
    ranked = sorted(train, key=lambda r: r.score)
    assert all(a.predicted <= b.predicted for a, b in zip(ranked, ranked[1:], strict=False))
