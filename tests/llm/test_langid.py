import numpy as np

from punctual.llm import langid

SCHEMA = "doc_id long, text string, lang string, score int"


def words(rng, alphabet, n):
    return " ".join("".join(rng.choice(list(alphabet), rng.integers(2, 8))) for _ in range(n))


def rows(n=300):
    rng = np.random.default_rng(1)
    return [(i, words(rng, "abcdefgh" if i % 2 else "mnopqrsü", int(rng.integers(3, 300))), "aa" if i % 2 else "mm", 0) for i in range(n)]


def test_held_out_accuracy_and_edge_cases(spark):
    odd = [(1000, None, "aa", 0), (1001, "", "aa", 0), (1002, "12 ... !!", "mm", 0), (1003, "a" * 300_000, None, 0), (None, "mnop", None, 0), (7, "mnop qrs", "mm", 0)]
    docs = spark.createDataFrame(rows() + odd, SCHEMA)
    got = langid.identify(docs, langid.fit(docs)).collect()
    assert len(got) == 306 and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 300]
    assert len(held) > 40
    assert np.mean([r.lang_pred == ("aa" if r.doc_id % 2 else "mm") for r in held]) > 0.97
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3
    assert by[1003].lang_pred == "aa" and by[None].lang_pred == "mm"


def test_reruns_agree(spark):
    docs = spark.createDataFrame(rows(80), SCHEMA)
    runs = [sorted(map(tuple, langid.identify(docs.repartition(n), langid.fit(docs.repartition(n))).collect())) for n in (1, 5)]
    assert runs[0] == runs[1]


def test_empty_table_and_nothing_to_learn(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert langid.identify(empty, langid.fit(empty)).count() == 0
    unlabelled = spark.createDataFrame([(1, "abc", None, 0)], SCHEMA)
    assert langid.identify(unlabelled, langid.fit(unlabelled)).first().lang_pred == "und"


def test_fused_tables_answer_as_the_plain_convolution():
    rng = np.random.default_rng(0)
    tables = [rng.normal(size=(w, 256, 3)).astype(np.float32) for w in (2, 3, 4)]
    x = rng.integers(0, 256, (2, 20)).astype(np.uint8)
    plain = [np.max([[sum(t[k, x[i, s + k]] for k in range(len(t))) for s in range(20 - len(t) + 1)] for i in range(2)], axis=1) for t in tables]
    got = langid._peaks(x, langid._fused(tables), [2, 3, 4])
    assert np.allclose(got, np.maximum(np.concatenate(plain, axis=1), 0), atol=1e-4)
