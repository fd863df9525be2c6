import random
from itertools import combinations

import pytest

from punctual.llm import minhash

SCHEMA = "doc_id long, text string, lang string, node long"


def brute(rows, percent=75):
    """Components by comparing all pairs of full shingle sets."""
    sets = {}
    for i, text, *_ in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    label = {i: i for i in sets}

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        n = len(sets[a] & sets[b])
        if n and 100 * n >= percent * len(sets[a] | sets[b]):
            x, y = top(a), top(b)
            label[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i), top(i) == i) for i in sets}


def corpus(seed=3):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows, i = [], 100
    for group in (1, 1, 2, 3, 8, 40):
        base = [rng.choice(vocab) for _ in range(rng.randint(30, 150))]
        for _ in range(group):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = rng.choice(vocab)
            rows.append((i, rng.choice([" ", "  ", "\n"]).join(own).upper() if i % 3 else " ".join(own), "en", 1))
            i += rng.randint(1, 3)
    rng.shuffle(rows)
    return rows + [(1, None, None, None), (2, "", "en", 2), (3, " \t\n", "en", 2), (4, "one two", "en", 0), (5, "ONE  two", "en", 0), (6, "one two three", None, 0), (7, "x" * 200_000, "en", 0)]


def collected(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_agrees_with_all_pairs(spark):
    rows = corpus()
    assert collected(minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_large_components_are_settled_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rows = corpus(5)
    assert collected(minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_bridge_between_large_clusters(spark):
    # Two clusters whose one link is between members that pivots of either side hold.
    words = [f"w{i}" for i in range(124)]
    at = lambda k: " ".join(words[k : k + 104])
    rows = [(1000 + i, f"u{i} {at(0)}", "en", 0) for i in range(149)] + [(2000 + i, f"v{i} {at(20)}", "en", 0) for i in range(149)]
    rows += [(1500, at(5), "en", 0), (2500, at(15), "en", 0)]
    assert len(rows) > minhash.BLOCK
    want = brute(rows)
    assert {top for _, top, _ in want.values()} == {1000}
    assert collected(minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA))) == want


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repeated_rows_and_null_ids(spark):
    text = "a b c d e f g h"
    rows = [(9, text, "", 0), (9, text, "", 0), (None, text, "", 0), (None, "q r s", "", 0)]
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert got == sorted([(9, 9, True), (9, 9, True), (None, 9, False), (None, None, True)], key=str)


@pytest.mark.parametrize("similar", [True, False])
def test_threshold_is_inclusive(spark, similar):
    # 3 of 4 shingles in the union are shared exactly at the threshold.
    one = "a b c d e f g h" if similar else "a b c d e f g"
    rows = [(1, "a b c d e f g", "", 0), (2, one + (" z" if not similar else ""), "", 0), (3, "z a b c d e f g h", "", 0)]
    assert collected(minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


A, B, C = "a b c d e f g h i j", "k l m n o p q r s t", "u v w x y z aa bb cc dd"


@pytest.mark.parametrize(
    ("rows", "want"),
    [
        ([(3, A), (5, A), (5, B), (9, B)], {3: {3}, 5: {3}, 9: {3}}),
        ([(5, ""), (5, B), (3, B), (9, None)], {5: {3}, 3: {3}, 9: {9}}),
        ([(8, A), (8, B), (2, B + " more"), (8, C), (9, C), (4, "one")], {8: {2}, 2: {2}, 9: {2}, 4: {4}}),
        ([(7, A), (7, B), (6, C)], {7: {7}, 6: {6}}),
    ],
)
def test_repeated_ids_are_one_node_with_all_links(spark, rows, want):
    found = {}
    for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        found.setdefault(r.doc_id, set()).add(r.component_id)
        assert r.kept == (r.doc_id == r.component_id)
    assert found == want
