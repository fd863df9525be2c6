import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from punctual.llm import decontaminate as d

DOCS, ITEMS = "doc_id long, text string, item_id long", "item_id long, text string, doc_id long"


def grams(w):
    k = min(5, len(w))
    return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def brute(docs, items):
    """The best similarity of every item-sized window of every document."""
    out = {}
    for i, text, *_ in docs:
        w = (text or "").lower().encode().split()
        for j, item, *_ in items:
            x = (item or "").lower().encode().split()
            if not w or not x or j is None:
                continue
            g, best = grams(x), 0
            for s in range(max(1, len(w) - len(x) + 1)):
                own = w[s : s + len(x)]
                if len(own) >= min(5, len(x)):
                    k = min(5, len(x))
                    mine = Counter(tuple(own[a : a + k]) for a in range(len(own) - k + 1))
                    both = sum((mine & g).values())
                    best = max(best, both / (mine.total() + g.total() - both))
            if best >= 0.75:
                out[i, j] = best
    return out


def world(seed=1):
    rng = random.Random(seed)
    words = lambda n: [f"w{rng.randrange(500)}" for _ in range(n)]
    items = [(j, " ".join(words(rng.choice([1, 3, 5, 8, 20, 40]))), 0) for j in range(25)]
    docs = []
    for i in range(80):
        text = words(rng.randint(0, 150))
        if i % 2:
            passage = rng.choice(items)[1].split()
            if i % 4 == 1 and len(passage) > 10:
                passage[rng.randrange(len(passage))] = "edited"
            at = rng.randint(0, len(text))
            text[at:at] = passage
        docs.append((i, " ".join(text).upper() if i % 3 else "\n".join(text), 0))
    return [*docs, (900, None, 1), (901, "", 1), (902, items[5][1], 1), (903, "q" * 100_000, None)], [*items, (100, None, 1), (101, " ", 1), (None, "w1 w2", 1)]


@pytest.mark.parametrize("portion", [2000, 7])
def test_agrees_with_all_windows(spark, monkeypatch, portion):
    monkeypatch.setattr(d, "PORTION_ITEMS", portion)
    docs, items = world(portion)
    got = {(r.doc_id, r.item_id): r.similarity for r in d.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()}
    want = brute(docs, items)
    assert got == pytest.approx(want) and len(want) > 30


def test_index_finds_all_within_the_radius():
    rng = np.random.default_rng(0)
    items = [(i, " ".join(f"w{x}" for x in rng.integers(0, 9999, 30)).encode()) for i in range(40)]
    index = d.index_of(items)
    probes = np.repeat(index.prints, 20, axis=0)
    for row in probes:
        flip = rng.choice(d.BITS, int(rng.integers(0, 60)), replace=False)
        row[flip] ^= 1
    apart = (probes[:, None, :] != index.prints[None]).sum(axis=2)
    assert (d.near(index, probes) == (apart <= d.RADIUS)).all()


def test_capitals_of_any_alphabet(spark):
    item = " ".join(f"ñandú{i} éclair ßig öl" for i in range(8))
    docs = spark.createDataFrame([(1, "so " + item.replace("ß", "s").upper() + " end", 0), (2, "nothing here", 0)], DOCS)
    items = spark.createDataFrame([(7, item.replace("ß", "s"), 0)], ITEMS)
    assert [(r.doc_id, r.item_id, r.similarity) for r in d.contaminated(docs, items).collect()] == [(1, 7, 1.0)]
    assert [r.doc_id for r in d.clean(docs, items).collect()] == [2]


def test_empty_tables_and_repeated_rows(spark):
    docs, items = spark.createDataFrame([(1, "a b c d e f", 0)] * 2, DOCS), spark.createDataFrame([(1, "a b c d e f", 0)] * 2, ITEMS)
    assert [tuple(r) for r in d.contaminated(docs, items).collect()] == [(1, 1, 0, 6, 1.0)]
    assert d.contaminated(docs.limit(0), items).count() == 0
    assert d.contaminated(docs, items.limit(0)).count() == 0


def test_clean_finds_items_without_id(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    docs = spark.createDataFrame([(1, f"before it {passage} after it", 1), (2, "nothing of the kind", 1)], DOCS)
    items = spark.createDataFrame([(None, passage, 1), (0, "some other passage of the benchmark", 1)], ITEMS)
    assert [r.doc_id for r in d.clean(docs, items).collect()] == [2]
    assert d.contaminated(docs, items).count() == 0


def test_many_words_and_many_hits_in_bounded_memory(monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(d, "AT_ONCE", 64)
    item = " ".join(f"p{i}" for i in range(40))
    index = d.index_of([(1, item.encode()), (2, b"one two three four five six")])
    words = [f"w{x}" for x in rng.integers(0, 99_999, 400_000)]
    for at in (5, 200_000, 399_950):
        words[at : at + 40] = item.split()
    words[300_000:300_030] = "one two three four five six".split() * 5
    text = " ".join(words).encode()
    tracemalloc.start()
    found = list(d._found([text], index))
    assert tracemalloc.get_traced_memory()[1] < 150 << 20
    tracemalloc.stop()
    assert found == [(0, 1, 5, 40, 1.0), (0, 2, 300_000, 6, 1.0)]
