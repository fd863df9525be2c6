import math
import random
import zlib
from collections import Counter

import pytest

from punctual.llm import suffixtree

SCHEMA = "doc_id long, text string, score string"


def corpus(n=150):
    rng = random.Random(2)
    parts = ["th", "er", "on", "an", "re", "es", "ti", "in"]
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.choice([1, 1, 2, 3])))
    rows = [(i, " ".join(word() for _ in range(rng.randint(1, 60))).title(), "s") for i in range(n)]
    return [*rows, (5000, None, ""), (5001, "", ""), (5002, "\n\t", ""), (None, "the end", ""), (5003, "x" * 70_000, ""), (3, rows[3][1], "")]


def test_base_scores_and_counts_agree_with_plain_counting(spark):
    rows = corpus()
    held = lambda i: zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2
    counts = Counter()
    for i, t, _ in rows:
        if not held(i):
            counts.update([*(t or "").encode().lower().split(), "end"])
    n, v = sum(counts.values()), len(counts)
    want = []
    for i, t, _ in rows:
        tokens = [*(t or "").encode().lower().split(), "end"]
        want.append((str(i), held(i), len(tokens), sum(counts[w] > 0 for w in tokens), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)))
    got = suffixtree.score(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    mine = [(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got]
    for a, b in zip(sorted(mine), sorted(want), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)
    assert all(-1e7 < r.score < 0 for r in got)


def held_out(i):
    return zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2


class Plain:
    """The tree by counting in dictionaries."""

    END = object()

    def __init__(self, rows):
        self.tokens = lambda t: [*(t or "").encode().lower().split(), self.END]
        train = [self.tokens(t) for i, t, *_ in rows if not held_out(i)]
        self.c = Counter(w for text in train for w in text)
        self.total, self.v = sum(self.c.values()), len(self.c)
        self.kept = {}
        for length in (1, 2, 3):
            found = {}
            for text in train:
                for i in range(length, len(text)):
                    context = tuple(text[i - length : i])
                    if self.grows(context):
                        found.setdefault(context, Counter())[text[i]] += 1
            new = {}
            for context, counts in found.items():
                n = sum(counts.values())
                own = {}
                for symbol, k in counts.items():
                    expected = n * self.p(context[1:], symbol)
                    if k >= 2 and self.c[symbol] >= 2 and k > expected and k * math.log(k / expected) - k + expected >= suffixtree.TELLING:
                        own[symbol] = (k - suffixtree.DISCOUNT) / n
                if own:
                    left = (1 - sum(own.values())) / (1 - sum(self.p(context[1:], x) for x in own))
                    new[context] = (own, left)
            self.kept |= new

    def grows(self, context):
        """Each word stands out behind the one before; a context of one word was seen twice."""
        if len(context) == 1:
            return self.c[context[0]] >= 2
        return all(b in self.kept.get((a,), ({},))[0] for a, b in zip(context, context[1:], strict=False))

    def p(self, context, symbol):
        if context and context in self.kept and self.grows(context):
            own, left = self.kept[context]
            return own[symbol] if symbol in own else left * self.p(context[1:], symbol)
        return self.p(context[1:], symbol) if context else (self.c[symbol] + 1) / (self.total + self.v + 1)

    def score(self, text):
        tokens = self.tokens(text)
        return sum(math.log10(self.p(tuple(tokens[max(0, i - 3) : i]), tokens[i])) for i in range(len(tokens)))


def prose(n=400, seed=6):
    """Texts of phrases: some words go together, two or three at a time."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    phrases = [[rng.choice(words) for _ in range(rng.randint(2, 6))] for _ in range(25)]
    # What follows the shared middle of these depends on the word before it.
    phrases += [[f"a{i}", "so", "then", f"b{i}"] for i in range(8)]
    rows = []
    for i in range(n):
        text = []
        for _ in range(rng.randint(0, 12)):
            text += rng.choice(phrases) if rng.random() < 0.6 else [rng.choice(words) for _ in range(3)]
        rows.append((i, " ".join(text), ""))
    return [*rows, (7000, None, ""), (7001, "w1", ""), (None, rows[0][1], ""), (3, rows[3][1], ""), (7002, "never seen words", "")]


@pytest.mark.parametrize("hot", [10**9, 40])
def test_scores_agree_with_plain_counting(spark, monkeypatch, hot):
    monkeypatch.setattr(suffixtree, "HOT", hot)
    monkeypatch.setattr(suffixtree, "BUCKET_BYTES", 9000)
    monkeypatch.setattr(suffixtree, "CHUNK", 4000)
    rows = prose()
    plain = Plain(rows)
    assert {len(c) for c in plain.kept} == {1, 2, 3}
    if hot == 40:
        assert any(plain.c[c[0]] >= 40 for c in plain.kept if len(c) == 1)
    want = sorted((str(i), plain.score(t)) for i, t, *_ in rows)
    got = sorted((str(r.doc_id), r.score) for r in suffixtree.score(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect())
    assert [i for i, _ in got] == [i for i, _ in want]
    assert [x for _, x in got] == pytest.approx([x for _, x in want], rel=1e-4, abs=5e-3)


def test_every_state_sums_to_one():
    plain = Plain(prose())
    seen = [*plain.c, b"unseen"]
    for context in [(), *list(plain.kept)[::7]]:
        assert sum(plain.p(context, x) for x in seen) == pytest.approx(1)


def test_order_counts_and_held_out_texts_gain_from_it(spark):
    rows = prose(600, seed=8)
    rng = random.Random(1)
    shuffled = []
    for i, t, _ in rows[:600]:
        own = t.split()
        rng.shuffle(own)
        shuffled.append((100_000 + 7 * i, " ".join(own), ""))
    shuffled = [r for r in shuffled if held_out(r[0])]  # scored, not learned from
    own = {r.doc_id: r for r in suffixtree.score(spark.createDataFrame([*rows, *shuffled], SCHEMA)).collect()}
    held = [r for r in own.values() if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert len(held) > 50 and sum(r.score for r in held) > 0.9 * sum(r.base_score for r in held)
    pairs = [(own[(i - 100_000) // 7], own[i]) for i, *_ in shuffled]
    assert sum(a.score for a, _ in pairs) > sum(b.score for _, b in pairs)


def test_states_grow_with_the_corpus():
    sizes = [len(Plain(prose(n)).kept) for n in (100, 400)]
    assert sizes[1] > sizes[0]


def test_empty_table(spark):
    assert suffixtree.score(spark.createDataFrame([], SCHEMA)).count() == 0
