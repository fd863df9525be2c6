import hashlib
import random

import pyarrow as pa
import pytest

from punctual.llm import substring

SCHEMA = "doc_id long, text string, places string"


def brute(rows, window=50):
    words = [(i, (t or "").encode().split()) for i, t, *_ in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k : k + window])
                first[key] = min(i, first.get(key, i))
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone |= set(range(k, k + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    shared = [words(n) for n in (49, 50, 51, 80, 200)]
    rows = []
    for i in range(60):
        text = words(rng.randint(0, 120))
        for _ in range(rng.randint(0, 2)):
            at = rng.randint(0, len(text))
            text[at:at] = rng.choice(shared)
        rows.append((i * 3, "  ".join(text) + rng.choice(["", "\n"]), "p"))
    rows += [(1000 + i, rows[5][1], None) for i in range(4)]
    rng.shuffle(rows)
    return [*rows, (1, None, ""), (2, "", ""), (4, " \t ", ""), (5, "Mixed Case", ""), (None, rows[3][1], "")]


def collected(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize("parts", [1, 7])
def test_agrees_with_all_windows(spark, parts):
    rows = corpus(parts)
    assert collected(substring.without_repeats(spark.createDataFrame(rows, SCHEMA).repartition(parts))) == brute(rows)


def test_very_long_and_self_repeating_texts(spark):
    rows = [(1, "a b " * 30_000, ""), (2, "b a " * 40, ""), (3, "x" * 100_000, "")]
    assert collected(substring.without_repeats(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_empty_table(spark):
    assert substring.without_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repeated_rows_never_cost_each_other(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(7, text, ""), (7, text, "")]
    assert [r.n_removed for r in substring.without_repeats(spark.createDataFrame(rows, SCHEMA)).collect()] == [0, 0]


def test_cover_holds_every_difference():
    d = {(a - b) % substring.PERIOD for a in substring.COVER for b in substring.COVER}
    assert d == set(range(substring.PERIOD))


@pytest.mark.parametrize("copies", [40, 400])
def test_rows_that_travel_do_not_multiply_with_partitions(copies):
    text = " ".join(f"w{i}" for i in range(200)).encode()
    ids, buckets = list(range(copies)), 3

    def steps(parts):
        batch = lambda own: pa.RecordBatch.from_arrays([pa.array(own), pa.array([text.decode()] * len(own))], names=["doc_id", "text"])
        anchors = [b for k in range(parts) for b in substring._anchors(iter([batch(ids[k::parts])]), 50, buckets)]
        rows = pa.Table.from_batches(anchors).sort_by("bucket").to_batches()
        return sum(map(len, anchors)), sum(len(b) for b in substring._shared(iter(rows), buckets))

    for parts in (8, 32):
        dealt, shared = steps(parts)
        assert dealt <= 2 * parts * buckets and shared <= parts * buckets + buckets**2
