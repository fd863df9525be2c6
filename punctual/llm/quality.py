"""Quality scores learned from preference pairs (Bradley-Terry).

A text of quality 1 is preferred to one of quality 0; the score is linear in
text features and learned by logistic loss on the feature differences of such
pairs. The threshold is a quantile of the scores of all labelled texts: the
share of them that the labels reject.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import bounded_batches, chunks, remainder, texts_of, written

#: Bounds of the training sample: texts of each quality (drawn by hash) and preference pairs.
SAMPLE_TEXTS, PAIRS = 4000, 60_000
RIDGE, STEPS, SEED = 1e-3, 25, 3
#: The score at the threshold.
LINE = 0.7
#: Resolution of the score quantile.
BINS = 20_000

_CLASSES = {
    "upper": bytes(range(65, 91)),
    "lower": bytes(range(97, 123)),
    "digit": bytes(range(48, 58)),
    "stop": b".?",
    "comma": b",;:",
    "bang": b"!",
    "bar": b"|",
    "symbol": b"#$%&*+/<=>@[\\]^_`{}~",
    "quote": b"\"'()-",
    "line": b"\n",
    "other": bytes(range(128, 256)),
}
#: Rates also enter by their square roots, which part small rates.
FEATURES = [*_CLASSES, *(f"root_{c}" for c in _CLASSES), "log_words", "log_words_squared", "word_length", "distinct", "repeated", "root_repeated", "shouted", "marked", "line_words", "distinct_lines"]
_GROUP = np.full(256, len(_CLASSES))
for _i, _c in enumerate(_CLASSES.values()):
    _GROUP[list(_c)] = _i


@dataclass
class Scorer:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def raw(self, features: np.ndarray) -> np.ndarray:
        return np.clip((features - self.mean) / self.scale, -8, 8) @ self.weights


def features_of(text: bytes) -> np.ndarray:
    """Features of one whole text."""
    size = max(1, len(text))
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    rates = np.bincount(_GROUP, weights=counts, minlength=len(_CLASSES) + 1)[: len(_CLASSES)] / size
    words = text.split()
    n = max(1, len(words))
    lines = text.split(b"\n")
    same = sum(map(bytes.__eq__, words, words[1:])) / n
    log_words = np.log1p(len(words))
    rest = [
        log_words,
        log_words**2,
        size / n,
        len(set(words)) / n,
        same,
        np.sqrt(same),
        sum(map(bytes.isupper, words)) / n,
        sum(w[-1:] in b"%*#$&" for w in words) / n,
        np.log1p(n / len(lines)),
        len(set(lines)) / len(lines),
    ]
    return np.r_[rates, np.sqrt(rates), rest]


def _described(batches: Iterator[pa.RecordBatch], scorer: Scorer | None) -> Iterator[pa.RecordBatch]:
    """Features of each text, or its raw score if there is a scorer."""
    for batch in chunks(batches):
        x = np.array([features_of(t) for t in texts_of(batch)])
        names = [n for n in batch.schema.names if n != "text"]
        if scorer is None:
            value = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES)), pa.array(x.reshape(-1)))
        else:
            value = pa.array(scorer.raw(x))
        yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(n)) for n in names), value], names=[*names, "value"])


def bradley_terry(better: np.ndarray, worse: np.ndarray, pairs: int = PAIRS) -> Scorer:
    """Newton's method on the logistic loss of feature differences, with a small ridge."""
    rng = np.random.default_rng(SEED)
    both = np.r_[better, worse]
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-9
    standard = lambda x: np.clip((x - mean) / scale, -8, 8)
    d = standard(better[rng.integers(0, len(better), pairs)]) - standard(worse[rng.integers(0, len(worse), pairs)])
    w = np.zeros(d.shape[1])
    loss = lambda w: np.logaddexp(0, -(d @ w)).mean() + RIDGE * (w @ w) / 2
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(np.clip(d @ w, -500, 500)))
        slope = -(d * p[:, None]).mean(axis=0) + RIDGE * w
        curve = (d * (p * (1 - p))[:, None]).T @ d / len(d) + RIDGE * np.eye(len(w))
        step, size, now = np.linalg.solve(curve, slope), 1.0, loss(w)
        while size > 1e-4 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return Scorer(mean, scale, w)


def quality_of(labels: DataFrame) -> DataFrame:
    """(doc_id, quality); contradictory labels of a document don't count."""
    known = labels.where("quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
    return known.where("quality = most").drop("most")


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 4, held: int = 2) -> Scorer | None:
    """A scorer from a bounded sample of labelled texts; None if a quality is missing.

    The sample is drawn from ids alone; only its texts are moved.
    """
    ids = docs.where(remainder(F.col("doc_id"), modulus) != held).select("doc_id").join(quality_of(labels), "doc_id")
    ids = written(ids)
    counts = {r.quality: r.n for r in ids.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if set(counts) != {0, 1}:
        return None
    draw = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 40)) / (1 << 40)
    rate = F.when(F.col("quality") == 1, SAMPLE_TEXTS / counts[1]).otherwise(SAMPLE_TEXTS / counts[0])
    bounded_batches(docs.sparkSession)
    chosen = written(ids.where(draw < rate).distinct().orderBy(draw, "doc_id").limit(4 * SAMPLE_TEXTS))
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    found = texts.mapInArrow(lambda it: _described(it, None), "doc_id long, quality int, value array<double>").collect()
    found = sorted((r.doc_id, r.quality, r.value) for r in found)
    x, y = np.array([v for *_, v in found]), np.array([q for _, q, _ in found])
    return bradley_terry(x[y == 1], x[y == 0]) if 0 < y.sum() < len(y) else None


def _line_of(scored: DataFrame) -> tuple[float, float]:
    """The raw score at the labels' reject share among all labelled scores, and the scores' spread."""
    squashed = F.floor((F.col("value") / (1 + F.abs("value")) + 1) / 2 * BINS).cast("long")
    rows = scored.groupBy(squashed.alias("bin")).agg(F.count("*").alias("n"), F.sum(1 - F.col("quality")).alias("bad")).collect()
    rows = sorted((r.bin, r.n, r.bad) for r in rows)
    back = lambda b: (lambda s: s / (1 - abs(s)))(min(max(2 * b / BINS - 1, -0.999999), 0.999999))
    total, bad, seen = sum(n for _, n, _ in rows), sum(b for *_, b in rows), 0
    for (bin_, n, _), after in zip(rows, [*rows[1:], (BINS, 0, 0)], strict=True):
        seen += n
        if seen >= bad:
            return back((bin_ + 1 + after[0]) / 2), max(1e-6, np.std([back(b + 0.5) for b, n, _ in rows for _ in range(max(1, round(1000 * n / total)))]))
    return 0.0, 1.0


def score(docs: DataFrame, labels: DataFrame, modulus: int = 4, held: int = 2) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs`` (doc_id, text).

    Only the text enters a score. A null text scores as an empty one. Without
    labels of both qualities every score is 0.5. ``predicted`` is 1 from the
    score 0.7 on, which is where the quantile's raw score is mapped. Repeated
    rows are scored alike; other columns are ignored.
    """
    scorer = fit(docs, labels, modulus, held)
    out = docs.select("doc_id", (remainder(F.col("doc_id"), modulus) == held).alias("held_out"), "text")
    if scorer is None:
        return out.select("doc_id", "held_out", F.lit(0.5).alias("score"), F.lit(0).alias("predicted"))
    bounded_batches(docs.sparkSession)
    raw = written(out.mapInArrow(lambda it: _described(it, scorer), "doc_id long, held_out boolean, value double"))
    line, spread = _line_of(raw.where("not held_out").join(quality_of(labels), "doc_id"))
    slope = 4.0 / spread
    squash = 1 / (1 + F.exp(-F.least(F.greatest((F.col("value") - line) * slope, F.lit(-30.0)), F.lit(30.0))) * (1 - LINE) / LINE)
    scored = raw.select("doc_id", "held_out", squash.alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= LINE, 1).otherwise(0))
