"""Language identification by a byte convolutional network.

Filters of several widths slide over the bytes of a fixed-length window; each
filter's largest answer feeds a softmax over the languages. A text is cut into
windows whole, and its languages' probabilities are the windows' means by length.
Training is numpy on the driver over a bounded sample of labelled texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.llm.common import bounded_batches, chunks, remainder, texts_of, written

WIDTHS, FILTERS, WINDOW = (2, 3, 4), 8, 256
#: Bounds of the training sample: texts of each language (drawn by hash), bytes of each text, and texts in all.
SAMPLE_TEXTS, SAMPLE_BYTES, SAMPLE_ROWS = 1500, 1024, 24_000
EPOCHS, RATE, SEED = 6, 0.02, 7
#: Windows handled at once: their answers stay in the cache.
AT_ONCE = 512


@dataclass
class Network:
    """``tables[i][k, byte, filter]`` is the weight of a byte at offset k of filters of the i-th width."""

    langs: list[str]
    tables: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Zero-padded windows of all texts, the text of each and its length."""
    parts, owner, length = [], [], []
    for i, text in enumerate(texts):
        n = max(1, -(-len(text) // WINDOW))
        parts.append(text.ljust(n * WINDOW, b"\0"))
        owner += [i] * n
        length += [WINDOW] * (n - 1) + [max(1, len(text) - (n - 1) * WINDOW)]
    return np.frombuffer(b"".join(parts), np.uint8).reshape(-1, WINDOW), np.array(owner, np.int64), np.array(length, np.float64)


def _fused(tables: list[np.ndarray]) -> list[list[tuple[int, np.ndarray]]]:
    """Pairs of adjacent offsets as one table over two bytes: half the look-ups."""
    out = []
    for t in tables:
        steps = []
        for k in range(0, len(t) - 1, 2):
            steps.append((k, (t[k][:, None, :] + t[k + 1][None, :, :]).reshape(65536, -1)))
        if len(t) % 2:
            steps.append((len(t) - 1, t[-1]))
        out.append(steps)
    return out


def _peaks(block: np.ndarray, fused: list[list[tuple[int, np.ndarray]]], widths: list[int]) -> np.ndarray:
    """Each filter's largest answer in each window."""
    pairs = block[:, :-1].astype(np.int32) * 256 + block[:, 1:]
    peaks = []
    for steps, width in zip(fused, widths, strict=True):
        span, total = block.shape[1] - width + 1, None
        for k, t in steps:
            part = np.take(t, (pairs if len(t) > 256 else block)[:, k : k + span], axis=0)
            total = part if total is None else np.add(total, part, out=total)
        peaks.append(total.max(axis=1))
    return np.maximum(np.concatenate(peaks, axis=1), 0)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def probabilities(net: Network, texts: list[bytes], fused: list | None = None) -> np.ndarray:
    """A row for each text: the probability of each language."""
    fused = fused or _fused(net.tables)
    blocks, owner, length = windows_of(texts)
    total = np.zeros((len(texts), len(net.langs)))
    for a in range(0, len(blocks), AT_ONCE):
        part = slice(a, a + AT_ONCE)
        p = _softmax(_peaks(blocks[part], fused, [len(t) for t in net.tables]) @ net.out + net.bias)
        np.add.at(total, owner[part], p * length[part, None])
    return total / np.maximum(total.sum(axis=1, keepdims=True), 1e-300)


def train(texts: list[bytes], langs: list[str], widths: tuple[int, ...] = WIDTHS, filters: int = FILTERS, epochs: int = EPOCHS) -> Network:
    """Adam on the cross-entropy; the gradient of a max goes to the bytes under the peak."""
    names = sorted(set(langs))
    rng = np.random.default_rng(SEED)
    blocks, owner, _ = windows_of(texts)
    y = np.array([names.index(x) for x in langs], np.int64)[owner]
    tables = [rng.normal(0, 0.3, (w, 256, filters)).astype(np.float32) for w in widths]
    out, bias = rng.normal(0, 0.3, (filters * len(widths), len(names))).astype(np.float32), np.zeros(len(names), np.float32)
    params = [*tables, out, bias]
    m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    share = np.bincount(y, minlength=len(names))
    weight = (len(y) / np.maximum(share, 1) / len(names)).astype(np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(blocks))
        for a in range(0, len(order), 128):
            x, t = blocks[order[a : a + 128]], y[order[a : a + 128]]
            answers = [sum(table[k][x[:, k : WINDOW - len(table) + 1 + k]] for k in range(len(table))) for table in tables]
            where = [r.argmax(axis=1) for r in answers]
            top = np.concatenate([np.take_along_axis(r, w[:, None, :], axis=1)[:, 0] for r, w in zip(answers, where, strict=True)], axis=1)
            live = top > 0
            peak = np.where(live, top, 0)
            p = _softmax(peak @ out + bias)
            d = p.copy()
            d[np.arange(len(t)), t] -= 1
            d *= (weight[t] / len(t))[:, None]
            back = (d @ out.T) * live
            grads = []
            for i, table in enumerate(tables):
                g, part = np.zeros_like(table), back[:, i * filters : (i + 1) * filters]
                for k in range(len(table)):
                    byte = np.take_along_axis(x, where[i] + k, axis=1)
                    np.add.at(g[k], (byte, np.arange(filters)[None, :]), part)
                grads.append(g)
            grads += [peak.T @ d, d.sum(axis=0)]
            step += 1
            for q, g, mm, vv in zip(params, grads, m, v, strict=True):
                mm += 0.1 * (g - mm)
                vv += 0.001 * (g * g - vv)
                q -= RATE * (mm / (1 - 0.9**step)) / (np.sqrt(vv / (1 - 0.999**step)) + 1e-6)
    return Network(names, tables, out, bias)


def sample(docs: DataFrame, texts: int = SAMPLE_TEXTS, size: int = SAMPLE_BYTES) -> tuple[list[bytes], list[str]]:
    """A bounded sample of labelled texts: about ``texts`` of each language, drawn by hash, a slice of each.

    The slice starts at a place that the hash draws, so that any part of a text
    can be in the sample.
    """
    counts = written(docs.groupBy("lang").agg(F.count("*").alias("n")))
    texts = min(texts, max(1, SAMPLE_ROWS * 2 // 3 // max(1, counts.count())))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) / (1 << 40)
    rated = docs.withColumn("draw", draw).join(counts, "lang").where(F.col("draw") * F.col("n") < texts)
    room = F.greatest(F.length("text") - size, F.lit(0)) + 1
    start = (F.pmod(F.xxhash64("text", F.lit(1)), room) + 1).cast("int")
    rows = rated.select("draw", "lang", F.substring(F.col("text"), start, F.lit(size)).alias("text")).orderBy("draw", "lang", "text").limit(SAMPLE_ROWS).collect()
    rows = sorted((r.text.encode()[:size], r.lang) for r in rows)
    return [t for t, _ in rows], [x for _, x in rows]


def fit(docs: DataFrame, modulus: int = 4, held: int = 2) -> Network | None:
    """A network learned from rows with text and lang whose remainder isn't ``held``; None if there are none."""
    rows = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (remainder(F.col("doc_id"), modulus) != held))
    texts, langs = sample(rows.select("doc_id", "text", "lang"))
    return train(texts, langs) if texts else None


def _predict(batches: Iterator[pa.RecordBatch], net: Network | None, name: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows without text and mark, with the prediction; a text under another name stays."""
    fused = _fused(net.tables) if net else None
    for batch in chunks(batches, name):
        lettered = batch.column(batch.schema.get_field_index("lettered")).to_numpy(zero_copy_only=False).astype(bool)
        pred, score = np.full(len(batch), "und", object), np.zeros(len(batch))
        if net and lettered.any():
            p = probabilities(net, [t for t, x in zip(texts_of(batch, name), lettered, strict=True) if x], fused)
            pred[lettered] = np.array(net.langs, object)[p.argmax(axis=1)]
            score[lettered] = p.max(axis=1)
        rest = [batch.column(i) for i, name in enumerate(batch.schema.names) if name not in ("text", "lettered")]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(pred.tolist(), pa.string()), pa.array(np.clip(score, 0, 1))], names=[*(n for n in batch.schema.names if n not in ("text", "lettered")), "lang_pred", "score"])


def identify(docs: DataFrame, net: Network | None, modulus: int = 4, held: int = 2) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row of ``docs`` (doc_id, text).

    Whole texts are read. ``und`` with score 0 for a null text, a text without a
    letter, or where nothing could be learned. Equal probabilities go to the
    language first by name. Other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select("doc_id", (remainder(F.col("doc_id"), modulus) == held).alias("held_out"), "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
    return rows.mapInArrow(lambda it: _predict(it, net), "doc_id long, held_out boolean, lang_pred string, score double")


def accepted(docs: DataFrame, net: Network | None, least: float) -> DataFrame:
    """The rows of ``docs`` that have a language of at least that probability; all columns are carried along."""
    bounded_batches(docs.sparkSession)
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(*[F.col(c).alias(f"in_{i}") for i, c in enumerate(docs.columns)], lettered.alias("lettered")).where("lettered")
    shape = T.StructType([*[T.StructField(f"in_{i}", f.dataType) for i, f in enumerate(docs.schema.fields)], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    name = f"in_{docs.columns.index('text')}"
    out = rows.mapInArrow(lambda it: _predict(it, net, name), shape).where((F.col("lang_pred") != "und") & (F.col("score") >= least))
    return out.select(*[F.col(f"in_{i}").alias(c) for i, c in enumerate(docs.columns)])
