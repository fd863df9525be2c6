"""Benchmark passages in documents: SimHash of item-sized windows, then exact similarity.

A benchmark item is compared with every window of a document that has as many
words as the item. Windows and items have 128-bit SimHash fingerprints of their
weighted five-word shingles. A multi-index over eleven blocks of the fingerprint
finds all items within the radius: a fingerprint so near agrees with the item
up to its share of the radius in some block. Weighted shingle similarity then
decides exactly. Windows that share no shingle with any item can't be similar
to one and are never fingerprinted.

Items come in portions of bounded size, each an index that every task holds; one
scan of the documents serves several portions. A text is fingerprinted stretch by
stretch, so that memory doesn't grow with its length.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import U64, bounded_batches, chunks, mix, ngrams, texts_of, word_hashes, written

WIDTH, SIMILARITY = 5, 0.75
#: Bits that fingerprints may differ in. At similarity 0.75 the mean is 22 of 128, the deviation 4.3.
BITS, RADIUS = 128, 38
BLOCK_BITS = (12,) * 7 + (11,) * 4
#: Items, and bytes of their texts, that one index holds.
PORTION_ITEMS, PORTION_BYTES = 2000, 8 << 20
#: Portions that one scan of the documents looks for.
SCAN = 4
#: Windows that are compared at once, and words that they span at most, their own length aside.
AT_ONCE, SPAN = 1024, 8192
_MASK = 1 << 20


def _shares(radius: int = RADIUS) -> list[int]:
    """What each block may differ in, so that no fingerprint within the radius exceeds all shares."""
    n = len(BLOCK_BITS)
    return [(radius + 1) // n - 1 + (i < (radius + 1) % n) for i in range(n)]


def _grams(h: np.ndarray, width: int) -> np.ndarray:
    return ngrams(h, width, 5 + width) if len(h) >= width else np.zeros(0, U64)


def signs(grams: np.ndarray) -> np.ndarray:
    """+1 or -1 for each bit of each shingle's hash."""
    two = np.stack([mix(grams ^ U64(0xA5A5)), mix(grams + U64(0x1234567))], axis=1)
    return np.unpackbits(two.view(np.uint8).reshape(len(grams), 16), axis=1).astype(np.int8) * 2 - 1


def blocks_of(bits: np.ndarray) -> np.ndarray:
    """Each fingerprint's blocks as numbers."""
    out, at = np.zeros((len(bits), len(BLOCK_BITS)), np.int64), 0
    for i, n in enumerate(BLOCK_BITS):
        out[:, i] = bits[:, at : at + n] @ (1 << np.arange(n))
        at += n
    return out


@dataclass
class Index:
    """A portion of the items, by shingle and by fingerprint."""

    ids: np.ndarray
    words: np.ndarray
    grams: list[Counter]
    prints: np.ndarray
    tables: list[np.ndarray] = field(default_factory=list)
    #: Of each shingle width that occurs: the items' shingles, sorted, and the items that have each.
    by_width: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)


def index_of(items: list[tuple[int, bytes]]) -> Index | None:
    """Items without words can't be found and are left out."""
    rows = [(i, *word_hashes([_lowered(t)], lower=False)) for i, t in items]
    rows = [(i, h) for i, h, n in rows if n[0]]
    if not rows:
        return None
    sizes = np.array([len(h) for _, h in rows])
    grams = [_grams(h, min(WIDTH, len(h))) for _, h in rows]
    prints = np.array([signs(g).astype(np.int32).sum(axis=0) > 0 for g in grams]).astype(np.uint8)
    index = Index(np.array([i for i, _ in rows], np.int64), sizes, [Counter(g.tolist()) for g in grams], prints)
    for i, (bits, share) in enumerate(zip(BLOCK_BITS, _shares(), strict=True)):
        apart = np.bitwise_count(np.arange(1 << bits)[:, None] ^ blocks_of(prints)[None, :, i])
        index.tables.append(np.packbits(apart <= share, axis=1))
    for width in sorted(set(np.minimum(sizes, WIDTH).tolist())):
        own = np.flatnonzero(np.minimum(sizes, WIDTH) == width)
        pairs = sorted({(g, int(k)) for k in own for g in grams[k].tolist()})
        keys, holder = np.array([g for g, _ in pairs], U64), np.array([k for _, k in pairs], np.int64)
        maybe = np.zeros(_MASK, bool)
        maybe[(keys & U64(_MASK - 1)).astype(np.int64)] = True
        unique, first = np.unique(keys, return_index=True)
        index.by_width[width] = (maybe, unique, np.r_[first, len(keys)], holder)
    return index


def near(index: Index, bits: np.ndarray) -> np.ndarray:
    """For each fingerprint and item: within the radius? Only candidates of the multi-index are compared."""
    blocks = blocks_of(bits)
    candidates = np.zeros((len(bits), index.tables[0].shape[1]), np.uint8)
    for i, t in enumerate(index.tables):
        candidates |= t[blocks[:, i]]
    found = np.unpackbits(candidates, axis=1)[:, : len(index.ids)].astype(bool)
    a, b = np.nonzero(found)
    apart = (bits[a] != index.prints[b]).sum(axis=1)
    found[a[apart > RADIUS], b[apart > RADIUS]] = False
    return found


def _stretches(starts: np.ndarray) -> Iterator[np.ndarray]:
    """Sorted starts in runs of at most ``AT_ONCE`` that span at most ``SPAN`` words."""
    a = 0
    while a < len(starts):
        b = min(a + AT_ONCE, int(np.searchsorted(starts, starts[a] + SPAN)))
        yield starts[a:b]
        a = b


def _matches(index: Index, h: np.ndarray, hits: dict[int, list[tuple[int, int]]]) -> Iterator[tuple[int, int, int, float]]:
    """(item, start, words, similarity) of the best window of each item in one text; ``hits``: (place, item) by width."""
    n_words, best = len(h), {}
    for width, found in hits.items():
        grams = _grams(h, width)
        starts: dict[int, set[int]] = defaultdict(set)
        for place, item in found:
            size = int(index.words[item])
            starts[size].update(range(max(0, place - (size - width)), max(0, min(place, n_words - size)) + 1))
        for size, own in sorted(starts.items()):
            for at in _stretches(np.array(sorted(own), np.int64)):
                low = int(at[0])
                end = np.minimum(at + size - width + 1, len(grams))
                part = grams[low : int(end[-1])]
                total = np.zeros((len(part) + 1, BITS), np.int32)
                np.cumsum(signs(part), axis=0, out=total[1:], dtype=np.int32)
                close = near(index, (total[end - low] - total[at - low] > 0).astype(np.uint8)) & (index.words == size)
                for w, item in zip(*np.nonzero(close), strict=True):
                    window, other = Counter(grams[at[w] : end[w]].tolist()), index.grams[item]
                    both = sum((window & other).values())
                    similarity = both / (window.total() + other.total() - both)
                    if similarity >= SIMILARITY and similarity > best.get(int(item), (0, 0, 0.0))[2]:
                        best[int(item)] = (int(at[w]), min(size, n_words), similarity)
    for item, (start, size, similarity) in sorted(best.items()):
        yield item, start, size, similarity


def _lowered(text: bytes) -> bytes:
    """Letters of any alphabet lower-cased: passages also turn up in capitals."""
    return text.decode("utf-8", "replace").lower().encode()


def _found(texts: list[bytes], index: Index) -> Iterator[tuple[int, int, int, int, float]]:
    """(text number, item, start, words, similarity) of all that is found in a chunk."""
    h, counts = word_hashes([_lowered(t) for t in texts], lower=False)
    ends = np.cumsum(counts)
    hits: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
    for width, (maybe, keys, first, holder) in index.by_width.items():
        grams = _grams(h, width)
        at = np.flatnonzero(maybe[(grams & U64(_MASK - 1)).astype(np.int64)])
        spot = np.minimum(np.searchsorted(keys, grams[at]), len(keys) - 1)
        good = keys[spot] == grams[at]
        at, spot = at[good], spot[good]
        doc = np.searchsorted(ends, at, side="right")
        for place, d, s in zip(at.tolist(), doc.tolist(), spot.tolist(), strict=True):
            if place + width <= ends[d]:
                hits[d][width] += [(place - int(ends[d] - counts[d]), k) for k in holder[first[s] : first[s + 1]].tolist()]
    for d, own in hits.items():
        for k, *rest in _matches(index, h[ends[d] - counts[d] : ends[d]], own):
            yield d, int(index.ids[k]), *rest


def _clean(batches: Iterator[pa.RecordBatch], indexes: list[Index], name: str) -> Iterator[pa.RecordBatch]:
    """The rows in which nothing is found."""
    for batch in chunks(batches, name):
        texts = texts_of(batch, name)
        dirty = {d for index in indexes for d, *_ in _found(texts, index)}
        yield batch.filter(pa.array([i not in dirty for i in range(len(batch))], pa.bool_())) if dirty else batch


def _search(batches: Iterator[pa.RecordBatch], indexes: list[Index]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        ids, texts = batch.column(0), texts_of(batch)
        rows = [(ids[d].as_py(), *rest) for index in indexes for d, *rest in _found(texts, index)]
        if rows:
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["doc_id", "item_id", "start", "n_words", "similarity"])


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, n_words, similarity): the best window of each document for each item found in it.

    Words are lower-cased, in any alphabet. An item of fewer than five words is one shingle;
    a document shorter than an item is compared whole. Null and blank texts hold
    nothing and are found nowhere. Rows that repeat a doc_id or an item_id with
    the same text give the same rows once. Items without item_id can't be named
    and give no rows; ``clean`` looks for them too. Other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    shape = "doc_id long, item_id long, start long, n_words long, similarity double"
    found = docs.sparkSession.createDataFrame([], shape)
    scans = _scans(items)
    for shared in scans:
        part = docs.select("doc_id", "text").mapInArrow(lambda it, own=shared: _search(it, [b.value for b in own]), shape)
        found = found.union(part if len(scans) == 1 else written(part))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n_words")).alias("m")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", (-F.col("m.back")).alias("start"), "m.n_words", "m.similarity")


def _portions(items: DataFrame) -> list[Broadcast]:
    """Indexes of the items, each of bounded size."""
    items = items.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    n, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    number, out = max(1, -(-n // PORTION_ITEMS), -(-size // PORTION_BYTES)), []
    for k in range(number):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(number)) == k).collect()
        index = index_of(sorted((r.item_id, r.text.encode()) for r in own))
        if index is not None:
            out.append(items.sparkSession.sparkContext.broadcast(index))
    return out


def _scans(items: DataFrame) -> list[list[Broadcast]]:
    """The portions that each scan of the documents looks for."""
    portions = _portions(items)
    return [portions[a : a + SCAN] for a in range(0, len(portions), SCAN)]


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, as ``contaminated`` finds them; all columns are carried along.

    Items without item_id count like others.
    """
    bounded_batches(docs.sparkSession)
    out = docs.select(*[F.col(c).alias(f"in_{i}") for i, c in enumerate(docs.columns)])
    shape, name = out.schema, f"in_{docs.columns.index('text')}"
    for shared in _scans(items.withColumn("item_id", F.coalesce(F.col("item_id").cast("long"), F.lit(0)))):
        out = out.mapInArrow(lambda it, own=shared: _clean(it, [b.value for b in own], name), shape)
    return out.select(*[F.col(f"in_{i}").alias(c) for i, c in enumerate(docs.columns)])
