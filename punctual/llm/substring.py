"""Removal of repeated passages, found through difference-cover anchors.

A window of 50 words that occurs in two places contains an aligned anchor: the
cover positions modulo the period hold every difference, so wherever the two
copies start, some offset below the period puts both on cover positions. Only
the short windows at those positions (6 of 31) are hashed and dealt out. Where an
anchor occurs in two documents, the 50-word windows around it are hashed in
turn, and each window's smallest document decides.

Entries travel packed, a binary value per bucket and chunk. The number of
buckets follows from the bytes of text alone, so a bucket is small whatever the
partitions are, and a task takes its buckets one after another. Within a chunk a
hash is settled as far as the chunk can, so a passage that a third of all
documents hold sends one entry a chunk, not one a document; what is settled goes
to its document's bucket at once and is only passed on by the judges of hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.llm.common import U64, bounded_batches, by_bucket, chunks, mix, odd_numbers, pack, shuffle_partitions, small, spans_by, texts_of, word_hashes, written

#: A perfect difference set: every remainder modulo 31 is a difference of two of these.
PERIOD, COVER = 31, (0, 1, 3, 8, 12, 18)
WINDOW = 50
#: Bytes of text whose entries make up a bucket.
BUCKET_BYTES = 8 << 20

PACKED = "bucket int, settled boolean, h binary, d binary, p binary, known binary"
PLACES = "doc_id long, places binary"


def _running(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial over the word hashes, and the powers to shift a window to 0."""
    p = int(odd_numbers(1, 31)[0])
    back = pow(p, -1, 1 << 64)
    up = np.cumprod(np.r_[U64(1), np.full(len(h), p, U64)], dtype=U64)
    down = np.cumprod(np.r_[U64(1), np.full(len(h), back, U64)], dtype=U64)
    return np.r_[U64(0), np.cumsum(h * up[:-1], dtype=U64)], up, down


def _window_hashes(h: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    total, _, down = _running(h)
    return mix((total[starts + width] - total[starts]) * down[starts])


def _rows(keys: np.ndarray, docs: np.ndarray, places: np.ndarray, known: np.ndarray, buckets: int, settled: bool = False) -> pa.RecordBatch:
    number, blobs = pack(keys, buckets, {"h": keys, "d": docs, "p": places.astype(np.int32), "known": known})
    return pa.RecordBatch.from_arrays([pa.array(number, pa.int32()), pa.array([settled] * len(number), pa.bool_()), *(pa.array(blobs[c], pa.binary()) for c in ("h", "d", "p", "known"))], names=["bucket", "settled", "h", "d", "p", "known"])


def _settled(docs: np.ndarray, places: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Places settled already, dealt out by document."""
    return _rows(mix(docs.view(U64)), docs, places.astype(np.int64), np.zeros(len(docs), np.int8), buckets, True)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...] | pa.RecordBatch]:
    """The entries of one bucket after another, from rows sorted by bucket; settled rows are passed through as they come."""
    parts: list[list[bytes]] = [[], [], [], []]
    bucket = None

    def whole() -> tuple[np.ndarray, ...]:
        out = tuple(np.frombuffer(b"".join(part), kind) for part, kind in zip(parts, (U64, np.int64, np.int32, np.int8), strict=True))
        for part in parts:
            part.clear()
        return out

    for batch in batches:
        mask = batch.column(1)
        done, batch = batch.filter(mask), batch.filter(pc.invert(mask))
        if len(done):
            yield done
        at, _ = spans_by(batch.column(0).to_numpy())
        for a, b in zip(at.tolist(), [*at[1:].tolist(), len(batch)], strict=False):
            number = batch.column(0)[a].as_py()
            if number != bucket and parts[0]:
                yield whole()
            bucket = number
            for i, part in enumerate(parts):
                part += batch.column(i + 2).slice(a, b - a).to_pylist()
    if parts[0]:
        yield whole()


def _stretches(batches: Iterator[pa.RecordBatch], before: int, after: int) -> Iterator[pa.RecordBatch]:
    """One row for each document: the union of the stretches [place - before, place + after), as pairs of int32."""
    plain = (b.set_column(1, "settled", pa.array([False] * len(b), pa.bool_())) for b in batches)
    for _, docs, places, _ in _gathered(plain):
        order = np.lexsort((places, docs))
        docs, places = docs[order], places[order].astype(np.int64)
        lo, hi = np.maximum(places - before, 0), places + after
        new = np.r_[True, (docs[1:] != docs[:-1]) | (lo[1:] > hi[:-1])]
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(docs)] - 1
        pairs, docs = np.stack([lo[first], hi[last]], axis=1).astype(np.int32), docs[first]
        at, _ = spans_by(docs)
        blobs = [pairs[a:b].tobytes() for a, b in zip(at.tolist(), [*at[1:].tolist(), len(docs)], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(docs[at]), pa.array(blobs, pa.binary())], names=["doc_id", "places"])


def _edges(blob: bytes | None, n: int) -> np.ndarray:
    """+1 where a stretch starts and -1 where it ends, within a text of n words."""
    pairs = np.minimum(np.frombuffer(blob or b"", np.int32).reshape(-1, 2), n)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, pairs[:, 0], 1)
    np.add.at(edge, pairs[:, 1], -1)
    return edge


#: An entry to judge; one that stands for a hash settled in its chunk.
ASK, TELL = 0, 1


def _anchors(batches: Iterator[pa.RecordBatch], window: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Hashes at cover positions; those two documents of the chunk share are settled here."""
    width = window - PERIOD + 1
    cover = np.zeros(PERIOD, bool)
    cover[list(COVER)] = True
    for batch in chunks(batches):
        ids = batch.column(0).to_numpy()
        h, counts = word_hashes(texts_of(batch), lower=False)
        first = np.cumsum(counts) - counts
        doc = np.repeat(np.arange(len(counts)), counts)
        at = np.arange(len(h)) - first[doc]
        starts = np.flatnonzero(cover[at % PERIOD] & (at + width <= counts[doc]) & (counts[doc] >= window))
        if not len(starts):
            continue
        keys, docs, places = _window_hashes(h, starts, width), ids[doc[starts]], at[starts]
        order = np.lexsort((docs, keys))
        keys, docs, places = keys[order], docs[order], places[order]
        run, of = spans_by(keys)
        last = np.r_[run[1:], len(keys)] - 1
        common = docs[run] != docs[last]
        alone, told = ~common[of], run[common]
        yield _settled(docs[~alone], places[~alone], buckets)
        yield _rows(np.r_[keys[alone], keys[told]], np.r_[docs[alone], docs[told]], np.r_[places[alone], places[told]], np.repeat(np.array([ASK, TELL], np.int8), [int(alone.sum()), len(told)]), buckets)


def _shared(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Of the dealt anchors: the places of those that two documents hold."""
    for found in _gathered(batches):
        if isinstance(found, pa.RecordBatch):
            yield found
            continue
        keys, docs, places, known = found
        order = np.lexsort((docs, keys))
        keys, docs, places, known = keys[order], docs[order], places[order], known[order]
        run, of = spans_by(keys)
        last = np.r_[run[1:], len(keys)] - 1
        common = (docs[run] != docs[last]) | (np.maximum.reduceat(known, run) == TELL)
        keep = common[of] & (known == ASK)
        if keep.any():
            yield _settled(docs[keep], places[keep], buckets)


def _windows(batches: Iterator[pa.RecordBatch], window: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Hashes of the windows that hold a shared anchor; beaten within the chunk, a window needs no judge."""
    for batch in chunks(batches):
        ids = batch.column(0).to_numpy()
        h, counts = word_hashes(texts_of(batch), lower=False)
        first = np.cumsum(counts) - counts
        edges = [_edges(blob, n)[:-1] for blob, n in zip(batch.column(batch.schema.get_field_index("places")).to_pylist(), counts.tolist(), strict=True)]
        near = np.concatenate([np.cumsum(e) > 0 for e in edges])
        doc = np.repeat(np.arange(len(counts)), counts)
        at = np.arange(len(h)) - first[doc]
        starts = np.flatnonzero(near & (at + window <= counts[doc]))
        if not len(starts):
            continue
        keys, docs, places = _window_hashes(h, starts, window), ids[doc[starts]], at[starts]
        order = np.lexsort((docs, keys))
        keys, docs, places = keys[order], docs[order], places[order]
        run, of = spans_by(keys)
        beaten = docs > docs[run][of]
        if beaten.any():
            yield _settled(docs[beaten], places[beaten], buckets)
        yield _rows(keys[~beaten], docs[~beaten], places[~beaten], np.full(int((~beaten).sum()), ASK, np.int8), buckets)


def _judged(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """The places of windows that also start in a document with a smaller id."""
    for found in _gathered(batches):
        if isinstance(found, pa.RecordBatch):
            yield found
            continue
        keys, docs, places, _ = found
        order = np.lexsort((docs, keys))
        keys, docs, places = keys[order], docs[order], places[order]
        run, of = spans_by(keys)
        beaten = docs > docs[run][of]
        if beaten.any():
            yield _settled(docs[beaten], places[beaten], buckets)


def _kept(text: bytes, blob: bytes | None) -> tuple[int, list[bytes]]:
    """The number of a text's words, and those that stay."""
    words = text.split()
    n = len(words)
    if blob:
        gone = np.cumsum(_edges(blob, n)[:-1]) > 0
        words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
    return n, words


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words that stay, their digest and what went."""
    names = ["row", "n_words", "n_removed", "kept_sha256", "kept_text"]
    for batch in chunks(batches):
        rows = []
        for text, blob in zip(texts_of(batch), batch.column(batch.schema.get_field_index("places")).to_pylist(), strict=True):
            n, words = _kept(text, blob)
            kept = b" ".join(words)
            rows.append((n, n - len(words), hashlib.sha256(kept).hexdigest(), kept))
        columns = list(zip(*rows, strict=True))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string()), pa.array(columns[3], pa.binary()).cast(pa.string())], names=names)


def _rewritten(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    """Whole rows with the text in column ``at`` cut; last, whether it lost words and whether any are left."""
    for batch in chunks(batches, f"in_{at}"):
        texts, changed, left = batch.column(at).to_pylist(), [], []
        for i, (text, blob) in enumerate(zip(texts, batch.column(batch.num_columns - 1).to_pylist(), strict=True)):
            n, words = _kept(text.encode(), blob) if blob and text else (0, [])
            changed.append(n > len(words))
            left.append(bool(words) or n == 0)
            if changed[-1]:
                texts[i] = b" ".join(words).decode()
        columns = [pa.array(texts, batch.column(at).type) if i == at else batch.column(i) for i in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(changed), pa.array(left)], names=[*batch.schema.names[:-1], "changed", "some_left"])


def repeated_places(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, places): the stretches of words to remove, as pairs of int32, for each document that has any."""
    if window < PERIOD:
        raise ValueError(f"windows of fewer than {PERIOD} words have no aligned anchor")
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.where("doc_id is not null").select("doc_id", "text")
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = -(-size // BUCKET_BYTES) or 1
    tasks = min(buckets, shuffle_partitions(spark))
    width = window - PERIOD + 1

    def stretches(packed: DataFrame, before: int, after: int) -> DataFrame:
        return written(by_bucket(packed, tasks).mapInArrow(lambda it: _stretches(it, before, after), PLACES))

    anchors = by_bucket(docs.mapInArrow(lambda it: _anchors(it, window, buckets), PACKED), tasks)
    shared = stretches(anchors.mapInArrow(lambda it: _shared(it, buckets), PACKED), window - width, 1)
    held = docs.join(small(shared, *_extent(shared)), "doc_id")
    windows = by_bucket(held.select("doc_id", "text", "places").mapInArrow(lambda it: _windows(it, window, buckets), PACKED), tasks)
    return stretches(windows.mapInArrow(lambda it: _judged(it, buckets), PACKED), 0, window)


def _extent(places: DataFrame) -> tuple[int, int]:
    """Rows and bytes."""
    return places.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("places") + 32), F.lit(0))).first()


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept_text) for each row of ``docs`` (doc_id, text).

    A word goes if a window of ``window`` consecutive words covers it whose word
    sequence also starts in a document with a smaller doc_id; windows are judged
    on the input. ``kept_text`` joins the words that stay by one space. A null
    text has no words. Rows with a null doc_id lose nothing and cost nobody a
    word. Rows that repeat a doc_id are parts of one document: they never cost
    each other a word, and where one of them loses a place, each that reaches so far does.
    Other columns are ignored.
    """
    places = repeated_places(docs, window)
    joined = docs.select("doc_id", "text").join(small(places, *_extent(places)), "doc_id", "left")
    shape = "row long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    renamed = joined.select(F.col("doc_id").alias("row"), "text", "places")
    return renamed.mapInArrow(lambda it: _cut(it), shape).withColumnRenamed("row", "doc_id")


def cut_documents(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without repeated passages; rows with no word left go.

    A text that loses nothing stays as it is; of others the words that stay are
    joined by one space, and n_chars, if there is such a column, is their length.
    All columns are carried along, whatever their names.
    """
    places = repeated_places(docs, window)
    named = docs.select(*[F.col(c).alias(f"in_{i}") for i, c in enumerate(docs.columns)])
    at, key = docs.columns.index("text"), docs.columns.index("doc_id")
    joined = named.join(small(places, *_extent(places)), F.col(f"in_{key}") == F.col("doc_id"), "left").drop("doc_id")
    fields = [T.StructField(f"in_{i}", f.dataType) for i, f in enumerate(docs.schema.fields)]
    shape = T.StructType([*fields, T.StructField("changed", T.BooleanType()), T.StructField("some_left", T.BooleanType())])
    out = joined.mapInArrow(lambda it: _rewritten(it, at), shape).where("some_left")
    length = lambda i, f: F.when(F.col("changed"), F.length(f"in_{at}").cast(f.dataType)).otherwise(F.col(f"in_{i}"))
    return out.select(*[(length(i, f) if f.name == "n_chars" else F.col(f"in_{i}")).alias(f.name) for i, f in enumerate(docs.schema.fields)])
