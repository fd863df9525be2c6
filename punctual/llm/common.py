"""Helpers that the operators share: tables, scratch files, words and hashes.

Words are runs of bytes other than the six ASCII white-space characters
(``[^\\x20\\x09-\\x0D]+``); ``bytes.split()`` cuts at exactly those, and
``bytes.lower()`` lower-cases exactly A-Z.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python worker holds at a time. One longer text is a chunk of its own.
CHUNK_BYTES = 4 << 20
#: Rows, and bytes, up to which a table may be broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 32 << 20

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % modulus


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, since ten thousand long texts don't fit a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(2 * CHUNK_BYTES))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that all executors share."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="punctual-")
        sc.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


#: Deletes an execution's shuffle files when it ends; what was written needs them no more.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written_at(df: DataFrame, by: str | None = None) -> tuple[DataFrame, str]:
    """``written``, and where; with ``by``, the values of that column are folders."""
    spark, path = df.sparkSession, scratch(df.sparkSession)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        writer = df.write.option("compression", "zstd")
        (writer.partitionBy(by) if by else writer).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path), path


def written(df: DataFrame) -> DataFrame:
    """The same rows from a Parquet table in the shared folder: cuts lineage, survives lost executors, frees the shuffles behind it."""
    return written_at(df)[0]


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables that nothing will read again."""
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def small(df: DataFrame, rows: int, size: int | None = None) -> DataFrame:
    """Mark a table of checked size (16 bytes a row, if not told) for broadcasting; beyond the bound, Spark joins by shuffle."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS and (16 * rows if size is None else size) <= BROADCAST_BYTES else df


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The texts as UTF-8 bytes; null reads as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [t or b"" for t in column.cast(pa.binary() if column.type == pa.string() else pa.large_binary()).to_pylist()]


def chunks(batches: Iterator[pa.RecordBatch], name: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut or pass on batches so that each holds about ``limit`` bytes of text at most."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(name))
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        block = np.cumsum(sizes) // limit
        edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(batch)]
        for a, b in zip(edges, edges[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def odd_numbers(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit multipliers that depend on the seed alone."""
    return mix((np.arange(n, dtype=U64) + U64(1)) * U64(0x9E3779B97F4A7C15) + U64(seed)) | U64(1)


def hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), U64, len(words))


def word_hashes(texts: list[bytes], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, one text after another, and the number of words of each text."""
    counts = np.zeros(len(texts), np.int64)
    words: list[bytes] = []
    for i, text in enumerate(texts):
        own = (text.lower() if lower else text).split()
        counts[i] = len(own)
        words += own
    return hashed(words), counts


def ngrams(h: np.ndarray, width: int, seed: int = 5) -> np.ndarray:
    """A hash of each ``width`` consecutive word hashes (also across texts; callers mask those)."""
    k = odd_numbers(width, seed)
    out = h[: len(h) - width + 1] * k[0]
    for i in range(1, width):
        out += h[i : len(h) - width + 1 + i] * k[i]
    return mix(out)


def shingle_sets(h: np.ndarray, counts: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct ``width``-word shingles of each text and their number.

    A text of fewer words has one shingle, its whole sequence; one without words none.
    """
    ends = np.cumsum(counts)
    starts = ends - counts
    grams = ngrams(h, width) if len(h) >= width else np.zeros(0, U64)
    k, sets, sizes = odd_numbers(width, 77), [], np.zeros(len(counts), np.int64)
    for i, (a, n) in enumerate(zip(starts.tolist(), counts.tolist(), strict=True)):
        if n >= width:
            own = np.unique(grams[a : a + n - width + 1])
        elif n:
            own = mix(np.array([(h[a : a + n] * k[:n]).sum(dtype=U64) + U64(n)], U64))
        else:
            continue
        sets.append(own)
        sizes[i] = len(own)
    return (np.concatenate(sets) if sets else np.zeros(0, U64)), sizes


def pack(keys: np.ndarray, n_buckets: int, columns: dict[str, np.ndarray]) -> tuple[np.ndarray, dict[str, list[bytes]]]:
    """Deal entries out to buckets by key: the bucket numbers that occur, and each column's bytes for them.

    Shuffling one binary value per bucket and chunk instead of a row per entry
    keeps the shuffle at the size of the data.
    """
    bucket = (keys % U64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    edges = [0, *cuts.tolist(), len(bucket)] if len(bucket) else [0]
    dealt = {k: v[order] for k, v in columns.items()}
    spans = list(zip(edges, edges[1:], strict=False))
    return bucket[np.array(edges[:-1], np.int64)], {k: [v[a:b].tobytes() for a, b in spans] for k, v in dealt.items()}


def spans_by(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted keys: where each run starts, and the run each entry is in."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.empty(len(keys), bool)
    new[0] = True
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    return np.flatnonzero(new), np.cumsum(new) - 1


def by_bucket(df: DataFrame, tasks: int) -> DataFrame:
    """Each task gets as many buckets as any other, one after another."""
    return df.repartitionById(tasks, "bucket").sortWithinPartitions("bucket")


def bucket_runs(batches: Iterator[pa.RecordBatch], name: str = "bucket") -> Iterator[pa.Table]:
    """The rows of one bucket after another, from rows sorted by bucket."""
    held, now = [], None
    for batch in batches:
        if not len(batch):
            continue
        keys = batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(batch)]
        for a, b in zip(edges, edges[1:], strict=False):
            if held and keys[a] != now:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            now = keys[a]
    if held:
        yield pa.Table.from_batches(held)


def squeeze(x: np.ndarray) -> bytes:
    """An array as bytes: its length, then its bytes place by place, compressed."""
    raw = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes() if len(x) else b""
    return len(x).to_bytes(8, "little") + (pa.compress(raw, "zstd", asbytes=True) if raw else b"")


def spread(blob: bytes, kind: type) -> np.ndarray:
    """The array that ``squeeze`` made bytes of."""
    n, size = int.from_bytes(blob[:8], "little"), np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    raw = np.frombuffer(pa.decompress(blob[8:], n * size, "zstd", asbytes=True), np.uint8).reshape(size, n)
    return np.ascontiguousarray(raw.T).view(kind).ravel()
