"""MinHash near-duplicates with tensored banding.

Each distinct set of word shingles gets ``halves`` small keys of two MinHash
values on either of two sides. A table key is a pair of one left and one right
key, so ``halves**2`` tables need only ``4 * halves`` MinHash values. Sets that
meet in a table are candidates; every link is confirmed on the full sets.

Exact copies are one class from the start. Candidates form small components
nearly always, and those are settled exactly, all members against all, in one
bounded block. A component beyond ``BLOCK`` members is settled in blocks: all
members against a few pivots, then what the largest part found so far does not
hold against everything, so that every two members not joined yet are compared.
Blocks are compared as products of 0/1 matrices; no pair is emitted but links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import U64, bounded_batches, chunks, mix, odd_numbers, shingle_sets, shuffle_partitions, small, spans_by, texts_of, word_hashes, written
from punctual.llm.graph import components

#: Keys on each side: at similarity 0.75, 99.95 % of pairs meet in one of the 100 tables.
HALVES = 10
#: Members, and shingles, of a component that one task settles whole.
BLOCK, BLOCK_SHINGLES = 256, 2_000_000
PIVOTS = 8


def linked(inter: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    return 100 * inter >= percent * (n + m - inter)


def _signatures(batches: Iterator[pa.RecordBatch], halves: int, width: int) -> Iterator[pa.RecordBatch]:
    flips, odds, keys = odd_numbers(4 * halves, 11), odd_numbers(4 * halves, 13), odd_numbers(2 * halves, 17)
    for batch in chunks(batches):
        sets, sizes = shingle_sets(*word_hashes(texts_of(batch), lower=True), width)
        full = np.flatnonzero(sizes)
        at = (np.cumsum(sizes) - sizes)[full]
        prints = np.zeros((2, len(sizes)), U64)
        half = np.zeros((len(sizes), 2 * halves), U64)
        if len(full):
            prints[0, full] = np.add.reduceat(mix(sets), at)
            prints[1, full] = np.add.reduceat(mix(sets ^ U64(0x5851F42D4C957F2D)), at)
            for k in range(2 * halves):
                one, two = (np.minimum.reduceat((sets ^ flips[j]) * odds[j], at) for j in (2 * k, 2 * k + 1))
                half[full, k] = mix(mix(one * keys[k]) + two)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * (2 * halves)), pa.array(half.reshape(-1).view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")), pa.array(sizes), pa.array(prints[0].view(np.int64)), pa.array(prints[1].view(np.int64)), lists], names=["doc_id", "n_shingles", "f1", "f2", "halves"])


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        sets, sizes = shingle_sets(*word_hashes(texts_of(batch), lower=True), width)
        ends = np.cumsum(sizes)
        blobs = [sets[e - n : e].tobytes() for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes), pa.array(blobs, pa.binary())], names=["node", "cc", "n", "shingles"])


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections within a bounded block of sets."""
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    order = np.argsort(values, kind="stable")
    at, column = spans_by(values[order])
    shared = np.diff(np.r_[at, len(values)]) > 1
    keep = shared[column]
    owner, column = owner[order][keep], (np.cumsum(shared) - 1)[column[keep]]
    out = np.zeros((len(sets), len(sets)), np.float64)
    for a in range(0, int(shared.sum()), 1 << 14):
        part = slice(*np.searchsorted(column, [a, a + (1 << 14)]))
        cells = np.zeros((len(sets), min(1 << 14, int(shared.sum()) - a)), np.float32)
        cells[owner[part], column[part] - a] = 1
        out += cells @ cells.T
    return out


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections between two bounded blocks of sets."""
    out = np.zeros((len(left), len(right)), np.float64)
    values = np.concatenate([*left, *right])
    owner = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in (*left, *right)])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.r_[True, values[1:] != values[:-1]] if len(values) else np.zeros(0, bool)
    column = np.cumsum(new) - 1
    is_left = owner < len(left)
    width = int(column[-1]) + 1 if len(column) else 0
    both = (np.bincount(column[is_left], minlength=width) > 0) & (np.bincount(column[~is_left], minlength=width) > 0)
    keep = both[column] if len(column) else np.zeros(0, bool)
    owner, column = owner[keep], (np.cumsum(both) - 1)[column[keep]]
    for a in range(0, int(both.sum()), 1 << 14):
        part = slice(*np.searchsorted(column, [a, a + (1 << 14)]))
        cells = np.zeros((len(left) + len(right), min(1 << 14, int(both.sum()) - a)), np.float32)
        cells[owner[part], column[part] - a] = 1
        out += cells[: len(left)] @ cells[len(left) :].T
    return out


def _unpack(shingles: pd.Series) -> list[np.ndarray]:
    return [np.frombuffer(x, U64) for x in shingles]


def _settle(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Exact components of each candidate component in a bin; repeated ids are one node."""
    out = []
    for _, group in rows.groupby("cc", sort=False):
        sets, node = _unpack(group["shingles"]), group["node"].to_numpy()
        n = np.array([len(x) for x in sets], np.float64)
        near = linked(overlaps(sets), n[:, None], n[None, :], percent) | (node[:, None] == node[None, :])
        left, label = np.ones(len(node), bool), np.zeros(len(node), np.int64)
        while left.any():
            reach = np.zeros(len(node), bool)
            reach[np.flatnonzero(left)[0]] = True
            while (more := near[reach].any(axis=0) & ~reach).any():
                reach |= more
            label[reach] = node[reach].min()
            left &= ~reach
        out.append(pd.DataFrame({"node": node, "component": label}))
    return pd.concat(out, ignore_index=True).drop_duplicates() if out else pd.DataFrame({"node": [], "component": []}).astype("int64")


def _links(left: pd.DataFrame, right: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links between two blocks; of each right member, one link to every label among the left."""
    none = pd.DataFrame({"a": [], "b": []}).astype("int64")
    if not len(left) or not len(right):
        return none
    x, y = _unpack(left["shingles"]), _unpack(right["shingles"])
    n, m = np.array([len(s) for s in x], np.float64), np.array([len(s) for s in y], np.float64)
    i, j = np.nonzero(linked(intersections(x, y), n[:, None], m[None, :], percent))
    found = pd.DataFrame({"a": left["node"].to_numpy()[i], "b": right["node"].to_numpy()[j], "label": left["label"].to_numpy()[i]})
    return found[found["a"] != found["b"]].groupby(["b", "label"], as_index=False)["a"].min()[["a", "b"]] if len(found) else none


def _hot_components(hot: DataFrame, percent: int) -> DataFrame:
    """(node, component) for candidate components too large for one task."""
    parted = hot.withColumn("blk", F.pmod(F.xxhash64("node"), F.col("blocks")))
    chosen = hot.groupBy("cc").agg(*[F.min_by("node", F.xxhash64("node", F.lit(k))).alias(f"p{k}") for k in range(PIVOTS)])
    chosen = chosen.select("cc", F.explode(F.array_distinct(F.array(*[f"p{k}" for k in range(PIVOTS)]))).alias("node"))
    pivots = written(chosen.join(hot, ["cc", "node"]).dropDuplicates(["cc", "node"]))
    dealt = pivots.withColumn("blk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).withColumn("label", F.col("node"))
    shape = "a long, b long"
    near = (
        dealt.groupBy("cc", "blk")
        .cogroup(parted.groupBy("cc", "blk"))
        .applyInPandas(lambda p, r: _links(p, r, percent), shape)
    )
    near = written(near)
    # Two members that no link joins yet are not both in the largest part: the rest meets all members.
    joined = written(components(near))
    known = written(parted.join(joined, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component"))
    largest = known.groupBy("cc", "label").agg(F.count("*").alias("size")).groupBy("cc").agg(F.max_by("label", F.struct("size", "label")).alias("largest"))
    rest = written(known.join(largest, "cc").where("label <> largest").drop("largest"))
    counts = rest.groupBy("cc").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("long").alias("rest_blocks"))
    if not rest.isEmpty():
        counts, again = written(counts), written(counts)  # two reads: the sides of a cogroup share no columns
        y = F.pmod(F.xxhash64("node", F.lit(1)), F.col("rest_blocks"))
        left = known.join(counts, "cc").withColumn("y", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rest_blocks") - 1)))
        right = rest.join(again, "cc").withColumn("y", y).drop("blk").withColumn("blk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        far = left.groupBy("cc", "blk", "y").cogroup(right.groupBy("cc", "blk", "y")).applyInPandas(lambda p, r: _links(p, r, percent), shape)
        joined = components(written(near.union(far)))
    return hot.select("node").distinct().join(joined, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def near_duplicates(docs: DataFrame, percent: int = 75, halves: int = HALVES, width: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs`` (doc_id, text).

    Documents whose shingle sets have ``100 * intersection >= percent * union``
    are linked. Null, empty and blank texts have no shingles and no links. Rows
    that repeat a doc_id are one node, with the links of all their texts and one
    component_id; a null doc_id is never a component's id unless all its class is
    null. Other columns are ignored.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select("doc_id", "text")
    marks = written(docs.mapInArrow(lambda it: _signatures(it, halves, width), "doc_id long, n_shingles long, f1 long, f2 long, halves array<long>"))
    some = marks.where("n_shingles > 0")
    classes = written(some.groupBy("f1", "f2", "n_shingles").agg(F.min("doc_id").alias("node")))

    # Half keys that two sets share, then pairs of them: the tables.
    heads = some.where("doc_id is not null").join(classes.withColumnRenamed("node", "doc_id"), ["f1", "f2", "n_shingles", "doc_id"])
    keys = heads.select(F.col("doc_id").alias("node"), F.posexplode("halves").alias("pos", "key"))
    shared = keys.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("key")
    met = keys.join(shared, "key").groupBy("node").agg(
        F.collect_set(F.when(F.col("pos") < halves, F.col("key"))).alias("left"),
        F.collect_set(F.when(F.col("pos") >= halves, F.col("key"))).alias("right"),
    )
    tables = written(met.select("node", F.explode("left").alias("l"), "right").select("node", "l", F.explode("right").alias("r")).select("node", F.xxhash64("l", "r").alias("key")))
    least = tables.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
    stars = tables.join(least, "key").where("node <> lo").select(F.col("lo").alias("a"), F.col("node").alias("b"))
    groups = written(components(stars).withColumnRenamed("component", "cc"))

    # Full sets of the candidates alone.
    texts = docs.join(small(groups, groups.count()), docs["doc_id"] == groups["node"]).select("node", "cc", "text")
    sets = texts.mapInArrow(lambda it: _sets(it, width), "node long, cc long, n long, shingles binary")
    sets = written(sets)
    sizes = sets.groupBy("cc").agg(F.count("*").alias("members"), F.sum("n").alias("total"))
    sizes = written(sizes.withColumn("blocks", F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("long")))
    n_all, n_hot, n_rows = sizes.agg(F.sum("total"), F.count_if(F.col("blocks") > 1), F.count("*")).first()
    bins = max(4 * shuffle_partitions(spark), (n_all or 0) // BLOCK_SHINGLES)
    cool = sets if not n_hot else sets.join(small(sizes.where("blocks = 1").select("cc"), n_rows), "cc", "left_semi")
    settled = (
        cool.withColumn("bin", F.pmod(F.xxhash64("cc"), F.lit(bins)))
        .groupBy("bin")
        .applyInPandas(lambda rows: _settle(rows, percent), "node long, component long")
    )
    if n_hot:
        hot = written(sets.join(small(sizes.where("blocks > 1").select("cc", "blocks"), n_rows), "cc"))
        settled = settled.union(_hot_components(hot, percent))
    settled = written(settled.groupBy("node").agg(F.min("component").alias("component")))

    # An id is one node whatever the texts of its rows: the classes of rows that share it are one component.
    member = marks.select("doc_id", "n_shingles", "f1", "f2").join(classes, ["f1", "f2", "n_shingles"], "left").select("doc_id", "n_shingles", F.coalesce("node", "doc_id").alias("node"))
    member = written(member)
    shared = member.where("doc_id is not null").groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b").select("doc_id", "a")
    shared = written(shared)
    if not shared.isEmpty():
        joined = member.join(shared, "doc_id").select("a", F.col("node").alias("b"))
        settled = written(components(joined.union(settled.select("node", "component"))))
    out = member.join(settled, "node", "left").select("doc_id", "n_shingles", F.coalesce("component", "node").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
