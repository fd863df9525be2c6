"""Approximate nearest neighbours through a hierarchical k-means tree.

The tree grows with the table: its top is fitted on one bounded sample, and each
leaf of the top that would hold too many rows is split by a tree of its own,
fitted where a second, larger sample of its rows is. Every row is put in a leaf. A query
walks the tree best bin first: a priority queue holds the branches not taken,
and leaves are visited until the calibrated number. That number is widened until
a set of calibration queries, compared exactly with all rows, finds the asked
share of their neighbours.

Equal vectors are one entry with their smallest ids, so copies cost nothing.
Neighbouring leaves make up blocks of bounded size, and large leaves are cut; a
block meets the queries that visit any of its leaves, in portions of bounded
size; a task hands on the nearest few of each query.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctual.llm.common import shuffle_partitions, small, written

#: Vectors that the tree's top, and all that is below it, are fitted on, about; branches of a node; rows that a leaf should get.
SAMPLE, DEEP, BRANCHES, LEAF = 20_000, 640_000, 8, 200
#: Sampled vectors below which a node isn't split.
LEAST = 16
#: Calibration queries, and the share of their neighbours that must be found.
PROBES, RECALL = 200, 0.97
#: Rows of a block, and queries, that one task holds.
BLOCK, ASKED = 2048, 4096
FAN = 1000


@dataclass
class Node:
    leaf: int = -1
    centres: np.ndarray | None = None
    children: list[Node] = field(default_factory=list)


def usable(vector: Column) -> Column:
    """No null, no component null or not finite, not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, np.float64)
    top = np.abs(x).max(axis=1, keepdims=True)
    x = x / top
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _means(x: np.ndarray, k: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: centres and each row's."""
    centres = x[rng.choice(len(x), k, replace=False)]
    own = np.zeros(len(x), np.int64)
    for _ in range(12):
        own = (x @ centres.T).argmax(axis=1)
        for j in range(k):
            total = x[own == j].sum(axis=0)
            size = np.sqrt(total @ total)
            centres[j] = total / size if size > 1e-12 else x[rng.integers(len(x))]
    return centres, (x @ centres.T).argmax(axis=1)


def grow(sample: np.ndarray, leaf: int, seed: int = 1) -> tuple[Node, int]:
    """The tree over unit vectors whose leaves hold about ``leaf`` sampled ones, and its number of leaves."""
    rng, n = np.random.default_rng(seed), 0
    root = Node()
    todo = [(root, sample)]
    while todo:
        node, x = todo.pop()
        if len(x) > max(leaf, LEAST):
            centres, own = _means(x, min(BRANCHES, max(2, -(-len(x) // leaf))), rng)
            sizes = np.bincount(own, minlength=len(centres))
            if (sizes > 0).sum() > 1:
                node.centres = centres[sizes > 0]
                node.children = [Node() for _ in node.centres]
                todo += [(c, x[own == j]) for c, j in zip(node.children, np.flatnonzero(sizes), strict=True)]
                continue
        node.leaf, n = n, n + 1
    return root, n


def place(root: Node, x: np.ndarray) -> np.ndarray:
    """The leaf of each unit vector."""
    out, todo = np.zeros(len(x), np.int64), [(root, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if node.centres is None:
            out[rows] = node.leaf
        elif len(rows):
            own = (x[rows] @ node.centres.T).argmax(axis=1)
            todo += [(c, rows[own == j]) for j, c in enumerate(node.children)]
    return out


def best_bins(root: Node, q: np.ndarray) -> Iterator[int]:
    """Leaves in the order of a best-bin-first walk."""
    queue, turn = [(0.0, 0, root)], 1
    while queue:
        _, _, node = heapq.heappop(queue)
        if node.centres is None:
            yield node.leaf
            continue
        for near, child in zip((node.centres @ q).tolist(), node.children, strict=True):
            heapq.heappush(queue, (-near, turn, child))
            turn += 1


def flat(root: Node) -> list[tuple[int, int, list[float]]]:
    """(number, parent's number, centre) of each node below the root, parents first."""
    out, todo, n = [], [(root, 0)], 0
    while todo:
        node, own = todo.pop(0)
        for centre, child in zip(node.centres if node.centres is not None else (), node.children, strict=True):
            n += 1
            out.append((n, own, centre.tolist()))
            todo.append((child, n))
    return out


def grafted(node: Node, rows: list[tuple[int, int, list[float]]]) -> None:
    """Put a flattened tree in the place of a leaf."""
    nodes, centres = {0: node}, {}
    for number, parent, centre in sorted(rows):
        nodes[number] = Node()
        nodes[parent].children.append(nodes[number])
        centres.setdefault(parent, []).append(centre)
    for parent, own in centres.items():
        nodes[parent].centres = np.array(own)


def leaves(root: Node) -> list[Node]:
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        todo += node.children[::-1]
        if node.centres is None:
            out.append(node)
    return out


def _stack(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosines of paired rows in double precision; each is computed the same way wherever it stands."""
    return np.clip((q * x).sum(axis=1) / (np.sqrt((q * q).sum(axis=1)) * np.sqrt((x * x).sum(axis=1))), -1, 1)


def _top(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query: the k nearest rows as (query number, row number, cosine); ties go to smaller ids."""
    order = np.argsort(ids, kind="stable")
    a, b, scores = [], [], []
    units = unit(rows[order])
    for at in range(0, len(queries), 256):
        q = queries[at : at + 256]
        rough = np.round(unit(q) @ units.T, 12)
        take = np.argsort(-rough, axis=1, kind="stable")[:, : k + 4]
        for i, t in enumerate(take):
            exact = cosines(np.broadcast_to(q[i], (len(t), q.shape[1])), rows[order[t]])
            best = np.lexsort((ids[order[t]], -exact))[:k]
            a += [at + i] * len(best)
            b += order[t[best]].tolist()
            scores += exact[best].tolist()
    return np.array(a, np.int64), np.array(b, np.int64), np.array(scores)


def _search(q: pd.DataFrame, x: pd.DataFrame, k: int) -> pd.DataFrame:
    """Of each query: the k nearest rows in the leaves of the block that it visits."""
    none = pd.DataFrame({"qid": [], "vid": [], "score": []}).astype({"qid": "int64", "vid": "int64", "score": "float64"})
    if not len(q) or not len(x):
        return none
    x = x.sort_values("vid")
    ids, rows, leaf = x["vid"].to_numpy(), np.stack(x["v"].to_list()).astype(np.float64), x["leaf"].to_numpy()
    units, parts = unit(rows), []
    for at in range(0, len(q), 256):
        part = q.iloc[at : at + 256]
        queries = np.stack(part["q"].to_list()).astype(np.float64)
        rough = np.round(unit(queries) @ units.T, 12)
        for i, visited in enumerate(part["leaves"]):
            here = np.flatnonzero(np.isin(leaf, visited))
            if not len(here):
                continue
            near = here[np.argsort(-rough[i, here], kind="stable")[: k + 4]]
            exact = cosines(np.broadcast_to(queries[i], (len(near), rows.shape[1])), rows[near])
            best = np.lexsort((ids[near], -exact))[:k]
            parts.append(pd.DataFrame({"qid": part["qid"].iloc[i], "vid": ids[near[best]], "score": exact[best]}))
    return pd.concat(parts, ignore_index=True) if parts else none


def _blocks(counts: dict[int, int]) -> dict[int, tuple[int, int]]:
    """Of each leaf: its first block and their number; leaves share a block up to ``BLOCK`` rows."""
    out, block, room = {}, 0, BLOCK
    for leaf in sorted(counts):
        n = counts[leaf]
        if n > room and room < BLOCK:
            block, room = block + 1, BLOCK
        own = -(-n // BLOCK)
        out[leaf] = (block, own)
        if own > 1:
            block, room = block + own, BLOCK
        else:
            room -= n
    return out


def _smallest(rows: DataFrame, keys: list[str], n: int, k: int) -> DataFrame:
    """``ids``: the k smallest vec_id of each key, through groups of about ``FAN`` however many rows share a key."""
    groups = max(1, -(-n // FAN))
    out = rows.select(*keys, F.array("vec_id").alias("ids"), F.pmod(F.xxhash64("vec_id"), F.lit(groups)).alias("salt"))
    while True:
        out = out.groupBy(*keys, "salt").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k).alias("ids"))
        if groups == 1:
            return out.drop("salt")
        groups = -(-groups // FAN)
        out = out.withColumn("salt", F.pmod("salt", F.lit(groups)))


def _ranked(rows: DataFrame, by: str, k: int) -> DataFrame:
    w = Window.partitionBy(by).orderBy(F.col("score").desc(), F.col("vid"))
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query among all other rows.

    ``vectors`` has vec_id and embedding. Null, zero and non-finite vectors and
    those of another length than the commonest (ties: the longest) take no part,
    nor do rows without vec_id. Rows that repeat a vec_id with an equal vector
    are one. A query with fewer than k candidates gets them all. Other columns
    are ignored.
    """
    spark = vectors.sparkSession
    shape = "query_id long, rank int, vec_id long, score double"
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"), is_query.alias("is_query"))
    length = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if length is None:
        return spark.createDataFrame([], shape)
    rows = rows.where(F.size("v") == length.d).withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64("v", F.lit(1)))
    n = length.n
    ids = _smallest(rows, ["h1", "h2"], n, k + 1).withColumn("vid", F.col("ids")[0])
    firsts = rows.groupBy("h1", "h2").agg(F.max("is_query").alias("asked"), F.min("vec_id").alias("vec_id"))
    entries = firsts.join(rows.select("h1", "h2", "vec_id", "v").dropDuplicates(["h1", "h2", "vec_id"]), ["h1", "h2", "vec_id"]).join(ids, ["h1", "h2"])
    entries = written(entries.select("h1", "h2", "vid", "asked", "ids", "v"))
    n_entries = entries.count()

    draw = F.pmod("h1", F.lit(1 << 40)) / (1 << 40)
    sample = entries.where(draw < SAMPLE / n_entries).select("vid", "v").orderBy("vid").limit(2 * SAMPLE).toPandas().sort_values("vid")
    fitted = unit(np.stack(sample["v"].to_list())) if len(sample) else np.zeros((0, length.d))
    root, n_leaves = grow(fitted, max(1, round(LEAF * len(fitted) / max(1, n_entries))))
    if n_entries > 2 * LEAF * n_leaves:
        n_leaves = _deepened(entries, root, n_entries, n_leaves)
    tree = spark.sparkContext.broadcast(root)
    index = written(entries.select("v", "vid", "asked").mapInArrow(lambda it: _placed(it, tree.value), "v array<double>, vid long, asked boolean, leaf long"))
    counts = {r.leaf: r.n for r in index.groupBy("leaf").agg(F.count("*").alias("n")).collect()}

    visits = _calibrated(entries, index, root, n_entries, n_leaves, k, recall)
    blocks = _blocks(counts)

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, numbers, leaves = [], [], []
            for i, q in enumerate(unit(_stack(batch.column(1))) if len(batch) else []):
                seen = met = 0
                visited: dict[int, list[int]] = {}
                for bin_ in best_bins(tree.value, q):
                    seen, met = seen + 1, met + counts.get(bin_, 0)
                    first, own = blocks.get(bin_, (0, 0))
                    for block in range(first, first + own):
                        visited.setdefault(block, []).append(bin_)
                    if seen >= visits and met > 4 * k:
                        break
                at += [i] * len(visited)
                numbers += visited
                leaves += visited.values()
            if at:
                take = pa.array(at)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(numbers, pa.int64()), pa.array(leaves, pa.list_(pa.int64()))], names=["qid", "q", "block", "leaves"])

    asked = entries.where("asked").select(F.col("vid").alias("qid"), F.col("v").alias("q")).repartition(shuffle_partitions(spark))
    asked = written(asked.mapInArrow(probes, "qid long, q array<double>, block long, leaves array<long>"))
    # A block that many queries visit stands once for each portion of them.
    portions = written(asked.groupBy("block").agg(F.ceil(F.count("*") / ASKED).alias("portions")))
    portions = small(portions, portions.count())
    part = F.pmod(F.xxhash64("qid"), F.col("portions"))
    asked = asked.join(portions, "block").withColumn("part", part).drop("portions")
    places = spark.createDataFrame([(leaf, first, own) for leaf, (first, own) in blocks.items()], "leaf long, first long, own long")
    held = index.join(F.broadcast(places), "leaf").select("vid", "v", "leaf", (F.col("first") + F.pmod(F.xxhash64("vid"), F.col("own"))).alias("block"))
    held = held.join(portions, "block").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("portions") - 1))).drop("portions")
    found = asked.groupBy("block", "part").cogroup(held.groupBy("block", "part")).applyInPandas(lambda q, x: _search(q, x, k + 1), "qid long, vid long, score double")
    near = written(_ranked(found, "qid", k + 1).select("qid", "vid", "score"))
    # Entries stand for all their ids, and a query's own id is no candidate.
    spread = near.join(entries.select("vid", "ids"), "vid").select("qid", "score", F.explode("ids").alias("vid"))
    spread = written(_ranked(spread, "qid", k + 1).select("qid", "vid", "score"))
    asking = rows.where("is_query").select("vec_id", "h1", "h2").distinct().join(entries.select("h1", "h2", F.col("vid").alias("qid")), ["h1", "h2"]).select(F.col("vec_id").alias("query_id"), "qid")
    out = _ranked(asking.join(spread, "qid").where("vid <> query_id"), "query_id", k)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("vid").alias("vec_id"), "score")


def _placed(batches: Iterator[pa.RecordBatch], root: Node) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if len(batch):
            leaf = place(root, unit(_stack(batch.column(0))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=[*batch.schema.names, "leaf"])


def _deepened(entries: DataFrame, root: Node, n_entries: int, n_leaves: int) -> int:
    """Split the leaves of the top by trees of their own; the number of leaves after."""
    top = entries.sparkSession.sparkContext.broadcast(root)
    draw = F.pmod(F.xxhash64("h1", F.lit(2)), F.lit(1 << 40)) / (1 << 40)
    some = entries.where(draw < DEEP / n_entries).select("v", "vid").mapInArrow(lambda it: _placed(it, top.value), "v array<double>, vid long, leaf long")
    size = max(1, round(LEAF * min(1.0, DEEP / n_entries)))

    def fitted(rows: pd.DataFrame) -> pd.DataFrame:
        own, _ = grow(unit(np.stack(rows.sort_values("vid")["v"].to_list())), size)
        return pd.DataFrame([(rows["leaf"].iloc[0], *r) for r in flat(own)], columns=["leaf", "node", "parent", "centre"])

    found: dict[int, list] = {}
    for r in some.groupBy("leaf").applyInPandas(fitted, "leaf long, node long, parent long, centre array<double>").collect():
        found.setdefault(r.leaf, []).append((r.node, r.parent, list(r.centre)))
    for leaf in leaves(root):
        grafted(leaf, found.get(leaf.leaf, []))
    own = leaves(root)
    for i, leaf in enumerate(own):
        leaf.leaf = i
    return len(own)


def _calibrated(entries: DataFrame, index: DataFrame, root: Node, n_entries: int, n_leaves: int, k: int, recall: float) -> int:
    """Leaf visits that find the asked share of the exact neighbours of the calibration queries."""
    if n_leaves == 1:
        return 1
    draw = F.pmod("h2", F.lit(1 << 40)) / (1 << 40)
    probes = entries.where(draw < PROBES / n_entries).select("vid", "v").orderBy("vid").limit(2 * PROBES).toPandas().sort_values("vid")
    if not len(probes):
        return n_leaves
    qid, q = probes["vid"].to_numpy(), np.stack(probes["v"].to_list()).astype(np.float64)

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                part = batch.slice(at, BLOCK)
                a, b, s = _top(q, _stack(part.column(1)), part.column(0).to_numpy(), k + 1)
                yield pa.RecordBatch.from_arrays([pa.array(qid[a]), part.column(0).take(pa.array(b)), pa.array(s), part.column(2).take(pa.array(b))], names=["qid", "vid", "score", "leaf"])

    true = _ranked(index.select("vid", "v", "leaf").mapInArrow(exact, "qid long, vid long, score double, leaf long").where("vid <> qid"), "qid", k).collect()
    wanted: dict[int, list[int]] = {}
    for r in true:
        wanted.setdefault(r.qid, []).append(r.leaf)
    turns = []
    for i, x in zip(qid.tolist(), unit(q), strict=True):
        left = wanted.get(i, [])
        for turn, leaf in enumerate(best_bins(root, x)):
            turns += [turn] * left.count(leaf)
            left = [y for y in left if y != leaf]
            if not left:
                break
    turns = np.sort(turns)
    return int(turns[min(len(turns) - 1, int(np.ceil(recall * len(turns))) - 1)]) + 1 if len(turns) else 1
