"""Connected components: as joins, for graphs that no single machine holds; on the driver, if few edges are left."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import BROADCAST_ROWS, written

#: Distinct edges up to which the driver joins them up (16 bytes each); more go through rounds of joins, with the same result.
FEW = BROADCAST_ROWS


def _joined_up(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of edges a-b, and the smallest node that each reaches: hooking of roots and pointer jumping."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        p, q = label[x], label[y]
        low, new = np.minimum(p, q), label.copy()
        np.minimum.at(new, p, low)
        np.minimum.at(new, q, low)
        while not np.array_equal(further := new[new], new):
            new = further
        if np.array_equal(new, label):
            return nodes, nodes[label]
        label = new


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of ``edges`` (a, b); component is the smallest node reachable.

    Alternating large-star and small-star contraction: each round links every
    node to the smallest neighbour it knows, until the edges are stars. Rounds
    grow with the logarithm of the longest path. Smallest neighbours are partial
    aggregates and are written before they are joined, so that both sides of a
    join are dealt out for it alone and adaptive execution can split a hub. Up to
    ``FEW`` distinct edges of long nodes are joined up at once instead: a round's
    jobs cost the same however little is in them.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    if {kind for _, kind in now.dtypes} == {"bigint"} and now.count() <= FEW:
        pairs = now.toArrow()
        nodes, least = _joined_up(*(pairs.column(c).to_numpy() for c in ("hi", "lo")))
        return now.sparkSession.createDataFrame(pa.table({"node": nodes, "component": least}), "node long, component long")
    seen = None
    while True:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")))
        large = written(both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.least("u", "m").alias("lo")).where("hi <> lo").distinct())
        least = written(large.groupBy("hi").agg(F.min("lo").alias("m")))
        joined = large.join(least, "hi")
        pairs = joined.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).union(joined.select("hi", F.col("m").alias("lo")))
        now = written(pairs.distinct())
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    least = now.groupBy("hi").agg(F.min("lo").alias("component"))
    roots = now.select(F.col("lo").alias("node")).distinct()
    return least.select(F.col("hi").alias("node"), "component").union(
        roots.join(least, roots["node"] == least["hi"], "left_anti").select("node", F.col("node").alias("component"))
    )
