"""The corpus pipeline: five stages from raw documents to a mixed training corpus.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's rows as Parquet and reads them again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.llm import decontaminate, langid, minhash, mixing, substring
from punctual.llm.common import small, table, written

#: Probability that a text's language must have, and how much more than by chance where few languages make chance likelier.
LEAST_SURE, OVER_CHANCE = 0.3, 1.02


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language: no text, no letter or no language likelier than LEAST_SURE and than by chance, and they go.

    With one language to choose from, all lettered texts are in it.
    """
    net = langid.fit(docs)
    n = len(net.langs) if net else 0
    return langid.accepted(docs, net, max(LEAST_SURE, OVER_CHANCE / n) if n > 1 else 0.0)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id.

    Of rows that repeat a doc_id the smallest stays, by text and then by the
    other columns in order. Rows without doc_id can't be told apart and stay.
    """
    kept = written(minhash.near_duplicates(docs).where("kept and doc_id is not null").select("doc_id"))
    ids = kept.distinct()
    rows, single = kept.count(), ids.count()
    out = docs.join(small(ids, single), "doc_id", "left_semi").select(*docs.columns)
    if rows > single:
        rest = [c for c in docs.columns if c not in ("doc_id", "text")]
        least = out.groupBy("doc_id").agg(F.min(F.struct("text", *rest)).alias("in_0"))
        out = least.select(*[F.col("doc_id") if c == "doc_id" else F.col("in_0")[c].alias(c) for c in docs.columns])
    return out.unionByName(docs.where("doc_id is null"))


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document with a smaller id holds; texts with nothing left go."""
    return substring.cut_documents(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as many times as it was drawn, with its copy's number."""
    return mixing.mixed(docs)


STAGES = [
    ("language_id", identified),
    ("near_dedup", distinct),
    ("substring_dedup", unrepeated),
    ("decontamination", decontaminated),
    ("mixing", mixed),
]

#: Trained networks and fingerprints aren't SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
