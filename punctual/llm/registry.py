"""The queries of this subpackage, under the names the entry module registers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.llm import ann, decontaminate, langid, minhash, mixing, oracles, quality, substring, suffixtree, urls, warc
from punctual.llm.common import table, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: Trained models, searches and digests in base 32 have no SQL; tests hold them against brute force.
ORACLES: dict[str, str] = {"op5_minhash": oracles.MINHASH, "op6_mixing": oracles.MIXING, "op7_substring": oracles.SUBSTRING}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.without_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


@query
def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = written(docs.select("doc_id", "source", mixing.size_of(F.col("text")).alias("size")))
    return mixing.plan(sized).select("doc_id", "size", "source_size", "target", "taken")


@query
def op8_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixtree.score(table(spark, sf_dir, "documents"))


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(table(spark, sf_dir, "pages"))


@query
def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, urls.labels_of(pages, table(spark, sf_dir, "labels")))
