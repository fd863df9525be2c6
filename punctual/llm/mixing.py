"""Mixing sources to target weights by systematic sampling, in DataFrame operations alone.

Each document of a source is expected ``target / source_size`` times. Along a
fixed order of the source's documents the expected copies are summed up, one
random offset is added, and a document is taken once for every whole number
that its step crosses. The order goes by size first, so that every stretch of
sizes gives its share and the words taken come near the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctual.llm.common import small, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, SHARE, LIMIT, SEED = (5.0, 2.0, 1.0), 1.5, 2.0, "mix"
#: Documents that are ranked together, about.
BLOCK = 2_000


def size_of(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """(source, source_size, target) from (source, source_size): a row for each source.

    Sources by code point, null last, get the weights in turn. A target stops at
    ``limit`` times its source's size and the excess goes to the others by
    weight: in order of size per weight, a source is full if what is left, dealt
    by the weights left, would fill it.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weighed = sizes.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1)).withColumn("cap", F.col("source_size") * limit)
    every = Window.partitionBy()
    fill = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before, after = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(every) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after)
    leveled = weighed.withColumn("level", level)
    # From the first source that is not full on, all get the same level.
    first = F.min(F.when(F.col("cap") > F.col("level") * F.col("w"), F.struct(F.col("cap") / F.col("w"), F.col("level").alias("level")))).over(every)["level"]
    target = F.when(F.col("cap") <= F.col("level") * F.col("w"), F.col("cap")).otherwise(F.least("cap", first * F.col("w")))
    return leveled.withColumn("target", target).select("source", "source_size", "target")


def plan(docs: DataFrame, key: str = "doc_id", weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT, seed: str = SEED) -> DataFrame:
    """The columns of ``docs`` (``key``, source, text, or else size, and any others) with size, source_size, target, copies and taken.

    A size is the number of words of the text (null: 0), ``taken`` the words that
    the copies hold. A null source is a source of its own, the last. Sources
    without words have target 0 and no copies. Documents are ordered within a
    source by the root of their size, a digest of their key (of their size, if
    they have none) and the key, so reruns agree; rows alike in all of these are
    interchangeable. Columns of the
    input named like the new ones are replaced.
    """
    size = size_of(F.col("text")) if "text" in docs.columns else F.col("size")
    docs = docs.drop("source_size", "target", "copies", "taken", *(["size"] if "text" in docs.columns else []))
    key_of = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))  # null is a source of its own
    rows = docs.select(*[F.col(c).alias(f"in_{i}") for i, c in enumerate(docs.columns)], "source", F.col(key).cast("string").alias("key"), size.alias("words"))
    rows = rows.withColumn("sk", key_of)
    slim = written(rows.select("source", "sk", "key", "words"))  # texts are read once for all statistics
    counted = written(slim.groupBy("source").agg(F.sum("words").alias("source_size")))
    shares = targets(counted.select("source", "source_size"), weights, share, limit)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce("source", F.lit("\0")))), 1, 8), 16, 10).cast("double") / float(1 << 32)
    shares = written(shares.select(key_of.alias("sk"), "source_size", "target", rate.alias("rate"), offset.alias("offset")))

    # Rank within the source, block by block: a block is a stretch of the order, small however large the source.
    def stretched(df: DataFrame) -> DataFrame:
        return df.drop("source").withColumn("stretch", F.floor(F.sqrt("words")).cast("long"))

    tall = stretched(slim).groupBy("sk", "stretch").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    tall = written(tall)
    tall = small(tall, tall.count(), tall.agg(F.coalesce(F.sum(F.octet_length("sk") + 24), F.lit(0))).first()[0])

    def placed(df: DataFrame) -> DataFrame:
        """Blocks in the order of the digest; documents without key go by their size, so that they are told apart as far as it matters."""
        df = stretched(df).join(tall, ["sk", "stretch"])
        df = df.withColumn("digest", F.md5(F.coalesce("key", F.concat(F.lit("?"), F.col("words").cast("string")))))
        share = F.conv(F.substring("digest", 1, 8), 16, 10).cast("double") / float(1 << 32)
        return df.withColumn("part", F.floor(share * F.col("parts"))).drop("parts")

    block = ["sk", "stretch", "part"]
    ahead = Window.partitionBy("sk").orderBy("stretch", "part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed(slim).groupBy(*block).agg(F.count("*").alias("n")).withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    parts = written(parts.select(*block, "ahead").join(shares, "sk"))
    within = Window.partitionBy(*block).orderBy("digest", F.col("key").asc_nulls_last())
    rank = F.col("ahead") + F.col("at")
    copies = F.floor(F.col("rate") * rank + F.col("offset")) - F.floor(F.col("rate") * (rank - 1) + F.col("offset"))
    out = placed(rows).withColumn("at", F.row_number().over(within)).join(parts, block).withColumn("copies", copies.cast("long"))
    return out.select(*[F.col(f"in_{i}").alias(c) for i, c in enumerate(docs.columns) if c != "size"], F.col("words").alias("size"), "source_size", "target", "copies", (F.col("copies") * F.col("words")).alias("taken"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document once for each copy, numbered from 1 in a new column, copy."""
    return plan(docs.drop("copy"), **options).where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
