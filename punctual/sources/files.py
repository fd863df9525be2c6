"""Reading tables and audit files, writing facts, dimensions and audits."""

from __future__ import annotations

import json
import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.session import ensure

#: Fixed layout: sort order within fact files.
FACT_ORDER = {"trip_stop": ["route_id", "trip_id", "stop_sequence"], "vehicle_position": ["route_id", "observed_at_utc"], "trip": ["route_id", "trip_id"]}
PARTITION_KEY = {"trip_stop": "service_date", "trip": "service_date", "vehicle_position": "service_date", "collector_run": "collection_date"}


def exists(spark: SparkSession, path: str) -> bool:
    """Does the path, or any file of a pattern, exist in its store?"""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def _folder(spark: SparkSession, path: str) -> tuple:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def count_files(spark: SparkSession, path: str) -> int:
    """How many files the folder holds, those of folders below it too; none if it isn't there."""
    p, store = _folder(spark, path)
    return store.getContentSummary(p).getFileCount() if store.exists(p) else 0


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds, if it is there."""
    p, store = _folder(spark, path)
    store.delete(p, True)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """All snapshots of a dimension with their label as text; columns are matched by name."""
    return ensure(spark).read.option("mergeSchema", "true").parquet(path)


def read_facts(spark: SparkSession, path: str) -> DataFrame:
    """Facts whose folders repeat a column of the file: folders are not read as columns."""
    return spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(path)


def read_paths(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    """Chosen folders of a partitioned table, with the folders' columns."""
    return ensure(spark).read.option("basePath", root).option("mergeSchema", "true").parquet(*paths)


def read_optional(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table, or an empty one of the schema where nothing was written yet."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def read_seed(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """Committed CSV seeds; a malformed value raises."""
    return spark.read.schema(schema).option("header", "true").option("mode", "FAILFAST").csv(paths)


CENTRES = "centre_id string, centre_name string, tier string, latitude double, longitude double, source string"
TIERS = ("metropolitan", "strategic", "regional")


def read_centres(spark: SparkSession, path: str, tiers: tuple[str, ...] | None = None) -> DataFrame:
    """Centres with checked tiers and coordinates."""
    rows = read_seed(spark, [path], CENTRES)
    bad = ~(F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180))
    if tiers:
        bad = bad | ~F.col("tier").isin(*tiers)
    return rows.withColumn("centre_id", F.when(F.coalesce(bad, F.lit(True)), F.raise_error(F.concat(F.lit("bad centre: "), F.col("centre_id")))).otherwise(F.col("centre_id")))


def read_audit(spark: SparkSession, root: str, days: list[date], schema: str) -> DataFrame:
    """JSON lines of the UTC days that exist."""
    paths = [p for p in (f"{root}/dt={d.isoformat()}" for d in days) if exists(spark, p)]
    return spark.read.schema(schema).json(paths) if paths else spark.createDataFrame([], schema)


def read_day(spark: SparkSession, merged: str, live: DataFrame) -> DataFrame:
    """The merged day if it was written, or else its live rows."""
    return spark.read.parquet(merged) if exists(spark, merged) else live


def write_fact(df: DataFrame, root: str, table: str, day: str) -> int:
    """Write a day's fact, sorted so that row groups can be skipped; the number of rows written."""
    from pyspark.sql import Observation

    seen = Observation()
    order = [c for c in FACT_ORDER.get(table, []) if c in df.columns]
    rows = df.observe(seen, F.count("*").alias("n"))
    (rows.sortWithinPartitions(*order) if order else rows).write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/fact_{table}/{PARTITION_KEY[table]}={day}")
    return seen.get["n"]


def write_snapshot(df: DataFrame, root: str, table: str, label: str) -> None:
    df.write.mode("errorifexists").option("compression", "snappy").parquet(f"{root}/dim_{table}/valid_from={label}")


def write_partial(df: DataFrame, root: str, table: str, hour: datetime) -> None:
    """An hour's partial; an empty one is a file with a schema."""
    df.write.mode("overwrite").option("compression", "snappy").parquet(f"{root}/_partial/{table}/dt={hour:%Y-%m-%d}/hour={hour:%H}")


def write_vintage(df: DataFrame, root: str, table: str, vintage: date) -> str:
    path = f"{root}/{table}/vintage={vintage.isoformat()}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return path


def append_audit(spark: SparkSession, root: str, day: date, record: dict) -> None:
    """One JSON object in a file of its own."""
    rows = spark.createDataFrame([(json.dumps(record, default=str),)], "value string")
    rows.coalesce(1).write.mode("append").text(f"{root}/dt={day.isoformat()}")


def write_csv(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


def raw_key(feed: str, at: datetime) -> str:
    return f"raw/{feed}/dt={at:%Y-%m-%d}/hour={at:%H}/{at:%H%M%S}.pb.gz"


def run_key(at: datetime, run: str | None = None) -> str:
    return f"curated/collector_run/dt={at:%Y-%m-%d}/{run or uuid.uuid4().hex}.jsonl"


def partial_key(table: str, hour: datetime) -> str:
    return f"curated/_partial/{table}/dt={hour:%Y-%m-%d}/hour={hour:%H}/data.parquet"


def pull_plan(remote: DataFrame, local: DataFrame) -> DataFrame:
    """(path, action): download what is new or differs in size or is newer, delete what vanished."""
    joined = remote.withColumnRenamed("size", "rs").withColumnRenamed("modified", "rm").join(local, "path", "full")
    action = F.when(F.col("rs").isNull(), "delete").when(F.col("size").isNull() | (F.col("rs") != F.col("size")) | (F.col("rm") > F.col("modified")), "download")
    return joined.withColumn("action", action).where("action is not null").select("path", "action")
