"""Structured Streaming twins of the hourly and daily steps.

Each gives the batch answer on the same input. Windows go by fetch time; what
comes later than the watermark is dropped, as a poll that lands after its hour
was compacted is.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: How long an hour stays open.
WAIT = "10 minutes"


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that all executors share; a folder of this machine only where Spark runs on it alone."""
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="punctual-")
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def to_end(df: DataFrame, mode: str = "append") -> DataFrame:
    """Run a stream over what is there now, into Parquet, and read the result."""
    spark, path = df.sparkSession, scratch(df.sparkSession)
    if mode == "append":
        writer = df.writeStream.format("parquet").outputMode(mode).option("path", f"{path}/out")
    else:
        writer = df.writeStream.outputMode(mode).foreachBatch(lambda rows, _: rows.write.mode("overwrite").parquet(f"{path}/out"))
    writer.option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{path}/out")


def source(spark: SparkSession, path: str) -> DataFrame:
    """A file stream over a table, whether it is one file or a folder of files."""
    schema = spark.read.parquet(path).schema
    folder, name = path.rstrip("/").rsplit("/", 1)
    reader = spark.readStream.schema(schema)
    files = spark.read.parquet(path).select(F.input_file_name().alias("f")).limit(1).collect()
    is_file = bool(files) and files[0].f.rstrip("/").endswith(f"/{name}")
    return reader.option("pathGlobFilter", name).parquet(folder) if is_file else reader.parquet(path)


def hourly_totals(spark: SparkSession, path: str) -> DataFrame:
    """Counts and sums by hour and type, from a stream over the events."""
    rows = source(spark, path).withColumn("ts", F.col("ts").cast("timestamp"))
    totals = rows.groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    out = to_end(totals, "complete")
    return out.select(F.date_format("window.start", "yyyy-MM-dd HH:mm").alias("hour"), "event_type", "n", "total")


def first_positions(stream: DataFrame, wait: str = WAIT) -> DataFrame:
    """The first sighting of each (vehicle, instant, place), state bounded by the watermark."""
    return stream.withWatermark("fetched_at_utc", wait).dropDuplicatesWithinWatermark(["vehicle_id", "observed_at_utc", "lat", "lon"])


def hourly_partials(stream: DataFrame, wait: str = WAIT) -> DataFrame:
    """Partials of the call reducer by fetch hour, final once the watermark has passed the hour.

    One aggregate holds the state of a call: counters, and the largest
    (time, poll) structs, so the order within a micro-batch can't matter.
    """
    keys = ["start_date", "trip_id", "stop_id", "stop_sequence"]
    real = F.col("relationship").isin("SCHEDULED", "SKIPPED")
    order = F.struct("seen_at", "poll")
    rows = stream.withWatermark("fetched_at_utc", wait)
    out = rows.groupBy(F.window("fetched_at_utc", "1 hour"), *keys).agg(
        F.count(F.when(real, 1)).cast("int").alias("n_updates"),
        F.max_by("departure_at", F.when(real, order)).alias("final_predicted_departure_utc"),
        F.max_by("relationship", F.when(real, order)).alias("schedule_relationship"),
        F.max(F.when(real, F.col("seen_at"))).alias("last_update_at_utc"),
        F.max("seen_at").alias("last_observed_at_utc"),
    )
    return out.select(F.col("window.start").alias("hour"), *keys, "n_updates", "final_predicted_departure_utc", "schedule_relationship", "last_update_at_utc", "last_observed_at_utc")


def merge_days(partials: DataFrame, merge, path: str, checkpoint: str):
    """Rewrite the service days that a micro-batch touches; running one twice changes nothing.

    ``merge(spark, batch)`` gives the merged rows, with service_date.
    """

    def write(batch: DataFrame, _: int) -> None:
        merge(batch.sparkSession, batch).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("service_date").parquet(path)

    return partials.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
