"""Hourly partials folded into service-day facts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from punctual.functions.aggregates import first_known, last_known
from punctual.functions.timeline import clock_seconds, compact_day, label_instant, local_date, merge_window, partition_bounds, wall_instant
from punctual.operators.reducers import first_positions

RELIABLE_LEAD_S = 60
STOP_KEY = ["service_date", "trip_id", "stop_id", "stop_sequence"]
MILLENNIUM = "timestamp'2000-01-01 00:00:00'"


def read_partials(spark: SparkSession, path: str, day: date) -> DataFrame:
    """A table's partials around a service day; dt prunes folders. Older schemas read with nulls."""
    first, last = partition_bounds(day)
    return spark.read.option("mergeSchema", "true").parquet(path).where(F.col("dt").between(first, last))


def first_hours(stop_times: DataFrame) -> DataFrame:
    """(trip_id, first_hour): the hour of each trip's first timetabled time, 24 and more past midnight."""
    known = F.coalesce("departure_time", "arrival_time")
    first = first_known(known, F.col("stop_sequence"))
    return stop_times.groupBy("trip_id").agg(F.split_part(first, F.lit(":"), F.lit(1)).cast("int").alias("first_hour"))


def service_day_partials(partials: DataFrame, day: date, stop_times: DataFrame | None = None, feed_date: str = "service_date") -> DataFrame:
    """The partial rows of a service day: a trip timetabled past midnight is filed under the day before its feed date."""
    fed = F.to_date(feed_date, "yyyyMMdd")
    rows = partials.where(F.col(feed_date).isin(*[d.strftime("%Y%m%d") for d in (day, date.fromordinal(day.toordinal() + 1))]))
    if stop_times is None:
        filed = rows.withColumn("filed", fed)
    else:
        joined = rows.join(first_hours(stop_times), "trip_id", "left")
        filed = joined.withColumn("filed", F.when(F.col("first_hour") >= 24, F.date_sub(fed, 1)).otherwise(fed)).drop("first_hour")
    return filed.where(F.col("filed") == F.lit(day))


def partial_hour() -> Column:
    return F.concat_ws("T", F.col("dt"), F.lpad(F.col("hour").cast("string"), 2, "0"))


def merge_calls(partials: DataFrame) -> DataFrame:
    """One row for each call of the day: the newest partial, the counters of all, the newest arrival.

    Everything is one aggregation by key, so partial states combine before the
    shuffle. Rows without a stop sequence are left out.
    """
    hour = partial_hour()
    recency = F.struct(F.coalesce(F.unix_micros("last_update_at_utc"), F.lit(-(1 << 62))).alias("u"), F.coalesce(F.unix_micros("last_observed_at_utc"), F.lit(-(1 << 62))).alias("o"), hour.alias("h"))
    newest = ["route_id", "final_predicted_departure_utc", "departure_delay_s", "last_update_at_utc", "schedule_relationship"]
    arrived = F.when(F.col("arrival_updated_at_utc").isNotNull(), F.struct("arrival_updated_at_utc", "last_observed_at_utc", hour.alias("h")))
    rows = partials.where("stop_sequence is not null and trip_id is not null and stop_id is not null").withColumn("service_date", F.col("filed"))
    merged = rows.groupBy(*STOP_KEY).agg(
        F.max_by(F.struct(*newest), recency).alias("r"),
        F.max_by(F.struct("final_predicted_arrival_utc", "delay_s", "arrival_updated_at_utc"), arrived).alias("a"),
        F.sum("n_updates").cast("int").alias("n_updates"),
        F.bool_or("had_vehicle").alias("had_vehicle"),
        F.max("last_observed_at_utc").alias("seen"),
    )
    out = merged.select(*STOP_KEY, "r.*", "a.*", "n_updates", "had_vehicle", (F.col("r.last_update_at_utc").isNotNull() & F.coalesce(F.col("seen") > F.col("r.last_update_at_utc"), F.lit(False))).alias("lost_tracking"))
    fresh = F.col("arrival_updated_at_utc") >= F.col("final_predicted_arrival_utc") - F.expr(f"interval {RELIABLE_LEAD_S} seconds")
    reliable = F.col("delay_s").isNotNull() & ~F.col("lost_tracking") & (F.col("final_predicted_arrival_utc") >= F.expr(MILLENNIUM)) & fresh
    return out.withColumn("is_reliable", F.coalesce(reliable, F.lit(False)))


FACT_CALL = ["service_date", "trip_id", "stop_id", "stop_sequence", "route_id", "final_predicted_arrival_utc", "delay_s", "final_predicted_departure_utc", "departure_delay_s", "last_update_at_utc", "arrival_updated_at_utc", "n_updates", "schedule_relationship", "had_vehicle", "lost_tracking", "is_reliable", "scheduled_arrival_utc"]


def build_calls(partials: DataFrame, day: date, stop_times: DataFrame | None = None) -> DataFrame:
    """The day's call facts with the timetable's arrival, sorted so that row groups can be skipped."""
    merged = merge_calls(service_day_partials(partials, day, stop_times))
    if stop_times is None:
        timed = merged.withColumn("scheduled_arrival_utc", F.lit(None).cast("timestamp"))
    else:
        # By sequence, not stop: the feed may name another platform.
        times = stop_times.where("arrival_time is not null").groupBy("trip_id", "stop_sequence").agg(F.min(clock_seconds(F.col("arrival_time"))).alias("at"))
        timed = merged.join(times, ["trip_id", "stop_sequence"], "left").withColumn("scheduled_arrival_utc", wall_instant(F.col("service_date"), F.col("at")))
    return timed.select(*FACT_CALL).orderBy("route_id", "trip_id", "stop_sequence")


FACT_TRIP = ["service_date", "trip_id", "start_date", "start_time", "route_id", "final_status", "final_status_at_utc", "scheduled_polls", "canceled_polls", "added_polls", "first_seen_at_utc", "last_seen_at_utc", "first_canceled_at_utc", "last_canceled_at_utc", "had_vehicle"]


def build_trips(partials: DataFrame, day: date, stop_times: DataFrame | None = None) -> DataFrame:
    """The day's trip facts: summed polls, widened spans, the latest status."""
    rows = service_day_partials(partials, day, stop_times, "start_date").withColumn("service_date", F.col("filed"))
    seen, status = F.struct("last_seen_at_utc", partial_hour().alias("h")), F.struct("final_status_at_utc", partial_hour().alias("h"))
    known = F.col("final_status_at_utc").isNotNull() & F.col("final_status").isNotNull()
    merged = rows.groupBy("service_date", "trip_id", "start_date").agg(
        last_known(F.col("start_time"), seen).alias("start_time"),
        last_known(F.col("route_id"), seen).alias("route_id"),
        F.max_by("final_status", F.when(known, status)).alias("final_status"),
        F.max("final_status_at_utc").alias("final_status_at_utc"),
        *[F.sum(c).cast("int").alias(c) for c in ("scheduled_polls", "canceled_polls", "added_polls")],
        F.min("first_seen_at_utc").alias("first_seen_at_utc"),
        F.max("last_seen_at_utc").alias("last_seen_at_utc"),
        F.min("first_canceled_at_utc").alias("first_canceled_at_utc"),
        F.max("last_canceled_at_utc").alias("last_canceled_at_utc"),
        F.bool_or("had_vehicle").alias("had_vehicle"),
    )
    return merged.select(*FACT_TRIP).orderBy("route_id", "trip_id")


def build_positions(partials: DataFrame, day: date) -> DataFrame:
    """The day's positions, each sighting once, within the day's window."""
    start, end = merge_window(day)
    inside = (F.col("observed_at_utc") >= F.lit(start)) & (F.col("observed_at_utc") < F.lit(end))
    return first_positions(partials.drop("dt", "hour").where(inside)).orderBy("route_id", "observed_at_utc")


COLLECTOR_RUN = "feed string, fetched_at_utc string, received_at_utc string, rtt_s double, server_date_utc string, skew_s double, status_code int, body_bytes bigint, error string"


def collector_run(rows: DataFrame, day: date) -> DataFrame:
    """Audit rows of a local day, typed and in order."""
    instants = ("fetched_at_utc", "received_at_utc", "server_date_utc")
    typed = rows.select(*[F.col(c).cast("timestamp").alias(c) if c in instants else F.col(c) for c in [x.split()[0] for x in COLLECTOR_RUN.split(", ")]])
    return typed.where(local_date(F.col("fetched_at_utc")) == F.lit(day)).orderBy("fetched_at_utc", "feed")


def snapshot_for(labels: list[str], day: date) -> tuple[str | None, bool]:
    """The snapshot a day is merged with, and whether it was borrowed from after the day."""
    from datetime import datetime, timezone

    from punctual.functions.timeline import service_date

    when = {x: service_date(datetime.strptime(x, "%Y-%m-%dT%H%M%SZ").replace(tzinfo=timezone.utc)) for x in labels}
    fit = [x for x in sorted(labels) if when[x] <= day]
    return (fit[-1], False) if fit else (min(labels), True) if labels else (None, False)


def redated(rows: DataFrame, column: str = "valid_from") -> DataFrame:
    """Snapshot labels with their instants and local check dates."""
    return rows.withColumn("checked_at_utc", label_instant(F.col(column))).withColumn("check_date", local_date(F.col("checked_at_utc"))).withColumn("check_day", compact_day(F.col("check_date")))


def upsert(stored: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """The stored rows with the new ones in their place, last one winning."""
    both = stored.withColumn("_turn", F.lit(0)).unionByName(new.withColumn("_turn", F.lit(1)))
    w = Window.partitionBy(*key).orderBy(F.desc("_turn"))
    return both.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank", "_turn")
