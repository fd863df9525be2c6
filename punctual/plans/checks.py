"""Checks of merged days, and summaries of what the pipeline did."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.functions.aggregates import count_where, ratio
from punctual.functions.timeline import day_hours, elapsed, expected_hours, hours_in_day

HALF_DAY_S = 12 * 3600
MILLENNIUM = "timestamp'2000-01-01 00:00:00'"
#: Fixed limits: measures that must be zero, the largest unscheduled share, the least reliable share and trips.
ZERO = ("times_far_from_schedule", "times_before_2000", "duplicate_stop_keys", "duplicate_trip_keys", "inconsistent_trips")
MOST_UNSCHEDULED, LEAST_RELIABLE, LEAST_TRIPS = 0.03, 0.80, 15_000
#: Polls that each feed owes a minute.
PER_MINUTE = {"vehiclepos": 6, "tripupdates": 1}
CRASH = "crashed"
WORST, EXAMPLES = 10, 5
SUMMED = ("objects_expected", "objects_read", "rows_in", "rows_out", "dupes_collapsed", "dupes_differing_position", "unjoined_route_ids", "unjoined_trip_ids", "unjoined_stop_ids")


def day_checks(calls: DataFrame, trips: DataFrame) -> DataFrame:
    """One row of eight measures of a merged day."""
    c = F.col
    arrival, departure, planned = c("final_predicted_arrival_utc"), c("final_predicted_departure_utc"), c("scheduled_arrival_utc")
    early = lambda t: F.coalesce(t < F.expr(MILLENNIUM), F.lit(False))
    far = lambda t: F.coalesce(~early(t) & (F.abs(elapsed(t, planned)) > HALF_DAY_S), F.lit(False))
    named, scheduled = F.coalesce(c("trip_id"), F.lit("")) != "", c("schedule_relationship") == "SCHEDULED"
    # Counts by key first: duplicates and measures from one pass.
    by_key = calls.groupBy("trip_id", "stop_id", "stop_sequence").agg(
        F.count("*").alias("n"), count_where(far(arrival) | far(departure)).alias("far"), count_where(early(arrival) | early(departure)).alias("early"),
        count_where(named).alias("named"), count_where(named & planned.isNull()).alias("unscheduled"), count_where(scheduled).alias("scheduled"), count_where(scheduled & c("is_reliable")).alias("reliable"),
    )
    sums = by_key.agg(*[F.sum(x).alias(x) for x in ("far", "early", "named", "unscheduled", "scheduled", "reliable")], count_where((c("n") > 1) & named).alias("duplicates"))
    polled = F.coalesce(c("canceled_polls"), F.lit(0)) > 0
    started = F.to_date("start_date", "yyyyMMdd")
    wrong = [
        (c("final_status") == "CANCELED") & ~polled,
        polled & c("first_canceled_at_utc").isNull(),
        c("first_canceled_at_utc") > c("last_canceled_at_utc"),
        c("first_seen_at_utc") > c("last_seen_at_utc"),
        ~((c("service_date") == started) | (c("service_date") == F.date_sub(started, 1))),
    ]
    any_wrong = F.lit(False)
    for w in wrong:
        any_wrong = any_wrong | F.coalesce(w, F.lit(False))
    per_trip = trips.groupBy("trip_id").agg(F.count("*").alias("n"), count_where(any_wrong).alias("bad"))
    trip_sums = per_trip.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("trips"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    share = lambda a, b: F.coalesce(ratio(c(a), c(b)), F.lit(0.0))
    zero = lambda x: F.coalesce(c(x), F.lit(0))
    return sums.crossJoin(trip_sums).select(
        zero("far").alias("times_far_from_schedule"), zero("early").alias("times_before_2000"), zero("duplicates").alias("duplicate_stop_keys"), c("surplus").alias("duplicate_trip_keys"), c("bad").alias("inconsistent_trips"),
        share("unscheduled", "named").alias("unscheduled_share"), share("reliable", "scheduled").alias("reliable_share"), "trips",
    )


def breaches(checks: DataFrame) -> DataFrame:
    """(name, value, limit) of each check that failed."""
    rules = [(n, F.col(n) > 0, 0.0) for n in ZERO] + [("unscheduled_share", F.col("unscheduled_share") > MOST_UNSCHEDULED, MOST_UNSCHEDULED), ("reliable_share", F.col("reliable_share") < LEAST_RELIABLE, LEAST_RELIABLE), ("trips", F.col("trips") < LEAST_TRIPS, float(LEAST_TRIPS))]
    rows = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).cast("double").alias("value"), F.lit(limit).alias("limit"), failed.alias("failed")) for n, failed, limit in rules])
    return checks.select(F.explode(rows).alias("r")).where("r.failed").select("r.name", "r.value", "r.limit")


def breach_metric(checks: DataFrame) -> DataFrame:
    """How many checks the day failed; zero counts too."""
    return checks.join(breaches(checks), F.lit(True), "left").agg(F.count("name").alias("anomalies"))


def failure_category() -> Column:
    error, status = F.col("error"), F.col("status_code")
    return F.when(error == CRASH, "crashed").when(error.isNotNull() & status.isNull(), "transport_error").when(status != 200, "non_200").when(F.col("server_date_utc").isNull(), "null_server_date").otherwise("ok")


def collection_window(rows: DataFrame) -> DataFrame:
    """start, end and whole minutes of the observed span; one row, null without rows."""
    t = F.col("fetched_at_utc")
    return rows.agg(F.min(t).alias("start"), F.max(t).alias("end")).withColumn("minutes", (F.floor(elapsed(F.col("end"), F.col("start")) / 60) + 1).cast("int"))


def feed_counts(rows: DataFrame) -> DataFrame:
    """(feed, actual, expected) over the observed minutes; a whole day's without rows."""
    owed = rows.sparkSession.createDataFrame(list(PER_MINUTE.items()), "feed string, per_minute int")
    actual = rows.groupBy("feed").agg(F.count("*").alias("actual"))
    minutes = collection_window(rows).select(F.coalesce("minutes", F.lit(1440)).alias("minutes"))
    return owed.join(actual, "feed", "left").crossJoin(F.broadcast(minutes)).select("feed", F.coalesce("actual", F.lit(0)).alias("actual"), (F.col("minutes") * F.col("per_minute")).cast("long").alias("expected"))


def status_counts(rows: DataFrame) -> DataFrame:
    """(feed, status, n): crashes and transport errors by name, the rest by status code."""
    category = failure_category()
    key = F.when(category.isin("crashed", "transport_error"), category).otherwise(F.coalesce(F.col("status_code").cast("string"), F.lit("None")))
    return rows.groupBy("feed", key.alias("status")).agg(F.count("*").alias("n"))


def failure_summary(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Counts by category, and the first few failures."""
    marked = rows.withColumn("category", failure_category())
    return marked.groupBy("category").agg(F.count("*").alias("n")), marked.where("category <> 'ok'").orderBy("fetched_at_utc", "feed").limit(EXAMPLES)


def timing_stats(rows: DataFrame) -> DataFrame:
    """Least, median and largest round trip and skew; bytes by feed are ``payload_stats``."""
    three = lambda x: [F.min(x).alias(f"{x}_min"), F.median(x).alias(f"{x}_median"), F.max(x).alias(f"{x}_max")]
    return rows.agg(*three("rtt_s"), *three("skew_s"))


def payload_stats(rows: DataFrame) -> DataFrame:
    return rows.groupBy("feed").agg(F.min("body_bytes").alias("minimum"), F.median("body_bytes").alias("median"), F.max("body_bytes").alias("maximum"))


def coverage_gaps(rows: DataFrame, boundary: DataFrame | None = None) -> DataFrame:
    """(minute, count) of the observed minutes with too few error-free position polls.

    Rows of a neighbouring partition fill counts but never widen the span.
    """
    every = rows if boundary is None else rows.unionByName(boundary)
    label = lambda t: F.date_format(t, "HH:mm")
    polls = every.where("feed = 'vehiclepos' and error is null").groupBy(label("fetched_at_utc").alias("minute")).agg(F.count("*").alias("count"))
    span = collection_window(rows).where("start is not null")
    first = F.date_trunc("minute", "start")
    minutes = span.select(F.explode(F.transform(F.sequence(F.lit(0), F.col("minutes") - 1), lambda i: label(first + F.make_dt_interval(F.lit(0), F.lit(0), i, F.lit(0))))).alias("minute"), F.lit(1).alias("one")).withColumn("at", F.monotonically_increasing_id())
    out = minutes.join(polls, "minute", "left").select("minute", F.coalesce("count", F.lit(0)).alias("count"), "at")
    return out.where(F.col("count") < PER_MINUTE["vehiclepos"]).select("minute", "count", "at")


def worst_gaps(gaps: DataFrame, limit: int = WORST) -> DataFrame:
    """The minutes with the fewest polls, earliest first among equals."""
    return gaps.orderBy("count", "at").limit(limit).select("minute", "count")


def summarize_job(records: DataFrame, expected: list[str]) -> DataFrame:
    """One row: partitions owed and seen, those missing, summed counters, peak memory and errors."""
    owed = records.sparkSession.createDataFrame([(p, i) for i, p in enumerate(expected)], "partition string, at int")
    joined = owed.join(records, "partition", "left").withColumn("seen", F.col("job").isNotNull())
    by = joined.groupBy("partition", "at").agg(F.bool_or("seen").alias("seen"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SUMMED], F.max("peak_rss_mb").alias("peak_rss_mb"), count_where(F.coalesce("error", F.lit("")) != "").alias("errors"))
    missing = F.transform(F.array_sort(F.collect_list(F.when(~F.col("seen"), F.struct("at", "partition")))), lambda x: x["partition"])
    return by.agg(F.count("*").alias("runs_expected"), count_where(F.col("seen")).alias("runs_seen"), missing.alias("missing_partitions"), *[F.sum(c).alias(c) for c in SUMMED], F.coalesce(F.max("peak_rss_mb"), F.lit(0)).alias("peak_rss_mb"), F.sum("errors").alias("errors"))


def summarize_curation(records: DataFrame, day: date, checks: DataFrame) -> dict[str, DataFrame | int]:
    """The jobs' days and the schedule's check."""
    hours = [f"{h:%Y-%m-%dT%H}" for h in day_hours(day)]
    jobs = {"compactor": hours, "merger": [day.isoformat()]}
    out: dict[str, DataFrame | int] = {job: summarize_job(records.where(F.col("job") == job), owed) for job, owed in jobs.items()}
    out["schedule"] = checks.agg(F.lit(1).alias("checks_expected"), F.count("*").alias("checks_seen"), F.coalesce(F.bool_or("changed"), F.lit(False)).alias("changed"))
    out["hours_in_day"] = hours_in_day(day)
    return out


TABLES = ("vehicle_position", "trip_stop", "trip")


def partial_coverage(day: date, present: DataFrame) -> dict[str, int | bool]:
    """Partials owed and there for a service day; ``present`` has table, dt and hour. Refuses a day without any."""
    hours = [(t, f"{h:%Y-%m-%d}", f"{h:%H}") for h in expected_hours(day) for t in TABLES]
    owed = present.sparkSession.createDataFrame(hours, "table string, dt string, hour string")
    read = owed.join(present, ["table", "dt", "hour"], "left_semi").count()
    if not read:
        raise ValueError(f"no partials for {day}")
    return {"objects_expected": len(hours), "objects_read": read, "short": read < len(hours)}
