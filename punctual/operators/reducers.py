"""Last-known state of calls, trips and vehicles from overlapping polls, as aggregations.

A poll is one row per entity: fetched_at_utc, n (the entity's place in the poll)
and the decoded fields. Order within a key is (fetched_at_utc, n). What a
record-at-a-time reducer keeps in a dictionary is here the largest struct of an
aggregate, so partial states combine before the shuffle. One thing can't be read
off a largest struct, the arrival of a call whose newest update has none; those
calls alone are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctual.functions.timeline import ZONE

#: Fixed values of the feed.
REAL = ("SCHEDULED", "SKIPPED")
DAY_AHEAD_S = 12 * 3600
STATUS_RANK = {"CANCELED": 3, "SCHEDULED": 2, "ADDED": 1}

STOP_KEY = ["service_date", "trip_id", "stop_id", "stop_sequence"]
STOP = "stop_id string, stop_sequence int, relationship string, arrival struct<time:bigint, delay:int>, departure struct<time:bigint, delay:int>"
UPDATES = f"fetched_at_utc timestamp, n int, trip_id string, route_id string, start_date string, start_time string, trip_relationship string, has_vehicle boolean, stamp bigint, stops array<struct<{STOP.replace(' string', ':string').replace(' int', ':int').replace('arrival struct', 'arrival:struct').replace('departure struct', 'departure:struct')}>>"


def instant(epoch: Column) -> Column:
    """A zero or absent time is unknown."""
    return F.timestamp_seconds(F.nullif(epoch, F.lit(0)))


def seen_at() -> Column:
    """The update's own time, or the poll's."""
    return F.coalesce(instant(F.col("stamp")), F.col("fetched_at_utc"))


def day_ahead() -> Column:
    """Does the update carry a time half a day or more past its trip's start? No if the start is unknown."""
    text = F.concat_ws(" ", "start_date", "start_time")
    start = F.when(text.rlike(r"^\d{8} \d{1,2}:\d{1,2}:\d{1,2}$"), F.unix_timestamp(F.to_utc_timestamp(F.try_to_timestamp(text, F.lit("yyyyMMdd H:m:s")), ZONE)))
    late = lambda e: F.coalesce(F.nullif(e["time"], F.lit(0)) - start >= DAY_AHEAD_S, F.lit(False))
    return F.coalesce(F.exists("stops", lambda s: late(s["arrival"]) | late(s["departure"])), F.lit(False))


def reduce_calls(updates: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row for each call (and each value of ``by``, such as the hour), as its last real update left it.

    NO_DATA never overwrites; a real update older than the last one counts and
    changes nothing; one without an arrival keeps the earlier arrival; of equal
    times the later poll wins.
    """
    extra = by or []
    rows = updates.where(~day_ahead()).withColumn("seen_at", seen_at()).select(*extra, "fetched_at_utc", "n", "seen_at", F.col("start_date").alias("service_date"), "trip_id", "route_id", "has_vehicle", F.posexplode("stops").alias("i", "s"))
    event = lambda name: F.struct(instant(F.col(f"s.{name}.time")).alias("at"), F.when(F.coalesce(F.col(f"s.{name}.time"), F.lit(0)) != 0, F.col(f"s.{name}.delay")).alias("delay"))
    rows = rows.select("*", "s.stop_id", "s.stop_sequence", "s.relationship", event("arrival").alias("arrival"), event("departure").alias("departure"), F.struct("fetched_at_utc", "n", "i").alias("turn")).withColumn("real", F.col("relationship").isin(*REAL))
    timed = F.col("real") & (F.col("arrival.at").isNotNull() | F.col("arrival.delay").isNotNull())
    rows = rows.drop("s").withColumn("timed", timed)
    key = [*extra, *STOP_KEY]
    # An update counts if none before it was newer: the last that counts is the newest, of equals the latest.
    newest = lambda on: F.when(on, F.struct("seen_at", "turn"))
    state = rows.groupBy(*key).agg(
        F.min_by("route_id", "turn").alias("route_id"),
        F.max_by(F.struct("arrival", "seen_at"), newest(F.col("timed"))).alias("a"),
        F.max_by("departure", newest(F.col("real"))).alias("d"),
        F.max(F.when(F.col("real"), F.col("seen_at"))).alias("last_update_at_utc"),
        F.count(F.when(F.col("real"), 1)).cast("int").alias("n_updates"),
        F.coalesce(F.max_by("relationship", newest(F.col("real"))), F.max_by("relationship", "turn")).alias("schedule_relationship"),
        F.bool_or("has_vehicle").alias("had_vehicle"),
        F.max("seen_at").alias("last_observed_at_utc"),
    )
    # Newer updates without an arrival may have come before the newest arrival: such calls go through in order.
    open_ = F.col("a.seen_at") < F.col("last_update_at_utc")
    doubtful = state.where(open_).select(*[F.col(k).alias(f"_{k}") for k in key])
    same = lambda t: [F.col(k).eqNullSafe(F.col(f"{t}{k}")) for k in key]
    w = Window.partitionBy(*key).orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    last = F.max(F.when(F.col("real"), F.col("seen_at"))).over(w)
    ordered = rows.select(*key, "turn", "seen_at", "real", "timed", "arrival").join(doubtful, same("_"), "left_semi").withColumn("last", last)
    counted = ordered.where(F.col("timed") & F.coalesce(F.col("seen_at") >= F.col("last"), F.lit(True)))
    exact = counted.groupBy(*key).agg(F.max_by(F.struct("arrival", "seen_at"), "turn").alias("exact")).select(*[F.col(k).alias(f"_{k}") for k in key], "exact")
    out = state.join(exact, same("_"), "left").withColumn("a", F.when(open_, F.col("exact")).otherwise(F.col("a")))
    lost = F.coalesce(F.col("last_observed_at_utc") > F.col("last_update_at_utc"), F.lit(False))
    return out.select(*key, "route_id", F.col("a.arrival.at").alias("final_predicted_arrival_utc"), F.col("a.arrival.delay").alias("delay_s"), F.col("d.at").alias("final_predicted_departure_utc"), F.col("d.delay").alias("departure_delay_s"), "last_update_at_utc", F.col("a.seen_at").alias("arrival_updated_at_utc"), "n_updates", "schedule_relationship", "had_vehicle", lost.alias("lost_tracking"), "last_observed_at_utc")


def reduce_trips(updates: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row for each trip: when seen, its last status, polls by status and the span of cancellation.

    Within a poll CANCELED outranks SCHEDULED, ADDED and the rest; a status is
    counted once a poll. Updates without a trip are left out.
    """
    key = [*(by or []), "start_date", "trip_id"]
    rank = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in STATUS_RANK.items() for x in kv]), F.col("trip_relationship")), F.lit(0))
    rows = updates.where(F.coalesce("trip_id", F.lit("")) != "").withColumn("turn", F.struct("fetched_at_utc", "n")).withColumn("weight", F.struct("fetched_at_utc", rank.alias("rank"), "n"))
    at, status = F.col("fetched_at_utc"), lambda s: F.col("trip_relationship") == s
    polls = lambda s: F.countDistinct(F.when(status(s), at)).cast("int")
    return rows.groupBy(*key).agg(
        F.max_by("route_id", "turn").alias("route_id"),
        F.max_by("start_time", "turn").alias("start_time"),
        F.max_by("trip_relationship", "weight").alias("final_status"),
        F.max(at).alias("final_status_at_utc"),
        polls("SCHEDULED").alias("scheduled_polls"),
        polls("CANCELED").alias("canceled_polls"),
        polls("ADDED").alias("added_polls"),
        F.min(at).alias("first_seen_at_utc"),
        F.max(at).alias("last_seen_at_utc"),
        F.min(F.when(status("CANCELED"), at)).alias("first_canceled_at_utc"),
        F.max(F.when(status("CANCELED"), at)).alias("last_canceled_at_utc"),
        F.bool_or("has_vehicle").alias("had_vehicle"),
    )


POSITION_KEY = ["vehicle_id", "observed_at_utc", "lat", "lon"]


def first_positions(positions: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The first sighting of each vehicle at an instant and place (and each value of ``by``, such as the hour)."""
    key = [*(by or []), *POSITION_KEY]
    rest = [c for c in positions.columns if c not in key]
    first = ["fetched_at_utc", *[c for c in rest if c != "fetched_at_utc"]]
    picked = positions.groupBy(*key).agg(F.min(F.struct(*first)).alias("r"))
    return picked.select(*[F.col(c) if c in key else F.col(f"r.{c}").alias(c) for c in positions.columns])


def position_conflicts(positions: DataFrame, by: list[str] | None = None) -> DataFrame:
    """How many sightings put a vehicle in a second place at one instant; for each value of ``by``, if given."""
    extra = by or []
    places = positions.groupBy(*extra, "vehicle_id", "observed_at_utc").agg(F.countDistinct("lat", "lon").alias("n"))
    return places.groupBy(*extra).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("dupes_differing_position"))


def position_facts() -> list[Column]:
    """Age of a sighting, and whether it lies at the origin."""
    age = (F.unix_micros("fetched_at_utc") - F.unix_micros("observed_at_utc")) / 1e6
    return [age.alias("position_age_s"), ((F.col("lat") == 0) & (F.col("lon") == 0)).alias("null_island")]
