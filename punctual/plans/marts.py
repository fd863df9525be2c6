"""The views over the curated tables, lazy DataFrames one upon another.

``Marts(tables)`` takes the inputs by name and gives each view as an attribute.
Nothing runs until a view is used. ``call_observation`` feeds three other views;
``freeze`` writes it, or any other view, once and reads it from then on.
"""

from __future__ import annotations

import json
from datetime import date
from functools import cached_property
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from punctual.functions.aggregates import count_where, excess_wait, last_known, ratio, sum_where
from punctual.functions.geo import haversine
from punctual.functions.timeline import clock_seconds, compact_day, elapsed, label_instant, local_date, rounded, seconds, service_hour, trip_instant
from punctual.operators.relational import current_vintage, expand_days, flagged_by, known_unpivot, latest_per_key, newest, weighted_quantiles
from punctual.session import ensure
from punctual.sources import files

#: Fixed layout of a pulled copy: snapshots keep their label from the path, facts and vintages have theirs in the files.
SNAPSHOTS = ("dim_route", "dim_trip", "dim_stop", "dim_calendar", "dim_calendar_dates", "dim_scheduled_stop_time")
FACTS, REFERENCE = ("fact_trip", "fact_trip_stop"), ("stop_geography", "stop_meshblock")
EXTRAS = {"dim_agency_all": "curated/dim_agency", "fact_collector_run": "curated/fact_collector_run"}
SEED = "start_date date, end_date date, exclusion_type string, reason string, source string"

#: Fixed values of the domain.
FIRST_DAY = date(2026, 9, 17)
BUS, SCHOOL_BUS, EXCLUDED_AGENCIES = "700", "712", ("7083", "7084")
USABLE_S, FRESH_S, TAIL_S = 21_600, 60, 600
EARLY_S, LATE_S = -59, 359
BANDS = ((600, "<=10"), (900, "10-15"), (1200, "15-20"), (1800, "20-30"))
CLOCKFACE = (15, 20, 30, 60)
MOVED_M = 25
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")

CELL = ["service_date", "stop_id", "route_id", "direction_id", "service_hour"]
MEASURES = ["irsd_score", "walk_population_800m", "distance_to_nearest_centre_m"]


class Marts:
    def __init__(self, tables: dict[str, DataFrame]) -> None:
        self.tables = tables
        self.spark = next(iter(tables.values())).sparkSession
        self.source: dict | None = None

    @classmethod
    def over(cls, spark: SparkSession, root: str, seeds: list[str]) -> Marts:
        """The views over a pulled copy, ``root`` holding curated/ and reference/; a required table that isn't there raises."""
        ensure(spark)
        folders = {**{f"{n}_all": f"curated/{n}" for n in SNAPSHOTS}, **{n: f"curated/{n}" for n in FACTS}, **{f"{n}_all": f"reference/{n}" for n in REFERENCE}}
        missing = [f for f in folders.values() if not files.exists(spark, f"{root}/{f}")]
        if missing:
            raise FileNotFoundError(f"not in {root}: {', '.join(missing)}")
        extra = {n: f for n, f in EXTRAS.items() if files.exists(spark, f"{root}/{f}")}
        labelled = lambda n: n in extra or n.removesuffix("_all") in SNAPSHOTS
        tables = {n: (files.read_snapshots if labelled(n) else files.read_facts)(spark, f"{root}/{f}") for n, f in (folders | extra).items()}
        tables["calendar_exclusion_seed"] = files.read_seed(spark, seeds, SEED)
        out = cls(tables)
        out.source = {"root": root, "seeds": seeds}
        return out

    def write_catalogue(self, path: str) -> None:
        """A file that names the copy and each view with its columns, in place of any before it; ``open_catalogue`` reads it."""
        if self.source is None:
            raise ValueError("only views over a pulled copy can be catalogued")
        views = {v: ", ".join(f"{c} {t}" for c, t in getattr(self, v).dtypes) for v in view_names()}
        Path(path).write_text(json.dumps({**self.source, "views": views}, indent=1))

    @classmethod
    def open_catalogue(cls, spark: SparkSession, path: str) -> Marts:
        """The catalogue's views and tables by name in this session, lazy as ever."""
        kept = json.loads(Path(path).read_text())
        out = cls.over(spark, kept["root"], kept["seeds"])
        out.register(*kept["views"])
        for name, df in out.tables.items():
            df.createOrReplaceTempView(name)
        return out

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def freeze(self, view: str, path: str) -> DataFrame:
        """Write a view and put the written table in its place."""
        getattr(self, view).write.mode("overwrite").parquet(path)
        self.__dict__[view] = self.spark.read.parquet(path)
        return self.__dict__[view]

    def register(self, *views: str) -> None:
        """Views by name for SQL; all of them without names."""
        for view in views or view_names():
            getattr(self, view).createOrReplaceTempView(view)

    @cached_property
    def calendar_exclusion(self) -> DataFrame:
        return expand_days(self["calendar_exclusion_seed"], "start_date", "end_date").select("day", "exclusion_type", "reason")

    @cached_property
    def term_weekday(self) -> DataFrame:
        excluded = self.calendar_exclusion.select("day").distinct()
        span = excluded.agg(F.min("day").alias("first"), F.max("day").alias("last")).where("first is not null")
        weekdays = expand_days(span, "first", "last").where(F.weekday("day") < 5).select("day")
        return weekdays.join(excluded, "day", "left_anti")

    @cached_property
    def dim_route(self) -> DataFrame:
        return newest(self["dim_route_all"], ["route_id"], "valid_from")

    @cached_property
    def dim_trip(self) -> DataFrame:
        return newest(self["dim_trip_all"], ["trip_id"], "valid_from")

    @cached_property
    def dim_stop(self) -> DataFrame:
        return newest(self["dim_stop_all"], ["stop_id"], "valid_from")

    @cached_property
    def school_route(self) -> DataFrame:
        return self.dim_route.where(F.col("route_type") == SCHOOL_BUS).select("route_id", "route_short_name", "route_long_name")

    @cached_property
    def school_trip(self) -> DataFrame:
        return self.dim_trip.join(self.school_route, "route_id", "left_semi").select("trip_id")

    @cached_property
    def ordinary_route(self) -> DataFrame:
        kept = (F.col("route_type") == BUS) & ~F.col("agency_id").isin(*EXCLUDED_AGENCIES)
        return self.dim_route.where(kept).select("route_id", "agency_id", "route_short_name", "route_long_name")

    @cached_property
    def period(self) -> DataFrame:
        h = F.col("service_hour")
        name = F.when(h.between(6, 8), "am_peak").when(h.between(9, 14), "inter_peak").when(h.between(15, 17), "pm_peak").when(h.between(18, 21), "evening").otherwise("night")
        return self.spark.range(48).select(F.col("id").cast("int").alias("service_hour")).withColumn("period", name)

    @cached_property
    def snapshot(self) -> DataFrame:
        labels = self["dim_scheduled_stop_time_all"].select("valid_from").distinct()
        checked = labels.withColumn("checked_at_utc", label_instant(F.col("valid_from"))).withColumn("check_date", local_date(F.col("checked_at_utc")))
        return flagged_by(checked, self["dim_trip_all"], ["valid_from"], "has_trips").select("valid_from", "checked_at_utc", "check_date", "has_trips")

    @cached_property
    def service_day(self) -> DataFrame:
        days = self["fact_trip"].select("service_date").distinct().where(F.col("service_date") >= F.lit(FIRST_DAY))
        # Days and snapshots: both a handful of rows a day.
        pairs = days.join(F.broadcast(self.snapshot), how="cross")
        known, trips = F.col("check_date") <= F.col("service_date"), F.col("has_trips")
        label = F.col("valid_from")
        chosen = pairs.groupBy("service_date").agg(
            F.coalesce(F.max(F.when(known, label)), F.min(label)).alias("stop_time_valid_from"),
            F.coalesce(F.max(F.when(known & trips, label)), F.min(F.when(trips, label))).alias("trip_valid_from"),
            (count_where(known) == 0).alias("timetable_borrowed"),
        )
        holidays = self.calendar_exclusion.where("exclusion_type = 'public_holiday'").select(F.col("day").alias("service_date"))
        terms = self.term_weekday.select(F.col("day").alias("service_date"))
        marked = flagged_by(flagged_by(chosen, holidays, ["service_date"], "is_holiday"), terms, ["service_date"], "is_term")
        of_week = F.weekday("service_date")
        day_type = F.when(F.col("is_holiday"), "public_holiday").when(of_week == 5, "saturday").when(of_week == 6, "sunday").when(F.col("is_term"), "term_weekday").otherwise("holiday_weekday")
        return marked.withColumn("day_type", day_type).drop("is_holiday", "is_term")

    @cached_property
    def active_service(self) -> DataFrame:
        days = self.service_day.select("service_date", F.col("trip_valid_from").alias("valid_from"), compact_day(F.col("service_date")).alias("day"))
        out = ["service_date", "valid_from", "service_id"]
        flags = F.array(*[F.col(c) for c in WEEKDAYS])
        weekly = days.join(self["dim_calendar_all"], "valid_from").where((F.col("start_date") <= F.col("day")) & (F.col("day") <= F.col("end_date")) & (flags[F.weekday("service_date")] == "1"))
        dated = days.join(self["dim_calendar_dates_all"].withColumnRenamed("date", "day"), ["valid_from", "day"])
        added, removed = (dated.where(F.col("exception_type") == x).select(*out) for x in ("1", "2"))
        return weekly.select(*out).union(added).distinct().subtract(removed)

    @cached_property
    def scheduled_trip(self) -> DataFrame:
        timetabled = self.active_service.join(self["dim_trip_all"].select("valid_from", "service_id", "trip_id"), ["valid_from", "service_id"]).select("service_date", "trip_id").distinct()
        timed = self["dim_scheduled_stop_time_all"].select(F.col("valid_from").alias("stop_time_valid_from"), "trip_id")
        seen = self["fact_trip"].select("service_date", "trip_id").join(self.service_day.select("service_date", "stop_time_valid_from"), "service_date")
        reported = seen.join(timed, ["stop_time_valid_from", "trip_id"], "left_semi").select("service_date", "trip_id")
        # One pass instead of a union and a second look-up: a trip is timetabled if any of its rows is.
        both = timetabled.withColumn("t", F.lit(True)).union(reported.withColumn("t", F.lit(False)))
        spine = both.groupBy("service_date", "trip_id").agg(F.bool_or("t").alias("is_timetabled"))
        return spine.join(self.dim_trip.select("trip_id", "route_id", "direction_id"), "trip_id").select("service_date", "trip_id", "route_id", "direction_id", "is_timetabled")

    @cached_property
    def scheduled_call(self) -> DataFrame:
        times = self["dim_scheduled_stop_time_all"].withColumnRenamed("valid_from", "stop_time_valid_from")
        days = self.service_day.select("service_date", "stop_time_valid_from")
        calls = self.scheduled_trip.join(days, "service_date").join(times, ["stop_time_valid_from", "trip_id"])
        calls = calls.withColumn("arrival_s", clock_seconds(F.col("arrival_time"))).withColumn("departure_s", clock_seconds(F.col("departure_time")))
        w = Window.partitionBy("service_date", "trip_id")
        day, first = F.col("service_date"), F.col("trip_start_s")
        return (
            calls.withColumn("trip_start_s", F.min_by("departure_s", "stop_sequence").over(w))
            .withColumn("is_first_stop", F.col("stop_sequence") == F.min("stop_sequence").over(w))
            .withColumn("is_last_stop", F.col("stop_sequence") == F.max("stop_sequence").over(w))
            .withColumn("is_boarding", ~F.col("is_last_stop") & ~F.col("pickup_type").eqNullSafe("1"))
            .withColumn("scheduled_arrival_utc", trip_instant(day, first, F.col("arrival_s")))
            .withColumn("scheduled_departure_utc", trip_instant(day, first, F.col("departure_s")))
            .withColumn("service_hour", service_hour(F.when(F.col("is_boarding"), F.col("departure_s")).otherwise(F.col("arrival_s"))))
            .select("service_date", "trip_id", "route_id", "direction_id", "is_timetabled", "stop_sequence", "stop_id", "timepoint", "pickup_type", "arrival_s", "departure_s", "trip_start_s", "is_first_stop", "is_last_stop", "is_boarding", "scheduled_arrival_utc", "scheduled_departure_utc", "service_hour")
        )

    @cached_property
    def call_observation(self) -> DataFrame:
        trips = self["fact_trip"].select("service_date", "trip_id", "final_status", F.col("first_canceled_at_utc"))
        kept = ["final_predicted_arrival_utc", "final_predicted_departure_utc", "schedule_relationship", "is_reliable", "lost_tracking", "last_update_at_utc"]
        facts = self["fact_trip_stop"].select("service_date", "trip_id", "stop_sequence", F.col("stop_id").alias("seen_stop_id"), F.lit(True).alias("present"), *kept)
        joined = self.scheduled_call.join(trips, ["service_date", "trip_id"], "left").join(facts, ["service_date", "trip_id", "stop_sequence"], "left")
        same = F.col("seen_stop_id") == F.col("stop_id")
        one = latest_per_key(joined, ["service_date", "trip_id", "stop_sequence"], same.desc_nulls_last(), F.col("seen_stop_id").asc_nulls_last())
        boarding = F.col("is_boarding")
        scheduled = F.when(boarding, F.col("scheduled_departure_utc")).otherwise(F.col("scheduled_arrival_utc"))
        predicted = F.when(boarding, F.col("final_predicted_departure_utc")).otherwise(F.col("final_predicted_arrival_utc"))
        cancelled = F.col("final_status").eqNullSafe("CANCELED")
        usable = (F.col("schedule_relationship") == "SCHEDULED") & (F.abs(elapsed(predicted, scheduled)) <= USABLE_S) & (~cancelled | (predicted < F.col("first_canceled_at_utc")))
        seen = one.withColumn("has_row", F.coalesce("present", F.lit(False))).withColumn("event_scheduled_utc", scheduled).withColumn("event_observed_utc", F.when(usable, predicted))
        status = F.when(F.col("schedule_relationship") == "SKIPPED", "skipped").when(F.col("event_observed_utc").isNotNull(), "observed").when(F.col("final_status") == "CANCELED", "cancelled").when(F.col("has_row"), "no_prediction").otherwise("absent")
        fresh = ~F.col("lost_tracking") & (F.col("last_update_at_utc") >= F.col("event_observed_utc") - seconds(F.lit(FRESH_S)))
        judged = F.col("event_observed_utc").isNotNull() & F.when(F.col("is_first_stop"), fresh).otherwise(F.col("is_reliable"))
        out = seen.withColumn("call_status", status).withColumn("delay_s", rounded(elapsed(F.col("event_observed_utc"), F.col("event_scheduled_utc")))).withColumn("is_judged", (F.col("call_status") == "observed") & judged)
        return out.select(*self.scheduled_call.columns, "final_status", "first_canceled_at_utc", "schedule_relationship", "is_reliable", "lost_tracking", "last_update_at_utc", "has_row", "event_scheduled_utc", "event_observed_utc", "call_status", "delay_s", "is_judged")

    @cached_property
    def headway(self) -> DataFrame:
        calls = self.call_observation.where("is_boarding").join(F.broadcast(self.ordinary_route.select("route_id")), "route_id")

        def gaps(rows: DataFrame, at: str, basis: str) -> DataFrame:
            w = Window.partitionBy("service_date", "stop_id", "route_id", "direction_id").orderBy(at, "trip_id")
            found = rows.withColumn("headway_s", elapsed(F.col(at), F.lag(at).over(w))).withColumn("basis", F.lit(basis))
            return found.where("headway_s is not null").select(*CELL, "basis", "headway_s")

        return gaps(calls, "scheduled_departure_utc", "scheduled").union(gaps(calls.where("call_status = 'observed'"), "event_observed_utc", "observed"))

    @cached_property
    def mart_stop_hour(self) -> DataFrame:
        calls = self.call_observation.join(F.broadcast(self.ordinary_route.select("route_id")), "route_id")
        judged, delay = F.col("is_judged"), F.col("delay_s")
        early, late = judged & F.col("is_boarding") & (delay < EARLY_S), judged & (delay > LATE_S)
        on_time, timed = judged & ~early & ~late, F.col("timepoint") == "1"
        status = lambda s: count_where(F.col("call_status") == s)
        cells = calls.groupBy(*CELL).agg(
            F.count("*").alias("n_scheduled_calls"),
            count_where(F.col("is_boarding")).alias("n_boarding_calls"),
            *[status(s).alias(f"n_{s}") for s in ("observed", "skipped", "cancelled", "no_prediction", "absent")],
            count_where(judged).alias("n_judged"),
            count_where(early).alias("n_early"),
            count_where(late).alias("n_late"),
            count_where(on_time).alias("n_on_time"),
            count_where(judged & timed).alias("n_judged_timepoint"),
            count_where(on_time & timed).alias("n_on_time_timepoint"),
        )
        # Both bases in one aggregation; the bunching threshold is the cell's own scheduled mean.
        gap, scheduled = F.col("headway_s"), F.col("basis") == "scheduled"
        mean = F.avg(F.when(scheduled, gap)).over(Window.partitionBy(*CELL))
        gaps = self.headway.withColumn("mean", mean)
        sums = gaps.groupBy(*CELL).agg(
            *[x.alias(f"{name}_headway_{kind}") for name, own in (("scheduled", scheduled), ("observed", ~scheduled)) for kind, x in (("n", count_where(own)), ("sum_s", sum_where(gap, own)), ("sq_s", sum_where(gap * gap, own)))],
            count_where(~scheduled & (gap < 0.25 * F.col("mean"))).alias("n_bunched"),
        )
        n, total = F.col("scheduled_headway_n"), F.col("scheduled_headway_sum_s")
        # A basis without a gap in the cell is unknown, not zero.
        sums = sums.withColumn("scheduled_headway_n", F.nullif("scheduled_headway_n", F.lit(0))).withColumn("observed_headway_n", F.nullif("observed_headway_n", F.lit(0)))
        band = F.when(n.isNull(), None)
        for limit, name in BANDS:
            band = band.when(total <= limit * n, name)
        joined = cells.join(sums, CELL, "left")
        return joined.select(
            *cells.columns,
            band.otherwise(">30").alias("frequency_band"),
            F.coalesce(n, F.lit(0)).alias("scheduled_headway_n"), *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("scheduled_headway_sum_s", "scheduled_headway_sq_s")],
            F.coalesce("observed_headway_n", F.lit(0)).alias("observed_headway_n"), *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("observed_headway_sum_s", "observed_headway_sq_s")],
            F.coalesce("n_bunched", F.lit(0)).alias("n_bunched"),
            (0.25 * total / n < 90).alias("bunching_below_precision"),
        )

    @cached_property
    def mart_trip(self) -> DataFrame:
        calls = self.call_observation.join(F.broadcast(self.ordinary_route.select("route_id")), "route_id")
        judged, first, seq = F.col("is_judged"), F.col("is_first_stop"), F.col("stop_sequence")
        per_trip = calls.groupBy("service_date", "trip_id", "route_id", "direction_id", "is_timetabled").agg(
            F.count("*").alias("n_calls"),
            count_where(F.col("call_status") == "observed").alias("n_observed"),
            count_where(judged).alias("n_judged"),
            count_where(F.col("call_status") == "skipped").alias("n_skipped"),
            count_where(F.col("call_status").isin("no_prediction", "absent")).alias("n_unknown"),
            F.min(F.when(judged, seq)).alias("first_judged_stop_sequence"),
            F.max(F.when(judged, seq)).alias("last_judged_stop_sequence"),
            F.max(seq).alias("last_stop_sequence"),
            F.coalesce(F.bool_or(first & judged), F.lit(False)).alias("judged_at_first_stop"),
            (F.max(F.when(F.col("is_last_stop"), F.col("arrival_s"))) - last_known(F.col("arrival_s"), F.when(judged, seq))).alias("unjudged_tail_s"),
            F.min(F.when(first & judged, F.col("delay_s"))).alias("first_stop_delay_s"),
            F.min(F.when(first, F.col("scheduled_departure_utc"))).alias("scheduled_start_utc"),
            F.min(F.when(first, service_hour(F.col("departure_s")))).alias("start_service_hour"),
        )
        fact = self["fact_trip"].select("service_date", "trip_id", F.lit(True).alias("present"), "final_status", "canceled_polls", "first_canceled_at_utc", "had_vehicle")
        cancelled = F.col("final_status") == "CANCELED"
        status = F.when(cancelled & (F.col("n_judged") == 0), "cancelled").when(cancelled, "incomplete").when(F.col("judged_at_first_stop") & (F.col("unjudged_tail_s") > TAIL_S), "incomplete").when(F.col("n_judged") > 0, "ran").otherwise("unknown")
        joined = per_trip.join(fact, ["service_date", "trip_id"], "left")
        return joined.select(*per_trip.columns, status.alias("status"), F.coalesce("present", F.lit(False)).alias("reported"), "final_status", (F.coalesce("canceled_polls", F.lit(0)) > 0).alias("ever_canceled"), "canceled_polls", "first_canceled_at_utc", "had_vehicle")

    @cached_property
    def stop_geography(self) -> DataFrame:
        return current_vintage(self["stop_geography_all"])

    @cached_property
    def stop_meshblock(self) -> DataFrame:
        return current_vintage(self["stop_meshblock_all"])

    @cached_property
    def stop_geography_stale(self) -> DataFrame:
        built = self.stop_geography.select("stop_id", F.col("stop_lat").alias("built_lat"), F.col("stop_lon").alias("built_lon"))
        now = self.dim_stop.select("stop_id", "stop_lat", "stop_lon")
        moved = haversine(*(F.col(c) for c in ("built_lat", "built_lon", "stop_lat", "stop_lon")))
        joined = now.join(built, "stop_id", "left").withColumn("moved_m", moved)
        return joined.where(F.col("built_lat").isNull() | (F.col("moved_m") > MOVED_M)).select("stop_id", "built_lat", "built_lon", "stop_lat", "stop_lon", "moved_m")

    @cached_property
    def stop_catchment(self) -> DataFrame:
        people, straight = F.col("person_count"), F.col("straight_line_distance_m") <= 800
        routed = F.col("routing_status") == "routed"
        walk = lambda m: F.coalesce(sum_where(people, routed & (F.col("network_distance_m") <= m)), F.lit(0))
        return self.stop_meshblock.groupBy("stop_id").agg(
            walk(400).alias("walk_population_400m"),
            walk(800).alias("walk_population_800m"),
            F.coalesce(sum_where(people, straight), F.lit(0)).alias("straight_population_800m"),
            count_where(straight & (people > 0) & ~F.col("routing_status").eqNullSafe("routed")).alias("n_unrouted_meshblocks_800m"),
        )

    @cached_property
    def stop_context(self) -> DataFrame:
        return self.stop_geography.join(self.stop_catchment, "stop_id", "left")

    @cached_property
    def stop_frequency(self) -> DataFrame:
        calls = self.scheduled_call.where("is_boarding").join(F.broadcast(self.ordinary_route.select("route_id")), "route_id")
        return calls.groupBy("stop_id", "service_date", "service_hour").agg(F.count("*").alias("n_departures"), F.countDistinct("route_id").alias("n_routes"))

    @cached_property
    def route_context(self) -> DataFrame:
        key = ["route_id", "direction_id"]
        calls = self.scheduled_call.join(F.broadcast(self.ordinary_route.select("route_id")), "route_id").groupBy(*key, "stop_id").agg(F.count("*").alias("n_calls"))
        places = self.stop_geography.select("stop_id", "irsd_score", "irsd_state_decile", "distance_to_nearest_centre_m")
        stops = calls.join(places, "stop_id", "left").join(self.stop_catchment.select("stop_id", "walk_population_800m"), "stop_id", "left")
        n, decile = F.col("n_calls"), F.col("irsd_state_decile")
        profile = stops.groupBy(*key).agg(
            F.count("*").alias("n_stops"),
            F.sum(n).alias("n_calls"),
            F.coalesce(sum_where(n, F.col("irsd_score").isNull()), F.lit(0)).alias("n_calls_null_seifa"),
            F.min(decile).alias("irsd_state_decile_min"),
            F.max(decile).alias("irsd_state_decile_max"),
            *[(sum_where(n, decile.isin(2 * k - 1, 2 * k)) / sum_where(n, decile.isNotNull())).alias(f"irsd_quintile_{k}_call_share") for k in range(1, 6)],
        )
        long = known_unpivot(stops.select(*key, "n_calls", *[F.col(m).cast("double").alias(m) for m in MEASURES]), [*key, "n_calls"], MEASURES)
        summary = weighted_quantiles(long, [*key, "measure"], "value", "n_calls", {"median": 0.5, "q25": 0.25, "q75": 0.75})
        wide = summary.groupBy(*key).agg(*[F.max(F.when(F.col("measure") == m, F.col(s))).alias(f"{m}_call_weighted_{s}") for m in MEASURES for s in ("mean", "median", "q25", "q75")])
        return profile.join(wide, key, "left")

    @cached_property
    def route_clockface(self) -> DataFrame:
        key = ["service_date", "route_id", "direction_id", "period"]
        starts = self.scheduled_call.where("is_first_stop").join(F.broadcast(self.ordinary_route.select("route_id")), "route_id").withColumn("hour", service_hour(F.col("departure_s")))
        starts = starts.join(F.broadcast(self.period.withColumnRenamed("service_hour", "hour")), "hour")
        w = Window.partitionBy(*key).orderBy("departure_s")
        starts = starts.withColumn("headway_s", F.col("departure_s") - F.lag("departure_s").over(w)).withColumn("minute", F.floor(F.col("departure_s") / 60)).withColumn("first_minute", F.first("minute").over(w))
        cycle = starts.groupBy(*key).agg(F.count("*").alias("n_departures"), F.round(F.median("headway_s") / 60).cast("int").alias("headway_min"))
        every = starts.join(cycle.where(F.col("headway_min").isin(*CLOCKFACE)), key)
        offset = F.pmod(F.col("minute") - F.col("first_minute"), F.col("headway_min"))
        worst = every.groupBy(*key).agg(F.max(F.least(offset, F.col("headway_min") - offset)).alias("drift"))
        regular = (F.col("n_departures") >= 2) & (F.col("drift") <= 1)
        return cycle.join(worst, key, "left").select(*key, "n_departures", "headway_min", F.coalesce(regular, F.lit(False)).alias("is_clockface"))

    @cached_property
    def route_league(self) -> DataFrame:
        key = ["route_id", "direction_id", "period"]
        days = F.broadcast(self.service_day.where("day_type = 'term_weekday'").select("service_date"))
        sums = ["scheduled_headway_n", "scheduled_headway_sum_s", "scheduled_headway_sq_s", "observed_headway_n", "observed_headway_sum_s", "observed_headway_sq_s"]
        cells = self.mart_stop_hour.join(days, "service_date").join(F.broadcast(self.period), "service_hour").groupBy(*key).agg(
            F.countDistinct("service_date").alias("n_days"),
            *[F.sum(c).alias(c) for c in ("n_scheduled_calls", "n_judged", "n_on_time")],
            F.sum(F.col("n_no_prediction") + F.col("n_absent")).alias("n_unknown_calls"),
            *[F.sum(c).alias(c) for c in sums],
        )
        status = lambda s: count_where(F.col("status") == s)
        hours = F.broadcast(self.period.withColumnRenamed("service_hour", "start_service_hour"))
        trips = self.mart_trip.join(days, "service_date").join(hours, "start_service_hour").groupBy(*key).agg(
            F.count("*").alias("n_trips"),
            status("ran").alias("n_ran"),
            status("cancelled").alias("n_cancelled"),
            status("incomplete").alias("n_incomplete"),
            status("unknown").alias("n_unknown_trips"),
            F.count("first_stop_delay_s").alias("n_first_stop_judged"),
            count_where(F.col("first_stop_delay_s").between(EARLY_S, LATE_S)).alias("n_first_stop_on_time"),
        )
        c = F.col
        joined = cells.join(trips, key, "full").join(F.broadcast(self.ordinary_route.select("route_id", "route_short_name")), "route_id")
        return joined.select(
            "route_id", "route_short_name", "direction_id", "period", *cells.columns[3:], *trips.columns[3:],
            ratio(c("n_on_time"), c("n_judged")).alias("on_time_share"),
            ratio(c("n_unknown_calls"), c("n_scheduled_calls")).alias("unknown_share"),
            excess_wait(c("observed_headway_sq_s"), c("observed_headway_sum_s"), c("scheduled_headway_sq_s"), c("scheduled_headway_sum_s")).alias("excess_wait_s"),
            ratio(c("n_cancelled") + c("n_incomplete"), c("n_trips")).alias("sd7_rate"),
            ratio(c("n_first_stop_on_time"), c("n_first_stop_judged")).alias("sd1_on_time_share"),
        )

    @cached_property
    def coverage(self) -> DataFrame:
        areas = self.stop_geography.where("sa2_code is not null").select("sa2_code", "sa2_name", "gccsa_name").distinct()
        day_types = self.service_day.groupBy("day_type").agg(F.count("*").alias("n_days"))
        calls = self.scheduled_call.where("is_boarding").join(F.broadcast(self.ordinary_route.select("route_id")), "route_id")
        calls = calls.join(F.broadcast(self.service_day.select("service_date", "day_type")), "service_date").join(F.broadcast(self.period), "service_hour")
        counted = calls.join(self.stop_geography.select("stop_id", "sa2_code"), "stop_id").groupBy("sa2_code", "period", "day_type").agg(F.count("*").alias("n_calls"))
        # Areas times five periods times five day types: zero rows are the point.
        grid = areas.crossJoin(F.broadcast(self.period.select("period").distinct())).crossJoin(F.broadcast(day_types))
        n = F.coalesce("n_calls", F.lit(0))
        return grid.join(counted, ["sa2_code", "period", "day_type"], "left").select("sa2_code", "sa2_name", "gccsa_name", "period", "day_type", "n_days", n.alias("n_calls"), (n / F.col("n_days")).alias("calls_per_day"))

    @cached_property
    def daily_ran_share(self) -> DataFrame:
        """Percent of trips that ran, by day."""
        return self.mart_trip.groupBy("service_date").agg((100 * F.avg((F.col("status") == "ran").cast("int"))).alias("ran_percent"))


def view_names() -> list[str]:
    """All views, each after those it is made of."""
    return [k for k, v in vars(Marts).items() if isinstance(v, cached_property)]
