"""Registered queries that write with the sinks and read with the sources, and their SQL twins.

Each writes tables made from the generic ones to the scratch folder, in the
engine's own layout, and gives back what the source under test reads there; or
decodes payloads that it encoded before. Streams run over what was written.
"""

from __future__ import annotations

import csv
import gzip
import io
import sys
import zipfile
from collections.abc import Callable, Iterator
from datetime import date, datetime, timedelta

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual import session
from punctual.functions import timeline
from punctual.operators import relational, reducers
from punctual.plans import facts, geography, merge
from punctual.plans.catalogue import table
from punctual.plans.marts import Marts
from punctual.plans.service import _WORLD, VIEWS, _over, register, shown, world
from punctual.sources import feed, files, shapes, timetable
from punctual.streaming import hourly

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SOURCES = ("events", "orders", "customer", "supplier", "nation", "region")
LABELS = ("2026-09-01T000000Z", "2026-09-02T000000Z")
SPAN = (date(2026, 3, 25), date(2026, 10, 15))
FIRST_HOUR = datetime(2024, 1, 10, 3)


def stores_sql(plus: Callable[[str, str], str]) -> dict[str, str]:
    ts = "CAST(ts AS TIMESTAMP)"
    return {
        "call_row": f"SELECT CAST({ts} AS DATE) AS service_date, 'r' || CAST(user_id % 9 AS STRING) AS route_id, 't' || CAST(user_id AS STRING) AS trip_id, CAST(event_id AS INT) AS stop_sequence, value FROM events",
        "raw_key": f"""SELECT event_id, '/raw/' || CASE WHEN event_id % 7 = 0 THEN 'tripupdates' ELSE 'vehiclepos' END || '/dt=' || substr(CAST({ts} AS STRING), 1, 10) || '/hour=' || substr(CAST({ts} AS STRING), 12, 2) || '/'
          || replace(substr(CAST({ts} AS STRING), 12, 8), ':', '') || CASE WHEN event_id % 50 = 0 THEN '.json' ELSE '.pb.gz' END AS path FROM events""",
        "seen": f"SELECT CAST(event_id AS INT) AS n, date_trunc('second', {ts}) AS fetched_at_utc, 'v' || CAST(user_id AS STRING) AS vehicle_id, 't' || CAST(user_id % 11 AS STRING) AS trip_id, 'r' || CAST(user_id % 4 AS STRING) AS route_id, CAST(event_id % 4 AS INT) AS place, CASE WHEN event_id % 5 <> 0 THEN CAST(event_id % 9 AS INT) END AS crowd FROM events",
        "clocked": f"SELECT event_id, date_trunc('second', {ts}) AS fetched_at_utc, {plus(f'date_trunc({chr(39)}second{chr(39)}, {ts})', 'event_id % 5')} AS received_at_utc FROM events",
        "header": """SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'attachment; filename="f' || CAST(event_id AS STRING) || '.zip"' WHEN 1 THEN 'attachment; FileName=g' || CAST(event_id AS STRING) || '.zip; x=1' WHEN 2 THEN 'attachment; filename*=UTF-8''''h.zip' END AS header FROM events""",
        "listed": "SELECT 'o/' || CAST(o_orderkey AS STRING) AS path, o_orderkey % 1000 AS size, CAST(o_orderdate AS TIMESTAMP) AS modified FROM orders",
    }


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    given = {name: table(spark, sf_dir, name) for name in SOURCES}
    return given | {name: _over(spark, sql, given) for name, sql in stores_sql(lambda t, n: f"({t} + make_dt_interval(0, 0, 0, {n}))").items()}


def snapshots(spark: SparkSession, t: dict[str, DataFrame]) -> DataFrame:
    """An older snapshot without a column, and a newer one; labels come from the folders, as text."""
    path = hourly.scratch(spark)
    rows = t["customer"].select("c_custkey", "c_name", F.col("c_nationkey").cast("int").alias("c_nationkey"))
    files.write_snapshot(rows.drop("c_nationkey"), path, "customer", LABELS[0])
    files.write_snapshot(rows.where("c_nationkey < 20"), path, "customer", LABELS[1])
    return files.read_snapshots(spark, f"{path}/dim_customer")


def newest_snapshot(spark: SparkSession, t: dict[str, DataFrame]) -> DataFrame:
    return relational.newest(snapshots(spark, t), ["c_custkey"], "valid_from")


def day_facts(spark: SparkSession, t: dict[str, DataFrame]) -> DataFrame:
    """Facts day by day, each with the number of rows its writer counted; the folder's copy of the day isn't read."""
    path, out = hourly.scratch(spark), []
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(31)]
    for day in days:
        n = files.write_fact(t["call_row"].where(F.col("service_date") == F.lit(day)), path, "trip_stop", day.isoformat())
        out.append((day, n))
    counted = spark.createDataFrame(out, "service_date date, n_written long")
    return files.read_facts(spark, f"{path}/fact_trip_stop").groupBy("service_date").agg(F.count("*").alias("n_read"), F.sum("value").alias("total"), F.max("route_id").alias("last_route")).join(F.broadcast(counted), "service_date")


def chosen_hours(spark: SparkSession, t: dict[str, DataFrame]) -> DataFrame:
    """Four hours of partials, of which two are read, with their folders' columns."""
    path = hourly.scratch(spark)
    hours = [FIRST_HOUR + timedelta(hours=i) for i in range(4)]
    rows = t["events"].select("event_id", "value", F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("at"))
    for h in hours:
        files.write_partial(rows.where(F.col("at") == F.lit(h)).drop("at"), path, "event", h)
    own = lambda h: f"{path}/_partial/event/dt={h:%Y-%m-%d}/hour={h:%H}"
    return files.read_paths(spark, f"{path}/_partial/event", [own(hours[1]), own(hours[3])])


def optional(spark: SparkSession, t: dict[str, DataFrame]) -> DataFrame:
    """One table that was written and one that wasn't."""
    path, shape = hourly.scratch(spark), "r_regionkey long, r_name string"
    t["region"].select(F.col("r_regionkey").cast("long").alias("r_regionkey"), "r_name").write.parquet(f"{path}/there")
    return files.read_optional(spark, f"{path}/there", shape).unionByName(files.read_optional(spark, f"{path}/not", shape))


def seeds(spark: SparkSession, t: dict[str, DataFrame]) -> DataFrame:
    """Two CSV files read as one, typed."""
    path = hourly.scratch(spark)
    rows = t["nation"].select("n_nationkey", "n_name", (F.col("n_nationkey") * 1.5).alias("score"))
    files.write_csv(rows.where("n_nationkey < 9"), f"{path}/a")
    files.write_csv(rows.where("n_nationkey >= 9"), f"{path}/b")
    return files.read_seed(spark, [f"{path}/a", f"{path}/b"], "n_nationkey int, n_name string, score double")


def centres(spark: SparkSession, t: dict[str, DataFrame]) -> DataFrame:
    path, k = hourly.scratch(spark), F.col("n_nationkey")
    tier = F.element_at(F.array(*[F.lit(x) for x in files.TIERS]), (k % 3 + 1).cast("int"))
    files.write_csv(t["nation"].select(k.alias("centre_id"), F.col("n_name").alias("centre_name"), tier.alias("tier"), (k * 2.0 - 30).alias("latitude"), (k * 5.0).alias("longitude"), F.lit("seed").alias("source")), path)
    return files.read_centres(spark, path, files.TIERS)


def audits(spark: SparkSession, t: dict[str, DataFrame]) -> DataFrame:
    """A record in a file of its own for each region, on days of which one has none."""
    path = hourly.scratch(spark)
    for r in t["region"].collect():  # five
        files.append_audit(spark, path, date(2026, 9, 1 + r.r_regionkey // 2 * 2), {"key": r.r_regionkey, "name": r.r_name, "error": None})
    return files.read_audit(spark, path, [date(2026, 9, 1 + i) for i in range(5)], "key long, name string, error string")


def vintages(spark: SparkSession, t: dict[str, DataFrame]) -> DataFrame:
    path = hourly.scratch(spark)
    for d, rows in ((date(2026, 1, 1), t["supplier"]), (date(2026, 9, 22), t["supplier"].where("s_suppkey % 3 <> 0"))):
        files.write_vintage(rows.select("s_suppkey", "s_acctbal", F.lit(d).alias("vintage")), path, "supplier", d)
    return relational.current_vintage(files.read_facts(spark, f"{path}/supplier"))


def _bundle(spark: SparkSession, t: dict[str, DataFrame]) -> DataFrame:
    """A timetable zip of the nations as stops and the regions as agencies."""
    members = {
        "stops.txt": (["stop_id", "stop_name", "stop_lat", "stop_lon"], [(r.n_nationkey, r.n_name, "" if r.n_nationkey % 6 == 0 else r.n_nationkey * 1.25, r.n_nationkey * -2) for r in t["nation"].collect()]),
        "agency.txt": (["agency_id", "agency_name", "agency_url", "agency_timezone"], [(r.r_regionkey, r.r_name, "", "Australia/Sydney") for r in t["region"].collect()]),
    }
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, (head, rows) in members.items():
            text = io.StringIO()
            csv.writer(text).writerows([head, *rows])
            z.writestr(name, "﻿" + text.getvalue())  # as publishers do
    return spark.createDataFrame([("b.zip", bytearray(buffer.getvalue()))], "path string, content binary")


def timetable_stops(spark: SparkSession, t: dict[str, DataFrame]) -> DataFrame:
    return timetable.dimension(_bundle(spark, t), "stop")


def timetable_agencies(spark: SparkSession, t: dict[str, DataFrame]) -> DataFrame:
    return timetable.dimension(_bundle(spark, t), "agency")


def _polled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Poll rows as compressed messages, one for each."""
    kind, number = feed.message_type(), {e: {v: k for k, v in own.items()} for e, own in feed.ENUMS.items()}
    for frame in frames:
        out = []
        for r in frame.itertuples():
            m = kind()
            m.header.gtfs_realtime_version = "2.0"
            u = m.entity.add(id=str(r.n)).trip_update
            u.trip.trip_id, u.trip.route_id, u.trip.start_date, u.trip.start_time, u.trip.schedule_relationship = r.trip_id or "", r.route_id, r.start_date, r.start_time, number["TripRelation"][r.trip_relationship]
            if r.has_vehicle:
                u.vehicle.id = "x"
            if not pd.isna(r.stamp):
                u.timestamp = int(r.stamp)
            for s in r.stops:
                own = u.stop_time_update.add(stop_id=s["stop_id"], stop_sequence=s["stop_sequence"], schedule_relationship=number["StopRelation"][s["relationship"]])
                for e, given in (("arrival", s["arrival"]), ("departure", s["departure"])):
                    if given["time"] is not None:
                        getattr(own, e).time, getattr(own, e).delay = int(given["time"]), int(given["delay"])
            out.append((r.fetched_at_utc, gzip.compress(m.SerializeToString(), mtime=0)))
        yield pd.DataFrame(out, columns=["fetched_at_utc", "content"])


def decoded_updates(spark: SparkSession, t: dict[str, DataFrame], sf_dir: str) -> DataFrame:
    """Polls encoded as messages and decoded again, stop by stop."""
    polls = facts.updates(facts.facts(spark, sf_dir)["poll_stop"])
    rows = feed.trip_updates(polls.mapInPandas(_polled, "fetched_at_utc timestamp, content binary"))
    stop = rows.select("fetched_at_utc", "trip_id", "route_id", "start_date", "start_time", "trip_relationship", "has_vehicle", "stamp", F.explode("stops").alias("s"))
    event = lambda e, x: F.col(f"s.{e}.{x}").alias(f"{e}_{x}")
    return stop.select(*stop.columns[:-1], "s.stop_id", "s.stop_sequence", "s.relationship", event("arrival", "time"), event("arrival", "delay"), event("departure", "time"))


def _sighted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    kind = feed.message_type()
    for frame in frames:
        out = []
        for r in frame.itertuples():
            m = kind()
            m.header.gtfs_realtime_version = "2.0"
            v = m.entity.add(id=str(r.n)).vehicle
            v.vehicle.id, v.timestamp, v.trip.trip_id, v.trip.route_id = r.vehicle_id, int(r.fetched_at_utc.timestamp()) - r.place, r.trip_id, r.route_id
            v.position.latitude, v.position.longitude = (0.0, 0.0) if r.n % 13 == 0 else (-33.5, 151.25)
            if not pd.isna(r.crowd):
                v.occupancy_status = int(r.crowd)
            out.append((r.fetched_at_utc, gzip.compress(m.SerializeToString(), mtime=0)))
        yield pd.DataFrame(out, columns=["fetched_at_utc", "content"])


def decoded_positions(spark: SparkSession, t: dict[str, DataFrame]) -> DataFrame:
    raw = t["seen"].mapInPandas(_sighted, "fetched_at_utc timestamp, content binary")
    return feed.vehicle_positions(raw).select("fetched_at_utc", "observed_at_utc", "position_age_s", "vehicle_id", "trip_id", "route_id", "lat", "lon", "occupancy_status", "null_island")


def key_times(spark: SparkSession, t: dict[str, DataFrame]) -> DataFrame:
    return t["raw_key"].select("event_id", feed.key_time(F.col("path")).alias("fetched_at_utc"))


def clock_skew(spark: SparkSession, t: dict[str, DataFrame]) -> DataFrame:
    """The server's date as HTTP writes it, unreadable for some."""
    text = F.when(F.col("event_id") % 19 == 0, "nonsense").otherwise(F.date_format(F.col("fetched_at_utc") + F.expr("interval 2 seconds"), "EEE, dd MMM yyyy HH:mm:ss 'GMT'"))
    return feed.poll_clock(t["clocked"].withColumn("server_date", text)).drop("server_date")


def attachments(spark: SparkSession, t: dict[str, DataFrame]) -> DataFrame:
    return t["header"].select("event_id", feed.attachment_name(F.col("header")).alias("name"))


def day_hours(spark: SparkSession, t: dict[str, DataFrame]) -> DataFrame:
    """Hours, merge windows and partition bounds of local days over both clock changes."""
    rows = []
    for day in timeline.day_range(*SPAN):
        start, end = (x.replace(tzinfo=None) for x in timeline.merge_window(day))
        rows.append((day, timeline.hours_in_day(day), len(timeline.expected_hours(day)), len(timeline.day_hours(day)), start, end, *timeline.partition_bounds(day)))
    return spark.createDataFrame(rows, "day date, hours int, expected int, own int, window_start timestamp, window_end timestamp, first_dt string, last_dt string")


def roundings(spark: SparkSession, t: dict[str, DataFrame]) -> DataFrame:
    half = F.col("event_id") / 2 - 100
    return t["events"].select("event_id", timeline.rounded(half).alias("nearest"), F.col("event_type").try_cast("int").alias("no_number"), F.col("event_id").cast("string").try_cast("smallint").alias("small"), F.col("ts").cast("date").alias("day"))


def upserts(spark: SparkSession, t: dict[str, DataFrame]) -> DataFrame:
    stored = t["customer"].select(F.col("c_custkey").alias("k"), F.lit("stored").alias("state"), F.lit(None).cast("double").alias("total"))
    new = t["orders"].groupBy(F.col("o_custkey").alias("k")).agg(F.lit("new").alias("state"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return merge.upsert(stored, new, ["k"])


def pulls(spark: SparkSession, t: dict[str, DataFrame]) -> DataFrame:
    day = F.expr("interval 1 day")
    remote = t["listed"].where("size <> 7")
    local = t["listed"].where("size % 5 <> 0").withColumn("modified", F.when(F.col("size") % 11 == 0, F.col("modified") - day).otherwise(F.col("modified"))).withColumn("size", F.when(F.col("size") % 13 == 0, F.col("size") + 1).otherwise(F.col("size")))
    return files.pull_plan(remote, local)


def instants_as_text(spark: SparkSession, t: dict[str, DataFrame]) -> DataFrame:
    return relational.as_text(t["clocked"].select("event_id", "fetched_at_utc"))


def frozen(spark: SparkSession, sf_dir: str) -> DataFrame:
    marts = Marts(world(spark, sf_dir))
    return marts.freeze("scheduled_trip", f"{hourly.scratch(spark)}/scheduled_trip")


def geojson_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks as a feature collection, and the stops within them."""
    path, t = f"{hourly.scratch(spark)}/blocks.geojson", facts.facts(spark, sf_dir)
    ring = F.array(*[F.array(x, y) for x, y in (("x1", "y1"), ("x2", "y1"), ("x2", "y2"), ("x1", "y2"), ("x1", "y1"))])
    of = F.struct(F.lit("Feature").alias("type"), F.struct(F.col("mesh_block_code").alias("MB"), *[F.col(c) for c in geography.AREA[1:]]).alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"))
    whole = t["block"].agg(F.collect_list(of).alias("features")).select(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")))  # at most 144 blocks
    whole.coalesce(1).write.text(path)
    blocks = geography.clipped(shapes.read_geojson(spark, path, {"mesh_block_code": "MB", **{c: c for c in geography.AREA[1:]}}))
    return geography.stop_mesh_block(t["place"], blocks)


def sheet_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A worksheet's export without a heading, all text."""
    path, names = hourly.scratch(spark), ("A", "B", "C", "D")
    facts.facts(spark, sf_dir)["sheet"].select(*names).coalesce(1).write.csv(path)
    return shapes.read_sheet(spark, path)


def _streamed(spark: SparkSession, rows: DataFrame) -> DataFrame:
    path = hourly.scratch(spark)
    rows.write.parquet(path)
    return hourly.source(spark, path)


def streamed_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partials by the hour from a stream of polls; the hours that the watermark hasn't passed stay open."""
    polls = facts.facts(spark, sf_dir)["poll_stop"]
    departs = reducers.instant(F.col("dep_time"))
    rows = polls.select("fetched_at_utc", F.coalesce(reducers.instant(F.col("stamp")), "fetched_at_utc").alias("seen_at"), F.struct("n", "i").alias("poll"), "start_date", "trip_id", "stop_id", "stop_sequence", "relationship", departs.alias("departure_at"))
    return hourly.to_end(hourly.hourly_partials(_streamed(spark, rows)))


def streamed_sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = facts.facts(spark, sf_dir)["sighting"]
    return hourly.to_end(hourly.first_positions(_streamed(spark, rows).select("vehicle_id", "observed_at_utc", "lat", "lon", "fetched_at_utc"), "40 days")).select("vehicle_id", "observed_at_utc", "lat", "lon")


def streamed_days(spark: SparkSession, t: dict[str, DataFrame]) -> DataFrame:
    """Service days rewritten by a stream, twice over the same rows."""
    path = hourly.scratch(spark)
    stream = _streamed(spark, t["call_row"])
    fold = lambda _, batch: batch.groupBy("service_date", "route_id").agg(F.count("*").alias("n"), F.max("stop_sequence").alias("last"))
    for run in ("a", "b"):
        hourly.merge_days(stream, fold, f"{path}/days", f"{path}/{run}").awaitTermination()
    return session.ensure(spark).read.parquet(f"{path}/days").withColumn("service_date", F.col("service_date").cast("date"))


RUNS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **{f.__name__: (lambda spark, d, f=f: f(spark, _tables(spark, d))) for f in (snapshots, newest_snapshot, day_facts, chosen_hours, optional, seeds, centres, audits, vintages, timetable_stops, timetable_agencies, decoded_positions, key_times, clock_skew, attachments, day_hours, roundings, upserts, pulls, instants_as_text, streamed_days)},
    "decoded_updates": lambda spark, d: decoded_updates(spark, {}, d),
    **{f.__name__: f for f in (frozen, geojson_blocks, sheet_text, streamed_partials, streamed_sightings)},
}

_MADE = stores_sql(lambda t, n: f"({t} + to_seconds({n}))")
_ZONE = timeline.ZONE
_MIDNIGHT = lambda d: f"(({d})::TIMESTAMP AT TIME ZONE '{_ZONE}' AT TIME ZONE 'UTC')"

TWINS = {
    "snapshots": f"SELECT c_custkey, c_name, NULL::INT AS c_nationkey, '{LABELS[0]}' AS valid_from FROM customer UNION ALL SELECT c_custkey, c_name, c_nationkey, '{LABELS[1]}' FROM customer WHERE c_nationkey < 20",
    "newest_snapshot": "SELECT c_custkey, c_name, CASE WHEN c_nationkey < 20 THEN c_nationkey END AS c_nationkey FROM customer",
    "day_facts": "SELECT service_date, count(*) AS n_read, sum(value) AS total, max(route_id) AS last_route, count(*) AS n_written FROM call_row WHERE service_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31' GROUP BY service_date",
    "chosen_hours": f"SELECT event_id, value, strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hour FROM events WHERE date_trunc('hour', ts) IN (TIMESTAMP '{FIRST_HOUR + timedelta(hours=1)}', TIMESTAMP '{FIRST_HOUR + timedelta(hours=3)}')",
    "optional": "SELECT r_regionkey, r_name FROM region",
    "seeds": "SELECT n_nationkey, n_name, n_nationkey * 1.5 AS score FROM nation",
    "centres": "SELECT n_nationkey::VARCHAR AS centre_id, n_name AS centre_name, ['metropolitan', 'strategic', 'regional'][n_nationkey % 3 + 1] AS tier, n_nationkey * 2.0 - 30 AS latitude, n_nationkey * 5.0 AS longitude, 'seed' AS source FROM nation",
    "audits": "SELECT r_regionkey AS key, r_name AS name, NULL::VARCHAR AS error FROM region",
    "vintages": "SELECT s_suppkey, s_acctbal, DATE '2026-09-22' AS vintage FROM supplier WHERE s_suppkey % 3 <> 0",
    "timetable_stops": "SELECT n_nationkey::VARCHAR AS stop_id, n_name AS stop_name, CASE WHEN n_nationkey % 6 <> 0 THEN n_nationkey * 1.25 END AS stop_lat, n_nationkey * -2.0 AS stop_lon, NULL::VARCHAR AS wheelchair_boarding FROM nation",
    "timetable_agencies": "SELECT r_regionkey::VARCHAR AS agency_id, r_name AS agency_name, NULL::VARCHAR AS agency_url, 'Australia/Sydney' AS agency_timezone FROM region",
    "decoded_updates": """SELECT fetched_at_utc, coalesce(trip_id, '') AS trip_id, route_id, start_date, start_time, trip_relationship, has_vehicle, stamp, stop_id, stop_sequence, relationship, arr_time AS arrival_time, CASE WHEN arr_time IS NOT NULL THEN arr_delay END AS arrival_delay, dep_time AS departure_time FROM poll_stop""",
    "decoded_positions": """SELECT fetched_at_utc, fetched_at_utc - to_seconds(place) AS observed_at_utc, place AS position_age_s, vehicle_id, trip_id, route_id, CASE WHEN n % 13 = 0 THEN 0.0 ELSE -33.5 END AS lat, CASE WHEN n % 13 = 0 THEN 0.0 ELSE 151.25 END AS lon,
      ['EMPTY', 'MANY_SEATS_AVAILABLE', 'FEW_SEATS_AVAILABLE', 'STANDING_ROOM_ONLY', 'CRUSHED_STANDING_ROOM_ONLY', 'FULL', 'NOT_ACCEPTING_PASSENGERS', 'NO_DATA_AVAILABLE', 'NOT_BOARDABLE'][crowd + 1] AS occupancy_status, n % 13 = 0 AS null_island FROM seen""",
    "key_times": "SELECT event_id, CASE WHEN event_id % 50 <> 0 THEN date_trunc('second', ts) END AS fetched_at_utc FROM events",
    "clock_skew": """SELECT *, event_id % 5 AS rtt_s, (epoch_us(fetched_at_utc) + epoch_us(received_at_utc)) / 2e6 - epoch_us(server_date_utc) / 1e6 AS skew_s FROM (SELECT *, CASE WHEN event_id % 19 <> 0 THEN fetched_at_utc + INTERVAL 2 SECOND END AS server_date_utc FROM clocked)""",
    "attachments": "SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'f' || event_id || '.zip' WHEN 1 THEN 'g' || event_id || '.zip' ELSE '' END AS name FROM events",
    "day_hours": f"""WITH d AS (SELECT day, {_MIDNIGHT('day')} AS a, {_MIDNIGHT('day + 1')} AS b FROM (SELECT unnest(generate_series(DATE '{SPAN[0]}', DATE '{SPAN[1]}', INTERVAL 1 DAY))::DATE AS day)), w AS (SELECT *, a - INTERVAL 1 HOUR AS s, b + INTERVAL 7 HOUR AS e FROM d)
      SELECT day, date_diff('hour', a, b) AS hours, date_diff('hour', s, e) AS expected, date_diff('hour', a, b) AS own, s AS window_start, e AS window_end, strftime(s::DATE - 1, '%Y-%m-%d') AS first_dt, strftime(e::DATE + 1, '%Y-%m-%d') AS last_dt FROM w""",
    "roundings": "SELECT event_id, (event_id / 2 - 100)::INT AS nearest, try_cast(event_type AS INT) AS no_number, try_cast(event_id::VARCHAR AS SMALLINT) AS small, ts::DATE AS day FROM events",
    "upserts": "SELECT c_custkey AS k, CASE WHEN n IS NULL THEN 'stored' ELSE 'new' END AS state, total FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ALL) ON o_custkey = c_custkey",
    "pulls": "SELECT path, CASE WHEN size = 7 THEN 'delete' ELSE 'download' END AS action FROM listed WHERE CASE WHEN size = 7 THEN true WHEN size % 5 = 0 THEN true ELSE size % 13 = 0 OR size % 11 = 0 END",
    "instants_as_text": "SELECT event_id, strftime(fetched_at_utc, '%Y-%m-%dT%H:%M:%S.%fZ') AS fetched_at_utc FROM clocked",
    "frozen": "SELECT * FROM scheduled_trip",
    "geojson_blocks": facts.TWINS["stop_mesh_block"],
    "sheet_text": "SELECT A, B, C, D FROM sheet",
    "streamed_partials": """SELECT hour, start_date, trip_id, stop_id, stop_sequence, count(*) FILTER (WHERE is_real) AS n_updates, make_timestamp(nullif(arg_max(coalesce(dep_time, 0), {'s': seen_at, 'n': n, 'i': i}) FILTER (WHERE is_real), 0)::BIGINT * 1000000) AS final_predicted_departure_utc,
      arg_max(relationship, {'s': seen_at, 'n': n, 'i': i}) FILTER (WHERE is_real) AS schedule_relationship, max(seen_at) FILTER (WHERE is_real) AS last_update_at_utc, max(seen_at) AS last_observed_at_utc
      FROM (SELECT *, date_trunc('hour', fetched_at_utc) AS hour, relationship IN ('SCHEDULED', 'SKIPPED') AS is_real, coalesce(make_timestamp(nullif(stamp, 0)::BIGINT * 1000000), fetched_at_utc) AS seen_at FROM poll_stop)
      WHERE hour + INTERVAL 1 HOUR <= (SELECT max(fetched_at_utc) - INTERVAL 10 MINUTE FROM poll_stop) GROUP BY hour, start_date, trip_id, stop_id, stop_sequence""",
    "streamed_sightings": "SELECT DISTINCT vehicle_id, observed_at_utc, lat, lon FROM sighting",
    "streamed_days": "SELECT service_date, route_id, count(*) AS n, max(stop_sequence) AS last FROM call_row GROUP BY ALL",
}


def _run(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return shown(RUNS[name](session.ensure(spark), sf_dir))

    return query


def ctes() -> dict[str, str]:
    return facts._FACTS | {"inside": facts.TWINS["inside"]} | _WORLD | VIEWS | _MADE | TWINS


#: The registered queries and their columns.
COLUMNS = {
    "w01_snapshots": "c_custkey bigint, c_name string, c_nationkey int, valid_from string",
    "w01b_newest_snapshot": "c_custkey bigint, c_name string, c_nationkey int",
    "w02_day_facts": "service_date date, n_read bigint, total double, last_route string, n_written bigint",
    "w03_chosen_hours": "event_id bigint, value double, dt string, hour string",
    "w05_optional": "r_regionkey bigint, r_name string",
    "w06_seeds": "n_nationkey int, n_name string, score double",
    "w07_centres": "centre_id string, centre_name string, tier string, latitude double, longitude double, source string",
    "w08_audits": "key bigint, name string, error string",
    "w10_vintages": "s_suppkey bigint, s_acctbal double, vintage date",
    "w12_timetable_stops": "stop_id string, stop_name string, stop_lat double, stop_lon double, wheelchair_boarding string",
    "w12b_timetable_agencies": "agency_id string, agency_name string, agency_url string, agency_timezone string",
    "w16_decoded_updates": "fetched_at_utc timestamp, trip_id string, route_id string, start_date string, start_time string, trip_relationship string, has_vehicle boolean, stamp bigint, stop_id string, stop_sequence int, relationship string, arrival_time bigint, arrival_delay int, departure_time bigint",
    "w16b_decoded_positions": "fetched_at_utc timestamp, observed_at_utc timestamp, position_age_s double, vehicle_id string, trip_id string, route_id string, lat double, lon double, occupancy_status string, null_island boolean",
    "w15_key_times": "event_id bigint, fetched_at_utc timestamp",
    "w22_clock_skew": "event_id bigint, fetched_at_utc timestamp, received_at_utc timestamp, server_date_utc timestamp, rtt_s double, skew_s double",
    "w25_attachments": "event_id bigint, name string",
    "w30_day_hours": "day date, hours int, expected int, own int, window_start timestamp, window_end timestamp, first_dt string, last_dt string",
    "w12c_roundings": "event_id bigint, nearest int, no_number int, small smallint, day date",
    "w08b_upserts": "k bigint, state string, total double",
    "w06b_pulls": "path string, action string",
    "w31_instants_as_text": "event_id bigint, fetched_at_utc string",
    "w07b_frozen": "service_date date, trip_id string, route_id string, direction_id string, is_timetabled boolean",
    "s02_streamed_partials": "hour timestamp, start_date string, trip_id string, stop_id string, stop_sequence int, n_updates int, final_predicted_departure_utc timestamp, schedule_relationship string, last_update_at_utc timestamp, last_observed_at_utc timestamp",
    "s08c_streamed_sightings": "vehicle_id string, observed_at_utc timestamp, lat double, lon double",
    "s09_streamed_days": "route_id string, n bigint, last int, service_date date",
    "w11_geojson_blocks": "stop_id string, mesh_block_code string, sa1_code string, sa2_code string, sa2_name string, sa3_code string, sa3_name string, sa4_code string, sa4_name string, gccsa_code string, gccsa_name string, boundary_tie boolean",
    "w10b_sheet_text": "A string, B string, C string, D string",
}

register(COLUMNS, _run, ctes())
