"""Registered queries that run the reducers, the merge, the day checks and the spatial build themselves, and their SQL twins.

As in ``service``, the tables are made from the generic ones by the same SQL in
both engines: events play polls, sightings and audit rows, order lines the
hourly partials, parts the blocks of a map, suppliers its stops.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual import session
from punctual.functions.geo import POLYGON
from punctual.functions.timeline import ZONE
from punctual.operators import reducers
from punctual.plans import checks, geography, merge
from punctual.plans.catalogue import table
from punctual.plans.service import _SECONDS, _WALL, DAYS, A, B, C, _clock, _over, register, shown

SOURCES = ("events", "orders", "lineitem", "supplier", "part", "customer", "nation")
DAY = date(2026, 9, 22)
#: A local day of the event stream.
AUDIT_DAY = date(2024, 1, 10)


def facts_sql(plus: Callable[[str, str], str], epoch: Callable[[str], str]) -> dict[str, str]:
    ts, day = "CAST(ts AS TIMESTAMP)", "replace(CAST(CAST(ts AS DATE) AS STRING), '-', '')"
    base = "TIMESTAMP '2026-09-21 14:00:00'"
    hour = "lpad(CAST(h % 24 AS STRING), 2, '0') AS hour, CASE WHEN h < 24 THEN '2026-09-22' ELSE '2026-09-23' END AS dt"
    keyed = """(SELECT o_orderkey % 3 AS d, o_custkey % 300 AS k, l_suppkey % 3 AS s, CASE WHEN l_orderkey % 50 <> 49 THEN l_linenumber END AS seq, l_orderkey % 31 AS h, min(l_orderkey * 8 + l_linenumber) AS q
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY o_orderkey % 3, o_custkey % 300, l_suppkey % 3, CASE WHEN l_orderkey % 50 <> 49 THEN l_linenumber END, l_orderkey % 31)"""
    trips = "(SELECT o_orderkey % 3 AS d, o_custkey % 300 AS k, o_orderkey % 31 AS h, min(o_orderkey) AS q FROM orders GROUP BY o_orderkey % 3, o_custkey % 300, o_orderkey % 31)"
    fed = "CAST(20260922 + d AS STRING)"
    maybe = lambda test, t: f"CASE WHEN {test} THEN {t} END"
    return {
        "poll_stop": f"""SELECT date_trunc('minute', {ts}) AS fetched_at_utc, CAST(event_id AS INT) AS n, CAST(i AS INT) AS i, CASE WHEN event_id % 97 = 0 THEN '' WHEN event_id % 101 <> 0 THEN 't' || CAST(user_id % 6 AS STRING) END AS trip_id,
          'r' || CAST(event_id % 3 AS STRING) AS route_id, {day} AS start_date, CASE WHEN user_id % 6 = 5 THEN '' ELSE lpad(CAST(user_id % 6 * 3 AS STRING), 2, '0') || ':15:00' END AS start_time,
          CASE event_id % 9 WHEN 0 THEN 'CANCELED' WHEN 1 THEN 'ADDED' WHEN 2 THEN 'UNSCHEDULED' ELSE 'SCHEDULED' END AS trip_relationship, event_id % 3 = 0 AS has_vehicle,
          CASE event_id % 5 WHEN 0 THEN 0 WHEN 1 THEN NULL ELSE {epoch(ts)} - (event_id * 7) % 900 END AS stamp,
          's' || CAST((user_id + i) % 2 AS STRING) AS stop_id, CAST(i + 1 AS INT) AS stop_sequence, CASE (event_id * 3 + i) % 7 WHEN 0 THEN 'NO_DATA' WHEN 1 THEN 'SKIPPED' WHEN 2 THEN 'UNSCHEDULED' ELSE 'SCHEDULED' END AS relationship,
          CASE (event_id + i) % 6 WHEN 0 THEN 0 WHEN 1 THEN NULL ELSE {epoch(ts)} + (event_id * 13 + i * 60) % 7200 + CASE WHEN event_id % 23 = 0 THEN 60000 ELSE 0 END END AS arr_time, CAST(event_id % 400 - 100 AS INT) AS arr_delay,
          CASE (event_id + i) % 4 WHEN 0 THEN 0 ELSE {epoch(ts)} + (event_id * 13 + i * 60) % 7200 + 30 END AS dep_time, CAST(event_id % 300 - 80 AS INT) AS dep_delay
          FROM events CROSS JOIN (VALUES (0), (1), (2)) AS v(i)""",
        "sighting": f"""SELECT 'v' || CAST(user_id % 30 AS STRING) AS vehicle_id, date_trunc('hour', {ts}) AS observed_at_utc, CASE WHEN event_id % 29 = 0 THEN CAST(0.0 AS DOUBLE) ELSE CAST(-33.0 - (user_id % 30) * 0.01 - event_id % 2 * 0.001 AS DOUBLE) END AS lat,
          CASE WHEN event_id % 29 = 0 THEN CAST(0.0 AS DOUBLE) ELSE CAST(151.0 + (user_id % 30) * 0.01 AS DOUBLE) END AS lon, {plus(ts, '5')} AS fetched_at_utc, 'r' || CAST(event_id % 4 AS STRING) AS route_id, CAST(event_id AS INT) AS n FROM events""",
        "partial_call": f"""SELECT {fed} AS service_date, 't' || CAST(k AS STRING) AS trip_id, 's' || CAST(s AS STRING) AS stop_id, CAST(seq AS INT) AS stop_sequence, 'r' || CAST(k % 9 AS STRING) AS route_id,
          {maybe('q % 13 <> 0', f"CASE WHEN q % 499 = 0 THEN TIMESTAMP '1999-05-05 00:00:00' ELSE {plus(base, '(q * 37) % 100000')} END")} AS final_predicted_arrival_utc, CAST({maybe('q % 13 <> 0', 'q % 500 - 90')} AS INT) AS delay_s,
          {maybe('q % 11 <> 0', plus(base, '(q * 37) % 100000 + 20'))} AS final_predicted_departure_utc, CAST({maybe('q % 11 <> 0', 'q % 400 - 50')} AS INT) AS departure_delay_s,
          {maybe('q % 7 <> 0', plus(base, '(q * 37) % 100000 - q % 90'))} AS last_update_at_utc, {maybe('q % 13 <> 0 AND q % 7 <> 0', plus(base, '(q * 37) % 100000 - q % 90'))} AS arrival_updated_at_utc, CAST(1 + q % 60 AS INT) AS n_updates,
          CASE q % 10 WHEN 0 THEN 'SKIPPED' WHEN 1 THEN 'NO_DATA' ELSE 'SCHEDULED' END AS schedule_relationship, q % 3 <> 0 AS had_vehicle, {plus(base, '(q * 37) % 100000 + q % 5 * 30 - q % 90')} AS last_observed_at_utc, {hour} FROM {keyed} AS c""",
        "partial_trip": f"""SELECT {fed} AS start_date, 't' || CAST(k AS STRING) AS trip_id, CASE WHEN q % 5 <> 0 THEN lpad(CAST(k % 24 AS STRING), 2, '0') || ':00:00' END AS start_time, CASE WHEN q % 6 <> 0 THEN 'r' || CAST(k % 9 AS STRING) END AS route_id,
          CASE q % 7 WHEN 0 THEN 'CANCELED' WHEN 1 THEN 'ADDED' WHEN 2 THEN NULL ELSE 'SCHEDULED' END AS final_status, {maybe('q % 17 <> 0', plus(base, '(q * 41) % 100000'))} AS final_status_at_utc, CAST(q % 50 AS INT) AS scheduled_polls, CAST(CASE WHEN q % 7 = 0 OR q % 19 = 0 THEN q % 40 ELSE 0 END AS INT) AS canceled_polls, CAST(q % 3 AS INT) AS added_polls,
          {plus(base, '(q * 41) % 90000')} AS first_seen_at_utc, {plus(base, '(q * 41) % 90000 + q % 4000')} AS last_seen_at_utc, {maybe('q % 7 = 0', plus(base, '(q * 41) % 90000'))} AS first_canceled_at_utc, {maybe('q % 7 = 0', plus(base, '(q * 41) % 90000 + q % 900 - 20'))} AS last_canceled_at_utc, q % 2 = 0 AS had_vehicle, {hour} FROM {trips} AS t""",
        "partial_position": f"""SELECT 'v' || CAST(k AS STRING) AS vehicle_id, {plus(base, 'q % 97 * 1200 - 7200')} AS observed_at_utc, CAST(-33.0 - k * 0.001 AS DOUBLE) AS lat, CAST(151.0 + q % 2 * 0.001 AS DOUBLE) AS lon, {plus(base, 'q % 97 * 1200 - 7200 + q % 11')} AS fetched_at_utc, 'r' || CAST(k % 9 AS STRING) AS route_id, q AS n, {hour} FROM {trips} AS t""",
        "stop_time": f"""SELECT 't' || CAST(k AS STRING) AS trip_id, seq AS stop_sequence, CASE WHEN k % 4 <> 0 OR seq > 1 THEN {_clock('s')} END AS arrival_time, CASE WHEN k % 6 <> 0 THEN {_clock('s + 30')} END AS departure_time
          FROM (SELECT k, seq, ((k * 11) % 1560) * 60 + seq * 300 AS s FROM (SELECT DISTINCT c_custkey % 300 AS k FROM customer) AS c CROSS JOIN (VALUES (1), (2), (3), (4), (5)) AS v(seq)) AS t""",
        "audit": f"""SELECT CASE WHEN event_id % 7 = 0 THEN 'tripupdates' ELSE 'vehiclepos' END AS feed, CAST({ts} AS STRING) AS fetched_at_utc, CAST({plus(ts, 'event_id % 4')} AS STRING) AS received_at_utc, CAST(event_id % 400 AS DOUBLE) / 100 AS rtt_s,
          CASE WHEN event_id % 31 <> 0 THEN CAST({plus(ts, '1')} AS STRING) END AS server_date_utc, CASE WHEN event_id % 31 <> 0 THEN CAST(event_id % 77 AS DOUBLE) / 10 - 3 END AS skew_s, CASE WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 41 = 0 THEN 503 ELSE 200 END AS status_code,
          event_id * 17 % 90000 AS body_bytes, CASE WHEN event_id % 74 = 0 THEN 'crashed' WHEN event_id % 37 = 0 THEN 'timeout' END AS error FROM events""",
        "run": f"""SELECT CASE WHEN event_id % 9 = 0 THEN 'merger' ELSE 'compactor' END AS job, substr(CAST({ts} AS STRING), 1, 10) || 'T' || substr(CAST({ts} AS STRING), 12, 2) AS partition, {', '.join(f'event_id % {7 + i} AS {c}' for i, c in enumerate(checks.SUMMED))},
          CAST(event_id % 900 AS BIGINT) AS peak_rss_mb, CASE WHEN event_id % 50 = 0 THEN 'failed' WHEN event_id % 3 = 0 THEN '' END AS error FROM events WHERE event_type <> 'purchase'""",
        "block": f"""SELECT 'b' || lpad(CAST(b AS STRING), 10, '0') AS mesh_block_code, {', '.join(f"'{c[:3]}' || CAST(b % {7 + i} AS STRING) AS {c}" for i, c in enumerate(geography.AREA[1:]))},
          CAST(151 + (b % 12) / CAST(32 AS DOUBLE) AS DOUBLE) AS x1, CAST(151 + (b % 12 + 1) / CAST(32 AS DOUBLE) AS DOUBLE) AS x2, CAST(-34 + floor(b / 12) / CAST(32 AS DOUBLE) AS DOUBLE) AS y1, CAST(-34 + (floor(b / 12) + 1) / CAST(32 AS DOUBLE) AS DOUBLE) AS y2
          FROM (SELECT DISTINCT p_partkey % 144 AS b FROM part) AS p WHERE b % 17 <> 0""",
        "local": "SELECT 'g' || CAST(c AS STRING) AS lga_code, 'Council ' || CAST(c AS STRING) AS lga_name, CAST(151 + c % 3 / CAST(8 AS DOUBLE) AS DOUBLE) AS x1, CAST(151 + (c % 3 + 1) / CAST(8 AS DOUBLE) AS DOUBLE) AS x2, CAST(-34 + floor(c / 3) / CAST(8 AS DOUBLE) AS DOUBLE) AS y1, CAST(-34 + (floor(c / 3) + 1) / CAST(8 AS DOUBLE) AS DOUBLE) AS y2 FROM (SELECT DISTINCT n_nationkey % 9 AS c FROM nation) AS n WHERE c <> 4",
        "score": f"""SELECT sa1_code, CAST(k * 70 AS INT) AS usual_resident_population, {', '.join(f"CAST(CASE WHEN k % {3 + i} <> 1 THEN 900 + k * {i + 1} END AS DOUBLE) AS {n}_score, CAST(1 + k % 10 AS SMALLINT) AS {n}_national_decile, CAST(1 + (k + {i}) % 10 AS SMALLINT) AS {n}_state_decile, k % {4 + i} = 0 AS {n}_excluded" for i, n in enumerate(geography.INDEXES))}
          FROM (SELECT DISTINCT sa1_code, CAST(substr(sa1_code, 4) AS INT) AS k FROM (SELECT 'sa1' || CAST(p_partkey % 144 % 7 AS STRING) AS sa1_code FROM part WHERE p_partkey % 144 % 17 <> 0) AS b) AS s WHERE k <> 5""",
        "place": "SELECT 'p' || CAST(s_suppkey AS STRING) AS stop_id, CAST(-34 + (s_suppkey * 5 % 83) / CAST(256 AS DOUBLE) AS DOUBLE) AS stop_lat, CAST(151 + (s_suppkey * 7 % 109) / CAST(256 AS DOUBLE) AS DOUBLE) AS stop_lon FROM supplier",
        "centre": "SELECT CAST(n_nationkey AS STRING) AS centre_id, n_name AS centre_name, CAST(-34 + n_nationkey * 0.013 AS DOUBLE) AS latitude, CAST(151 + n_nationkey * 7 % 25 * 0.017 AS DOUBLE) AS longitude FROM nation",
        "sheet": """SELECT CASE WHEN p_partkey % 9 = 0 THEN 'note' ELSE lpad(CAST(p_partkey AS STRING), 11, '1') END AS A, CASE WHEN p_partkey % 7 = 0 THEN 'np' ELSE CAST(p_size * 9 AS STRING) END AS B, CASE WHEN p_partkey % 8 = 0 THEN '-' ELSE CAST(p_size AS STRING) || '.25' END AS C,
          CASE WHEN p_size > 25 THEN 'Y' ELSE 'N' END AS D, CASE WHEN p_size > 40 THEN 'Y' END AS E, CAST(p_size % 10 + 1 AS STRING) AS F, CASE WHEN p_partkey % 6 = 0 THEN '' ELSE CAST(p_partkey % 10 + 1 AS STRING) END AS K, p_partkey % 5 AS part FROM part""",
        "leg": """SELECT stop_id, mesh_block_code, CASE WHEN n % 5 <> 0 THEN CAST(n % 1900 AS DOUBLE) END AS distance_m, CAST(n % 700 AS DOUBLE) AS duration_s, CAST(n % 130 AS DOUBLE) AS snap_m
          FROM (SELECT 'p' || CAST(s_suppkey AS STRING) AS stop_id, 'b' || lpad(CAST(j * 3 + s_suppkey % 11 AS STRING), 10, '0') AS mesh_block_code, s_suppkey * 131 + j * 37 AS n FROM supplier CROSS JOIN (VALUES (1), (5), (9), (20), (31), (40)) AS v(j)) AS t""",
    }


def facts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    given = {name: table(spark, sf_dir, name) for name in SOURCES}
    made = facts_sql(lambda t, n: f"({t} + make_dt_interval(0, 0, 0, {n}))", lambda t: f"unix_timestamp({t})")
    return {name: _over(spark, sql, given) for name, sql in made.items()}


def updates(polls: DataFrame) -> DataFrame:
    """Polls with their stops in an array, as the feed's decoder gives them."""
    event = lambda e: F.struct(F.col(f"{e}_time").cast("long").alias("time"), F.col(f"{e}_delay").alias("delay"))
    stop = F.struct("i", "stop_id", "stop_sequence", "relationship", event("arr").alias("arrival"), event("dep").alias("departure"))
    head = ["fetched_at_utc", "n", "trip_id", "route_id", "start_date", "start_time", "trip_relationship", "has_vehicle", "stamp"]
    packed = polls.groupBy(*head).agg(F.array_sort(F.collect_list(stop)).alias("stops"))
    return packed.withColumn("stops", F.transform("stops", lambda s: s.dropFields("i")))


def boxes(df: DataFrame) -> DataFrame:
    """Corners as polygons."""
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    ring = F.array(corner("x1", "y1"), corner("x2", "y1"), corner("x2", "y2"), corner("x1", "y2"), corner("x1", "y1"))
    return df.withColumn("geom", F.array(ring).cast(POLYGON)).drop("x1", "x2", "y1", "y2")


def _blocks(t: dict[str, DataFrame]) -> DataFrame:
    return geography.clipped(boxes(t["block"]))


def _lgas(t: dict[str, DataFrame]) -> DataFrame:
    return geography.clipped(boxes(t["local"]))


def _published(t: dict[str, DataFrame]) -> DataFrame:
    return geography.stop_geography(t["place"], _blocks(t), _lgas(t), t["centre"], _counts(t), t["score"], _build(t), cbd="0")


def _snapshot_choice(t: dict[str, DataFrame]) -> DataFrame:
    rows = [(d, *merge.snapshot_for([A, B, C], d)) for d in map(date.fromisoformat, DAYS)]
    return t["block"].sparkSession.createDataFrame(rows, "day date, label string, borrowed boolean")


def _coverage(t: dict[str, DataFrame]) -> DataFrame:
    own = {"trip_stop": "partial_call", "trip": "partial_trip", "vehicle_position": "partial_position"}
    present = None
    for name, given in own.items():
        rows = t[given].where("hour <> '07'").select(F.lit(name).alias("table"), "dt", "hour").distinct()
        present = rows if present is None else present.union(rows)
    found = checks.partial_coverage(DAY, present)
    return present.sparkSession.createDataFrame([tuple(found[k] for k in ("objects_expected", "objects_read", "short"))], "objects_expected long, objects_read long, short boolean")


def _sheets(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    names = (*geography.INDEXES, "excluded")
    return {n: t["sheet"].where(F.col("part") != i) for i, n in enumerate(names)}


def _counts(t: dict[str, DataFrame]) -> DataFrame:
    return t["block"].select("mesh_block_code", F.expr("CAST(substr(mesh_block_code, 2) AS INT) % 90").alias("person_count"), F.expr("CAST(substr(mesh_block_code, 2) AS INT) % 40").alias("dwelling_count"), F.lit("Residential").alias("mesh_block_category"), F.lit(0.5).alias("area_sqkm"))


def _build(t: dict[str, DataFrame]) -> DataFrame:
    return t["block"].sparkSession.range(1).select(F.lit("2026-09-22").cast("date").alias("vintage"))


def _pairs(t: dict[str, DataFrame]) -> DataFrame:
    return geography.stop_meshblock(t["place"], _blocks(t), _counts(t), _build(t))


def _merged_calls(t: dict[str, DataFrame]) -> DataFrame:
    return merge.build_calls(t["partial_call"], DAY, t["stop_time"])


def _merged_trips(t: dict[str, DataFrame]) -> DataFrame:
    return merge.build_trips(t["partial_trip"], DAY, t["stop_time"])


def _audit(t: dict[str, DataFrame]) -> DataFrame:
    return merge.collector_run(t["audit"], AUDIT_DAY)


def _gaps(t: dict[str, DataFrame]) -> DataFrame:
    return checks.coverage_gaps(_audit(t))


HOURS = [f"2024-01-{d:02d}T{h:02d}" for d in (9, 10, 11) for h in range(24)] + ["2031-01-01T00"]

RUNS: dict[str, Callable[[dict[str, DataFrame]], DataFrame]] = {
    "calls_of_polls": lambda t: reducers.reduce_calls(updates(t["poll_stop"])),
    "trips_of_polls": lambda t: reducers.reduce_trips(updates(t["poll_stop"])),
    "first_sightings": lambda t: reducers.first_positions(t["sighting"]).select("*", *reducers.position_facts()),
    "sighting_conflicts": lambda t: reducers.position_conflicts(t["sighting"]),
    "service_day_partials": lambda t: merge.service_day_partials(t["partial_call"], DAY, t["stop_time"]),
    "merged_calls": _merged_calls,
    "merged_trips": _merged_trips,
    "merged_positions": lambda t: merge.build_positions(t["partial_position"], DAY),
    "collector_run": _audit,
    "day_measures": lambda t: checks.day_checks(_merged_calls(t), _merged_trips(t)),
    "day_breaches": lambda t: checks.breaches(checks.day_checks(_merged_calls(t), _merged_trips(t))),
    "anomalies": lambda t: checks.breach_metric(checks.day_checks(_merged_calls(t), _merged_trips(t))),
    "feed_counts": lambda t: checks.feed_counts(_audit(t)),
    "status_counts": lambda t: checks.status_counts(_audit(t)),
    "failure_counts": lambda t: checks.failure_summary(_audit(t))[0],
    "poll_timing": lambda t: checks.timing_stats(_audit(t)),
    "payloads": lambda t: checks.payload_stats(_audit(t)),
    "coverage_gaps": lambda t: _gaps(t).drop("at"),
    "worst_gaps": lambda t: checks.worst_gaps(_gaps(t)),
    "job_summary": lambda t: checks.summarize_job(t["run"].where("job = 'compactor'"), HOURS).withColumn("missing_partitions", F.concat_ws(",", "missing_partitions")),
    "mesh_block_count": lambda t: geography.mesh_block_count(t["sheet"].select(F.col("A").alias("code"), F.col("D").alias("category"), F.col("C").alias("area"), F.col("F").alias("dwellings"), F.col("B").alias("persons"))),
    "seifa_index": lambda t: geography.seifa_index(t["sheet"], population=True),
    "seifa_sa1": lambda t: geography.seifa_sa1(_sheets(t)),
    "stop_mesh_block": lambda t: geography.stop_mesh_block(t["place"], _blocks(t)),
    "stop_nearest_block": lambda t: geography.stop_nearest_block(t["place"], geography.stop_mesh_block(t["place"], _blocks(t)).select("stop_id"), _blocks(t)),
    "stop_area": lambda t: geography.stop_area(t["place"], _blocks(t)),
    "stop_centre": lambda t: geography.stop_centre(t["place"], t["centre"]),
    "stop_lga": lambda t: geography.stop_lga(t["place"], _lgas(t)),
    "published_geography": _published,
    "build_report": lambda t: geography.build_report(_published(t)),
    "snapshot_choice": _snapshot_choice,
    "partial_coverage": _coverage,
    "block_anchors": lambda t: geography.anchors(_blocks(t)).select("mesh_block_code", "anchor_lat", "anchor_lon"),
    "stop_block_pairs": _pairs,
    "legs_status": lambda t: t["leg"].withColumn("status", geography.routing_status(F.col("snap_m"), F.col("distance_m"))),
    "stop_block_routed": lambda t: geography.stop_meshblock_routed(_pairs(t), t["leg"].withColumn("status", geography.routing_status(F.col("snap_m"), F.col("distance_m")))),
    "unrouted": lambda t: geography.unrouted(_pairs(t), t["leg"]).withColumn("mesh_block_codes", F.concat_ws(",", "mesh_block_codes")),
    "publish_checks": lambda t: geography.publish_checks(geography.stop_meshblock_routed(_pairs(t), t["leg"].withColumn("status", geography.routing_status(F.col("snap_m"), F.col("distance_m"))))),
}

_FACTS = facts_sql(lambda t, n: f"({t} + to_seconds({n}))", lambda t: f"floor(epoch({t}))::BIGINT")
_INSTANT = lambda e: f"make_timestamp(nullif({e}, 0)::BIGINT * 1000000)"
_TURN = "{'f': fetched_at_utc, 'n': n, 'i': i}"
_STOP_KEY = "start_date, trip_id, stop_id, stop_sequence"
_REACHES = "abs(stop_lat - anchor_lat) <= 0.0145 AND abs(stop_lon - anchor_lon) <= 0.0175"
_METRES = lambda a, b, c, d: f"(2 * 6371008.8 * asin(sqrt(least(1.0, pow(sin((radians({c}) - radians({a})) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin(radians({d} - {b}) / 2), 2)))))"
_AREA = ", ".join(geography.AREA)
_FILED = """CASE WHEN first_hour >= 24 THEN strptime({0}, '%Y%m%d')::DATE - 1 ELSE strptime({0}, '%Y%m%d')::DATE END"""
_ZERO = checks.ZERO

#: What the queries compute, in SQL, each over those before it.
TWINS = {
    "started": f"""SELECT *, CASE WHEN start_time <> '' THEN epoch(strptime(start_date || ' ' || start_time, '%Y%m%d %H:%M:%S') AT TIME ZONE '{ZONE}') END AS start_s, coalesce({_INSTANT('stamp')}, fetched_at_utc) AS seen_at, relationship IN ('SCHEDULED', 'SKIPPED') AS is_real FROM poll_stop""",
    "told": """SELECT * FROM started WHERE n NOT IN (SELECT n FROM started WHERE nullif(arr_time, 0) - start_s >= 43200 OR nullif(dep_time, 0) - start_s >= 43200)""",
    "applied": f"""SELECT *, is_real AND coalesce(seen_at >= max(CASE WHEN is_real THEN seen_at END) OVER (PARTITION BY {_STOP_KEY} ORDER BY fetched_at_utc, n, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS applied FROM told""",
    "calls_of_polls": f"""SELECT *, coalesce(last_observed_at_utc > last_update_at_utc, false) AS lost_tracking FROM (
      SELECT start_date AS service_date, trip_id, stop_id, stop_sequence, arg_min(route_id, {_TURN}) AS route_id, {_INSTANT(f"arg_max(arr_time, {_TURN}) FILTER (WHERE applied AND coalesce(arr_time, 0) <> 0)")} AS final_predicted_arrival_utc,
        arg_max(arr_delay, {_TURN}) FILTER (WHERE applied AND coalesce(arr_time, 0) <> 0) AS delay_s, {_INSTANT(f"arg_max(dep_time, {_TURN}) FILTER (WHERE applied)")} AS final_predicted_departure_utc,
        CASE WHEN arg_max(dep_time, {_TURN}) FILTER (WHERE applied) <> 0 THEN arg_max(dep_delay, {_TURN}) FILTER (WHERE applied) END AS departure_delay_s, max(seen_at) FILTER (WHERE applied) AS last_update_at_utc,
        arg_max(seen_at, {_TURN}) FILTER (WHERE applied AND coalesce(arr_time, 0) <> 0) AS arrival_updated_at_utc, count(*) FILTER (WHERE is_real) AS n_updates, coalesce(arg_max(relationship, {_TURN}) FILTER (WHERE applied), arg_max(relationship, {_TURN})) AS schedule_relationship,
        bool_or(has_vehicle) AS had_vehicle, max(seen_at) AS last_observed_at_utc FROM applied GROUP BY {_STOP_KEY})""",
    "polled": "SELECT DISTINCT fetched_at_utc AS polled_at, n, trip_id, route_id, start_date, start_time, trip_relationship AS r, has_vehicle, CASE trip_relationship WHEN 'CANCELED' THEN 3 WHEN 'SCHEDULED' THEN 2 WHEN 'ADDED' THEN 1 ELSE 0 END AS rank FROM poll_stop WHERE trip_id <> ''",
    "trips_of_polls": """SELECT start_date, trip_id, arg_max(route_id, {'a': polled_at, 'n': n}) AS route_id, arg_max(start_time, {'a': polled_at, 'n': n}) AS start_time, arg_max(r, {'a': polled_at, 'r': rank, 'n': n}) AS final_status, max(polled_at) AS final_status_at_utc,
      count(DISTINCT polled_at) FILTER (WHERE r = 'SCHEDULED') AS scheduled_polls, count(DISTINCT polled_at) FILTER (WHERE r = 'CANCELED') AS canceled_polls, count(DISTINCT polled_at) FILTER (WHERE r = 'ADDED') AS added_polls, min(polled_at) AS first_seen_at_utc, max(polled_at) AS last_seen_at_utc,
      min(polled_at) FILTER (WHERE r = 'CANCELED') AS first_canceled_at_utc, max(polled_at) FILTER (WHERE r = 'CANCELED') AS last_canceled_at_utc, bool_or(has_vehicle) AS had_vehicle FROM polled GROUP BY start_date, trip_id""",
    "first_sightings": "SELECT *, (epoch_us(fetched_at_utc) - epoch_us(observed_at_utc)) / 1e6 AS position_age_s, lat = 0 AND lon = 0 AS null_island FROM sighting QUALIFY row_number() OVER (PARTITION BY vehicle_id, observed_at_utc, lat, lon ORDER BY fetched_at_utc, route_id, n) = 1",
    "sighting_conflicts": "SELECT coalesce(sum(places - 1), 0)::BIGINT AS dupes_differing_position FROM (SELECT count(*) AS places FROM (SELECT DISTINCT vehicle_id, observed_at_utc, lat, lon FROM sighting) GROUP BY vehicle_id, observed_at_utc)",
    "first_hour": "SELECT trip_id, split_part(arg_min(coalesce(departure_time, arrival_time), stop_sequence), ':', 1)::INT AS first_hour FROM stop_time GROUP BY trip_id",
    "service_day_partials": f"SELECT * EXCLUDE (first_hour) FROM (SELECT p.*, first_hour, {_FILED.format('service_date')} AS filed FROM partial_call p LEFT JOIN first_hour USING (trip_id)) WHERE filed = DATE '{DAY}'",
    "newest_partial": """SELECT *, dt || 'T' || hour AS h FROM service_day_partials WHERE stop_sequence IS NOT NULL""",
    "merged_calls": f"""WITH r AS (SELECT * FROM newest_partial QUALIFY row_number() OVER (PARTITION BY trip_id, stop_id, stop_sequence ORDER BY last_update_at_utc DESC NULLS LAST, last_observed_at_utc DESC NULLS LAST, h DESC) = 1),
      a AS (SELECT * FROM newest_partial WHERE arrival_updated_at_utc IS NOT NULL QUALIFY row_number() OVER (PARTITION BY trip_id, stop_id, stop_sequence ORDER BY arrival_updated_at_utc DESC, last_observed_at_utc DESC NULLS LAST, h DESC) = 1),
      s AS (SELECT trip_id, stop_id, stop_sequence, sum(n_updates)::INT AS n_updates, bool_or(had_vehicle) AS had_vehicle, max(last_observed_at_utc) AS seen FROM newest_partial GROUP BY ALL),
      m AS (SELECT r.filed AS service_date, trip_id, stop_id, stop_sequence, r.route_id, a.final_predicted_arrival_utc, a.delay_s, r.final_predicted_departure_utc, r.departure_delay_s, r.last_update_at_utc, a.arrival_updated_at_utc, s.n_updates, r.schedule_relationship, s.had_vehicle,
        coalesce(seen > r.last_update_at_utc, false) AS lost_tracking FROM r JOIN s USING (trip_id, stop_id, stop_sequence) LEFT JOIN a USING (trip_id, stop_id, stop_sequence)),
      t AS (SELECT trip_id, stop_sequence, min({_SECONDS('arrival_time')}) AS s FROM stop_time WHERE arrival_time IS NOT NULL GROUP BY ALL)
      SELECT m.*, coalesce(delay_s IS NOT NULL AND NOT lost_tracking AND final_predicted_arrival_utc >= TIMESTAMP '2000-01-01' AND arrival_updated_at_utc >= final_predicted_arrival_utc - INTERVAL 60 SECOND, false) AS is_reliable, {_WALL('service_date', 't.s')} AS scheduled_arrival_utc FROM m LEFT JOIN t USING (trip_id, stop_sequence)""",
    "merged_trips": f"""WITH p AS (SELECT p.*, {_FILED.format('start_date')} AS service_date, dt || 'T' || hour AS h FROM partial_trip p LEFT JOIN first_hour USING (trip_id)), d AS (SELECT * FROM p WHERE service_date = DATE '{DAY}')
      SELECT service_date, trip_id, start_date, arg_max(start_time, {{'s': last_seen_at_utc, 'h': h}}) AS start_time, arg_max(route_id, {{'s': last_seen_at_utc, 'h': h}}) AS route_id, arg_max(final_status, {{'s': final_status_at_utc, 'h': h}}) FILTER (WHERE final_status_at_utc IS NOT NULL) AS final_status, max(final_status_at_utc) AS final_status_at_utc,
        sum(scheduled_polls)::INT AS scheduled_polls, sum(canceled_polls)::INT AS canceled_polls, sum(added_polls)::INT AS added_polls, min(first_seen_at_utc) AS first_seen_at_utc, max(last_seen_at_utc) AS last_seen_at_utc, min(first_canceled_at_utc) AS first_canceled_at_utc, max(last_canceled_at_utc) AS last_canceled_at_utc, bool_or(had_vehicle) AS had_vehicle
      FROM d GROUP BY service_date, trip_id, start_date""",
    "merged_positions": f"""SELECT * EXCLUDE (dt, hour) FROM partial_position WHERE observed_at_utc >= {_WALL(f"DATE '{DAY}'", '-3600')} AND observed_at_utc < {_WALL(f"DATE '{DAY}'", '86400 + 25200')} QUALIFY row_number() OVER (PARTITION BY vehicle_id, observed_at_utc, lat, lon ORDER BY fetched_at_utc, route_id, n) = 1""",
    "collector_run": f"SELECT feed, fetched_at_utc::TIMESTAMP AS fetched_at_utc, received_at_utc::TIMESTAMP AS received_at_utc, rtt_s, server_date_utc::TIMESTAMP AS server_date_utc, skew_s, status_code, body_bytes, error FROM audit WHERE (fetched_at_utc::TIMESTAMP AT TIME ZONE 'UTC' AT TIME ZONE '{ZONE}')::DATE = DATE '{AUDIT_DAY}'",
    "call_marks": """SELECT *, final_predicted_arrival_utc < TIMESTAMP '2000-01-01' OR final_predicted_departure_utc < TIMESTAMP '2000-01-01' AS early,
      (final_predicted_arrival_utc >= TIMESTAMP '2000-01-01' AND abs(epoch(final_predicted_arrival_utc) - epoch(scheduled_arrival_utc)) > 43200) OR (final_predicted_departure_utc >= TIMESTAMP '2000-01-01' AND abs(epoch(final_predicted_departure_utc) - epoch(scheduled_arrival_utc)) > 43200) AS far FROM merged_calls""",
    "day_measures": """SELECT (SELECT count(*) FROM call_marks WHERE far) AS times_far_from_schedule, (SELECT count(*) FROM call_marks WHERE early) AS times_before_2000, (SELECT count(*) FROM (SELECT 1 FROM merged_calls WHERE trip_id <> '' GROUP BY trip_id, stop_id, stop_sequence HAVING count(*) > 1)) AS duplicate_stop_keys,
      (SELECT count(*) - count(DISTINCT trip_id) FROM merged_trips) AS duplicate_trip_keys, (SELECT count(*) FROM merged_trips WHERE (final_status = 'CANCELED' AND coalesce(canceled_polls, 0) = 0) OR (canceled_polls > 0 AND first_canceled_at_utc IS NULL) OR first_canceled_at_utc > last_canceled_at_utc OR first_seen_at_utc > last_seen_at_utc
        OR service_date NOT IN (strptime(start_date, '%Y%m%d')::DATE, strptime(start_date, '%Y%m%d')::DATE - 1)) AS inconsistent_trips,
      (SELECT coalesce(count(*) FILTER (WHERE scheduled_arrival_utc IS NULL) / nullif(count(*), 0), 0) FROM merged_calls WHERE trip_id <> '') AS unscheduled_share, (SELECT coalesce(count(*) FILTER (WHERE is_reliable) / nullif(count(*), 0), 0) FROM merged_calls WHERE schedule_relationship = 'SCHEDULED') AS reliable_share, (SELECT count(*) FROM merged_trips) AS trips""",
    "day_breaches": f"""SELECT name, value, "limit" FROM ({' UNION ALL '.join(f"SELECT '{n}' AS name, {n}::DOUBLE AS value, 0.0::DOUBLE AS \"limit\", {n} > 0 AS failed FROM day_measures" for n in _ZERO)} UNION ALL SELECT 'unscheduled_share', unscheduled_share, 0.03, unscheduled_share > 0.03 FROM day_measures
      UNION ALL SELECT 'reliable_share', reliable_share, 0.8, reliable_share < 0.8 FROM day_measures UNION ALL SELECT 'trips', trips, 15000, trips < 15000 FROM day_measures) WHERE failed""",
    "anomalies": "SELECT count(*) AS anomalies FROM day_breaches",
    "minutes": "SELECT min(fetched_at_utc) AS a, floor((epoch(max(fetched_at_utc)) - epoch(min(fetched_at_utc))) / 60)::BIGINT + 1 AS n FROM collector_run",
    "feed_counts": "SELECT feed, (SELECT count(*) FROM collector_run c WHERE c.feed = f.feed) AS actual, coalesce((SELECT n FROM minutes), 1440) * per AS expected FROM (VALUES ('vehiclepos', 6), ('tripupdates', 1)) f(feed, per)",
    "failures": "SELECT *, CASE WHEN error = 'crashed' THEN 'crashed' WHEN error IS NOT NULL AND status_code IS NULL THEN 'transport_error' WHEN status_code <> 200 THEN 'non_200' WHEN server_date_utc IS NULL THEN 'null_server_date' ELSE 'ok' END AS category FROM collector_run",
    "status_counts": "SELECT feed, CASE WHEN category IN ('crashed', 'transport_error') THEN category ELSE coalesce(status_code::VARCHAR, 'None') END AS status, count(*) AS n FROM failures GROUP BY ALL",
    "failure_counts": "SELECT category, count(*) AS n FROM failures GROUP BY category",
    "poll_timing": "SELECT min(rtt_s) AS rtt_s_min, median(rtt_s) AS rtt_s_median, max(rtt_s) AS rtt_s_max, min(skew_s) AS skew_s_min, median(skew_s) AS skew_s_median, max(skew_s) AS skew_s_max FROM collector_run",
    "payloads": "SELECT feed, min(body_bytes) AS minimum, median(body_bytes) AS median, max(body_bytes) AS maximum FROM collector_run GROUP BY feed",
    "gap_minutes": """SELECT minute, turn, coalesce(c, 0) AS count FROM (SELECT turn, strftime(date_trunc('minute', a) + to_minutes(turn), '%H:%M') AS minute FROM minutes, range(0, n) t(turn))
      LEFT JOIN (SELECT strftime(fetched_at_utc, '%H:%M') AS minute, count(*) AS c FROM collector_run WHERE feed = 'vehiclepos' AND error IS NULL GROUP BY ALL) USING (minute) WHERE coalesce(c, 0) < 6""",
    "coverage_gaps": "SELECT minute, count FROM gap_minutes",
    "worst_gaps": "SELECT minute, count FROM gap_minutes ORDER BY count, turn LIMIT 10",
    "job_summary": f"""WITH p AS (SELECT partition, turn, bool_or(r.job IS NOT NULL) AS seen, {', '.join(f'coalesce(sum({c}), 0)::BIGINT AS {c}' for c in checks.SUMMED)}, max(peak_rss_mb) AS peak_rss_mb, count(*) FILTER (WHERE error <> '') AS errors
        FROM (VALUES {', '.join(f"('{h}', {i})" for i, h in enumerate(HOURS))}) o(partition, turn) LEFT JOIN (SELECT * FROM run WHERE job = 'compactor') r USING (partition) GROUP BY partition, turn)
      SELECT count(*) AS runs_expected, count(*) FILTER (WHERE seen) AS runs_seen, coalesce(string_agg(partition, ',' ORDER BY turn) FILTER (WHERE NOT seen), '') AS missing_partitions, {', '.join(f'sum({c})::BIGINT AS {c}' for c in checks.SUMMED)}, coalesce(max(peak_rss_mb), 0) AS peak_rss_mb, sum(errors)::BIGINT AS errors FROM p""",
    "mesh_block_count": "SELECT A AS mesh_block_code, D AS mesh_block_category, try_cast(C AS DOUBLE) AS area_sqkm, try_cast(F AS INT) AS dwelling_count, try_cast(B AS INT) AS person_count FROM sheet WHERE length(A) = 11",
    "seifa_index": "SELECT A AS sa1_code, try_cast(B AS INT) AS usual_resident_population, try_cast(C AS DOUBLE) AS score, try_cast(F AS SMALLINT) AS national_decile, try_cast(K AS SMALLINT) AS state_decile FROM sheet WHERE length(A) = 11",
    "seifa_sa1": f"""WITH {', '.join(f"s{i} AS (SELECT A AS sa1_code, try_cast(B AS INT) AS people, try_cast(C AS DOUBLE) AS score, try_cast(F AS SMALLINT) AS nd, try_cast(K AS SMALLINT) AS sd FROM sheet WHERE length(A) = 11 AND part <> {i})" for i in range(4))}, x AS (SELECT * FROM sheet WHERE length(A) = 11 AND part <> 4),
      k AS ({' UNION '.join(f'SELECT sa1_code FROM s{i}' for i in range(4))})
      SELECT sa1_code, s0.people AS usual_resident_population, {', '.join(f's{i}.score AS {n}_score, s{i}.nd AS {n}_national_decile, s{i}.sd AS {n}_state_decile' for i, n in enumerate(geography.INDEXES))}, {', '.join(f"coalesce(x.{c} = 'Y', false) AS {n}_excluded" for n, c in zip(geography.INDEXES, 'CDEF', strict=True))}
      FROM k {' '.join(f'LEFT JOIN s{i} USING (sa1_code)' for i in range(4))} LEFT JOIN x ON x.A = sa1_code""",
    "inside": "SELECT stop_id, block.* EXCLUDE (x1, x2, y1, y2) FROM place JOIN block ON stop_lon BETWEEN x1 AND x2 AND stop_lat BETWEEN y1 AND y2",
    "stop_mesh_block": f"SELECT stop_id, {_AREA}, ties > 1 AS boundary_tie FROM (SELECT *, count(*) OVER (PARTITION BY stop_id) AS ties, row_number() OVER (PARTITION BY stop_id ORDER BY mesh_block_code) AS rank FROM inside) WHERE rank = 1",
    "stop_nearest_block": f"""SELECT stop_id, {_AREA}, {_METRES('py', 'px', 'stop_lat', 'stop_lon')} AS distance_m FROM (SELECT *, least(greatest(stop_lon, x1), x2) AS px, least(greatest(stop_lat, y1), y2) AS py FROM place CROSS JOIN block WHERE stop_id NOT IN (SELECT stop_id FROM stop_mesh_block))
      QUALIFY row_number() OVER (PARTITION BY stop_id ORDER BY pow(px - stop_lon, 2) + pow(py - stop_lat, 2), mesh_block_code) = 1""",
    "stop_area": f"SELECT stop_id, {_AREA}, 'inside' AS geography_match, 0.0 AS geography_match_distance_m, boundary_tie FROM stop_mesh_block UNION ALL SELECT stop_id, {_AREA}, 'nearest', distance_m, false FROM stop_nearest_block",
    "stop_centre": f"SELECT stop_id, centre_id AS nearest_centre_id, centre_name AS nearest_centre_name, d AS distance_to_nearest_centre_m FROM (SELECT *, {_METRES('stop_lat', 'stop_lon', 'latitude', 'longitude')} AS d FROM place CROSS JOIN centre) QUALIFY row_number() OVER (PARTITION BY stop_id ORDER BY d, centre_id) = 1",
    "stop_lga": "SELECT stop_id, lga_code, lga_name FROM place JOIN local ON stop_lon BETWEEN x1 AND x2 AND stop_lat BETWEEN y1 AND y2 QUALIFY row_number() OVER (PARTITION BY stop_id ORDER BY lga_code) = 1",
    "published_geography": f"""SELECT stop_id, stop_lat, stop_lon, a.mesh_block_code, CASE WHEN b.mesh_block_code IS NOT NULL THEN 'Residential' END AS mesh_block_category, {', '.join(f'a.{c}' for c in geography.AREA[1:])}, lga_code, lga_name, geography_match, geography_match_distance_m, boundary_tie,
      {', '.join(f's.{n}_{x}' for n in geography.INDEXES for x in ('score', 'national_decile', 'state_decile'))}, s.usual_resident_population AS sa1_usual_resident_population, coalesce(s.irsd_excluded, false) AS seifa_irsd_excluded,
      {_METRES('c.latitude', 'c.longitude', 'stop_lat', 'stop_lon')} AS distance_to_cbd_m, nearest_centre_id, nearest_centre_name, distance_to_nearest_centre_m, DATE '2026-09-22' AS vintage
      FROM place LEFT JOIN stop_area a USING (stop_id) LEFT JOIN stop_lga USING (stop_id) LEFT JOIN stop_centre USING (stop_id) LEFT JOIN block b ON b.mesh_block_code = a.mesh_block_code LEFT JOIN score s ON s.sa1_code = a.sa1_code CROSS JOIN (SELECT * FROM centre WHERE centre_id = '0') c""",
    "build_report": "SELECT count(*) AS stops, count(*) FILTER (WHERE geography_match = 'inside') AS inside, count(*) FILTER (WHERE geography_match = 'nearest') AS nearest, count(*) FILTER (WHERE boundary_tie) AS boundary_ties, count(*) FILTER (WHERE irsd_score IS NULL) AS unscored FROM published_geography",
    "labelled": f"SELECT label, (strptime(label, '%Y-%m-%dT%H%M%SZ') AT TIME ZONE 'UTC' AT TIME ZONE '{ZONE}')::DATE AS since FROM (VALUES ('{A}'), ('{B}'), ('{C}')) t(label)",
    "snapshot_choice": f"SELECT day, coalesce((SELECT max(label) FROM labelled WHERE since <= day), (SELECT min(label) FROM labelled)) AS label, NOT EXISTS (SELECT 1 FROM labelled WHERE since <= day) AS borrowed FROM (VALUES {', '.join(f'(DATE {chr(39)}{d}{chr(39)})' for d in DAYS)}) t(day)",
    "owed": f"SELECT tbl, strftime(h, '%Y-%m-%d') AS dt, strftime(h, '%H') AS hour FROM (SELECT unnest(generate_series({_WALL(f"DATE '{DAY}'", '-3600')}, {_WALL(f"DATE '{DAY}'", '86400 + 25200')} - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS h) CROSS JOIN (VALUES ('trip_stop'), ('trip'), ('vehicle_position')) t(tbl)",
    "partial_coverage": """SELECT (SELECT count(*) FROM owed) AS objects_expected, n AS objects_read, n < (SELECT count(*) FROM owed) AS short FROM (SELECT count(*) AS n FROM owed WHERE hour <> '07' AND (tbl, dt, hour) IN (SELECT ('trip_stop', dt, hour) FROM partial_call UNION SELECT ('trip', dt, hour) FROM partial_trip UNION SELECT ('vehicle_position', dt, hour) FROM partial_position))""",
    "block_anchors": "SELECT mesh_block_code, sa1_code, (y1 + y2) / 2 + (y2 - y1) * 1e-7 AS anchor_lat, (x1 + x2) / 2 AS anchor_lon FROM block",
    "stop_block_pairs": f"""SELECT stop_id, mesh_block_code, d AS straight_line_distance_m, NULL::DOUBLE AS network_distance_m, NULL::DOUBLE AS network_duration_s, 'not_attempted' AS routing_status, substr(mesh_block_code, 2)::INT % 90 AS person_count, substr(mesh_block_code, 2)::INT % 40 AS dwelling_count, 'Residential' AS mesh_block_category, sa1_code, 0.5 AS area_sqkm, DATE '2026-09-22' AS vintage
      FROM (SELECT *, {_METRES('anchor_lat', 'anchor_lon', 'stop_lat', 'stop_lon')} AS d FROM place JOIN block_anchors ON {_REACHES}) WHERE d <= 1600""",
    "legs_status": "SELECT *, CASE WHEN snap_m > 100 THEN 'snap_failed' WHEN distance_m IS NULL THEN 'unroutable' ELSE 'routed' END AS status FROM leg",
    "stop_block_routed": """SELECT *, network_distance_m / nullif(straight_line_distance_m, 0) AS detour_ratio FROM (SELECT p.* REPLACE (CASE WHEN status = 'routed' THEN distance_m END AS network_distance_m, CASE WHEN status = 'routed' THEN duration_s END AS network_duration_s, coalesce(status, routing_status) AS routing_status) FROM stop_block_pairs p LEFT JOIN legs_status USING (stop_id, mesh_block_code))""",
    "unrouted": "SELECT stop_id, string_agg(mesh_block_code, ',' ORDER BY mesh_block_code) AS mesh_block_codes FROM stop_block_pairs p WHERE NOT EXISTS (SELECT 1 FROM leg l WHERE l.stop_id = p.stop_id AND l.mesh_block_code = p.mesh_block_code) GROUP BY stop_id",
    "publish_checks": "SELECT count(*) AS pairs, count(*) FILTER (WHERE routing_status = 'routed') AS routed, median(detour_ratio) AS median_detour, count(*) FILTER (WHERE detour_ratio < 0.999) AS impossible_detours FROM stop_block_routed",
}


def _run(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return shown(RUNS[name](facts(session.ensure(spark), sf_dir)))

    return query

#: The registered queries and their columns.
COLUMNS = {
    "s03_calls_of_polls": "service_date string, trip_id string, stop_id string, stop_sequence int, route_id string, final_predicted_arrival_utc timestamp, delay_s int, final_predicted_departure_utc timestamp, departure_delay_s int, last_update_at_utc timestamp, arrival_updated_at_utc timestamp, n_updates int, schedule_relationship string, had_vehicle boolean, lost_tracking boolean, last_observed_at_utc timestamp",
    "s07_trips_of_polls": "start_date string, trip_id string, route_id string, start_time string, final_status string, final_status_at_utc timestamp, scheduled_polls int, canceled_polls int, added_polls int, first_seen_at_utc timestamp, last_seen_at_utc timestamp, first_canceled_at_utc timestamp, last_canceled_at_utc timestamp, had_vehicle boolean",
    "s08_first_sightings": "vehicle_id string, observed_at_utc timestamp, lat double, lon double, fetched_at_utc timestamp, route_id string, n int, position_age_s double, null_island boolean",
    "s08b_sighting_conflicts": "dupes_differing_position bigint",
    "v28_service_day_partials": "trip_id string, service_date string, stop_id string, stop_sequence int, route_id string, final_predicted_arrival_utc timestamp, delay_s int, final_predicted_departure_utc timestamp, departure_delay_s int, last_update_at_utc timestamp, arrival_updated_at_utc timestamp, n_updates int, schedule_relationship string, had_vehicle boolean, last_observed_at_utc timestamp, hour string, dt string, filed date",
    "v29_merged_calls": "service_date date, trip_id string, stop_id string, stop_sequence int, route_id string, final_predicted_arrival_utc timestamp, delay_s int, final_predicted_departure_utc timestamp, departure_delay_s int, last_update_at_utc timestamp, arrival_updated_at_utc timestamp, n_updates int, schedule_relationship string, had_vehicle boolean, lost_tracking boolean, is_reliable boolean, scheduled_arrival_utc timestamp",
    "v31_merged_trips": "service_date date, trip_id string, start_date string, start_time string, route_id string, final_status string, final_status_at_utc timestamp, scheduled_polls int, canceled_polls int, added_polls int, first_seen_at_utc timestamp, last_seen_at_utc timestamp, first_canceled_at_utc timestamp, last_canceled_at_utc timestamp, had_vehicle boolean",
    "v32_merged_positions": "vehicle_id string, observed_at_utc timestamp, lat double, lon double, fetched_at_utc timestamp, route_id string, n bigint",
    "v33_collector_run": "feed string, fetched_at_utc timestamp, received_at_utc timestamp, rtt_s double, server_date_utc timestamp, skew_s double, status_code int, body_bytes bigint, error string",
    "v34_day_measures": "times_far_from_schedule bigint, times_before_2000 bigint, duplicate_stop_keys bigint, duplicate_trip_keys bigint, inconsistent_trips bigint, unscheduled_share double, reliable_share double, trips bigint",
    "v34b_day_breaches": "name string, value double, limit double",
    "v34c_anomalies": "anomalies bigint",
    "v36_feed_counts": "feed string, actual bigint, expected bigint",
    "v36b_status_counts": "feed string, status string, n bigint",
    "v36c_failure_counts": "category string, n bigint",
    "v36d_poll_timing": "rtt_s_min double, rtt_s_median double, rtt_s_max double, skew_s_min double, skew_s_median double, skew_s_max double",
    "v36e_payloads": "feed string, minimum bigint, median double, maximum bigint",
    "v36f_coverage_gaps": "minute string, count bigint",
    "v36g_worst_gaps": "minute string, count bigint",
    "v37_job_summary": "runs_expected bigint, runs_seen bigint, missing_partitions string, objects_expected bigint, objects_read bigint, rows_in bigint, rows_out bigint, dupes_collapsed bigint, dupes_differing_position bigint, unjoined_route_ids bigint, unjoined_trip_ids bigint, unjoined_stop_ids bigint, peak_rss_mb bigint, errors bigint",
    "v41_mesh_block_count": "mesh_block_code string, mesh_block_category string, area_sqkm double, dwelling_count int, person_count int",
    "v42_seifa_index": "sa1_code string, usual_resident_population int, score double, national_decile smallint, state_decile smallint",
    "v43_seifa_sa1": "sa1_code string, usual_resident_population int, irsd_score double, irsd_national_decile smallint, irsd_state_decile smallint, irsad_score double, irsad_national_decile smallint, irsad_state_decile smallint, ier_score double, ier_national_decile smallint, ier_state_decile smallint, ieo_score double, ieo_national_decile smallint, ieo_state_decile smallint, irsd_excluded boolean, irsad_excluded boolean, ier_excluded boolean, ieo_excluded boolean",
    "v44_stop_mesh_block": "stop_id string, mesh_block_code string, sa1_code string, sa2_code string, sa2_name string, sa3_code string, sa3_name string, sa4_code string, sa4_name string, gccsa_code string, gccsa_name string, boundary_tie boolean",
    "v45_stop_nearest_block": "stop_id string, mesh_block_code string, sa1_code string, sa2_code string, sa2_name string, sa3_code string, sa3_name string, sa4_code string, sa4_name string, gccsa_code string, gccsa_name string, distance_m double",
    "v46_stop_area": "stop_id string, mesh_block_code string, sa1_code string, sa2_code string, sa2_name string, sa3_code string, sa3_name string, sa4_code string, sa4_name string, gccsa_code string, gccsa_name string, geography_match string, geography_match_distance_m double, boundary_tie boolean",
    "v46b_stop_centre": "stop_id string, nearest_centre_id string, nearest_centre_name string, distance_to_nearest_centre_m double",
    "v47_block_anchors": "mesh_block_code string, anchor_lat double, anchor_lon double",
    "v47b_stop_block_pairs": "stop_id string, mesh_block_code string, straight_line_distance_m double, network_distance_m double, network_duration_s double, routing_status string, person_count int, dwelling_count int, mesh_block_category string, sa1_code string, area_sqkm double, vintage date",
    "v48_legs_status": "stop_id string, mesh_block_code string, distance_m double, duration_s double, snap_m double, status string",
    "v48b_stop_block_routed": "stop_id string, mesh_block_code string, straight_line_distance_m double, person_count int, dwelling_count int, mesh_block_category string, sa1_code string, area_sqkm double, vintage date, network_distance_m double, network_duration_s double, routing_status string, detour_ratio double",
    "v48c_unrouted": "stop_id string, mesh_block_codes string",
    "v49_publish_checks": "pairs bigint, routed bigint, median_detour double, impossible_detours bigint",
    "v46c_stop_lga": "stop_id string, lga_code string, lga_name string",
    "v46d_published_geography": "stop_id string, stop_lat double, stop_lon double, mesh_block_code string, mesh_block_category string, sa1_code string, sa2_code string, sa2_name string, sa3_code string, sa3_name string, sa4_code string, sa4_name string, gccsa_code string, gccsa_name string, lga_code string, lga_name string, geography_match string, geography_match_distance_m double, boundary_tie boolean, irsd_score double, irsd_national_decile smallint, irsd_state_decile smallint, irsad_score double, irsad_national_decile smallint, irsad_state_decile smallint, ier_score double, ier_national_decile smallint, ier_state_decile smallint, ieo_score double, ieo_national_decile smallint, ieo_state_decile smallint, sa1_usual_resident_population int, seifa_irsd_excluded boolean, distance_to_cbd_m double, nearest_centre_id string, nearest_centre_name string, distance_to_nearest_centre_m double, vintage date",
    "v49b_build_report": "stops bigint, inside bigint, nearest bigint, boundary_ties bigint, unscored bigint",
    "v35_snapshot_choice": "day date, label string, borrowed boolean",
    "v39_partial_coverage": "objects_expected bigint, objects_read bigint, short boolean",
}

register(COLUMNS, _run, _FACTS | TWINS)
