"""Registered queries over the generic tables and their SQL twins.

The service tables don't come with the generic test data, so each query applies
the engine's operators to the star schema and the event stream: an event type
plays a route, a user a stop, an order a trip and its lines the trip's calls.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from punctual import session
from punctual.functions.aggregates import count_where, excess_wait, first_known, last_known, ratio, sum_where, weighted_mean
from punctual.functions.geo import POLYGON, edges, haversine, meets
from punctual.functions.timeline import clock_seconds, compact_day, elapsed, local_date, rounded, service_hour, trip_instant, wall_instant
from punctual.operators import relational as op

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
FLAGSHIP = "q01_stop_hour_mart"


def query(sql: str | None = None) -> Callable:
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(session.ensure(spark), sf_dir)

        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their time as an instant."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def dated(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.col(column).cast("date"))


CELL = ["event_date", "event_type", "event_hour"]
HEADWAY_SQL = """
gaps AS (
  SELECT ts::DATE AS event_date, event_type, extract(hour FROM ts)::BIGINT AS event_hour, value, ts, event_id,
    (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY ts::DATE, event_type ORDER BY ts, event_id)) / 1e6 AS gap
  FROM events)"""


def _gaps(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("event_date", F.col("ts").cast("date")).withColumn("event_hour", F.hour("ts").cast("long"))
    return op.previous(rows, ["event_date", "event_type"], "event_hour", "ts", "event_id", "before").withColumn("gap", elapsed(F.col("ts"), F.col("before")))


@query(f"""WITH {HEADWAY_SQL},
observed AS (SELECT ts::DATE AS event_date, event_type, extract(hour FROM ts)::BIGINT AS event_hour,
    (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY ts::DATE, event_type ORDER BY ts, event_id)) / 1e6 AS gap
  FROM events WHERE value >= 20),
a AS (SELECT event_date, event_type, event_hour, count(*) AS n_events, count(*) FILTER (WHERE value > 50) AS n_large,
    count(gap) AS n_gaps, sum(gap) AS s, sum(gap * gap) AS q FROM gaps GROUP BY ALL),
b AS (SELECT event_date, event_type, event_hour, count(gap) AS observed_gaps, sum(gap) AS s, sum(gap * gap) AS q FROM observed GROUP BY ALL)
SELECT event_date, event_type, event_hour, n_events, n_large, n_gaps, round(a.s, 6) AS gap_sum_s, round(a.q, 4) AS gap_sq_s,
  coalesce(observed_gaps, 0) AS observed_gaps, round(b.q / nullif(2 * b.s, 0) - a.q / nullif(2 * a.s, 0), 6) AS excess_wait_s
FROM a LEFT JOIN b USING (event_date, event_type, event_hour)""")
def q01_stop_hour_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("event_id", "ts", "event_type", "value")
    gap = F.col("gap")
    a = _gaps(rows).groupBy(*CELL).agg(F.count("*").alias("n_events"), count_where(F.col("value") > 50).alias("n_large"), F.count(gap).alias("n_gaps"), F.sum(gap).alias("s"), F.sum(gap * gap).alias("q"))
    b = _gaps(rows.where("value >= 20")).groupBy(*CELL).agg(F.count(gap).alias("observed_gaps"), F.sum(gap).alias("os"), F.sum(gap * gap).alias("oq"))
    out = a.join(b, CELL, "left")
    wait = excess_wait(F.col("oq"), F.col("os"), F.col("q"), F.col("s"))
    return out.select(*CELL, "n_events", "n_large", "n_gaps", F.round("s", 6).alias("gap_sum_s"), F.round("q", 4).alias("gap_sq_s"), F.coalesce("observed_gaps", F.lit(0)).alias("observed_gaps"), F.round(wait, 6).alias("excess_wait_s"))


@query("SELECT event_id, user_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def q02_latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).withColumn("label", F.struct("ts", "event_id"))
    return op.newest(rows.select("user_id", "label", "event_id", "event_type", "value"), ["user_id"], "label").select("event_id", "user_id", "event_type", "value")


@query("SELECT DISTINCT ON (user_id, event_type, ts::DATE) user_id, event_type, ts::DATE AS day, event_id, value FROM events ORDER BY user_id, event_type, ts::DATE, ts, event_id")
def q03_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).withColumn("day", F.col("ts").cast("date"))
    return op.latest_per_key(rows, ["user_id", "event_type", "day"], F.col("ts").asc_nulls_last(), F.col("event_id").asc_nulls_last()).select("user_id", "event_type", "day", "event_id", "value")


@query("""SELECT user_id, arg_max(nullif(event_type, 'error'), event_id) AS last_type, arg_min(nullif(event_type, 'error'), event_id) AS first_type,
  arg_max(value, {'v': value, 'i': event_id}) AS largest, arg_max(event_id, {'v': value, 'i': event_id}) AS largest_id FROM events GROUP BY user_id""")
def q04_arg_max_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    known, key = F.nullif("event_type", F.lit("error")), F.struct("value", "event_id")
    return events(spark, sf_dir).groupBy("user_id").agg(last_known(known, F.col("event_id")).alias("last_type"), first_known(known, F.col("event_id")).alias("first_type"), F.max_by("value", key).alias("largest"), F.max_by("event_id", key).alias("largest_id"))


@query("SELECT user_id, event_type, count(*) AS n_updates, round(sum(value), 2) AS total, arg_max(value, event_id) AS last_value, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_at FROM events GROUP BY ALL")
def q05_partials_then_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, at = ["user_id", "event_type"], F.struct("event_id")
    hourly = events(spark, sf_dir).groupBy(*key, F.date_trunc("hour", "ts").alias("hour")).agg(F.count("*").alias("n"), F.sum("value").alias("s"), F.max(F.struct("event_id", "value")).alias("last"), F.max("ts").alias("at"))
    merged = hourly.groupBy(*key).agg(F.sum("n").alias("n_updates"), F.round(F.sum("s"), 2).alias("total"), F.max("last")["value"].alias("last_value"), F.max("at").alias("at"))
    return merged.select(*key, "n_updates", "total", "last_value", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("last_at"))


@query("SELECT (ts - INTERVAL 4 HOUR)::DATE AS service_date, strftime((ts - INTERVAL 4 HOUR)::DATE, '%Y%m%d') AS label, count(*) AS n, count(*) FILTER (WHERE extract(hour FROM ts) < 4) AS n_past_midnight FROM events GROUP BY ALL")
def q06_service_day_rollover(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = (F.col("ts") - F.expr("interval 4 hours")).cast("date")
    return events(spark, sf_dir).groupBy(day.alias("service_date")).agg(F.count("*").alias("n"), count_where(F.hour("ts") < 4).alias("n_past_midnight")).withColumn("label", compact_day(F.col("service_date")))


@query("SELECT ((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Australia/Sydney')::DATE AS local_day, count(*) AS n, round(sum(value), 2) AS total FROM events WHERE ts >= TIMESTAMP '2024-01-09 13:00:00' AND ts < TIMESTAMP '2024-01-19 13:00:00' GROUP BY ALL")
def q07_local_day_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = (wall_instant(F.to_date(F.lit(d)), F.lit(0)) for d in ("2024-01-10", "2024-01-20"))
    rows = events(spark, sf_dir).where((F.col("ts") >= start) & (F.col("ts") < end))
    return rows.groupBy(local_date(F.col("ts")).alias("local_day")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("""WITH c AS (SELECT o_orderkey, o_orderdate::DATE AS d, (o_orderkey % 30)::INTEGER AS h, (o_orderkey % 60)::INTEGER AS m FROM orders),
s AS (SELECT *, h * 3600 + m * 60 AS s FROM c)
SELECT o_orderkey, lpad(h::VARCHAR, 2, '0') || ':' || lpad(m::VARCHAR, 2, '0') || ':00' AS clock, s AS seconds, (s // 3600)::INTEGER AS hour,
  strftime(((d::TIMESTAMP + to_seconds(s)) AT TIME ZONE 'Australia/Sydney') AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS starts_utc,
  strftime((((d::TIMESTAMP + to_seconds(s)) AT TIME ZONE 'Australia/Sydney') + to_seconds(900)) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS calls_utc
FROM s""")
def q08_clock_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dated(table(spark, sf_dir, "orders"), "o_orderdate")
    pad = lambda n: F.lpad((F.col("o_orderkey") % n).cast("string"), 2, "0")
    rows = rows.withColumn("clock", F.concat_ws(":", pad(30), pad(60), F.lit("00"))).withColumn("seconds", clock_seconds(F.col("clock")))
    s, text = F.col("seconds"), lambda t: F.date_format(t, "yyyy-MM-dd HH:mm:ss")
    return rows.select("o_orderkey", "clock", "seconds", service_hour(s).alias("hour"), text(wall_instant(F.col("o_orderdate"), s)).alias("starts_utc"), text(trip_instant(F.col("o_orderdate"), s, s + 900)).alias("calls_utc"))


@query("""WITH snap AS (SELECT o_orderdate::DATE AS check_date, max(o_orderkey) AS label FROM orders GROUP BY ALL),
days AS (SELECT DISTINCT l_shipdate::DATE - 400 AS day FROM lineitem)
SELECT day, coalesce((SELECT arg_max(label, check_date) FROM snap WHERE check_date <= day), (SELECT arg_min(label, check_date) FROM snap)) AS label,
  NOT EXISTS (SELECT 1 FROM snap WHERE check_date <= day) AS label_borrowed FROM days""")
def q09_as_of_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    snaps = dated(table(spark, sf_dir, "orders"), "o_orderdate").groupBy(F.col("o_orderdate").alias("check_date")).agg(F.max("o_orderkey").alias("key"))
    days = table(spark, sf_dir, "lineitem").select(F.date_sub(F.col("l_shipdate").cast("date"), 400).alias("day")).distinct()
    return op.as_of(days, snaps, "day", "check_date", "key", "label")


@query("""(SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1996 UNION SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1998)
EXCEPT SELECT o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' AND l_quantity > 45""")
def q10_active_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    in_year = lambda y: orders.where(F.year("o_orderdate") == y).select("o_custkey")
    returned = orders.join(lines.where("l_returnflag = 'R' and l_quantity > 45"), F.col("o_orderkey") == F.col("l_orderkey")).select("o_custkey")
    return in_year(1996).union(in_year(1998)).distinct().subtract(returned)


@query("""WITH x AS (SELECT min(o_orderdate)::DATE AS a, max(o_orderdate)::DATE AS b FROM orders),
days AS (SELECT unnest(generate_series(a, b, INTERVAL 1 DAY))::DATE AS day FROM x),
busy AS (SELECT o_orderdate::DATE AS day FROM orders GROUP BY ALL HAVING count(*) >= 8)
SELECT day, isodow(day)::BIGINT AS weekday FROM days WHERE isodow(day) <= 5 AND day NOT IN (SELECT day FROM busy)""")
def q11_term_weekdays(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = dated(table(spark, sf_dir, "orders"), "o_orderdate")
    span = orders.agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    busy = orders.groupBy(F.col("o_orderdate").alias("day")).count().where("count >= 8")
    days = op.expand_days(span, "a", "b").select("day", (F.weekday("day") + 1).cast("long").alias("weekday"))
    return days.where("weekday <= 5").join(busy, "day", "left_anti")


@query("""WITH planned AS (SELECT DISTINCT l_orderkey AS k, l_suppkey AS s FROM lineitem WHERE l_linestatus = 'O'),
seen AS (SELECT DISTINCT l_orderkey AS k, l_suppkey AS s FROM lineitem WHERE l_returnflag = 'A' AND EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F'))
SELECT k, s, (k, s) IN (SELECT (k, s) FROM planned) AS is_planned FROM (SELECT * FROM planned UNION SELECT * FROM seen)""")
def q12_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, done = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    planned = lines.where("l_linestatus = 'O'")
    seen = lines.where("l_returnflag = 'A'").join(done, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    both = planned.withColumn("p", F.lit(True)).unionByName(seen.withColumn("p", F.lit(False)))
    return both.groupBy(F.col("l_orderkey").alias("k"), F.col("l_suppkey").alias("s")).agg(F.bool_or("p").alias("is_planned"))


@query("""WITH u AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
SELECT l_orderkey, l_linenumber, l_linenumber = min(l_linenumber) OVER w AS is_first, l_linenumber = max(l_linenumber) OVER w AS is_last,
  arg_min(l_linenumber * 10, l_linenumber) OVER w AS start_s FROM u WINDOW w AS (PARTITION BY l_orderkey)""")
def q13_first_last_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, n = Window.partitionBy("l_orderkey"), F.col("l_linenumber")
    calls = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    return calls.select("l_orderkey", n, (n == F.min(n).over(w)).alias("is_first"), (n == F.max(n).over(w)).alias("is_last"), F.min_by(n * 10, n).over(w).alias("start_s"))


@query("""SELECT o_orderkey, l_suppkey, l_quantity FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY (l_suppkey = o_custkey % 100) DESC NULLS LAST, l_suppkey NULLS LAST, l_quantity NULLS LAST) = 1""")
def q14_preferred_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    same = F.col("l_suppkey") == F.col("o_custkey") % 100
    return op.latest_per_key(joined, ["o_orderkey"], same.desc_nulls_last(), F.col("l_suppkey").asc_nulls_last(), F.col("l_quantity").asc_nulls_last()).select("o_orderkey", "l_suppkey", "l_quantity")


@query("""SELECT event_type, CASE WHEN t = 'skipped' THEN 'skipped' WHEN v IS NOT NULL THEN 'observed' WHEN event_type = 'error' THEN 'cancelled' WHEN value < 60 THEN 'no_prediction' ELSE 'absent' END AS status,
  count(*) AS n, count(*) FILTER (WHERE t IS DISTINCT FROM 'kept') AS n_not_kept FROM (SELECT *, CASE WHEN event_id % 17 = 0 THEN 'skipped' WHEN event_id % 3 = 0 THEN 'kept' END AS t, CASE WHEN value < 40 THEN value END AS v FROM events) GROUP BY ALL""")
def q15_status_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).withColumn("t", F.when(F.expr("event_id % 17 = 0"), "skipped").when(F.expr("event_id % 3 = 0"), "kept")).withColumn("v", F.when(F.col("value") < 40, F.col("value")))
    status = F.when(F.col("t") == "skipped", "skipped").when(F.col("v").isNotNull(), "observed").when(F.col("event_type") == "error", "cancelled").when(F.col("value") < 60, "no_prediction").otherwise("absent")
    return rows.groupBy("event_type", status.alias("status")).agg(F.count("*").alias("n"), count_where(~F.col("t").eqNullSafe("kept")).alias("n_not_kept"))


@query("""WITH b AS (SELECT 'scheduled' AS basis, user_id, event_type, event_id, (epoch_us(ts) - lag(epoch_us(ts)) OVER w) / 1e6 AS headway_s FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id)
UNION ALL SELECT 'observed', user_id, event_type, event_id, (epoch_us(ts) - lag(epoch_us(ts)) OVER w) / 1e6 FROM events WHERE value > 30 WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id))
SELECT basis, user_id, event_type, event_id, headway_s FROM b WHERE headway_s IS NOT NULL""")
def q16_headways(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id", "event_type").orderBy("ts", "event_id")

    def gaps(rows: DataFrame, basis: str) -> DataFrame:
        return rows.select(F.lit(basis).alias("basis"), "user_id", "event_type", "event_id", elapsed(F.col("ts"), F.lag("ts").over(w)).alias("headway_s")).where("headway_s is not null")

    rows = events(spark, sf_dir)
    return gaps(rows, "scheduled").unionByName(gaps(rows.where("value > 30"), "observed"))


@query(f"""WITH {HEADWAY_SQL}, m AS (SELECT *, avg(gap) OVER (PARTITION BY event_date, event_type, event_hour) AS mean FROM gaps WHERE gap IS NOT NULL)
SELECT event_date, event_type, event_hour, count(*) AS n, count(*) FILTER (WHERE gap < 0.25 * mean) AS n_bunched, any_value(0.25 * mean < 90) AS below_precision,
  CASE WHEN sum(gap) <= 600 * count(*) THEN '<=10' WHEN sum(gap) <= 1200 * count(*) THEN '10-20' ELSE '>20' END AS band FROM m GROUP BY ALL""")
def q17_bands_and_bunching(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = _gaps(events(spark, sf_dir)).where("gap is not null").withColumn("mean", F.avg("gap").over(Window.partitionBy(*CELL)))
    total, n = F.sum("gap"), F.count("*")
    band = F.when(total <= 600 * n, "<=10").when(total <= 1200 * n, "10-20").otherwise(">20")
    return gaps.groupBy(*CELL).agg(n.alias("n"), count_where(F.col("gap") < 0.25 * F.col("mean")).alias("n_bunched"), F.bool_or(0.25 * F.col("mean") < 90).alias("below_precision"), band.alias("band"))


@query("""SELECT l_orderkey, count(*) AS n_lines, min(l_linenumber) FILTER (WHERE l_returnflag = 'N') AS first_kept, max(l_linenumber) FILTER (WHERE l_returnflag = 'N') AS last_kept,
  coalesce(bool_or(l_linestatus = 'F' AND l_returnflag = 'R'), false) AS any_returned, CASE WHEN count(*) FILTER (WHERE l_returnflag = 'N') = 0 THEN 'cancelled' WHEN bool_or(l_returnflag = 'R') THEN 'incomplete' ELSE 'ran' END AS status
FROM lineitem GROUP BY l_orderkey""")
def q18_trip_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, n = F.col("l_returnflag") == "N", F.col("l_linenumber")
    status = F.when(count_where(kept) == 0, "cancelled").when(F.bool_or(F.col("l_returnflag") == "R"), "incomplete").otherwise("ran")
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n_lines"), F.min(F.when(kept, n)).alias("first_kept"), F.max(F.when(kept, n)).alias("last_kept"), F.coalesce(F.bool_or((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "R")), F.lit(False)).alias("any_returned"), status.alias("status"))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE date_trunc('month', o_orderdate) = (SELECT max(date_trunc('month', o_orderdate)) FROM orders)")
def q19_current_vintage(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("vintage", F.date_trunc("month", F.col("o_orderdate").cast("timestamp")))
    return op.current_vintage(orders).select("o_orderkey", "o_custkey", "o_totalprice")


_DISTANCE = "2 * 6371008.8 * asin(sqrt(least(1.0, pow(sin((radians(c.lat) - radians(p.lat)) / 2), 2) + cos(radians(p.lat)) * cos(radians(c.lat)) * pow(sin(radians(c.lon - p.lon) / 2), 2))))"


@query(f"""WITH c AS (SELECT n_nationkey AS centre, -34.5 + n_nationkey * 0.05 AS lat, 150.2 + n_nationkey * 0.07 AS lon FROM nation),
p AS (SELECT s_suppkey, -34.4 + (s_suppkey % 71) * 0.011 AS lat, 150.3 + (s_suppkey % 53) * 0.013 AS lon FROM supplier)
SELECT s_suppkey, arg_min(centre, {_DISTANCE}) AS centre, round(min({_DISTANCE}), 3) AS distance_m FROM p CROSS JOIN c GROUP BY s_suppkey""")
def q20_nearest_centre(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, s = F.col("n_nationkey"), F.col("s_suppkey")
    centres = table(spark, sf_dir, "nation").select(n.alias("centre"), (-34.5 + n * 0.05).alias("clat"), (150.2 + n * 0.07).alias("clon"))
    stops = table(spark, sf_dir, "supplier").select(s, (-34.4 + (s % 71) * 0.011).alias("lat"), (150.3 + (s % 53) * 0.013).alias("lon"))
    d = haversine(F.col("lat"), F.col("lon"), F.col("clat"), F.col("clon"))
    return op.nearest_one(stops, centres, ["s_suppkey"], d, ["centre"]).select("s_suppkey", "centre", F.round("distance", 3).alias("distance_m"))


@query("""SELECT l_suppkey, coalesce(sum(l_linenumber) FILTER (WHERE l_returnflag = 'A' AND l_quantity <= 10), 0)::BIGINT AS near, coalesce(sum(l_linenumber) FILTER (WHERE l_quantity <= 20), 0)::BIGINT AS far,
  count(*) FILTER (WHERE l_quantity <= 20 AND l_linenumber > 0 AND l_returnflag IS DISTINCT FROM 'A') AS unrouted FROM lineitem GROUP BY l_suppkey""")
def q21_conditional_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, n, routed = F.col("l_quantity"), F.col("l_linenumber"), F.col("l_returnflag") == "A"
    known = lambda c: F.coalesce(c, F.lit(0))
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(known(sum_where(n, routed & (q <= 10))).alias("near"), known(sum_where(n, q <= 20)).alias("far"), count_where((q <= 20) & (n > 0) & ~F.col("l_returnflag").eqNullSafe("A")).alias("unrouted"))


@query("SELECT c_custkey, c_mktsegment, n.n_orders, n.total FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderstatus = 'P' GROUP BY ALL) n ON o_custkey = c_custkey")
def q22_left_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment").join(sums, "c_custkey", "left")


@query("SELECT ts::DATE AS day, extract(hour FROM ts)::BIGINT AS hour, count(*) AS n, count(DISTINCT user_id) AS n_users FROM events GROUP BY ALL")
def q23_distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).groupBy(F.col("ts").cast("date").alias("day"), F.hour("ts").cast("long").alias("hour")).agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("n_users"))


@query("""WITH l AS (UNPIVOT (SELECT l_suppkey, l_linenumber AS w, l_quantity AS quantity, l_discount * 100 AS discount, nullif(l_tax, 0) AS tax FROM lineitem) ON quantity, discount, tax INTO NAME measure VALUE value),
c AS (SELECT *, sum(w) OVER (PARTITION BY l_suppkey, measure ORDER BY value ROWS UNBOUNDED PRECEDING) AS below, sum(w) OVER (PARTITION BY l_suppkey, measure) AS total FROM l)
SELECT l_suppkey, measure, round(sum(value * w) / sum(w), 6) AS mean, min(value) FILTER (WHERE below >= 0.25 * total) AS q25, min(value) FILTER (WHERE below >= 0.5 * total) AS median, min(value) FILTER (WHERE below >= 0.75 * total) AS q75 FROM c GROUP BY ALL""")
def q24_weighted_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_linenumber").alias("w"), F.col("l_quantity").alias("quantity"), (F.col("l_discount") * 100).alias("discount"), F.nullif("l_tax", F.lit(0.0)).alias("tax"))
    long = op.known_unpivot(rows, ["l_suppkey", "w"], ["quantity", "discount", "tax"])
    return op.weighted_quantiles(long, ["l_suppkey", "measure"], "value", "w", {"q25": 0.25, "median": 0.5, "q75": 0.75}).withColumn("mean", F.round("mean", 6))


@query("""WITH e AS (SELECT user_id, epoch_us(ts) // 60000000 AS minute, epoch_us(ts) / 1e6 AS s, event_id FROM events),
g AS (SELECT *, s - lag(s) OVER w AS gap, first_value(minute) OVER w AS first_minute FROM e WINDOW w AS (PARTITION BY user_id ORDER BY s, event_id)),
c AS (SELECT user_id, count(*) AS n, round(median(gap) / 60)::BIGINT AS cycle FROM g GROUP BY user_id)
SELECT user_id, c.n, c.cycle, max(least((minute - first_minute) % cycle, cycle - (minute - first_minute) % cycle)) AS drift FROM g JOIN c USING (user_id) WHERE c.cycle > 0 GROUP BY ALL""")
def q25_clockface(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("s", "event_id")
    rows = events(spark, sf_dir).select("user_id", "event_id", F.expr("unix_micros(ts) div 60000000").alias("minute"), (F.unix_micros("ts") / 1e6).alias("s"))
    rows = rows.withColumn("gap", F.col("s") - F.lag("s").over(w)).withColumn("first_minute", F.first("minute").over(w))
    cycle = rows.groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.median("gap") / 60).cast("long").alias("cycle")).where("cycle > 0")
    offset = F.pmod(F.col("minute") - F.col("first_minute"), F.col("cycle"))
    return rows.join(cycle, "user_id").groupBy("user_id", "n", "cycle").agg(F.max(F.least(offset, F.col("cycle") - offset)).alias("drift"))


@query("""WITH a AS (SELECT o_orderpriority AS priority, year(o_orderdate)::BIGINT AS y, count(*) AS n_orders, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_done FROM orders WHERE o_orderstatus <> 'P' OR year(o_orderdate) < 1999 GROUP BY ALL),
b AS (SELECT o_orderpriority AS priority, year(l_shipdate)::BIGINT AS y, count(*) AS n_lines, sum(l_quantity) AS quantity FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_quantity > 10 GROUP BY ALL)
SELECT priority, y, n_orders, n_done, n_lines, quantity, round(n_done / nullif(n_orders, 0), 8) AS done_share, round(quantity / nullif(n_lines, 0), 8) AS mean_quantity FROM a FULL JOIN b USING (priority, y) WHERE priority IN (SELECT DISTINCT o_orderpriority FROM orders)""")
def q26_league(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem").where("l_quantity > 10")
    a = orders.where("o_orderstatus <> 'P' or year(o_orderdate) < 1999").groupBy(F.col("o_orderpriority").alias("priority"), F.year("o_orderdate").cast("long").alias("y")).agg(F.count("*").alias("n_orders"), count_where(F.col("o_orderstatus") == "F").alias("n_done"))
    joined = lines.join(orders.select("o_orderkey", "o_orderpriority"), F.col("l_orderkey") == F.col("o_orderkey"))
    b = joined.groupBy(F.col("o_orderpriority").alias("priority"), F.year("l_shipdate").cast("long").alias("y")).agg(F.count("*").alias("n_lines"), F.sum("l_quantity").alias("quantity"))
    out = a.join(b, ["priority", "y"], "full").join(orders.select(F.col("o_orderpriority").alias("priority")).distinct(), "priority")
    return out.withColumn("done_share", F.round(ratio(F.col("n_done"), F.col("n_orders")), 8)).withColumn("mean_quantity", F.round(ratio(F.col("quantity"), F.col("n_lines")), 8))


@query("""WITH g AS (SELECT r_name, p.priority, y.y FROM region CROSS JOIN (SELECT DISTINCT o_orderpriority AS priority FROM orders) p CROSS JOIN (SELECT DISTINCT year(o_orderdate)::BIGINT AS y FROM orders) y),
c AS (SELECT r_name, o_orderpriority AS priority, year(o_orderdate)::BIGINT AS y, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey WHERE o_totalprice > 450000 GROUP BY ALL)
SELECT r_name, priority, y, coalesce(n, 0) AS n, round(coalesce(n, 0) / 12, 8) AS monthly FROM g LEFT JOIN c USING (r_name, priority, y)""")
def q27_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", F.col("o_orderpriority").alias("priority"), F.year("o_orderdate").cast("long").alias("y"))
    places = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    customers = table(spark, sf_dir, "customer").join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "r_name")
    counted = orders.where("o_totalprice > 450000").join(customers, F.col("o_custkey") == F.col("c_custkey")).groupBy("r_name", "priority", "y").agg(F.count("*").alias("n"))
    # Five regions, five priorities and a row for each year.
    grid = table(spark, sf_dir, "region").select("r_name").crossJoin(F.broadcast(orders.select("priority").distinct())).crossJoin(F.broadcast(orders.select("y").distinct()))
    n = F.coalesce("n", F.lit(0))
    return grid.join(counted, ["r_name", "priority", "y"], "left").select("r_name", "priority", "y", n.alias("n"), F.round(n / 12, 8).alias("monthly"))


@query("""SELECT h::INTEGER AS service_hour, CASE WHEN h BETWEEN 6 AND 8 THEN 'am_peak' WHEN h BETWEEN 9 AND 14 THEN 'inter_peak' WHEN h BETWEEN 15 AND 17 THEN 'pm_peak' WHEN h BETWEEN 18 AND 21 THEN 'evening' ELSE 'night' END AS period FROM range(48) t(h)""")
def q28_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    from punctual.plans.marts import Marts

    return Marts({"any": spark.range(0)}).period


@query("""WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS c FROM lineitem GROUP BY ALL HAVING count(*) > 1)
SELECT count(*) AS n_rows, (SELECT count(*) FROM k) AS duplicate_keys, count(*) - count(DISTINCT l_orderkey) AS repeated_orders,
  count(*) FILTER (WHERE l_shipdate > TIMESTAMP '2001-06-01') AS far, round(count(*) FILTER (WHERE l_returnflag = 'R') / nullif(count(*), 0), 8) AS returned_share,
  round(count(*) FILTER (WHERE l_linestatus = 'O' AND l_returnflag = 'N') / nullif(count(*) FILTER (WHERE l_returnflag = 'N'), 0), 8) AS open_share FROM lineitem""")
def q29_day_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, c = table(spark, sf_dir, "lineitem"), F.col
    # Measures and duplicate keys from one aggregation by key, then one over all.
    keyed = lines.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"), count_where(c("l_shipdate") > F.expr("timestamp_ntz'2001-06-01 00:00:00'")).alias("far"), count_where(c("l_returnflag") == "R").alias("r"), count_where((c("l_linestatus") == "O") & (c("l_returnflag") == "N")).alias("o"), count_where(c("l_returnflag") == "N").alias("kept"))
    by_order = keyed.groupBy("l_orderkey").agg(F.sum("n").alias("n"), count_where(c("n") > 1).alias("d"), *[F.sum(x).alias(x) for x in ("far", "r", "o", "kept")])
    out = by_order.agg(F.sum("n").alias("n_rows"), F.sum("d").alias("duplicate_keys"), (F.sum("n") - F.count("*")).alias("repeated_orders"), F.sum("far").alias("far"), F.sum("r").alias("r"), F.sum("o").alias("o"), F.sum("kept").alias("kept"))
    return out.select("n_rows", "duplicate_keys", "repeated_orders", "far", F.round(ratio(c("r"), c("n_rows")), 8).alias("returned_share"), F.round(ratio(c("o"), c("kept")), 8).alias("open_share"))


@query("""SELECT category, minute, n FROM (SELECT CASE WHEN event_type = 'error' AND value > 80 THEN 'crashed' WHEN event_type = 'error' THEN 'transport' WHEN value > 100 THEN 'non_200' WHEN event_id % 50 = 0 THEN 'null_date' ELSE 'ok' END AS category,
  strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M') AS minute, count(*) AS n FROM events GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY category ORDER BY n DESC, minute) <= 10""")
def q30_failure_tallies(spark: SparkSession, sf_dir: str) -> DataFrame:
    category = F.when((F.col("event_type") == "error") & (F.col("value") > 80), "crashed").when(F.col("event_type") == "error", "transport").when(F.col("value") > 100, "non_200").when(F.expr("event_id % 50 = 0"), "null_date").otherwise("ok")
    counts = events(spark, sf_dir).groupBy(category.alias("category"), F.date_format("ts", "yyyy-MM-dd HH:mm").alias("minute")).agg(F.count("*").alias("n"))
    w = Window.partitionBy("category").orderBy(F.desc("n"), "minute")
    return counts.withColumn("rank", F.row_number().over(w)).where("rank <= 10").drop("rank")


@query("""WITH e AS (SELECT DISTINCT date_trunc('hour', ts) AS h FROM events WHERE event_type = 'purchase'), x AS (SELECT min(h) AS a, max(h) AS b FROM e)
SELECT strftime(h, '%Y-%m-%d %H') AS missing FROM (SELECT unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS h FROM x) WHERE h NOT IN (SELECT h FROM e)""")
def q31_coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = events(spark, sf_dir).where("event_type = 'purchase'").select(F.date_trunc("hour", "ts").alias("h")).distinct()
    every = seen.agg(F.min("h").alias("a"), F.max("h").alias("b")).select(F.explode(F.sequence("a", "b", F.expr("interval 1 hour"))).alias("h"))
    return every.join(seen, "h", "left_anti").select(F.date_format("h", "yyyy-MM-dd HH").alias("missing"))


@query("SELECT ts::DATE AS day, 24::BIGINT AS expected, count(DISTINCT extract(hour FROM ts)) AS seen, 24 - count(DISTINCT extract(hour FROM ts)) AS missing, count(*) AS total, max(value) AS peak FROM events WHERE event_type IN ('signup', 'error') GROUP BY ALL")
def q32_attendance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).where(F.col("event_type").isin("signup", "error"))
    out = rows.groupBy(F.col("ts").cast("date").alias("day")).agg(F.countDistinct(F.hour("ts")).alias("seen"), F.count("*").alias("total"), F.max("value").alias("peak"))
    return out.withColumn("expected", F.lit(24).cast("long")).withColumn("missing", F.col("expected") - F.col("seen"))


@query("SELECT c_custkey, c_name FROM customer ANTI JOIN (SELECT * FROM orders WHERE o_totalprice > 300000) ON o_custkey = c_custkey")
def q33_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "orders").where("o_totalprice > 300000")
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name").join(done, F.col("c_custkey") == F.col("o_custkey"), "left_anti")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey IN (3, 7, 11))")
def q34_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = table(spark, sf_dir, "customer").where(F.col("c_nationkey").isin(3, 7, 11))
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(chosen, F.col("o_custkey") == F.col("c_custkey"), "left_semi")


@query("""WITH a AS (SELECT c_nationkey AS k, count(*) AS n_customers FROM customer WHERE c_acctbal > 9000 GROUP BY ALL), b AS (SELECT s_nationkey AS k, count(*) AS n_suppliers FROM supplier WHERE s_acctbal > 3000 GROUP BY ALL),
c AS (SELECT n_nationkey AS k, n_name FROM nation WHERE n_regionkey < 3)
SELECT k, n_customers, n_suppliers, n_name, k IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 4) AS excluded FROM a FULL JOIN b USING (k) FULL JOIN c USING (k)""")
def q35_chained_full_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "k")
    a = table(spark, sf_dir, "customer").where("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("n_customers"))
    b = table(spark, sf_dir, "supplier").where("s_acctbal > 3000").groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("n_suppliers"))
    joined = a.join(b, "k", "full").join(nation.where("n_regionkey < 3").select("k", "n_name"), "k", "full")
    return op.flagged_by(joined, nation.where("n_regionkey = 4"), ["k"], "excluded")


@query("""WITH a AS (SELECT p_partkey, p_size * 1.0 AS x, p_retailprice AS y FROM part), b AS (SELECT s_suppkey, 1 + s_suppkey % 50 + 0.5 AS x, 900 + s_suppkey * 1.7 AS y FROM supplier)
SELECT p_partkey, s_suppkey, round(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)), 6) AS distance FROM a JOIN b ON abs(a.x - b.x) <= 1.25 AND abs(a.y - b.y) <= 4.0""")
def q36_band_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") * 1.0).alias("x"), F.col("p_retailprice").alias("y"))
    places = table(spark, sf_dir, "supplier").select(s, (1 + s % 50 + 0.5).cast("double").alias("px"), (900 + s * 1.7).cast("double").alias("py"))
    near = op.grid_band_join(parts, places, [("x", "px", 1.25), ("y", "py", 4.0)])
    return near.select("p_partkey", "s_suppkey", F.round(F.sqrt(F.pow(F.col("x") - F.col("px"), 2) + F.pow(F.col("y") - F.col("py"), 2)), 6).alias("distance"))


@query("""SELECT code, try_cast(score AS DOUBLE) AS score, try_cast(decile AS INTEGER) AS decile, flag = 'Y' AS excluded FROM (SELECT CASE WHEN p_partkey % 9 = 0 THEN 'note' ELSE lpad(p_partkey::VARCHAR, 11, '0') END AS code,
  CASE WHEN p_partkey % 7 = 0 THEN '-' ELSE p_size::VARCHAR || '.5' END AS score, CASE WHEN p_partkey % 5 = 0 THEN 'np' ELSE (p_size % 10)::VARCHAR END AS decile, CASE WHEN p_size > 40 THEN 'Y' ELSE 'N' END AS flag FROM part) WHERE length(code) = 11""")
def q37_tidy_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")
    sheet = table(spark, sf_dir, "part").select(F.when(k % 9 == 0, "note").otherwise(F.lpad(k.cast("string"), 11, "0")).alias("code"), F.when(k % 7 == 0, "-").otherwise(F.concat(size.cast("string"), F.lit(".5"))).alias("score"), F.when(k % 5 == 0, "np").otherwise((size % 10).cast("string")).alias("decile"), F.when(size > 40, "Y").otherwise("N").alias("flag"))
    return sheet.where(F.length("code") == 11).select("code", F.col("score").try_cast("double").alias("score"), F.col("decile").try_cast("int").alias("decile"), (F.col("flag") == "Y").alias("excluded"))


@query("""SELECT p_partkey, s.routed, round(s.network / nullif(p_size - 10, 0), 8) AS detour_ratio, CASE WHEN s.snap > 100 THEN 'snap_failed' WHEN s.network IS NULL THEN 'unroutable' ELSE 'routed' END AS status
FROM part LEFT JOIN (SELECT l_partkey, count(*) AS routed, sum(l_quantity) FILTER (WHERE l_returnflag = 'R') AS network, max(l_quantity) * 2.1 AS snap FROM lineitem GROUP BY ALL) s ON l_partkey = p_partkey""")
def q38_detour(spark: SparkSession, sf_dir: str) -> DataFrame:
    legs = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("routed"), sum_where(F.col("l_quantity"), F.col("l_returnflag") == "R").alias("network"), (F.max("l_quantity") * 2.1).alias("snap"))
    status = F.when(F.col("snap") > 100, "snap_failed").when(F.col("network").isNull(), "unroutable").otherwise("routed")
    return table(spark, sf_dir, "part").join(legs, "p_partkey", "left").select("p_partkey", "routed", F.round(ratio(F.col("network"), F.col("p_size") - 10), 8).alias("detour_ratio"), status.alias("status"))


@query("""WITH d AS (SELECT DISTINCT ON (user_id, minute, event_type) user_id, minute, event_type, event_id FROM (SELECT *, epoch_us(ts) // 600000000 AS minute FROM events) ORDER BY user_id, minute, event_type, ts, event_id)
SELECT user_id, count(*) AS n_kept, (count(*) - count(DISTINCT minute))::BIGINT AS n_conflicts FROM d GROUP BY user_id""")
def q39_dedupe_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).withColumn("minute", F.expr("unix_micros(ts) div 600000000"))
    kept = op.latest_per_key(rows, ["user_id", "minute", "event_type"], F.col("ts").asc_nulls_last(), F.col("event_id").asc_nulls_last())
    return kept.groupBy("user_id").agg(F.count("*").alias("n_kept"), (F.count("*") - F.countDistinct("minute")).alias("n_conflicts"))


@query("SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS hour, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL")
def q40_tumbling_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = events(spark, sf_dir).groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return hourly.select(F.date_format("window.start", "yyyy-MM-dd HH:mm").alias("hour"), "event_type", "n", "total")


@query("SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS hour, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL")
def q41_streaming_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from punctual.streaming.hourly import hourly_totals

    return hourly_totals(spark, f"{sf_dir}/events.parquet")


@query("SELECT ts::DATE AS day, round(100 * avg((event_type <> 'error')::INTEGER), 8) AS ran_percent FROM events GROUP BY ALL")
def q42_status_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).groupBy(F.col("ts").cast("date").alias("day")).agg(F.round(100 * F.avg((F.col("event_type") != "error").cast("int")), 8).alias("ran_percent"))


@query("SELECT event_type, (props->>'k')::BIGINT % 10 AS k, count(*) AS n FROM events GROUP BY ALL")
def q43_json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).withColumn("p", F.from_json("props", "k long"))
    return rows.groupBy("event_type", (F.col("p.k") % 10).alias("k")).agg(F.count("*").alias("n"))


_RING = ((4.0, 905.0), (30.0, 920.0), (47.0, 1010.0), (20.0, 1060.0), (12.0, 960.0), (4.0, 905.0))


@query(f"""WITH e AS (SELECT * FROM (VALUES {", ".join(f"({a[0]}::DOUBLE, {a[1]}::DOUBLE, {b[0]}::DOUBLE, {b[1]}::DOUBLE)" for a, b in zip(_RING, _RING[1:], strict=False))}) t(ax, ay, bx, by_))
SELECT p_partkey, count(*) FILTER (WHERE (ay > p_retailprice) <> (by_ > p_retailprice) AND p_size < (bx - ax) * (p_retailprice - ay) / nullif(by_ - ay, 0) + ax) % 2 = 1
  OR bool_or((bx - ax) * (p_retailprice - ay) - (by_ - ay) * (p_size - ax) = 0 AND p_size BETWEEN least(ax, bx) AND greatest(ax, bx) AND p_retailprice BETWEEN least(ay, by_) AND greatest(ay, by_)) AS inside
FROM part CROSS JOIN e GROUP BY p_partkey""")
def q44_point_in_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    ring = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in _RING])
    return table(spark, sf_dir, "part").select("p_partkey", meets(edges(F.array(ring).cast(POLYGON)), F.col("p_size").cast("double"), F.col("p_retailprice")).alias("inside"))


@query("SELECT l_returnflag, round(sum(l_quantity), 2) AS quantity, round(sum(l_discount), 2) AS discount, round(sum(l_tax), 2) AS tax FROM lineitem GROUP BY l_returnflag")
def q45_unpivot_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["quantity", "discount", "tax"]
    long = op.known_unpivot(table(spark, sf_dir, "lineitem").select("l_returnflag", *[F.col(f"l_{n}").alias(n) for n in names]), ["l_returnflag"], names)
    return long.groupBy("l_returnflag").pivot("measure", names).agg(F.round(F.sum("value"), 2))


@query("SELECT * EXCLUDE (ts, props) REPLACE (value * 2 AS value, upper(event_type) AS event_type) FROM events")
def q46_exclude_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.replaced(events(spark, sf_dir).drop("ts", "props"), value=F.col("value") * 2, event_type=F.upper("event_type"))


@query("""SELECT l_returnflag, l_linestatus, round(sum(l_quantity * l_linenumber) / sum(l_linenumber), 6) AS weighted, bool_or(l_tax > 0.07) AS any_high, min(l_shipdate)::DATE AS first_day, max(l_returnflag || l_linestatus) AS label,
  min(nullif(l_linenumber, 1)) AS least, (round(avg(l_quantity) * 1.0)::INTEGER % 7)::BIGINT AS spread FROM lineitem GROUP BY ALL""")
def q47_aggregate_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy("l_returnflag", "l_linestatus").agg(F.round(weighted_mean(F.col("l_quantity"), F.col("l_linenumber")), 6).alias("weighted"), F.bool_or(F.col("l_tax") > 0.07).alias("any_high"), F.min("l_shipdate").cast("date").alias("first_day"), F.max(F.concat("l_returnflag", "l_linestatus")).alias("label"), F.min(F.nullif("l_linenumber", F.lit(1))).alias("least"), F.pmod(rounded(F.avg("l_quantity")), F.lit(7)).cast("long").alias("spread"))
