"""The jobs end to end: hours of raw objects to partials, partials to a day's facts, a bundle to a snapshot.

Each is one batch over all its input and can be run again: it overwrites the
partitions it owes and nothing else.
"""

from __future__ import annotations

import json
import resource
import sys
import uuid
from collections.abc import Callable
from datetime import UTC, date, datetime, timedelta
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.functions.timeline import expected_hours, hours_to_compact, last_complete_day, partition_bounds, snapshot_label
from punctual.operators.reducers import first_positions, position_conflicts, reduce_calls, reduce_trips
from punctual.plans import checks, merge
from punctual.session import ensure
from punctual.sources import feed, files, timetable

HOUR = ["dt", "hour"]


def _record(job: str, partition: str, began: datetime, **counts: int) -> dict:
    zero = dict.fromkeys(checks.SUMMED, 0)
    return {"job": job, "partition": partition, "started_at_utc": began.isoformat(), "finished_at_utc": datetime.now(UTC).isoformat(), **zero, **counts, "peak_rss_mb": peak_rss_mb(), "error": None}


def peak_rss_mb() -> int:
    """The most memory this process has held, in megabytes."""
    most = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    return most >> (20 if sys.platform == "darwin" else 10)


def _hourly(df: DataFrame) -> DataFrame:
    at = F.col("fetched_at_utc")
    return df.withColumn("dt", F.date_format(at, "yyyy-MM-dd")).withColumn("hour", F.date_format(at, "HH"))


def _put(df: DataFrame, path: str, codec: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", codec).partitionBy(*HOUR).parquet(path)


def raw_folders(spark: SparkSession, raw: str, name: str, hours: list[datetime]) -> list[str]:
    paths = [f"{raw}/{name}/dt={h:%Y-%m-%d}/hour={h:%H}" for h in hours]
    return [p for p in paths if files.exists(spark, p)]


def compact(spark: SparkSession, raw: str, root: str, hours: list[datetime]) -> list[dict]:
    """Partials of the hours, from the polls fetched in them; hours without any object raise.

    All hours are one job for each table: the hour is part of the reducers' key,
    so an hour's partial is the same whatever other hours are compacted with it.
    Each object is decoded once, into a table that the reducers read. The records
    count objects and conflicting sightings hour by hour.
    """
    ensure(spark)
    began, found = datetime.now(UTC), {n: raw_folders(spark, raw, n, hours) for n in ("tripupdates", "vehiclepos")}
    if not any(found.values()):
        raise ValueError("no raw objects in these hours")
    conflicts: dict[str, int] = {}
    scratch = f"{root}/_decoded/{uuid.uuid4().hex}"
    try:
        if found["tripupdates"]:
            updates = _decoded(_hourly(feed.trip_updates(_raw(spark, found["tripupdates"]))), f"{scratch}/tripupdates")
            _put(reduce_calls(updates, HOUR), f"{root}/_partial/trip_stop", "snappy")
            _put(reduce_trips(updates, HOUR), f"{root}/_partial/trip", "snappy")
        if found["vehiclepos"]:
            seen = _decoded(_hourly(feed.vehicle_positions(_raw(spark, found["vehiclepos"]))), f"{scratch}/vehiclepos")
            _put(first_positions(seen, HOUR), f"{root}/_partial/vehicle_position", "snappy")
            conflicts = {f"{r.dt}T{r.hour}": r.dupes_differing_position for r in position_conflicts(seen, HOUR).collect()}
    finally:
        files.remove(spark, scratch)
    objects = {f"{h:%Y-%m-%dT%H}": sum(files.count_files(spark, f"{raw}/{n}/dt={h:%Y-%m-%d}/hour={h:%H}") for n in found) for h in hours}
    return [_record("compactor", p, began, objects_read=n, dupes_differing_position=conflicts.get(p, 0)) for p, n in objects.items()]


def _decoded(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _raw(spark: SparkSession, folders: list[str]) -> DataFrame:
    out = feed.read_raw(spark, folders[0])
    for folder in folders[1:]:
        out = out.union(feed.read_raw(spark, folder))
    return out


def present_partials(spark: SparkSession, root: str, day: date) -> DataFrame:
    """(table, dt, hour) of the partials there are among those a day owes."""
    owed = [(t, f"{h:%Y-%m-%d}", f"{h:%H}") for h in expected_hours(day) for t in checks.TABLES]
    return spark.createDataFrame([x for x in owed if files.exists(spark, f"{root}/_partial/{x[0]}/dt={x[1]}/hour={x[2]}")], "table string, dt string, hour string")


def stop_times_for(spark: SparkSession, root: str, day: date) -> tuple[DataFrame | None, str | None]:
    """The stop times a day is merged with, and their snapshot."""
    path = f"{root}/dim_scheduled_stop_time"
    if not files.exists(spark, path):
        return None, None
    rows = files.read_snapshots(spark, path)
    label, _ = merge.snapshot_for([r.valid_from for r in rows.select("valid_from").distinct().collect()], day)
    return (rows.where(F.col("valid_from") == label).drop("valid_from"), label) if label else (None, None)


def merge_day(spark: SparkSession, root: str, day: date, tables: tuple[str, ...] = checks.TABLES) -> dict:
    """A service day's facts from its partials; refuses a day without any. Checks run if both trips and calls were merged."""
    ensure(spark)
    unknown = set(tables) - set(checks.TABLES)
    if unknown:
        raise ValueError(f"no such table: {', '.join(sorted(unknown))}")
    began, coverage = datetime.now(UTC), checks.partial_coverage(day, present_partials(spark, root, day))
    times, label = stop_times_for(spark, root, day)
    first, last = partition_bounds(day)
    rows = 0
    for table in tables:
        path = f"{root}/_partial/{table}"
        if not files.exists(spark, path):
            continue
        partials = files.read_snapshots(spark, path).where(F.col("dt").between(first, last))
        built = {"trip_stop": lambda p: merge.build_calls(p, day, times), "trip": lambda p: merge.build_trips(p, day, times), "vehicle_position": lambda p: merge.build_positions(p, day)}[table](partials)
        rows += files.write_fact(built, root, table, day.isoformat())
    record = _record("merger", day.isoformat(), began, objects_expected=coverage["objects_expected"], objects_read=coverage["objects_read"], rows_out=rows)
    files.append_audit(spark, f"{root}/curation_run", day, record)
    out = {"record": record, "short": coverage["short"], "valid_from": label, "breaches": None}
    fact = lambda t: f"{root}/fact_{t}/service_date={day.isoformat()}"
    if {"trip", "trip_stop"} <= set(tables) and all(files.exists(spark, fact(t)) for t in ("trip", "trip_stop")):
        found = checks.day_checks(spark.read.parquet(fact("trip_stop")), spark.read.parquet(fact("trip")))
        out["breaches"] = [r.name for r in checks.breaches(found).collect()]
    return out


#: How long a replay's finished steps are trusted, and failures after which it stops.
TRUSTED, MOST_FAILURES = timedelta(days=2), 3


def replay(spark: SparkSession, raw: str, root: str, days: list[date], now: datetime, log: str | None = None) -> list[dict]:
    """Compact and merge closed days again; an open one is refused.

    With a ``log``, a file of finished steps, a replay that was cut short goes on
    where it stopped; steps logged more than two days ago are done again. A step
    that fails is logged with its error and the others go on; the third failure
    raises. A day is merged only if its hours were compacted.
    """
    late = [d for d in days if d > last_complete_day(now)]
    if late:
        raise ValueError(f"not closed yet: {late[0]}")
    done = _finished(log, now) if log else set()
    failures: list[Exception] = []

    def step(name: str, work: Callable[[], object]) -> object:
        if name in done:
            return None
        try:
            out, error = work(), None
        except Exception as e:  # noqa: BLE001 - logged, and raised once there are too many
            out, error = None, f"{type(e).__name__}: {e}"
            failures.append(e)
        if log:
            with open(log, "a") as f:
                f.write(json.dumps({"step": name, "at": now.isoformat(), "error": error}) + "\n")
        if error and (len(failures) >= MOST_FAILURES or not log):
            raise failures[-1]
        return out

    hours = hours_to_compact(days)
    step(f"compact {hours[0]:%Y-%m-%dT%H} to {hours[-1]:%Y-%m-%dT%H}", lambda: compact(spark, raw, root, hours))
    return [] if failures else [x for x in (step(f"merge {d.isoformat()}", lambda d=d: merge_day(spark, root, d)) for d in days) if x is not None]


def _finished(log: str, now: datetime) -> set[str]:
    if not Path(log).exists():
        return set()
    records = [json.loads(line) for line in Path(log).read_text().splitlines() if line.strip()]
    last = {r["step"]: r for r in records}  # of a step that was done again the last record counts
    return {n for n, r in last.items() if r["error"] is None and now - datetime.fromisoformat(r["at"]) <= TRUSTED}


def load_schedule(spark: SparkSession, bundle_path: str, root: str, now: datetime, last_sha256: str | None = None) -> dict:
    """A new snapshot of all dimensions, if the bundle is another than the last one checked."""
    bundle = timetable.bundles(spark, bundle_path)
    sha = bundle.select("sha256").first().sha256
    changed, label = sha != last_sha256, snapshot_label(now)
    if changed:
        for table in timetable.DIMENSIONS:
            files.write_snapshot(timetable.dimension(bundle, table), root, table, label)
    check = {"checked_at_utc": now.isoformat(), "zip_sha256": sha, "zip_filename": bundle_path.rsplit("/", 1)[-1], "changed": changed, "valid_from": label if changed else None}
    files.append_audit(spark, f"{root}/schedule_check", now.date(), check)
    return check
