"""Timetable bundles: members of a zip as text, rows as typed dimensions."""

from __future__ import annotations

import csv
import io
import sys
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Fixed columns of the dimensions: file, then target column, source column and type. ``?`` marks optional sources.
DIMENSIONS = {
    "agency": ("agency.txt", "agency_id agency_id string, agency_name agency_name string, agency_url agency_url? string, agency_timezone agency_timezone? string"),
    "stop": ("stops.txt", "stop_id stop_id string, stop_name stop_name string, stop_lat stop_lat double, stop_lon stop_lon double, wheelchair_boarding wheelchair_boarding? string"),
    "route": ("routes.txt", "route_id route_id string, agency_id agency_id string, route_short_name route_short_name string, route_long_name route_long_name string, route_type route_type string"),
    "trip": ("trips.txt", "trip_id trip_id string, route_id route_id string, service_id service_id string, direction_id direction_id string, trip_headsign trip_headsign string, shape_id shape_id string"),
    "scheduled_stop_time": ("stop_times.txt", "trip_id trip_id string, stop_id stop_id string, stop_sequence stop_sequence int, arrival_time arrival_time string, departure_time departure_time string, shape_dist_traveled shape_dist_traveled double, timepoint timepoint? string, pickup_type pickup_type? string, drop_off_type drop_off_type? string"),
    "shape": ("shapes.txt", "shape_id shape_id string, shape_pt_lat shape_pt_lat double, shape_pt_lon shape_pt_lon double, shape_pt_sequence shape_pt_sequence int, shape_dist_traveled shape_dist_traveled? double"),
    "calendar": ("calendar.txt", ", ".join(f"{c} {c} string" for c in ("service_id", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday", "start_date", "end_date"))),
    "calendar_dates": ("calendar_dates.txt", "service_id service_id string, date date string, exception_type exception_type string"),
}
#: Rows of a member that are handed on at once.
BATCH = 50_000


def bundles(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256, content) of each bundle."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"), "content")


def member(bundle: DataFrame, name: str) -> DataFrame:
    """(values map) for each row of a member, read as a stream; a missing member raises KeyError."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for content in frame["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z, z.open(name) as raw:
                    held = []
                    for row in csv.DictReader(io.TextIOWrapper(raw, "utf-8-sig", newline="")):
                        held.append({k: v for k, v in row.items() if k})
                        if len(held) == BATCH:
                            yield pd.DataFrame({"values": held})
                            held = []
                    yield pd.DataFrame({"values": held})

    return bundle.select("content").mapInPandas(rows, "values map<string,string>")


def dimension(bundle: DataFrame, table: str) -> DataFrame:
    """A typed dimension; blanks are null, a required column that is missing raises."""
    name, text = DIMENSIONS[table]
    columns = []
    for part in text.split(", "):
        target, source, kind = part.split()
        value = F.col("values")[source.rstrip("?")]
        if not source.endswith("?"):
            value = F.when(F.map_contains_key("values", source), value).otherwise(F.raise_error(F.lit(f"{name} has no column {source}")))
        columns.append(F.nullif(value, F.lit("")).cast(kind).alias(target))
    return member(bundle, name).select(*columns)


def changed(bundle: DataFrame, last_sha256: str | None) -> bool:
    """Is the bundle another than the one last checked?"""
    return bundle.select("sha256").first().sha256 != last_sha256


def last_check(checks: DataFrame):
    """The latest schedule check, or None."""
    return checks.orderBy(F.desc("checked_at_utc")).first()
