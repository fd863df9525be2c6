"""Raw feed objects: keys, payloads and messages.

The message types are built at run time from the public field numbers of the
GTFS-Realtime specification, so no generated module is needed. Fields that are
not set stay null.
"""

from __future__ import annotations

import gzip
import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.operators.reducers import UPDATES

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Fixed values of the specification: (name, number, type, label) by message; enumerations by number.
ENUMS = {
    "StopRelation": {0: "SCHEDULED", 1: "SKIPPED", 2: "NO_DATA", 3: "UNSCHEDULED"},
    "TripRelation": {0: "SCHEDULED", 1: "ADDED", 2: "UNSCHEDULED", 3: "CANCELED", 5: "REPLACEMENT", 6: "DUPLICATED", 7: "DELETED"},
    "StopStatus": {0: "INCOMING_AT", 1: "STOPPED_AT", 2: "IN_TRANSIT_TO"},
    "Congestion": {0: "UNKNOWN_CONGESTION_LEVEL", 1: "RUNNING_SMOOTHLY", 2: "STOP_AND_GO", 3: "CONGESTION", 4: "SEVERE_CONGESTION"},
    "Occupancy": {0: "EMPTY", 1: "MANY_SEATS_AVAILABLE", 2: "FEW_SEATS_AVAILABLE", 3: "STANDING_ROOM_ONLY", 4: "CRUSHED_STANDING_ROOM_ONLY", 5: "FULL", 6: "NOT_ACCEPTING_PASSENGERS", 7: "NO_DATA_AVAILABLE", 8: "NOT_BOARDABLE"},
}
MESSAGES = {
    "Event": "delay 1 int32, time 2 int64, uncertainty 3 int32",
    "Trip": "trip_id 1 string, start_time 2 string, start_date 3 string, schedule_relationship 4 TripRelation, route_id 5 string, direction_id 6 uint32",
    "Vehicle": "id 1 string, label 2 string, license_plate 3 string",
    "Place": "latitude 1 float, longitude 2 float, bearing 3 float, odometer 4 double, speed 5 float",
    "StopUpdate": "stop_sequence 1 uint32, arrival 2 Event, departure 3 Event, stop_id 4 string, schedule_relationship 5 StopRelation",
    "TripUpdate": "trip 1 Trip, stop_time_update 2 StopUpdate*, vehicle 3 Vehicle, timestamp 4 uint64, delay 5 int32",
    "Position": "trip 1 Trip, position 2 Place, current_stop_sequence 3 uint32, current_status 4 StopStatus, timestamp 5 uint64, congestion_level 6 Congestion, stop_id 7 string, vehicle 8 Vehicle, occupancy_status 9 Occupancy",
    "Entity": "id 1 string, is_deleted 2 bool, trip_update 3 TripUpdate, vehicle 4 Position",
    "Header": "gtfs_realtime_version 1 string, incrementality 2 int32, timestamp 3 uint64",
    "Feed": "header 1 Header, entity 2 Entity*",
}
KEY = r"/(vehiclepos|tripupdates)/dt=(\d{4}-\d{2}-\d{2})/hour=(\d{2})/(\d{6})\.pb\.gz$"


def message_type(name: str = "Feed") -> type:
    """The message class, with a pool of its own; tasks build it once."""
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

    file = descriptor_pb2.FileDescriptorProto(name="punctual_feed.proto", package="punctual_feed", syntax="proto2")
    field = descriptor_pb2.FieldDescriptorProto
    kinds = {"int32": field.TYPE_INT32, "int64": field.TYPE_INT64, "uint32": field.TYPE_UINT32, "uint64": field.TYPE_UINT64, "string": field.TYPE_STRING, "float": field.TYPE_FLOAT, "double": field.TYPE_DOUBLE, "bool": field.TYPE_BOOL}
    for enum, values in ENUMS.items():
        e = file.enum_type.add(name=enum)
        for number, value in values.items():
            e.value.add(name=f"{enum}_{value}", number=number)
    for message, text in MESSAGES.items():
        m = file.message_type.add(name=message)
        for part in text.split(", "):
            own, number, kind = part.split()
            f = m.field.add(name=own, number=int(number), label=field.LABEL_REPEATED if kind.endswith("*") else field.LABEL_OPTIONAL)
            kind = kind.rstrip("*")
            if kind in kinds:
                f.type = kinds[kind]
            else:
                f.type, f.type_name = field.TYPE_ENUM if kind in ENUMS else field.TYPE_MESSAGE, f".punctual_feed.{kind}"
    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    return message_factory.GetMessageClass(pool.FindMessageTypeByName(f"punctual_feed.{name}"))


def decode(payload: bytes, kind: type | None = None):
    """A message from a compressed payload; a broken one raises ValueError."""
    from google.protobuf.message import DecodeError

    try:
        return (kind or message_type()).FromString(gzip.decompress(payload))
    except (OSError, EOFError, DecodeError) as e:
        raise ValueError(f"not a feed message: {e}") from e


def known(message, name: str):
    return getattr(message, name) if message.HasField(name) else None


def named(message, name: str, enum: str) -> str | None:
    return ENUMS[enum].get(getattr(message, name)) if message.HasField(name) else None


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """(path, feed, fetched_at_utc, content); a key of another shape raises."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    part = lambda i: F.regexp_extract("path", KEY, i)
    at = F.to_timestamp(F.concat(part(2), part(4)), "yyyy-MM-ddHHmmss")
    checked = F.when(part(1) == "", F.raise_error(F.concat(F.lit("not a raw key: "), F.col("path")))).otherwise(at)
    return files.select("path", part(1).alias("feed"), checked.alias("fetched_at_utc"), "content")


def key_time(path: Column) -> Column:
    """The fetch time in an object's key; null for another shape."""
    return F.try_to_timestamp(F.concat(F.regexp_extract(path, KEY, 2), F.regexp_extract(path, KEY, 4)), F.lit("yyyy-MM-ddHHmmss"))


def _event(stop, name: str) -> dict | None:
    if not stop.HasField(name):
        return None
    e = getattr(stop, name)
    return {"time": known(e, "time"), "delay": known(e, "delay")}


#: Rows that a task hands on at once.
BATCH = 20_000


def _batches(frames: Iterator[pd.DataFrame], columns: list[str], rows_of: Callable) -> Iterator[pd.DataFrame]:
    """The rows of all messages, a bounded number at a time."""
    kind, held = message_type(), []
    for frame in frames:
        for at, content in zip(frame["fetched_at_utc"], frame["content"], strict=True):
            held += rows_of(at, decode(bytes(content), kind))
            if len(held) >= BATCH:
                yield pd.DataFrame(held, columns=columns)
                held = []
    yield pd.DataFrame(held, columns=columns)


def _update_rows(at: pd.Timestamp, message) -> Iterator[tuple]:
    for n, entity in enumerate(message.entity):
        if entity.HasField("trip_update"):
            u = entity.trip_update
            stops = [{"stop_id": s.stop_id, "stop_sequence": known(s, "stop_sequence"), "relationship": ENUMS["StopRelation"].get(s.schedule_relationship), "arrival": _event(s, "arrival"), "departure": _event(s, "departure")} for s in u.stop_time_update]
            yield at, n, u.trip.trip_id, u.trip.route_id, u.trip.start_date, u.trip.start_time, named(u.trip, "schedule_relationship", "TripRelation"), u.HasField("vehicle"), known(u, "timestamp"), stops


def _updates(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    yield from _batches(frames, ["fetched_at_utc", "n", "trip_id", "route_id", "start_date", "start_time", "trip_relationship", "has_vehicle", "stamp", "stops"], _update_rows)


def trip_updates(raw: DataFrame) -> DataFrame:
    """A row for each trip update of each poll, as the reducers read them; a poll is decoded where it is read."""
    return raw.select("fetched_at_utc", "content").mapInPandas(_updates, UPDATES)


POSITIONS = "observed_at_utc timestamp, fetched_at_utc timestamp, position_age_s double, vehicle_id string, vehicle_label string, trip_id string, route_id string, lat double, lon double, bearing double, speed double, occupancy_status string, congestion_level string, schedule_relationship string, current_status string, null_island boolean"


def _position_rows(at: pd.Timestamp, message) -> Iterator[tuple]:
    for entity in message.entity:
        if entity.HasField("vehicle"):
            v = entity.vehicle
            seen, lat, lon = pd.Timestamp(v.timestamp, unit="s"), float(v.position.latitude), float(v.position.longitude)
            yield seen, at, (at - seen).total_seconds(), v.vehicle.id, known(v.vehicle, "label"), v.trip.trip_id, v.trip.route_id, lat, lon, known(v.position, "bearing"), known(v.position, "speed"), named(v, "occupancy_status", "Occupancy"), named(v, "congestion_level", "Congestion"), named(v.trip, "schedule_relationship", "TripRelation"), named(v, "current_status", "StopStatus"), lat == 0 and lon == 0


def _positions(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    yield from _batches(frames, [c.split()[0] for c in POSITIONS.split(", ")], _position_rows)


def vehicle_positions(raw: DataFrame) -> DataFrame:
    """A row for each vehicle of each poll."""
    return raw.select("fetched_at_utc", "content").mapInPandas(_positions, POSITIONS)


def poll_clock(rows: DataFrame) -> DataFrame:
    """Round trip and clock skew of audit rows: the server's date against the middle of the round trip.

    ``server_date`` is an HTTP date; its weekday is not read.
    """
    micros = lambda c: F.unix_micros(F.col(c))
    server = F.try_to_timestamp(F.expr("substr(server_date, 6)"), F.lit("dd MMM yyyy HH:mm:ss z"))
    middle = (micros("fetched_at_utc") + micros("received_at_utc")) / 2
    return rows.withColumn("server_date_utc", server).withColumn("rtt_s", (micros("received_at_utc") - micros("fetched_at_utc")) / 1e6).withColumn("skew_s", (middle - F.unix_micros("server_date_utc")) / 1e6)


def attachment_name(header: Column) -> Column:
    """The file name of a Content-Disposition header; empty without one or in the extended form."""
    return F.coalesce(F.regexp_extract(header, r'(?i)(?:^|;)\s*filename\s*=\s*"?([^";]+)"?', 1), F.lit(""))
