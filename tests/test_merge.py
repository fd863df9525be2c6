from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from punctual.plans import merge

CALL = "service_date string, trip_id string, stop_id string, stop_sequence int, route_id string, final_predicted_arrival_utc timestamp, delay_s int, final_predicted_departure_utc timestamp, departure_delay_s int, last_update_at_utc timestamp, arrival_updated_at_utc timestamp, n_updates int, schedule_relationship string, had_vehicle boolean, lost_tracking boolean, last_observed_at_utc timestamp, dt string, hour string"
DAY = date(2026, 9, 17)
TIMES = "trip_id string, stop_id string, stop_sequence int, arrival_time string, departure_time string"


def t(text):
    return datetime.fromisoformat(text)


def call(delay=60, updated="2026-09-16T20:30:00", observed=None, arrival="2026-09-17T00:00:00", arrival_updated="same", n=1, hour="21", dt="2026-09-16", feed="20260917", trip="1012281", seq=1, departure=None):
    updated = t(updated) if updated else None
    moved = updated if arrival_updated == "same" else (t(arrival_updated) if arrival_updated else None)
    return (feed, trip, "200013", seq, "2447_160", t(arrival) if arrival and moved else None, delay if moved else None, t(departure) if departure else None, None, updated, moved, n, "SCHEDULED", True, False, t(observed) if observed else updated, dt, hour)


@pytest.fixture
def build(spark):
    def run(rows, day=DAY, times=None):
        stop_times = spark.createDataFrame(times, TIMES) if times else None
        return merge.build_calls(spark.createDataFrame(rows, CALL), day, stop_times).collect()

    return run


def test_counts_sum(build):
    (row,) = build([call(n=5), call(n=7, hour="22"), call(n=3, hour="23")])
    assert row.n_updates == 15 and row.service_date == DAY


def test_latest_wins(build):
    (row,) = build([call(delay=300, updated="2026-09-16T22:30:00", hour="22"), call(delay=60)])
    assert row.delay_s == 300


def test_lost_tracking_is_not_reliable(build):
    (row,) = build([call(observed="2026-09-16T20:45:00", arrival="2026-09-16T20:30:30")])
    assert row.lost_tracking and not row.is_reliable


def test_arrival_is_carried_forward(build):
    (row,) = build([call(delay=120, updated="2026-09-16T20:59:00", hour="20"), call(updated="2026-09-16T21:05:00", arrival_updated=None, hour="21")])
    assert (row.delay_s, row.arrival_updated_at_utc, row.last_update_at_utc) == (120, t("2026-09-16T20:59:00"), t("2026-09-16T21:05:00"))


def test_reliability_needs_a_fresh_arrival(build):
    stale = call(updated="2026-09-17T00:05:00", arrival_updated="2026-09-16T23:55:00")
    fresh = call(updated="2026-09-17T00:05:00", arrival_updated="2026-09-16T23:59:30", trip="other")
    assert {r.trip_id: r.is_reliable for r in build([stale, fresh])} == {"1012281": False, "other": True}


@pytest.mark.parametrize("turned", [False, True])
def test_ties_go_to_the_later_hour(build, turned):
    rows = [call(delay=100, hour="20"), call(delay=200, hour="21")]
    (row,) = build(rows[::-1] if turned else rows)
    assert row.delay_s == 200


def test_after_midnight_trips_are_filed_under_the_day_before(build):
    times = [("1012281", "200013", 1, "24:30:00", "24:30:00")]
    (row,) = build([call(feed="20260918")], times=times)
    assert row.service_date == DAY and row.scheduled_arrival_utc == t("2026-09-17T14:30:00")
    assert build([call(feed="20260918")], day=date(2026, 9, 18), times=times) == []


def test_trips_crossing_midnight_and_unknown_ones_stay(build):
    times = [("1012281", "200013", 1, "23:30:00", "23:30:00")]
    assert build([call()], times=times)[0].service_date == DAY
    assert build([call(feed="20260918", trip="unknown")], day=date(2026, 9, 18), times=times)[0].service_date == date(2026, 9, 18)


def test_calls_without_a_sequence_drop_out(build):
    assert build([call(seq=None)]) == []


def test_partition_bounds_and_older_schemas(spark, tmp_path):
    rows = spark.createDataFrame([call(n=1), call(n=500, dt="2026-08-01")], CALL)
    path = str(tmp_path / "p")
    rows.where("dt > '2026-09'").drop("had_vehicle").withColumn("retired", F.lit(1)).write.partitionBy("dt", "hour").parquet(path)
    rows.where("dt < '2026-09'").write.mode("append").partitionBy("dt", "hour").parquet(path)
    (row,) = merge.build_calls(merge.read_partials(spark, path, DAY), DAY).collect()
    assert row.n_updates == 1 and "retired" not in row and row.asDict()["hour"] if "hour" in row else True


def test_stored_types(spark, tmp_path):
    path = str(tmp_path / "fact")
    merge.build_calls(spark.createDataFrame([call()], CALL), DAY).write.parquet(path)
    kinds = dict(spark.read.parquet(path).dtypes)
    assert (kinds["n_updates"], kinds["is_reliable"], kinds["service_date"]) == ("int", "boolean", "date")


TRIP = "start_date string, trip_id string, route_id string, start_time string, final_status string, final_status_at_utc timestamp, scheduled_polls int, canceled_polls int, added_polls int, first_seen_at_utc timestamp, last_seen_at_utc timestamp, first_canceled_at_utc timestamp, last_canceled_at_utc timestamp, had_vehicle boolean, dt string, hour string"


def test_trip_polls_sum_and_the_latest_status_wins(spark):
    a, b = t("2026-09-16T21:00:00"), t("2026-09-16T22:00:00")
    rows = [("20260917", "k", "r", "08:00:00", "SCHEDULED", a, 50, 10, 0, a, a, a, a, False, "2026-09-16", "21"), ("20260917", "k", "r", None, "CANCELED", b, 5, 55, 0, b, b, b, b, True, "2026-09-16", "22")]
    (row,) = merge.build_trips(spark.createDataFrame(rows, TRIP), DAY).collect()
    assert (row.scheduled_polls, row.canceled_polls, row.added_polls, row.final_status, row.start_time) == (55, 65, 0, "CANCELED", "08:00:00")
    assert (row.first_seen_at_utc, row.last_canceled_at_utc, row.had_vehicle, row.service_date) == (a, b, True, DAY)


def test_positions_are_kept_once_within_the_window(spark):
    columns = "observed_at_utc timestamp, fetched_at_utc timestamp, vehicle_id string, route_id string, lat double, lon double, dt string, hour string"
    at = t("2026-09-17T01:00:00")
    rows = [(at, t("2026-09-17T01:00:20"), "v", "late", 1.0, 2.0, "", ""), (at, t("2026-09-17T01:00:10"), "v", "r", 1.0, 2.0, "", ""), (at, at, "v", "r", 1.1, 2.0, "", ""), (t("2026-09-18T09:00:00"), at, "v", "r", 1.0, 2.0, "", "")]
    got = merge.build_positions(spark.createDataFrame(rows, columns), DAY).collect()
    assert len(got) == 2 and {r.route_id for r in got} == {"r"}


def test_collector_rows_are_cut_by_the_local_day(spark):
    row = lambda at: ("vehiclepos", at, at, 0.1, None, None, 200, 10, None)
    rows = spark.createDataFrame([row("2026-09-16T13:59:59Z"), row("2026-09-16T14:00:00Z"), row("2026-09-17T13:59:59Z")], merge.COLLECTOR_RUN)
    assert [r.fetched_at_utc for r in merge.collector_run(rows, DAY).collect()] == [t("2026-09-16T14:00:00"), t("2026-09-17T13:59:59")]


def test_snapshot_choice():
    labels = ["2026-09-19T173455Z", "2026-09-22T150000Z"]
    assert merge.snapshot_for(labels, date(2026, 9, 22)) == (labels[0], False)
    assert merge.snapshot_for(labels, date(2026, 9, 23)) == (labels[1], False)
    assert merge.snapshot_for(labels, date(2026, 9, 1)) == (labels[0], True) and merge.snapshot_for([], DAY) == (None, False)


def test_upsert(spark):
    old, new = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert sorted(map(tuple, merge.upsert(old, new, ["k"]).collect())) == [(1, "a"), (2, "c"), (3, "d")]
