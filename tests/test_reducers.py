import gzip
from datetime import datetime

import pytest

from punctual.operators import reducers
from punctual.sources import feed


def t(clock, day=22):
    h, m, *s = map(int, clock.split(":"))
    return datetime(2026, 9, day, h, m, *s)


def epoch(at):
    return int((at - datetime(1970, 1, 1)).total_seconds())


def stop(relation="SCHEDULED", arrival=None, departure=None, delay=None, seq=1, stop_id="s1"):
    event = lambda at: None if at is None else {"time": epoch(at) if at != 0 else 0, "delay": delay}
    return {"stop_id": stop_id, "stop_sequence": seq, "relationship": relation, "arrival": event(arrival), "departure": event(departure)}


def update(at, stops, stamp=None, n=0, trip="k", route="r", relation="SCHEDULED", vehicle=False, start="08:00:00"):
    return (at, n, trip, route, "20260922", start, relation, vehicle, epoch(stamp) if stamp else None, stops)


@pytest.fixture
def calls(spark):
    return lambda rows: reducers.reduce_calls(spark.createDataFrame(rows, reducers.UPDATES)).collect()


def test_echoes_never_overwrite(calls):
    (r,) = calls([update(t("00:01"), [stop(arrival=t("00:30"), delay=60)]), update(t("00:02"), [stop("NO_DATA", arrival=t("01:30"), delay=9)], vehicle=True)])
    assert (r.final_predicted_arrival_utc, r.delay_s, r.n_updates, r.schedule_relationship) == (t("00:30"), 60, 1, "SCHEDULED")
    assert (r.last_update_at_utc, r.last_observed_at_utc, r.lost_tracking, r.had_vehicle) == (t("00:01"), t("00:02"), True, True)


def test_an_echo_alone_is_recorded(calls):
    (r,) = calls([update(t("00:01"), [stop("NO_DATA")])])
    assert (r.n_updates, r.schedule_relationship, r.lost_tracking, r.last_update_at_utc) == (0, "NO_DATA", False, None)


def test_an_absent_or_zero_arrival_keeps_the_earlier_one(calls):
    (r,) = calls([update(t("00:01"), [stop(arrival=t("00:30"), departure=t("00:31"), delay=60)]), update(t("00:02"), [stop(arrival=0, departure=t("00:33"))])])
    assert (r.final_predicted_arrival_utc, r.delay_s, r.arrival_updated_at_utc) == (t("00:30"), 60, t("00:01"))
    assert (r.final_predicted_departure_utc, r.last_update_at_utc, r.n_updates) == (t("00:33"), t("00:02"), 2)


def test_older_updates_count_and_change_nothing(calls):
    rows = [update(t("00:01"), [stop(departure=t("00:40"))], stamp=t("00:05")), update(t("00:02"), [stop(arrival=t("00:31"), delay=7, departure=t("00:41"))], stamp=t("00:03"))]
    (r,) = calls(rows)
    assert (r.n_updates, r.final_predicted_arrival_utc, r.final_predicted_departure_utc) == (2, None, t("00:40"))


def test_of_equal_times_the_later_poll_wins(calls):
    (r,) = calls([update(t("00:02"), [stop(departure=t("00:41"))], stamp=t("00:01")), update(t("00:03"), [stop(departure=t("00:42"))], stamp=t("00:01"), route="later")])
    assert (r.final_predicted_departure_utc, r.route_id) == (t("00:42"), "r")


def test_updates_dated_a_day_ahead_are_dropped(calls):
    # The trip starts at 08:00 local, which is 22:00 the day before.
    near, far = t("09:59:59"), t("10:00:00")
    assert len(calls([update(t("00:01"), [stop(arrival=near)])])) == 1
    assert calls([update(t("00:01"), [stop(arrival=far), stop(seq=2)])]) == []
    assert len(calls([update(t("00:01"), [stop(arrival=far)], start="later")])) == 1


def test_trips(spark):
    rows = [
        update(t("00:01"), [], relation="SCHEDULED"),
        update(t("00:02"), [], relation="SCHEDULED", n=0),
        update(t("00:02"), [], relation="CANCELED", n=1, route="r2"),
        update(t("00:02"), [], relation="SCHEDULED", n=2, route="r3", vehicle=True),
        update(t("00:03"), [], relation="ADDED", trip="other"),
        update(t("00:03"), [], trip=""),
    ]
    got = {r.trip_id: r for r in reducers.reduce_trips(spark.createDataFrame(rows, reducers.UPDATES)).collect()}
    k = got["k"]
    assert set(got) == {"k", "other"}
    assert (k.final_status, k.scheduled_polls, k.canceled_polls, k.route_id, k.had_vehicle) == ("CANCELED", 2, 1, "r3", True)
    assert (k.first_seen_at_utc, k.last_seen_at_utc, k.first_canceled_at_utc) == (t("00:01"), t("00:02"), t("00:02"))


def message(**vehicle):
    m = feed.message_type()()
    m.header.gtfs_realtime_version = "2.0"
    e = m.entity.add(id="1")
    u = e.trip_update
    u.trip.trip_id, u.trip.start_date, u.trip.start_time, u.trip.schedule_relationship = "k", "20260922", "08:00:00", 3
    s = u.stop_time_update.add(stop_id="s1", stop_sequence=4)
    s.arrival.time, s.arrival.delay = epoch(t("00:30")), 60
    u.stop_time_update.add(stop_id="s2", schedule_relationship=2)
    v = m.entity.add(id="2").vehicle
    v.vehicle.id, v.timestamp, v.position.latitude, v.position.longitude, v.occupancy_status = "bus", epoch(t("00:00")), 0, 0, 5
    return m.SerializeToString()


def test_payloads_decode_with_presence(spark, tmp_path):
    folder = tmp_path / "raw/tripupdates/dt=2026-09-22/hour=00"
    folder.mkdir(parents=True)
    (folder / "000102.pb.gz").write_bytes(gzip.compress(message()))
    raw = feed.read_raw(spark, str(tmp_path / "raw"))
    (u,) = feed.trip_updates(raw).collect()
    assert (u.fetched_at_utc, u.trip_id, u.trip_relationship, u.has_vehicle, u.stamp) == (t("00:01:02"), "k", "CANCELED", False, None)
    assert [(s.stop_id, s.stop_sequence, s.relationship, s.arrival and s.arrival.delay) for s in u.stops] == [("s1", 4, "SCHEDULED", 60), ("s2", None, "NO_DATA", None)]
    (p,) = feed.vehicle_positions(raw).collect()
    assert (p.vehicle_id, p.position_age_s, p.null_island, p.occupancy_status, p.bearing) == ("bus", 62.0, True, "FULL", None)
    calls = {r.stop_id: r.schedule_relationship for r in reducers.reduce_calls(feed.trip_updates(raw)).collect()}
    assert calls == {"s1": "SCHEDULED", "s2": "NO_DATA"}


def test_broken_payloads_and_keys_raise(spark, tmp_path):
    for bad in (b"junk", gzip.compress(b"\xff\xff\xff")):
        with pytest.raises(ValueError):
            feed.decode(bad)
    (tmp_path / "odd.pb.gz").write_bytes(gzip.compress(message()))
    with pytest.raises(Exception, match="not a raw key"):
        feed.read_raw(spark, str(tmp_path)).collect()


def test_positions(spark):
    shape = "vehicle_id string, observed_at_utc timestamp, lat double, lon double, fetched_at_utc timestamp, trip_id string"
    rows = [("v", t("00:00"), 1.0, 1.0, t("00:02"), "late"), ("v", t("00:00"), 1.0, 1.0, t("00:01"), "first"), ("v", t("00:00"), 2.0, 1.0, t("00:03"), "moved"), ("w", t("00:00"), 1.0, 1.0, t("00:01"), "w")]
    df = spark.createDataFrame(rows, shape)
    assert sorted(r.trip_id for r in reducers.first_positions(df).collect()) == ["first", "moved", "w"]
    assert reducers.position_conflicts(df).first()[0] == 1


def test_clock_of_a_poll(spark):
    rows = spark.createDataFrame([(t("00:00:00"), t("00:00:02"), "Tue, 22 Sep 2026 00:00:03 GMT"), (t("00:00:00"), t("00:00:02"), "nonsense")], "fetched_at_utc timestamp, received_at_utc timestamp, server_date string").coalesce(1)
    got = [(r.rtt_s, r.skew_s) for r in feed.poll_clock(rows).collect()]
    assert got == [(2.0, -2.0), (2.0, None)]
    names = spark.createDataFrame([('attachment; filename="a b.zip"',), ("attachment; filename*=UTF-8''a.zip",), (None,)], "h string").coalesce(1)
    assert [r[0] for r in names.select(feed.attachment_name(names.h)).collect()] == ["a b.zip", "", ""]
