import gzip
import io
import json
import threading
import zipfile
from datetime import UTC, date, datetime, timedelta
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from punctual.functions.timeline import expected_hours
from punctual import session
from punctual.plans import geography, jobs, report
from punctual.sources import feed, files, polls, timetable

DAY = date(2026, 9, 17)


def epoch(at):
    return int((at - datetime(1970, 1, 1)).total_seconds())


def put(root, name, at, content):
    path = root / f"{name}/dt={at:%Y-%m-%d}/hour={at:%H}"
    path.mkdir(parents=True, exist_ok=True)
    (path / f"{at:%H%M%S}.pb.gz").write_bytes(gzip.compress(content))


def updates(arrival, delay, relation=0):
    m = feed.message_type()()
    m.header.gtfs_realtime_version = "2.0"
    u = m.entity.add(id="1").trip_update
    u.trip.trip_id, u.trip.route_id, u.trip.start_date, u.trip.start_time, u.trip.schedule_relationship = "k", "r", "20260917", "08:00:00", relation
    s = u.stop_time_update.add(stop_id="s1", stop_sequence=1)
    s.arrival.time, s.arrival.delay = epoch(arrival), delay
    return m.SerializeToString()


def positions(at):
    m = feed.message_type()()
    m.header.gtfs_realtime_version = "2.0"
    v = m.entity.add(id="1").vehicle
    v.vehicle.id, v.timestamp, v.position.latitude, v.position.longitude = "bus", epoch(at), -33.5, 151.25
    return m.SerializeToString()


def bundle():
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, text in timetable.DIMENSIONS.values():
            columns = [p.split()[1].rstrip("?") for p in text.split(", ")]
            row = {"trip_id": "k", "stop_id": "s1", "stop_sequence": "1", "arrival_time": "08:00:00", "departure_time": "08:00:00", "service_id": "x"}
            z.writestr(name, ",".join(columns) + "\n" + ",".join(row.get(c, "") for c in columns) + "\n")
    return buffer.getvalue()


def test_a_day_from_raw_objects_to_checked_facts(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "curated")
    a, b = datetime(2026, 9, 16, 21, 59), datetime(2026, 9, 16, 22, 1)
    arrival = datetime(2026, 9, 16, 22, 1, 30)
    put(raw, "tripupdates", a, updates(arrival, 60))
    put(raw, "tripupdates", b, updates(arrival + timedelta(seconds=30), 90))
    for at in (a, a + timedelta(seconds=10), b):
        put(raw, "vehiclepos", at, positions(a))
    (tmp_path / "b.zip").write_bytes(bundle())
    check = jobs.load_schedule(spark, str(tmp_path / "b.zip"), root, datetime(2026, 9, 16, 2, tzinfo=UTC))
    assert check["changed"] and not jobs.load_schedule(spark, str(tmp_path / "b.zip"), root, datetime(2026, 9, 17, 2, tzinfo=UTC), check["zip_sha256"])["changed"]

    with pytest.raises(ValueError, match="no partials"):
        jobs.merge_day(spark, root, DAY)
    with pytest.raises(ValueError, match="no raw objects"):
        jobs.compact(spark, str(raw), root, [datetime(2020, 1, 1, tzinfo=UTC)])
    for _ in range(2):  # a second run changes nothing
        records = jobs.compact(spark, str(raw), root, [datetime(2026, 9, 16, 21, tzinfo=UTC), datetime(2026, 9, 16, 22, tzinfo=UTC)])
        merged = jobs.merge_day(spark, root, DAY)
    assert [r["partition"] for r in records] == ["2026-09-16T21", "2026-09-16T22"]
    assert [r["objects_read"] for r in records] == [3, 2] and all(r["peak_rss_mb"] > 0 for r in records)
    hourly = sorted((r.hour, r.fetched_at_utc) for r in spark.read.parquet(f"{root}/_partial/vehicle_position").collect())
    assert [t for _, t in hourly] == [a, b]  # each hour has its own first sighting
    assert not list((tmp_path / "curated" / "_decoded").iterdir())
    assert merged["short"] and merged["valid_from"] == "2026-09-16T020000Z" and "trips" in merged["breaches"]
    (call,) = files.read_facts(spark, f"{root}/fact_trip_stop").collect()
    assert (call.service_date, call.n_updates, call.delay_s, call.is_reliable) == (DAY, 2, 90, True)
    assert call.scheduled_arrival_utc == datetime(2026, 9, 16, 22)
    (trip,) = files.read_facts(spark, f"{root}/fact_trip").collect()
    assert (trip.scheduled_polls, trip.final_status) == (2, "SCHEDULED")
    (seen,) = files.read_facts(spark, f"{root}/fact_vehicle_position").collect()
    assert (seen.fetched_at_utc, seen.vehicle_id) == (a, "bus") and "dt" not in seen
    with pytest.raises(ValueError, match="no such table"):
        jobs.merge_day(spark, root, DAY, ("trips",))
    with pytest.raises(ValueError, match="not closed"):
        jobs.replay(spark, str(raw), root, [DAY], datetime(2026, 9, 17, 20, tzinfo=UTC))
    assert len(expected_hours(DAY)) == 32


def test_a_replay_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    ran, broken = [], {"merge": True}
    monkeypatch.setattr(jobs, "compact", lambda *a: ran.append("compact"))

    def merge_day(spark, root, day):
        ran.append(day)
        if broken["merge"] and day == date(2026, 9, 18):
            raise OSError("no store")
        return {"day": day}

    monkeypatch.setattr(jobs, "merge_day", merge_day)
    days, log, now = [date(2026, 9, 17), date(2026, 9, 18), date(2026, 9, 19)], str(tmp_path / "log"), datetime(2026, 9, 25, tzinfo=UTC)
    assert jobs.replay(spark, "", "", days, now, log) == [{"day": days[0]}, {"day": days[2]}]
    broken["merge"] = False
    assert jobs.replay(spark, "", "", days, now + timedelta(hours=1), log) == [{"day": days[1]}]
    assert ran == ["compact", *days, days[1]]
    assert len(jobs.replay(spark, "", "", days, now + timedelta(days=3), log)) == 3  # too long ago
    monkeypatch.setattr(jobs, "merge_day", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        jobs.replay(spark, "", "", days, now, str(tmp_path / "other"))
    with pytest.raises(ZeroDivisionError):
        jobs.replay(spark, "", "", days[:1], now)


def test_the_health_report_of_a_day(spark, tmp_path):
    root, day = str(tmp_path), date(2026, 9, 17)
    at = datetime(2026, 9, 16, 20, 0)
    iso = lambda s: (at + timedelta(seconds=s)).isoformat()
    row = lambda s, feed="vehiclepos", code=200, error=None: {"feed": feed, "fetched_at_utc": iso(s), "received_at_utc": iso(s + 1), "rtt_s": 1.0, "server_date_utc": iso(s), "skew_s": 0.5, "status_code": code, "body_bytes": 10 + s, "error": error}
    for r in [*(row(10 * i) for i in range(11)), row(5, "tripupdates"), row(65, "tripupdates", None, "crashed")]:
        files.append_audit(spark, f"{root}/collector_run", date(2026, 9, 16), r)
    files.append_audit(spark, f"{root}/curation_run", day, {"job": "merger", "partition": "2026-09-17", "rows_out": 7, "peak_rss_mb": 90, "error": None})
    record = report.health(spark, root, day)
    assert record["collection"]["feeds"] == {"vehiclepos": {"expected": 12, "actual": 11}, "tripupdates": {"expected": 2, "actual": 2}}
    assert record["collection"]["failures"] == {"crashed": 1} and record["collection"]["worst_minutes"] == {"20:01": 5}
    assert record["curation"]["merger"]["runs_seen"] == 1 and len(record["curation"]["compactor"]["missing_partitions"]) == 24
    text = report.render(record)
    assert "vehiclepos: 11 of 12 (91.7 %) polls" in text and "merger: 1 of 1 (100.0 %) partitions, 0 errors, 7 rows, 90 MB" in text and "timetable: 0 of 1" in text
    assert report.render({"version": 9}).startswith("unknown report version")
    empty = report.health(spark, str(tmp_path / "nothing"), day)
    assert empty["collection"]["minutes"] == 1440 and "no failures" in report.render(empty)


def test_session_settings_read_back(spark):
    session.object_store(spark, "http://store.example:9000", "who", "hush")
    found = session.effective(spark)
    assert found["spark.sql.session.timeZone"] == "UTC" and found["fs.s3a.endpoint"] == "http://store.example:9000"
    assert found["fs.s3a.secret.key"] == "set" and "hush" not in str(found)
    assert session.ask(spark, "SELECT :a + 1 AS x, :b AS y", a=4, b="it's").first() == (5, "it's")


class Answer(BaseHTTPRequestHandler):
    def do_GET(self):
        body = b"" if "empty" in self.path else json.dumps({"code": "Ok", "distances": [[7.0]], "durations": [[5.0]], "sources": [{"distance": 1}], "destinations": [{"distance": 200}]}).encode()
        self.send_response(503 if "bad" in self.path else 200)
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *args):
        pass


@pytest.fixture(scope="module")
def server():
    s = ThreadingHTTPServer(("127.0.0.1", 0), Answer)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def test_polls_never_raise(server):
    ok, bad, gone, empty = (polls.fetch_feed("vehiclepos", u) for u in (f"{server}/ok", f"{server}/bad", "http://127.0.0.1:1/", f"{server}/empty"))
    assert ok.status == 200 and ok.error is None and ok.server_date and gzip.decompress(polls.payload(ok)) == ok.body
    assert (bad.status, bad.error) == (503, "HTTP 503") and gone.status is None and gone.error
    assert polls.payload(empty) is None and empty.audit()["body_bytes"] == 0
    assert abs(ok.audit()["skew_s"]) < 5 and gone.audit()["skew_s"] is None
    assert polls.fetch_bundle(f"{server}/ok") == ok.body
    with pytest.raises(OSError):
        polls.fetch_bundle(f"{server}/bad")
    assert polls.server_date("nonsense") is None


def test_a_minute_of_polls_is_audited_whatever_happens(server):
    kept, rows = [], []

    def store(poll, content):
        if poll.feed == "tripupdates":
            raise OSError("disk full")
        kept.append((poll.feed, len(content)))

    urls = {"vehiclepos": f"{server}/ok", "tripupdates": f"{server}/ok"}
    polls.collect_minute(urls, store, rows.extend, {"vehiclepos": (0, 0.1, 0.2), "tripupdates": (0.05,)})
    assert [r["feed"] for r in rows] == ["vehiclepos", "tripupdates", "vehiclepos", "vehiclepos"] and len(kept) == 3
    assert [r["error"] for r in rows] == [None, "crashed", None, None]
    polls.collect_minute({"vehiclepos": "http://127.0.0.1:1/"}, store, rows.extend, {"vehiclepos": (0,)})
    assert rows[-1]["error"] and rows[-1]["status_code"] is None


def test_router_tables(spark, server):
    shape = "stop_id string, stop_lon double, stop_lat double, mesh_block_codes array<string>, lons array<double>, lats array<double>"
    origins = spark.createDataFrame([("s", 151.0, -33.0, ["10001"], [151.1], [-33.1])], shape)
    assert [(r.mesh_block_code, r.status) for r in geography.parse_routes(polls.route_tables(origins, server)).collect()] == [("10001", "snap_failed")]
    assert geography.parse_routes(polls.route_tables(origins, "http://127.0.0.1:1")).count() == 0
