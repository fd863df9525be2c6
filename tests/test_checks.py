from datetime import date, datetime, timedelta

import pytest

from punctual.functions.timeline import expected_hours
from punctual.plans import checks

CALLS = "trip_id string, stop_id string, stop_sequence int, scheduled_arrival_utc timestamp, final_predicted_arrival_utc timestamp, final_predicted_departure_utc timestamp, schedule_relationship string, is_reliable boolean"
TRIPS = "service_date date, trip_id string, start_date string, final_status string, canceled_polls int, first_canceled_at_utc timestamp, last_canceled_at_utc timestamp, first_seen_at_utc timestamp, last_seen_at_utc timestamp"
AT, DAY = datetime(2026, 9, 22, 1), date(2026, 9, 22)


def test_planted_faults(spark):
    hours = lambda n: AT + timedelta(hours=n)
    calls = [
        ("a", "s", 1, AT, AT, AT, "SCHEDULED", True),
        ("a", "s", 2, AT, hours(13), AT, "SCHEDULED", False),
        ("a", "s", 3, AT, AT, hours(-13), "SCHEDULED", False),
        ("a", "s", 4, AT, datetime(1970, 1, 1), None, "SCHEDULED", False),
        ("b", "s", 1, None, AT, AT, "SCHEDULED", False),
        ("b", "s", 1, AT, AT, AT, "SKIPPED", False),
        ("", "s", 1, None, None, None, "NO_DATA", False),
        ("", "s", 1, None, None, None, "NO_DATA", False),
    ]
    seen = (AT, hours(1))
    trips = [(DAY, "a", "20260922", "SCHEDULED", 0, None, None, *seen), (DAY, "a", "20260923", "SCHEDULED", 0, None, None, *seen), (DAY, "b", "20260922", "CANCELED", 0, None, None, *seen), (DAY, "c", "20260922", "SCHEDULED", 2, hours(1), AT, *seen)]
    found = checks.day_checks(spark.createDataFrame(calls, CALLS), spark.createDataFrame(trips, TRIPS))
    r = found.first()
    assert tuple(r) == (2, 1, 1, 1, 2, pytest.approx(1 / 6), pytest.approx(1 / 5), 4)
    assert {b.name for b in checks.breaches(found).collect()} == {*checks.ZERO, "unscheduled_share", "reliable_share", "trips"}
    assert checks.breach_metric(found).first()[0] == 8


def test_an_empty_day_breaches_shares_and_trips(spark):
    found = checks.day_checks(spark.createDataFrame([], CALLS), spark.createDataFrame([], TRIPS))
    assert {b.name for b in checks.breaches(found).collect()} == {"reliable_share", "trips"}


AUDIT = "feed string, fetched_at_utc timestamp, rtt_s double, server_date_utc timestamp, skew_s double, status_code int, body_bytes bigint, error string"


def polls():
    t = lambda s: datetime(2026, 9, 22, 0, 0) + timedelta(seconds=s)
    ok = [("vehiclepos", t(50 + 10 * i), 0.1 * i, t(0), 0.0, 200, 100 + i, None) for i in range(9)]
    bad = [("vehiclepos", t(60), None, None, None, None, 0, "crashed"), ("tripupdates", t(70), None, None, None, None, 0, "timed out"), ("tripupdates", t(80), 0.5, t(0), 0.0, 503, 5, "HTTP 503"), ("tripupdates", t(85), 0.5, None, None, 200, 7, None)]
    return ok + bad


def test_collection(spark):
    rows = spark.createDataFrame(polls(), AUDIT)
    assert {r.feed: (r.actual, r.expected) for r in checks.feed_counts(rows).collect()} == {"vehiclepos": (10, 12), "tripupdates": (3, 2)}
    assert {(r.feed, r.status): r.n for r in checks.status_counts(rows).collect()} == {("vehiclepos", "200"): 9, ("vehiclepos", "crashed"): 1, ("tripupdates", "transport_error"): 1, ("tripupdates", "503"): 1, ("tripupdates", "200"): 1}
    counts, examples = checks.failure_summary(rows)
    assert {r.category: r.n for r in counts.collect()} == {"ok": 9, "crashed": 1, "transport_error": 1, "non_200": 1, "null_server_date": 1}
    assert [r.category for r in examples.collect()] == ["crashed", "transport_error", "non_200", "null_server_date"]
    gaps = checks.coverage_gaps(rows)
    assert [tuple(r) for r in checks.worst_gaps(gaps).collect()] == [("00:00", 1)]
    assert {r.feed: r.median for r in checks.payload_stats(rows).collect()}["tripupdates"] == 5
    assert checks.timing_stats(rows).first().rtt_s_max == pytest.approx(0.8)


def test_a_day_without_polls_owes_all_minutes(spark):
    rows = spark.createDataFrame([], AUDIT)
    assert {r.feed: r.expected for r in checks.feed_counts(rows).collect()} == {"vehiclepos": 8640, "tripupdates": 1440}
    assert checks.coverage_gaps(rows).count() == 0


def test_curation(spark):
    shape = "job string, partition string, " + ", ".join(f"{c} bigint" for c in checks.SUMMED) + ", peak_rss_mb bigint, error string"
    row = lambda job, p, rss, error=None: (job, p, *([1] * len(checks.SUMMED)), rss, error)
    records = spark.createDataFrame([row("compactor", "2026-09-21T14", 10), row("compactor", "2026-09-21T14", 30, "boom"), row("compactor", "2020-01-01T00", 99), row("merger", "2026-09-22", 5)], shape)
    got = checks.summarize_curation(records, DAY, spark.createDataFrame([(True,)], "changed boolean"))
    c = got["compactor"].first()
    assert (c.runs_expected, c.runs_seen, c.objects_read, c.peak_rss_mb, c.errors) == (24, 1, 2, 30, 1)
    assert len(c.missing_partitions) == 23 and c.missing_partitions[0] == "2026-09-21T15"
    assert got["merger"].first().missing_partitions == [] and got["hours_in_day"] == 24
    assert tuple(got["schedule"].first()) == (1, 1, True)


def test_partial_coverage(spark):
    hours = expected_hours(DAY)
    present = spark.createDataFrame([("trip", f"{h:%Y-%m-%d}", f"{h:%H}") for h in hours[:5]], "table string, dt string, hour string")
    assert checks.partial_coverage(DAY, present) == {"objects_expected": 96, "objects_read": 5, "short": True}
    with pytest.raises(ValueError):
        checks.partial_coverage(DAY, present.limit(0))
