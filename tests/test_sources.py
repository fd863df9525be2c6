import io
import zipfile
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from punctual.operators import relational as op
from punctual.sources import files, timetable
from punctual.streaming import hourly


def test_snapshots_keep_their_label_as_text(spark, tmp_path):
    for label, extra in (("2026-09-19T173455Z", False), ("2026-09-22T020011Z", True)):
        df = spark.createDataFrame([("001", "x")], "id string, extra string")
        files.write_snapshot(df if extra else df.drop("extra"), str(tmp_path), "stop", label)
    rows = files.read_snapshots(spark, str(tmp_path / "dim_stop")).orderBy("valid_from").collect()
    assert [(r.id, r.valid_from, r.extra) for r in rows] == [("001", "2026-09-19T173455Z", None), ("001", "2026-09-22T020011Z", "x")]


def test_facts_count_what_they_write(spark, tmp_path):
    df = spark.createDataFrame([("r", "t", i, date(2026, 9, 22)) for i in range(5)], "route_id string, trip_id string, stop_sequence int, service_date date")
    assert files.write_fact(df, str(tmp_path), "trip_stop", "2026-09-22") == 5
    back = files.read_facts(spark, str(tmp_path / "fact_trip_stop"))
    assert back.count() == 5 and dict(back.dtypes)["service_date"] == "date"
    assert files.write_fact(df.limit(0), str(tmp_path), "trip", "2026-09-22") == 0


def test_optional_tables_and_merged_days(spark, tmp_path):
    assert files.read_optional(spark, str(tmp_path / "none"), "a int").count() == 0
    live = spark.createDataFrame([(1,)], "a int")
    assert files.read_day(spark, str(tmp_path / "none"), live).first().a == 1
    live.selectExpr("a + 1 as a").write.parquet(str(tmp_path / "day"))
    assert files.read_day(spark, str(tmp_path / "day"), live).first().a == 2


def test_audits_read_the_days_that_exist(spark, tmp_path):
    files.append_audit(spark, str(tmp_path), date(2026, 9, 22), {"job": "merger", "rows_out": 3})
    files.append_audit(spark, str(tmp_path), date(2026, 9, 22), {"job": "compactor"})
    rows = files.read_audit(spark, str(tmp_path), [date(2026, 9, 21), date(2026, 9, 22)], "job string, rows_out bigint").collect()
    assert sorted((r.job, r.rows_out) for r in rows) == [("compactor", None), ("merger", 3)]
    assert files.read_audit(spark, str(tmp_path), [date(2020, 1, 1)], "job string").count() == 0


def test_centres_are_checked(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("centre_id,centre_name,tier,latitude,longitude,source\na,A,strategic,-33,151,s\n")
    assert files.read_centres(spark, str(path)).first().latitude == -33
    path.write_text("centre_id,centre_name,tier,latitude,longitude,source\na,A,strategic,-133,151,s\n")
    with pytest.raises(Exception, match="bad centre"):
        files.read_centres(spark, str(path)).collect()


def test_pull_plan(spark):
    t = lambda n: datetime(2026, 9, n)
    remote = spark.createDataFrame([("a", 1, t(1)), ("b", 2, t(1)), ("c", 1, t(2)), ("d", 1, t(1))], "path string, size long, modified timestamp")
    local = spark.createDataFrame([("b", 1, t(1)), ("c", 1, t(1)), ("d", 1, t(1)), ("e", 1, t(1))], "path string, size long, modified timestamp")
    assert dict(map(tuple, files.pull_plan(remote, local).collect())) == {"a": "download", "b": "download", "c": "download", "e": "delete"}


def test_timetable_bundles(spark, tmp_path):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("stops.txt", "﻿stop_id,stop_name,stop_lat,stop_lon\n001,\"A, b\",-33.5,151\n002,,,\n")
        z.writestr("routes.txt", "route_id\nr\n")
    (tmp_path / "b.zip").write_bytes(buffer.getvalue())
    bundle = timetable.bundles(spark, str(tmp_path / "b.zip"))
    rows = timetable.dimension(bundle, "stop").orderBy("stop_id").collect()
    assert [tuple(r) for r in rows] == [("001", "A, b", -33.5, 151.0, None), ("002", None, None, None, None)]
    with pytest.raises(Exception, match="has no column"):
        timetable.dimension(bundle, "route").collect()
    with pytest.raises(Exception, match="trips.txt"):
        timetable.dimension(bundle, "trip").collect()
    assert timetable.changed(bundle, None) and not timetable.changed(bundle, bundle.first().sha256)


def test_as_of_and_band_joins(spark):
    days = spark.createDataFrame([(d,) for d in (1, 5, 9)], "day int")
    snaps = spark.createDataFrame([(4, "a"), (8, "b"), (8, "c")], "since int, label string")
    got = {r.day: (r.pick, r.pick_borrowed) for r in op.as_of(days, snaps, "day", "since", "label", "pick").collect()}
    assert got == {1: ("a", True), 5: ("a", False), 9: ("c", False)}
    a = spark.createDataFrame([(i, i * 0.7) for i in range(40)], "i int, x double")
    b = spark.createDataFrame([(j, j * 0.5) for j in range(40)], "j int, y double")
    want = {(i, j) for i in range(40) for j in range(40) if abs(i * 0.7 - j * 0.5) <= 1.0}
    assert {(r.i, r.j) for r in op.grid_band_join(a, b, [("x", "y", 1.0)]).collect()} == want


def test_streams_give_the_batch_answer(spark, tmp_path):
    t = lambda h, m: datetime(2026, 9, 22, h, m)
    rows = [("v", t(0, 1), 1.0, 1.0, t(0, 1), "first"), ("v", t(0, 1), 1.0, 1.0, t(0, 2), "again"), ("w", t(0, 1), 1.0, 1.0, t(0, 3), "w")]
    path = str(tmp_path / "positions")
    spark.createDataFrame(rows, "vehicle_id string, observed_at_utc timestamp, lat double, lon double, fetched_at_utc timestamp, trip_id string").coalesce(1).write.parquet(path)
    out = hourly.to_end(hourly.first_positions(hourly.source(spark, path)))
    assert sorted(r.trip_id for r in out.collect()) == ["first", "w"]


def test_hourly_partials_close_with_the_watermark(spark, tmp_path):
    t = lambda h, m: datetime(2026, 9, 22, h, m)
    row = lambda at, relation, dep: (at, "20260922", "k", "s", 1, relation, t(9, dep), at, 0)
    path = str(tmp_path / "polls")
    shape = "fetched_at_utc timestamp, start_date string, trip_id string, stop_id string, stop_sequence int, relationship string, departure_at timestamp, seen_at timestamp, poll int"
    for i, part in enumerate([[row(t(0, 5), "SCHEDULED", 1), row(t(0, 50), "NO_DATA", 9), row(t(0, 40), "SCHEDULED", 2)], [row(t(2, 0), "SCHEDULED", 3)]]):
        spark.createDataFrame(part, shape).coalesce(1).write.mode("append").parquet(path) if i else spark.createDataFrame(part, shape).coalesce(1).write.parquet(path)
    out = hourly.to_end(hourly.hourly_partials(hourly.source(spark, path))).collect()
    (r,) = [x for x in out if x.hour == t(0, 0)]
    assert (r.n_updates, r.final_predicted_departure_utc, r.last_update_at_utc, r.last_observed_at_utc) == (2, t(9, 2), t(0, 40), t(0, 50))


def test_days_are_rewritten_by_partition(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(date(2026, 9, 22), 1), (date(2026, 9, 22), 2)], "service_date date, n int").coalesce(1).write.parquet(path)
    total = lambda spark, batch: batch.groupBy("service_date").agg(F.sum("n").alias("n"))
    for run in ("a", "b"):
        hourly.merge_days(hourly.source(spark, path), total, out, str(tmp_path / run)).awaitTermination()
    assert [r.n for r in spark.read.parquet(out).collect()] == [3]
