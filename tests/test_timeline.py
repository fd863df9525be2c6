from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from punctual.functions import timeline as tl


def test_clock_texts():
    assert tl.parse_clock("25:10:00") == 90_600
    for bad in ("8", "08:61:00", "", "a:b:c"):
        with pytest.raises(ValueError):
            tl.parse_clock(bad)


def test_wall_clock_agrees_between_driver_and_columns(spark):
    days = [(date(2026, 10, 4), "02:30:00"), (date(2026, 9, 22), "25:10:00"), (date(2026, 10, 3), "26:30:00"), (date(2026, 1, 1), "00:00:00")]
    df = spark.createDataFrame(days, "d date, t string").coalesce(1)
    got = [r.x.replace(tzinfo=UTC) for r in df.select(tl.wall_instant(F.col("d"), tl.clock_seconds(F.col("t"))).alias("x")).collect()]
    assert got[0] == datetime(2026, 10, 3, 16, 30, tzinfo=UTC)
    assert got == [tl.scheduled_instant(d, t) for d, t in days]


def test_days_have_their_hours():
    assert [tl.hours_in_day(date(2026, m, d)) for m, d in ((9, 22), (10, 4), (4, 5))] == [24, 23, 25]
    assert [len(tl.day_hours(date(2026, m, d))) for m, d in ((9, 22), (10, 4), (4, 5))] == [24, 23, 25]
    start, end = tl.merge_window(date(2026, 9, 17))
    assert (start, end) == (datetime(2026, 9, 16, 13, tzinfo=UTC), datetime(2026, 9, 17, 21, tzinfo=UTC))
    assert len(tl.expected_hours(date(2026, 9, 17))) == 32
    assert tl.partition_bounds(date(2026, 9, 17)) == ("2026-09-15", "2026-09-18")


def test_days_of_instants():
    assert tl.service_date(datetime(2026, 9, 22, 15, tzinfo=UTC)) == date(2026, 9, 23)
    assert tl.last_complete_day(datetime(2026, 9, 18, 21, tzinfo=UTC)) == date(2026, 9, 18)
    assert tl.last_complete_day(datetime(2026, 9, 18, 20, tzinfo=UTC)) == date(2026, 9, 17)
    assert len(tl.hours_to_compact(tl.day_range(date(2026, 9, 17), date(2026, 9, 18)))) == 56
    assert tl.snapshot_label(datetime(2026, 9, 19, 17, 34, 55, tzinfo=UTC)) == "2026-09-19T173455Z"
