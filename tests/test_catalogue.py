"""Every registered query against its SQL twin, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from punctual.plans import catalogue, facts, service, stores  # noqa: F401

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    return value


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([plain(r[i]) for i in order] for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_matches_its_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, str(DATA))
    got = df.collect()
    result = duck.execute(catalogue.ORACLES[name])
    names, want = [d[0] for d in result.description], result.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert canonical(df.columns, got) == canonical(names, want)


def test_the_service_world_holds_every_case(spark):
    """The views' queries mean something only where each branch has rows."""
    marts = service.Marts(service.world(spark, str(DATA)))
    values = lambda df, c: {r[0] for r in df.select(c).distinct().collect()}
    assert values(marts.call_observation, "call_status") == {"observed", "skipped", "cancelled", "no_prediction", "absent"}
    assert values(marts.mart_trip, "status") == {"ran", "cancelled", "incomplete", "unknown"}
    assert values(marts.service_day, "day_type") == {"public_holiday", "saturday", "sunday", "term_weekday", "holiday_weekday"}
    assert values(marts.scheduled_trip, "is_timetabled") == {True, False}
    # Trips that start in the repeated hour.
    assert marts.scheduled_call.where("service_date = '2027-04-03' and trip_start_s between 26 * 3600 and 27 * 3600 - 1").count()


def test_columns_are_as_declared(spark):
    marts = service.Marts(service.world(spark, str(DATA)))
    for name, kinds in service.COLUMNS.items():
        assert ", ".join(f"{c} {t}" for c, t in getattr(marts, name.split("_", 1)[1]).dtypes) == kinds
    tables = facts.facts(spark, str(DATA))
    for name, kinds in facts.COLUMNS.items():
        assert ", ".join(f"{c} {t}" for c, t in facts.RUNS[name.split("_", 1)[1]](tables).dtypes) == kinds
