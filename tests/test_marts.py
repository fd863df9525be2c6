import json
import math
from datetime import date, datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from punctual.functions.timeline import trip_instant
from punctual.plans import service
from punctual.plans.marts import Marts
from tests.world import SCHEMAS, rows, tables

KINDS = {"string": "VARCHAR", "int": "INTEGER", "double": "DOUBLE", "date": "DATE", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN", "short": "SMALLINT"}


def sql_of(seed):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name, own in rows(seed).items():
        columns = [c.split(" ") for c in SCHEMAS[name].split(", ")]
        con.execute(f"CREATE TABLE {name} ({', '.join(f'{c} {KINDS[t]}' for c, t in columns)})")
        if own:
            con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(columns))})", own)
    return con


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else float(f"{value:.9g}") if isinstance(value, float) else value


@pytest.mark.parametrize("seed", [1, 2])
def test_views_of_small_networks_match_their_sql(spark, seed, tmp_path):
    marts, con = Marts(tables(spark, seed)), sql_of(seed)
    marts.freeze("call_observation", str(tmp_path / "calls"))
    for name, kinds in service.COLUMNS.items():
        view, columns = name.split("_", 1)[1], [tuple(c.split(" ")) for c in kinds.split(", ")]
        want = con.execute(service.twin(view, service.VIEWS, columns)).fetchall()
        got = service.shown(getattr(marts, view).select(*[c for c, _ in columns])).collect()
        assert sorted(([plain(x) for x in r] for r in got), key=str) == sorted(([plain(x) for x in r] for r in want), key=str), view


def test_the_networks_reach_every_outcome():
    con = sql_of(1)
    ctes = ", ".join(f"{n} AS ({s})" for n, s in service.VIEWS.items())
    ask = lambda sql: {r[0] for r in con.execute(f"WITH {ctes} {sql}").fetchall()}
    assert ask("SELECT DISTINCT call_status FROM call_observation") == {"observed", "skipped", "cancelled", "no_prediction", "absent"}
    assert ask("SELECT DISTINCT status FROM mart_trip") == {"ran", "cancelled", "incomplete", "unknown"}
    assert ask("SELECT DISTINCT timetable_borrowed FROM service_day") == {True, False}
    assert {-59, -60, 359, 360} <= ask("SELECT DISTINCT delay_s FROM call_observation WHERE is_judged")


def pulled(spark, root, seed=1):
    """A local copy as a pull leaves it."""
    for name, df in tables(spark, seed).items():
        if name == "calendar_exclusion_seed":
            df.coalesce(1).write.option("header", "true").csv(f"{root}/seeds")
            continue
        base = name.removesuffix("_all")
        folder, key = ("reference", "vintage") if base.startswith("stop_") else ("curated", "valid_from" if name.startswith("dim_") else "service_date")
        part = "valid_from" if key == "valid_from" else f"{key}_folder"
        df.withColumn(part, F.col(key).cast("string")).write.partitionBy(part).parquet(f"{root}/{folder}/{base}")
    return f"{root}/seeds"


def test_marts_over_a_pulled_folder(spark, tmp_path):
    root = str(tmp_path)
    seeds = pulled(spark, root)
    marts, direct = Marts.over(spark, root, [seeds]), Marts(tables(spark, 1))
    for view in ("snapshot", "scheduled_call", "mart_trip", "stop_context"):
        ordered = lambda m, v=view: sorted(map(str, getattr(m, v).select(*sorted(getattr(direct, v).columns)).collect()))
        assert ordered(marts) == ordered(direct)
    assert "dim_agency_all" not in marts.tables
    spark.createDataFrame([("1", "Ferries")], "agency_id string, agency_name string").write.parquet(f"{root}/curated/dim_agency/valid_from=2026-09-17T010000Z")
    assert Marts.over(spark, root, [seeds])["dim_agency_all"].first().valid_from == "2026-09-17T010000Z"


def test_a_catalogue_outlives_its_session(spark, tmp_path):
    root, path = str(tmp_path), str(tmp_path / "views.json")
    marts = Marts.over(spark, root, [pulled(spark, root)])
    (tmp_path / "views.json").write_text("stale")
    marts.write_catalogue(path)
    assert set(json.loads((tmp_path / "views.json").read_text())["views"]) == {n.split("_", 1)[1] for n in service.COLUMNS}
    other = spark.newSession()
    Marts.open_catalogue(other, path)
    assert other.sql("SELECT count(*) FROM mart_trip").first()[0] == marts.mart_trip.count() > 0
    assert other.sql("SELECT count(*) FROM period").first()[0] == 48


def test_a_missing_table_is_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="curated/dim_route"):
        Marts.over(spark, str(tmp_path), [])


def test_trip_instants_across_the_clock_changes(spark):
    h = 3600
    given = [
        ((2026, 10, 3), 25 * h + 1800, 27 * h + 600, datetime(2026, 10, 3, 17, 10)),  # elapsed over the skipped hour
        ((2026, 10, 3), 26 * h + 900, 26 * h + 960, datetime(2026, 10, 3, 16, 16)),  # starts within the skipped hour
        ((2026, 10, 4), 9 * h, 9 * h, datetime(2026, 10, 3, 22, 0)),
        ((2027, 4, 3), 26 * h + 1800, 27 * h, datetime(2027, 4, 3, 17, 0)),  # starts in the repeated hour: its later reading
        ((2027, 4, 3), 25 * h, 27 * h, datetime(2027, 4, 3, 16, 0)),  # begins before it and runs on
        ((2027, 4, 4), 9 * h, 10 * h, datetime(2027, 4, 4, 0, 0)),
    ]
    df = spark.createDataFrame([(i, date(*d), a, b) for i, (d, a, b, _) in enumerate(given)], "i int, d date, a int, b int")
    got = df.select("i", trip_instant(F.col("d"), F.col("a"), F.col("b")).alias("t")).orderBy("i").collect()
    assert [r.t for r in got] == [t for *_, t in given]
