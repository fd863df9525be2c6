from datetime import date

import pytest
from pyspark.sql import functions as F

from punctual.functions.geo import POLYGON, box, haversine, haversine_m
from punctual.plans import geography as g

BLOCK = ", ".join(f"{c} string" for c in g.AREA) + f", state_code string, geom {POLYGON}"


def block(code, polygon):
    return (code, f"sa1{code}", "sa2", "n", "sa3", "n", "sa4", "n", "g", "n", "1", polygon)


@pytest.fixture(scope="module")
def world(spark):
    ring_with_hole = [box(151.0, -33.7, 151.1, -33.6)[0], box(151.04, -33.66, 151.06, -33.64)[0]]
    blocks = spark.createDataFrame([block("10001", box(151.19, -33.89, 151.21, -33.86)), block("10002", box(151.17, -33.89, 151.19, -33.86)), block("10003", ring_with_hole), block("far", box(10, 10, 11, 11))], BLOCK)
    stops = spark.createDataFrame([("inside", -33.870, 151.205), ("tie", -33.880, 151.190), ("outside", -33.900, 151.300), ("hole", -33.65, 151.05), ("ring", -33.65, 151.02)], "stop_id string, stop_lat double, stop_lon double")
    return stops, g.clipped(blocks, "1").cache()


def test_stops_in_blocks(world):
    stops, blocks = world
    assert blocks.count() == 3
    got = {r.stop_id: (r.mesh_block_code, r.boundary_tie) for r in g.stop_mesh_block(stops, blocks).collect()}
    assert got == {"inside": ("10001", False), "tie": ("10001", True), "ring": ("10003", False)}


def test_nearest_block(world):
    stops, blocks = world
    area = {r.stop_id: r for r in g.stop_area(stops, blocks).collect()}
    assert len(area) == 5 and area["outside"].geography_match == "nearest" and area["outside"].mesh_block_code == "10001"
    assert 8000 < area["outside"].geography_match_distance_m < 9000
    assert area["hole"].geography_match_distance_m == pytest.approx(haversine_m(-33.65, 151.05, -33.65, 151.04), rel=1e-3)
    assert area["inside"].geography_match_distance_m == 0


def test_a_degree_of_latitude(spark):
    one = spark.range(1).select(haversine(F.lit(-33.0), F.lit(151.0), F.lit(-34.0), F.lit(151.0))).first()[0]
    assert 111_000 < one < 111_400 and one == pytest.approx(haversine_m(-33, 151, -34, 151))


def test_published_tables(spark, world):
    stops, blocks = world
    lga = g.clipped(spark.createDataFrame([("17200", "Sydney", box(151.15, -33.90, 151.25, -33.85))], f"lga_code string, lga_name string, geom {POLYGON}"))
    centres = spark.createDataFrame([("sydney", "Sydney", -33.87, 151.21), ("parra", "Parramatta", -33.81, 151.0)], "centre_id string, centre_name string, latitude double, longitude double")
    sheet = spark.createDataFrame([("x" * 6 + "10001", "Residential", "0.5", "7", "20"), ("note", None, None, None, None)], "code string, category string, area string, dwellings string, persons string")
    counts = g.mesh_block_count(sheet).withColumn("mesh_block_code", F.lit("10001"))
    assert counts.count() == 1
    letters = ", ".join(f"{c} string" for c in "ABCDEFGHIJKL")
    line = lambda code, score: (code, "100", score, None, None, "3", "30", None, None, None, "4", "40")
    sheets = {n: spark.createDataFrame([line("12345678901", "950.5" if n != "ier" else "-"), line("© note", "1")], letters) for n in g.INDEXES}
    sheets["excluded"] = spark.createDataFrame([("12345678901", "5", "Y", "N", "N", "Y"), ("99999999999", "5", "Y", "Y", "Y", "Y")], "A string, B string, C string, D string, E string, F string")
    seifa = g.seifa_sa1(sheets)
    r = seifa.first()
    assert seifa.count() == 1 and (r.irsd_score, r.irsd_state_decile, r.ier_score, r.irsd_excluded, r.irsad_excluded) == (950.5, 4, None, True, False)
    build = spark.createDataFrame([(date(2026, 9, 22), "3", "2021", 2021)], "vintage date, asgs_edition string, seifa_release string, census_year int")
    table = g.stop_geography(stops, blocks, lga, centres, counts, seifa, build)
    got = {r.stop_id: r for r in table.collect()}
    assert len(got) == 5 and got["inside"].lga_name == "Sydney" and got["tie"].lga_code == "17200" and got["ring"].lga_code is None
    assert got["ring"].nearest_centre_id == "parra" and got["inside"].mesh_block_category == "Residential" and not got["inside"].seifa_irsd_excluded
    report = g.build_report(table).first()
    assert tuple(report) == (5, 3, 2, 1, 5)


def test_catchments_and_routing(spark, world):
    stops, blocks = world
    counts = spark.createDataFrame([("10001", 50, 20, "Residential", 0.5)], "mesh_block_code string, person_count int, dwelling_count int, mesh_block_category string, area_sqkm double")
    build = spark.createDataFrame([(date(2026, 9, 22),)], "vintage date")
    pairs = g.stop_meshblock(stops, blocks, counts, build).cache()
    near = {(r.stop_id, r.mesh_block_code): r for r in pairs.collect()}
    assert ("inside", "10001") in near and all(r.straight_line_distance_m <= 1600 for r in near.values())
    assert near["inside", "10001"].person_count == 50 and near["inside", "10001"].routing_status == "not_attempted"
    assert {r.stop_id for r in g.unrouted(pairs, spark.createDataFrame([], "stop_id string, mesh_block_code string")).collect()} == {s for s, _ in near}
    body = '{"code":"Ok","distances":[[1000,null]],"durations":[[700,null]],"sources":[{"distance":5}],"destinations":[{"distance":3},{"distance":4}]}'
    legs = g.parse_routes(spark.createDataFrame([("inside", ["10001", "10002"], body)], "stop_id string, mesh_block_codes array<string>, body string"))
    assert {r.mesh_block_code: r.status for r in legs.collect()} == {"10001": "routed", "10002": "unroutable"}
    routed = g.stop_meshblock_routed(pairs, legs)
    got = {(r.stop_id, r.mesh_block_code): r for r in routed.collect()}
    assert got["inside", "10001"].detour_ratio == pytest.approx(1000 / near["inside", "10001"].straight_line_distance_m)
    assert g.publish_checks(routed).first().routed == 1
