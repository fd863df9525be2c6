import json
import struct
from datetime import datetime

import pytest

from punctual.operators.relational import as_text
from punctual.plans.geography import clipped, stop_mesh_block
from punctual.sources import shapes


def shapefile(records):
    """A polygon file and its table, by the public format."""
    body = b""
    for i, rings in enumerate(records, 1):
        if rings is None:
            content = struct.pack("<i", 0)
        else:
            points = [p for r in rings for p in r]
            starts = [sum(map(len, rings[:k])) for k in range(len(rings))]
            content = struct.pack("<i4d2i", 5, 0, 0, 0, 0, len(rings), len(points)) + struct.pack(f"<{len(rings)}i", *starts) + b"".join(struct.pack("<2d", *p) for p in points)
        body += struct.pack(">2i", i, len(content) // 2) + content
    return bytes(100) + body


def table(rows, width=8):
    fields = b"CODE".ljust(11, b"\0") + b"C" + bytes(4) + bytes([width]) + bytes(15)
    head = struct.pack("<4BIHH", 3, 126, 9, 22, len(rows), 32 + len(fields) + 1, 1 + width) + bytes(20)
    return head + fields + b"\x0d" + b"".join(b" " + r.encode().ljust(width) for r in rows)


BOX = [(151.19, -33.89), (151.21, -33.89), (151.21, -33.86), (151.19, -33.86), (151.19, -33.89)]
HOLE = [(151.195, -33.88), (151.2, -33.88), (151.2, -33.87), (151.195, -33.87), (151.195, -33.88)]


def test_shapefiles(spark, tmp_path):
    (tmp_path / "mb.shp").write_bytes(shapefile([[BOX, HOLE], None]))
    (tmp_path / "mb.dbf").write_bytes(table(["10001", "10002"]))
    rows = shapes.read_shapefile(spark, str(tmp_path / "mb.shp"), {"mesh_block_code": "CODE"}).cache()
    got = {r.mesh_block_code: r.geom for r in rows.collect()}
    assert [[(p.x, p.y) for p in ring] for ring in got["10001"]] == [BOX, HOLE] and got["10002"] is None
    with pytest.raises(ValueError):
        list(shapes.polygons(shapefile([[BOX]])[:-4]))


def test_geojson_polygons_join_stops(spark, tmp_path):
    features = [{"type": "Feature", "properties": {"code": "10001"}, "geometry": {"type": "Polygon", "coordinates": [BOX, HOLE]}}, {"type": "Feature", "properties": {"code": "10002"}, "geometry": {"type": "MultiPolygon", "coordinates": [[[(x + 1, y) for x, y in BOX]]]}}]
    path = tmp_path / "mb.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    names = ("mesh_block_code", "sa1_code", "sa2_code", "sa2_name", "sa3_code", "sa3_name", "sa4_code", "sa4_name", "gccsa_code", "gccsa_name")
    blocks = clipped(shapes.read_geojson(spark, str(path), dict.fromkeys(names, "code")), clip=(150.0, -35.0, 153.0, -32.0))
    stops = spark.createDataFrame([("in", -33.865, 151.205), ("hole", -33.875, 151.197), ("second", -33.875, 152.2)], "stop_id string, stop_lat double, stop_lon double")
    assert {r.stop_id: r.mesh_block_code for r in stop_mesh_block(stops, blocks).collect()} == {"in": "10001", "second": "10002"}


def test_sheets_are_text(spark, tmp_path):
    (tmp_path / "s.csv").write_text("00012345678,5,-\nnote,,\n")
    assert [tuple(r) for r in shapes.read_sheet(spark, str(tmp_path / "s.csv")).collect()] == [("00012345678", "5", "-"), ("note", None, None)]


def test_instants_as_text(spark):
    df = spark.createDataFrame([(datetime(2026, 9, 22, 1, 2, 3), "x")], "at timestamp, s string")
    assert tuple(as_text(df).first()) == ("2026-09-22T01:02:03.000000Z", "x")
