"""Polygons from shapefiles and GeoJSON, and worksheets as text.

Shapefiles are read by the public file format: a header, then records of rings,
beside a dBASE table of attributes. Files are read through Spark, one per task.
"""

from __future__ import annotations

import struct
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.functions.geo import POLYGON

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Fixed shape types with rings: polygon, with z, with m.
POLYGON_TYPES = (5, 15, 25)
BATCH = 2000


def polygons(data: bytes) -> Iterator[list[list[dict]] | None]:
    """The rings of each record; None for a record without a shape."""
    at = 100
    while at + 8 <= len(data):
        (words,) = struct.unpack_from(">i", data, at + 4)
        body = data[at + 8 : at + 8 + 2 * words]
        if len(body) < 2 * words:
            raise ValueError("the shapefile is cut off")
        (kind,) = struct.unpack_from("<i", body)
        if kind in POLYGON_TYPES:
            parts, points = struct.unpack_from("<2i", body, 36)
            starts = [*struct.unpack_from(f"<{parts}i", body, 44), points]
            flat = struct.unpack_from(f"<{2 * points}d", body, 44 + 4 * parts)
            xy = [{"x": flat[2 * i], "y": flat[2 * i + 1]} for i in range(points)]
            yield [xy[a:b] for a, b in zip(starts, starts[1:], strict=False)]
        elif kind == 0:
            yield None
        else:
            raise ValueError(f"shapes of type {kind} have no rings")
        at += 8 + 2 * words


def attributes(data: bytes, encoding: str = "utf-8") -> Iterator[dict[str, str]]:
    """The rows of a dBASE table, all as text."""
    rows, head, size = struct.unpack_from("<IHH", data, 4)
    fields, at = [], 32
    while data[at] != 0x0D:
        fields.append((data[at : at + 11].split(b"\0")[0].decode("ascii"), data[at + 16]))
        at += 32
    for i in range(rows):
        spot, out = head + i * size + 1, {}
        for name, width in fields:
            out[name] = data[spot : spot + width].decode(encoding).strip()
            spot += width
        yield out


def _shapes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for shp, dbf in zip(frame["shp"], frame["dbf"], strict=True):
            held: list[tuple] = []
            for geom, row in zip(polygons(bytes(shp)), attributes(bytes(dbf)), strict=True):
                held.append((row, geom))
                if len(held) == BATCH:
                    yield pd.DataFrame(held, columns=["attributes", "geom"])
                    held = []
            yield pd.DataFrame(held, columns=["attributes", "geom"])


def read_shapefile(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """Shapes with chosen attributes; ``columns`` maps new names to the table's."""
    stem = path.removesuffix(".shp")
    shp, dbf = (spark.read.format("binaryFile").load(f"{stem}.{x}").select(F.lit(1).alias("k"), F.col("content").alias(x)) for x in ("shp", "dbf"))
    rows = shp.join(dbf, "k").select("shp", "dbf").mapInPandas(_shapes, f"attributes map<string,string>, geom {POLYGON}")
    return rows.select(*[F.col("attributes")[c].alias(n) for n, c in columns.items()], "geom")


def read_geojson(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """Polygons and multipolygons of a feature collection, with chosen properties."""
    rings = "array<array<array<double>>>"
    shape = "features array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>"
    features = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", shape)["features"]).alias("f"))
    kind, text = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    one = F.from_json(F.when(kind == "Polygon", text), rings)
    many = F.flatten(F.from_json(F.when(kind == "MultiPolygon", text), f"array<{rings}>"))
    geom = F.transform(F.coalesce(one, many), lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    return features.select(*[F.col("f.properties")[c].alias(n) for n, c in columns.items()], geom.alias("geom"))


def read_sheet(spark: SparkSession, path: str, sheet: str | None = None, skip: int = 0) -> DataFrame:
    """A worksheet as text columns A, B, ...: CSV through Spark, XLSX where its reader is installed."""
    if not path.endswith(".xlsx"):
        rows = spark.read.csv(path, header=False)
        return rows.toDF(*[chr(65 + i) for i in range(len(rows.columns))])
    try:
        import openpyxl  # noqa: F401
    except ImportError as e:
        raise RuntimeError("reading XLSX needs openpyxl; export the sheet as CSV instead") from e
    frame = pd.read_excel(path, sheet_name=sheet or 0, header=None, dtype=str, skiprows=skip)
    names = [chr(65 + i) for i in range(frame.shape[1])]
    return spark.createDataFrame(frame.astype(object).where(frame.notna(), None).set_axis(names, axis=1), ", ".join(f"{n} string" for n in names))
