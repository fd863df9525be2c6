"""The spatial reference tables: stops in areas, nearest centres, catchments.

Polygons are arrays of rings (see ``functions.geo``). A stop meets the polygons
of its grid cell only; the exact test follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.functions.aggregates import count_where, ratio
from punctual.functions.geo import bounds, closest_point, edges, haversine, meets
from punctual.operators.relational import bounded, grid_band_join, nearest_one

#: Degrees of a grid cell. Fixed values of the build: the clip, reaches and limits.
CELL = 0.02
CLIP = (150.1, -34.7, 152.2, -32.0)
REACH_LAT, REACH_LON, REACH_M = 0.0145, 0.0175, 1600
SNAP_M = 100
AREA = ["mesh_block_code", "sa1_code", "sa2_code", "sa2_name", "sa3_code", "sa3_name", "sa4_code", "sa4_name", "gccsa_code", "gccsa_name"]
INDEXES = ("irsd", "irsad", "ier", "ieo")


def clipped(shapes: DataFrame, state: str | None = None, clip: tuple[float, float, float, float] = CLIP) -> DataFrame:
    """Shapes of a state whose bounds meet the envelope, with ring edges and bounds beside them."""
    rows = shapes if state is None else shapes.where(F.col("state_code") == state)
    rows = rows.where("geom is not null").withColumn("bounds", bounds(F.col("geom")))
    b, (x1, y1, x2, y2) = F.col("bounds"), clip
    return rows.where((b["x1"] <= x2) & (b["x2"] >= x1) & (b["y1"] <= y2) & (b["y2"] >= y1))


def _cells(lo: Column, hi: Column) -> Column:
    return F.explode(F.sequence(F.floor(lo / CELL).cast("long"), F.floor(hi / CELL).cast("long")))


def points_in(points: DataFrame, shapes: DataFrame, columns: list[str], x: str = "stop_lon", y: str = "stop_lat") -> DataFrame:
    """Every pair of a point and a shape that holds it, boundary included."""
    b = F.col("bounds")
    spread = shapes.select(*columns, edges(F.col("geom")).alias("edges"), "bounds")
    spread = spread.withColumn("_cx", _cells(b["x1"], b["x2"])).withColumn("_cy", _cells(b["y1"], b["y2"]))
    own = points.withColumn("_cx", F.floor(F.col(x) / CELL).cast("long")).withColumn("_cy", F.floor(F.col(y) / CELL).cast("long"))
    near = own.join(spread, ["_cx", "_cy"]).where(F.col(x).between(b["x1"], b["x2"]) & F.col(y).between(b["y1"], b["y2"]))
    return near.where(meets(F.col("edges"), F.col(x), F.col(y))).drop("_cx", "_cy", "edges", "bounds")


def stop_mesh_block(stops: DataFrame, blocks: DataFrame) -> DataFrame:
    """The block of each stop; a stop on an edge takes the first by code and is marked."""
    found = points_in(stops, blocks, AREA)
    return found.groupBy("stop_id").agg(F.min(F.struct(*AREA)).alias("a"), (F.count("*") > 1).alias("boundary_tie")).select("stop_id", "a.*", "boundary_tie")


def stop_lga(stops: DataFrame, lgas: DataFrame) -> DataFrame:
    found = points_in(stops, lgas, ["lga_code", "lga_name"])
    return found.groupBy("stop_id").agg(F.min(F.struct("lga_code", "lga_name")).alias("a")).select("stop_id", "a.*")


def stop_nearest_block(stops: DataFrame, inside: DataFrame, blocks: DataFrame) -> DataFrame:
    """Of each stop in no block: the nearest one in degrees, and metres to its closest point.

    Few stops are left over; they alone meet the blocks.
    """
    left = stops.join(inside, "stop_id", "left_anti")
    shapes = blocks.select(*AREA, edges(F.col("geom")).alias("edges"))
    near = shapes.crossJoin(bounded(left)).withColumn("p", closest_point(F.col("edges"), F.col("stop_lon"), F.col("stop_lat")))
    best = near.groupBy("stop_id", "stop_lat", "stop_lon").agg(F.min(F.struct(F.col("p.d").alias("d"), *AREA, F.col("p.x").alias("px"), F.col("p.y").alias("py"))).alias("b"))
    return best.select("stop_id", *[F.col(f"b.{c}").alias(c) for c in AREA], haversine(F.col("b.py"), F.col("b.px"), F.col("stop_lat"), F.col("stop_lon")).alias("distance_m"))


def stop_area(stops: DataFrame, blocks: DataFrame) -> DataFrame:
    """The area of each stop: the block it is in, or else the nearest."""
    inside = stop_mesh_block(stops, blocks)
    near = stop_nearest_block(stops, inside.select("stop_id"), blocks)
    within = inside.select("stop_id", *AREA, F.lit("inside").alias("geography_match"), F.lit(0.0).alias("geography_match_distance_m"), "boundary_tie")
    return within.unionByName(near.select("stop_id", *AREA, F.lit("nearest").alias("geography_match"), F.col("distance_m").alias("geography_match_distance_m"), F.lit(False).alias("boundary_tie")))


def stop_centre(stops: DataFrame, centres: DataFrame) -> DataFrame:
    """The nearest centre of each stop."""
    d = haversine(F.col("stop_lat"), F.col("stop_lon"), F.col("latitude"), F.col("longitude"))
    found = nearest_one(stops, centres.select("centre_id", "centre_name", "latitude", "longitude"), ["stop_id"], d, ["centre_id", "centre_name"])
    return found.select("stop_id", F.col("centre_id").alias("nearest_centre_id"), F.col("centre_name").alias("nearest_centre_name"), F.col("distance").alias("distance_to_nearest_centre_m"))


def mesh_block_count(sheet: DataFrame) -> DataFrame:
    """Counts from a worksheet of text; notes and headings have codes of another length."""
    return sheet.where(F.length("code") == 11).select(F.col("code").alias("mesh_block_code"), F.col("category").alias("mesh_block_category"), F.col("area").try_cast("double").alias("area_sqkm"), F.col("dwellings").try_cast("int").alias("dwelling_count"), F.col("persons").try_cast("int").alias("person_count"))


def seifa_index(sheet: DataFrame, population: bool = False) -> DataFrame:
    """One index from a worksheet with columns A to L."""
    people = [F.col("B").try_cast("int").alias("usual_resident_population")] if population else []
    return sheet.where(F.length("A") == 11).select(F.col("A").alias("sa1_code"), *people, F.col("C").try_cast("double").alias("score"), F.col("F").try_cast("smallint").alias("national_decile"), F.col("K").try_cast("smallint").alias("state_decile"))


def seifa_excluded(sheet: DataFrame) -> DataFrame:
    return sheet.where(F.length("A") == 11).select(F.col("A").alias("sa1_code"), *[(F.col(c) == "Y").alias(f"{n}_excluded") for n, c in zip(INDEXES, "CDEF", strict=True)])


def seifa_sa1(sheets: dict[str, DataFrame]) -> DataFrame:
    """The four indexes side by side with their exclusions; an area in no index has no row."""
    out = None
    for name in INDEXES:
        own = seifa_index(sheets[name], population=name == "irsd")
        own = own.select("sa1_code", *(["usual_resident_population"] if name == "irsd" else []), *[F.col(c).alias(f"{name}_{c}") for c in ("score", "national_decile", "state_decile")])
        out = own if out is None else out.join(own, "sa1_code", "full")
    flags = seifa_excluded(sheets["excluded"])
    joined = out.join(flags, "sa1_code", "left")
    return joined.select(*out.columns, *[F.coalesce(f"{n}_excluded", F.lit(False)).alias(f"{n}_excluded") for n in INDEXES])


def stop_geography(stops: DataFrame, blocks: DataFrame, lgas: DataFrame, centres: DataFrame, counts: DataFrame, seifa: DataFrame, build: DataFrame, cbd: str = "sydney") -> DataFrame:
    """The published table: a row for each stop."""
    c = F.col
    city = centres.where(c("centre_id") == cbd).select(c("latitude").alias("cbd_lat"), c("longitude").alias("cbd_lon"))
    joined = stops.select("stop_id", "stop_lat", "stop_lon").join(stop_area(stops, blocks), "stop_id", "left").join(stop_lga(stops, lgas), "stop_id", "left").join(stop_centre(stops, centres), "stop_id", "left")
    joined = joined.join(counts.select("mesh_block_code", "mesh_block_category"), "mesh_block_code", "left").join(seifa, "sa1_code", "left").crossJoin(F.broadcast(city)).crossJoin(F.broadcast(build))
    scores = [f"{n}_{x}" for n in INDEXES for x in ("score", "national_decile", "state_decile")]
    return joined.select(
        "stop_id", "stop_lat", "stop_lon", "mesh_block_code", "mesh_block_category", *AREA[1:], "lga_code", "lga_name", "geography_match", "geography_match_distance_m", "boundary_tie", *scores,
        c("usual_resident_population").alias("sa1_usual_resident_population"), F.coalesce("irsd_excluded", F.lit(False)).alias("seifa_irsd_excluded"),
        haversine(c("cbd_lat"), c("cbd_lon"), c("stop_lat"), c("stop_lon")).alias("distance_to_cbd_m"), "nearest_centre_id", "nearest_centre_name", "distance_to_nearest_centre_m", *build.columns,
    )


def anchors(blocks: DataFrame) -> DataFrame:
    """A point inside each block: the middle of the widest stretch that a scan line through the block's middle has inside."""
    b = F.col("bounds")
    y = (b["y1"] + b["y2"]) / 2 + (b["y2"] - b["y1"]) * 1e-7
    crossing = lambda e: F.when((e["a"]["y"] > y) != (e["b"]["y"] > y), (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) / F.nullif(e["b"]["y"] - e["a"]["y"], F.lit(0.0)) + e["a"]["x"])
    xs = F.array_sort(F.filter(F.transform(edges(F.col("geom")), crossing), lambda v: v.isNotNull()))
    rows = blocks.withColumn("xs", xs).withColumn("y", y)
    spans = F.transform(F.sequence(F.lit(1), F.floor(F.size("xs") / 2).cast("int")), lambda i: F.struct((F.element_at("xs", 2 * i) - F.element_at("xs", 2 * i - 1)).alias("w"), ((F.element_at("xs", 2 * i) + F.element_at("xs", 2 * i - 1)) / 2).alias("x")))
    best = F.when(F.size("xs") >= 2, F.array_max(spans)["x"]).otherwise((b["x1"] + b["x2"]) / 2)
    return rows.withColumn("anchor_lon", best).withColumn("anchor_lat", F.col("y")).drop("xs", "y", "geom", "bounds")


def stop_meshblock(stops: DataFrame, blocks: DataFrame, counts: DataFrame, build: DataFrame) -> DataFrame:
    """Pairs of a stop and a block's anchor within reach, not routed yet."""
    c = F.col
    near = grid_band_join(stops.select("stop_id", "stop_lat", "stop_lon"), anchors(blocks).select("mesh_block_code", "sa1_code", "anchor_lat", "anchor_lon"), [("stop_lat", "anchor_lat", REACH_LAT), ("stop_lon", "anchor_lon", REACH_LON)])
    straight = haversine(c("anchor_lat"), c("anchor_lon"), c("stop_lat"), c("stop_lon"))
    pairs = near.withColumn("straight_line_distance_m", straight).where(c("straight_line_distance_m") <= REACH_M)
    return pairs.join(counts, "mesh_block_code", "left").crossJoin(F.broadcast(build)).select(
        "stop_id", "mesh_block_code", "straight_line_distance_m", F.lit(None).cast("double").alias("network_distance_m"), F.lit(None).cast("double").alias("network_duration_s"), F.lit("not_attempted").alias("routing_status"),
        "person_count", "dwelling_count", "mesh_block_category", "sa1_code", "area_sqkm", *build.columns,
    )


def routing_status(snap: Column, distance: Column) -> Column:
    return F.when(snap > SNAP_M, "snap_failed").when(distance.isNull(), "unroutable").otherwise("routed")


def parse_routes(responses: DataFrame) -> DataFrame:
    """(stop_id, mesh_block_code, distance_m, duration_s, snap_m, status) from table responses of a router.

    ``responses``: stop_id, mesh_block_codes and the JSON body of one origin's
    request. Places beside each other in the arrays belong together.
    """
    shape = "code string, distances array<array<double>>, durations array<array<double>>, sources array<struct<distance:double>>, destinations array<struct<distance:double>>"
    rows = responses.withColumn("r", F.from_json("body", shape)).where("r.code = 'Ok'")
    legs = rows.select("stop_id", F.col("r.sources")[0]["distance"].alias("own"), F.explode(F.arrays_zip(F.col("mesh_block_codes").alias("c"), F.col("r.distances")[0].alias("d"), F.col("r.durations")[0].alias("t"), F.col("r.destinations").alias("e"))).alias("z"))
    snap = F.greatest("own", F.col("z.e.distance"))
    return legs.select("stop_id", F.col("z.c").alias("mesh_block_code"), F.col("z.d").alias("distance_m"), F.col("z.t").alias("duration_s"), snap.alias("snap_m"), routing_status(snap, F.col("z.d")).alias("status"))


def stop_meshblock_routed(pairs: DataFrame, legs: DataFrame) -> DataFrame:
    """The pairs with their legs folded in; a leg not tried leaves them as they were."""
    joined = pairs.drop("network_distance_m", "network_duration_s").withColumnRenamed("routing_status", "before").join(legs, ["stop_id", "mesh_block_code"], "left")
    done = F.when(F.col("status") == "routed", F.col("distance_m"))
    out = joined.withColumn("network_distance_m", done).withColumn("network_duration_s", F.when(F.col("status") == "routed", F.col("duration_s"))).withColumn("routing_status", F.coalesce("status", "before"))
    return out.withColumn("detour_ratio", ratio(F.col("network_distance_m"), F.col("straight_line_distance_m"))).drop("before", "status", "distance_m", "duration_s", "snap_m")


def unrouted(pairs: DataFrame, legs: DataFrame) -> DataFrame:
    """Pairs not tried yet, one row for each origin with its destinations."""
    left = pairs.join(legs, ["stop_id", "mesh_block_code"], "left_anti")
    return left.groupBy("stop_id").agg(F.array_sort(F.collect_set("mesh_block_code")).alias("mesh_block_codes"))


def build_report(geography: DataFrame) -> DataFrame:
    match = F.col("geography_match")
    return geography.agg(F.count("*").alias("stops"), count_where(match == "inside").alias("inside"), count_where(match == "nearest").alias("nearest"), count_where(F.col("boundary_tie")).alias("boundary_ties"), count_where(F.col("irsd_score").isNull()).alias("unscored"))


def publish_checks(routed: DataFrame) -> DataFrame:
    """Counts by status, the median detour and the detours that can't be."""
    ratio_ = F.col("detour_ratio")
    return routed.agg(F.count("*").alias("pairs"), count_where(F.col("routing_status") == "routed").alias("routed"), F.median(ratio_).alias("median_detour"), count_where(ratio_ < 0.999).alias("impossible_detours"))
