"""Queries on zone geometry.

Suppliers are PUMA polygons on a lattice: L-shaped, with a square hole. Customers are points, or
small square block groups, scattered around the polygon of their key range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popflow.catalog.registry import query
from popflow.catalog.roles import Roles
from popflow.functions.geoid import compose_geoids
from popflow.operators import spatial
from popflow.sources import geometry

_SHELL = [(0, 0), (0.018, 0), (0.018, 0.009), (0.009, 0.009), (0.009, 0.018), (0, 0.018), (0, 0)]
_HOLE = [(0.003, 0.003), (0.003, 0.006), (0.006, 0.006), (0.006, 0.003), (0.003, 0.003)]


def _lattice(key: str) -> tuple[str, str, str]:
    """Corner and state of the lattice cell of a polygon number."""
    col, row = f"({key} % 400)", f"CAST(floor({key} / 400) AS BIGINT)"
    state = f"concat('0', CAST(1 + CAST(floor({col} / 10) AS BIGINT) % 2 AS STRING))"
    side = "CAST(0.02 AS DOUBLE)"
    return (f"(CAST(-100 AS DOUBLE) + {col} * {side})", f"(CAST(30 AS DOUBLE) + {row} * {side})",
            state)


_ZX, _ZY, _ZSTATE = _lattice("s_suppkey")
_CELL = "CAST(floor(c_custkey / 15) AS BIGINT)"
_PX, _PY, _PSTATE = _lattice(_CELL)
POINT = {
    "point_id": "c_custkey",
    "STATEFP": _PSTATE,
    "lon": f"{_PX} + ((c_custkey * 7919) % 1009) / CAST(1009 AS DOUBLE) * CAST(0.02 AS DOUBLE)",
    "lat": f"{_PY} + ((c_custkey * 104729) % 1013) / CAST(1013 AS DOUBLE) * CAST(0.02 AS DOUBLE)",
}
_ZONE_ID = f"concat({_ZSTATE}, lpad(CAST(s_suppkey AS STRING), 5, '0'))"


def zones(t: Roles) -> DataFrame:
    def ring(offsets):
        return F.array(*[
            F.struct((F.expr(_ZX) + F.lit(float(x))).alias("lon"),
                     (F.expr(_ZY) + F.lit(float(y))).alias("lat")) for x, y in offsets])
    return t.table("supplier").select(
        F.expr(_ZONE_ID).alias("GEOID"), F.expr(_ZSTATE).alias("STATEFP"),
        F.array(ring(_SHELL), ring(_HOLE)).alias("rings"))


def points(t: Roles) -> DataFrame:
    return t.table("customer").selectExpr(*[f"{e} AS {n}" for n, e in POINT.items()])


# The same tables in SQL with their edges.
_OFFSETS = ", ".join(
    f"({a[0]}, {a[1]}, {b[0]}, {b[1]})" for r in (_SHELL, _HOLE) for a, b in zip(r, r[1:]))


_GEO = f"""
points AS (SELECT {", ".join(f"{e} AS {n}" for n, e in POINT.items())} FROM customer),
corners AS (SELECT {_ZONE_ID} AS GEOID, {_ZSTATE} AS STATEFP, {_ZX} AS bx, {_ZY} AS by_
  FROM supplier),
offsets(ax, ay, cx, cy) AS (VALUES {_OFFSETS}),
edges AS (SELECT GEOID, STATEFP, bx + CAST(ax AS DOUBLE) AS x0, by_ + CAST(ay AS DOUBLE) AS y0,
  bx + CAST(cx AS DOUBLE) AS x1, by_ + CAST(cy AS DOUBLE) AS y1 FROM corners, offsets),
inside AS (
  SELECT point_id, GEOID FROM points JOIN edges
    ON (y0 > lat) <> (y1 > lat) AND lon < (x1 - x0) * (lat - y0) / (y1 - y0) + x0
  GROUP BY point_id, GEOID HAVING count(*) % 2 = 1),
seg AS (
  SELECT p.point_id, p.STATEFP, e.GEOID, p.lon, p.lat, x0, y0, x1 - x0 AS dx, y1 - y0 AS dy,
    least(1, greatest(0, ((lon - x0) * (x1 - x0) + (lat - y0) * (y1 - y0))
      / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)))) AS u
  FROM points p JOIN edges e ON e.STATEFP = p.STATEFP),
dist AS (
  SELECT s.point_id, s.GEOID,
    CASE WHEN any_value(i.GEOID) IS NOT NULL THEN 0
         ELSE min(sqrt((lon - x0 - u * dx) * (lon - x0 - u * dx)
                     + (lat - y0 - u * dy) * (lat - y0 - u * dy))) END * 111139 AS dist_m
  FROM seg s LEFT JOIN inside i ON i.point_id = s.point_id AND i.GEOID = s.GEOID
  GROUP BY s.point_id, s.GEOID),
best AS (SELECT point_id, min_by(GEOID, (round(dist_m, 6), GEOID)) AS GEOID, min(dist_m) AS dist_m
         FROM dist GROUP BY point_id)"""


@query("point_in_polygon", f"WITH {_GEO} SELECT point_id, GEOID FROM inside")
def point_in_polygon(t: Roles) -> DataFrame:
    return spatial.within(points(t), zones(t), cell_deg=0.01)


@query("nearest_zone", f"""WITH {_GEO}
SELECT point_id, GEOID, round(dist_m, 3) AS dist_m FROM best WHERE dist_m < 1000""")
def nearest_zone(t: Roles) -> DataFrame:
    return spatial.nearest(points(t), zones(t)).withColumn("dist_m", F.round("dist_m", 3))


@query("nearest_zone_any_distance", f"""WITH {_GEO}
SELECT p.point_id, GEOID, round(dist_m, 3) AS dist_m FROM points p LEFT JOIN best USING (point_id)""")
def nearest_zone_any_distance(t: Roles) -> DataFrame:
    """Points of states without zones are rows without a zone."""
    return spatial.nearest_any(points(t), zones(t)).withColumn("dist_m", F.round("dist_m", 3))


_E2 = 0.0066943799901413165


def _sql_q(lat: str) -> str:
    s, e = f"sin(radians({lat}))", _E2**0.5
    return (f"((1 - {_E2!r}::DOUBLE) * ({s} / (1 - {_E2!r}::DOUBLE * {s} * {s}) - "
            f"ln((1 - {e!r}::DOUBLE * {s}) / (1 + {e!r}::DOUBLE * {s})) / (2 * {e!r}::DOUBLE)))")


@query("centroid_planar", f"""WITH {_GEO},
m AS (SELECT e.GEOID, any_value(bx) AS bx, any_value(by_) AS by_,
  sum((x0 - bx) * (y1 - by_) - (x1 - bx) * (y0 - by_)) AS a,
  sum((x0 + x1 - 2 * bx) * ((x0 - bx) * (y1 - by_) - (x1 - bx) * (y0 - by_))) AS mx,
  sum((y0 + y1 - 2 * by_) * ((x0 - bx) * (y1 - by_) - (x1 - bx) * (y0 - by_))) AS my
  FROM edges e JOIN corners c ON c.GEOID = e.GEOID GROUP BY e.GEOID)
SELECT GEOID, round(bx + mx / (3 * a), 8) AS lon, round(by_ + my / (3 * a), 8) AS lat FROM m""")
def centroid_planar(t: Roles) -> DataFrame:
    return _rounded(spatial.centroids(zones(t), equal_area=False))


_BETA = f"asin(q / {_sql_q('90')})"
_LATITUDE = (
    f"degrees({_BETA} + {_E2 / 3 + 31 * _E2**2 / 180 + 517 * _E2**3 / 5040!r} * sin(2 * {_BETA})"
    f" + {23 * _E2**2 / 360 + 251 * _E2**3 / 3780!r} * sin(4 * {_BETA})"
    f" + {761 * _E2**3 / 45360!r} * sin(6 * {_BETA}))")


@query("centroid", f"""WITH {_GEO},
flat AS (SELECT e.GEOID, bx, {_sql_q('by_')} AS q0, x0 - bx AS x0, x1 - bx AS x1,
  {_sql_q('y0')} - {_sql_q('by_')} AS y0, {_sql_q('y1')} - {_sql_q('by_')} AS y1
  FROM edges e JOIN corners c ON c.GEOID = e.GEOID),
m AS (SELECT GEOID, any_value(bx) AS bx, any_value(q0) AS q0, sum(x0 * y1 - x1 * y0) AS a,
  sum((x0 + x1) * (x0 * y1 - x1 * y0)) AS mx, sum((y0 + y1) * (x0 * y1 - x1 * y0)) AS my
  FROM flat GROUP BY GEOID),
c AS (SELECT GEOID, bx + mx / (3 * a) AS lon, q0 + my / (3 * a) AS q FROM m)
SELECT GEOID, round(lon, 8) AS lon, round({_LATITUDE}, 8) AS lat FROM c""")
def centroid(t: Roles) -> DataFrame:
    return _rounded(spatial.centroids(zones(t)))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select("GEOID", F.round("lon", 8).alias("lon"), F.round("lat", 8).alias("lat"))


@query("rings_from_wkt", f"""WITH {_GEO}
SELECT GEOID, 2 AS n_rings, round(bx + 0.018, 6) AS lon, round(by_ + 0.018, 6) AS lat
FROM corners""")
def rings_from_wkt(t: Roles) -> DataFrame:
    def text(ring):
        return F.concat_ws(",", F.transform(ring, lambda p: F.concat_ws(
            " ", p["lon"].cast("string"), p["lat"].cast("string"))))
    wkt = F.concat(F.lit("POLYGON (("), text(F.col("rings")[0]), F.lit("), ("),
                   text(F.col("rings")[1]), F.lit("))"))
    parsed = zones(t).select("GEOID", geometry.rings_from_wkt(wkt).alias("rings"))
    vertices = F.flatten("rings")
    return parsed.select(
        "GEOID", F.size("rings").alias("n_rings"),
        F.round(F.array_max(F.transform(vertices, lambda p: p["lon"])), 6).alias("lon"),
        F.round(F.array_max(F.transform(vertices, lambda p: p["lat"])), 6).alias("lat"))


# --- crosswalk -------------------------------------------------------------
_BG_PARTS = {
    "COUNTYFP": "lpad(CAST(1 + CAST(floor(c_custkey / 30) AS BIGINT) % 900 AS STRING), 3, '0')",
    "TRACTCE": "lpad(CAST(CAST(floor(c_custkey / 3) AS BIGINT) AS STRING), 6, '0')",
    "BLKGRPCE": "CAST(1 + c_custkey % 3 AS STRING)",
}


def _block_groups(t: Roles) -> DataFrame:
    """A square of 0.001 degrees around each customer's point."""
    half = 0.0005
    square = [(-half, -half), (half, -half), (half, half), (-half, half), (-half, -half)]
    named = t.table("customer").selectExpr(
        *[f"{e} AS {n}" for n, e in (POINT | _BG_PARTS).items()])
    ring = F.array(*[
        F.struct((F.col("lon") + F.lit(x)).alias("lon"), (F.col("lat") + F.lit(y)).alias("lat"))
        for x, y in square])
    return named.select(
        F.concat("STATEFP", "COUNTYFP", "TRACTCE", "BLKGRPCE").alias("GEOID"),
        "STATEFP", *_BG_PARTS, F.array(ring).alias("rings"))


_LINKED = f"""
named AS (SELECT c_custkey AS point_id, CAST({_PSTATE} AS BIGINT) AS STATE, """ + ", ".join(
    f"CAST({e} AS BIGINT) AS {n}" for n, e in _BG_PARTS.items()) + """ FROM customer),
linked AS (
  SELECT point_id, GEOID AS puma FROM inside
  UNION ALL
  SELECT point_id, GEOID FROM best
  WHERE dist_m < 1000 AND point_id NOT IN (SELECT point_id FROM inside)),
made AS (
  SELECT point_id, ((STATE * 1000 + COUNTYFP) * 1000000 + TRACTCE) * 10 + BLKGRPCE AS BG,
         (STATE * 1000 + COUNTYFP) * 1000000 + TRACTCE AS TRACT, STATE * 1000 + COUNTYFP AS COUNTY,
         STATE, STATE * 100000 + CAST(puma AS BIGINT) % 100000 AS PUMA, 1 AS REGION
  FROM named JOIN linked USING (point_id))"""


@query("crosswalk_build", f"""WITH {_GEO}, {_LINKED}
SELECT BG, TRACT, COUNTY, STATE, PUMA, REGION FROM made""")
def crosswalk_build(t: Roles) -> DataFrame:
    return spatial.build_crosswalk(_block_groups(t), zones(t), cell_deg=0.01).select(
        "BG", "TRACT", "COUNTY", "STATE", "PUMA", "REGION")


@query("crosswalk_ambiguous", f"""WITH {_GEO}, {_LINKED}
SELECT TRACT, count(DISTINCT PUMA) AS n_pumas FROM made GROUP BY TRACT
HAVING count(DISTINCT PUMA) > 1""")
def crosswalk_ambiguous(t: Roles) -> DataFrame:
    return spatial.ambiguous_zones(crosswalk_build(t), "TRACT")


# Tract points: the place of the tract's first customer.
_DEDUPED = """
tp AS (SELECT TRACT, min(point_id) AS point_id FROM (
         SELECT point_id, (STATE * 1000 + COUNTYFP) * 1000000 + TRACTCE AS TRACT FROM named)
       GROUP BY TRACT),
unclear AS (SELECT TRACT FROM made GROUP BY TRACT HAVING count(DISTINCT PUMA) > 1),
near AS (SELECT TRACT, CAST(GEOID AS BIGINT) AS near, dist_m
         FROM unclear JOIN tp USING (TRACT) JOIN best USING (point_id))"""


@query("crosswalk_dedupe", f"""WITH {_GEO}, {_LINKED}, {_DEDUPED}
SELECT BG, TRACT, CASE WHEN dist_m < 1000 THEN near ELSE PUMA END AS PUMA
FROM made LEFT JOIN near USING (TRACT)
WHERE near IS NULL OR dist_m < 1000 OR PUMA = near""")
def crosswalk_dedupe(t: Roles) -> DataFrame:
    named = compose_geoids(t.table("customer").selectExpr(
        *[f"{e} AS {n}" for n, e in (POINT | _BG_PARTS).items()]).select(
            "point_id", "lon", "lat", "STATEFP", F.col("STATEFP").alias("STATE"),
            F.col("COUNTYFP").alias("COUNTY"), F.col("TRACTCE").alias("TRACT")))
    place = F.min_by(F.struct("STATEFP", "lon", "lat"), "point_id")
    tracts = named.groupBy("TRACT").agg(place.alias("p")).select("TRACT", "p.*")
    areas = zones(t).select(F.col("GEOID").cast("bigint").alias("PUMA"), "STATEFP", "rings")
    return spatial.dedupe_crosswalk(crosswalk_build(t), tracts, areas).select(
        "BG", "TRACT", "PUMA")


@query("crs_check", """
WITH s AS (SELECT 4269 + s_nationkey % 2 AS srid FROM supplier),
     c AS (SELECT 4269 + c_nationkey % 3 AS srid FROM customer),
     one AS (SELECT srid FROM s WHERE srid = 4269 UNION ALL SELECT srid FROM c WHERE srid = 4269),
     many AS (SELECT srid FROM s UNION ALL SELECT srid FROM c)
SELECT 'one' AS tables, count(DISTINCT srid) AS n_crs, count(DISTINCT srid) = 1 AS same_crs FROM one
UNION ALL
SELECT 'many', count(DISTINCT srid), count(DISTINCT srid) = 1 FROM many""")
def crs_check(t: Roles) -> DataFrame:
    a = t.table("supplier").select((4269 + F.col("s_nationkey") % 2).alias("srid"))
    b = t.table("customer").select((4269 + F.col("c_nationkey") % 3).alias("srid"))
    one = spatial.same_crs(a.filter("srid = 4269"), b.filter("srid = 4269"))
    return one.select(F.lit("one").alias("tables"), "*").unionByName(
        spatial.same_crs(a, b).select(F.lit("many").alias("tables"), "*"))
