"""Zone geometry: centroids, point in polygon, nearest polygon and the zone crosswalk.

A zone is one row with ``rings ARRAY<ARRAY<STRUCT<lon, lat>>>``; rings are closed and holes run
against their shell. All predicates are equi-joins on grid cells followed by arithmetic, so a
point only ever meets the few edges of its own neighbourhood.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import log, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from popflow.functions.geoid import compose_geoids
from popflow.operators.targets import drop_empty_zones
from popflow.session import cut
from popflow.specs import ARC_METERS, CROSSWALK_RENAMES, NEAREST_CAP_M, REGION

# WGS 84 first eccentricity squared.
_E2 = 0.0066943799901413165
_E = sqrt(_E2)


# --------------------------------------------------------------------------
# Centroids
# --------------------------------------------------------------------------
def _q(lat: Column) -> Column:
    """Authalic function of the latitude (Snyder 1987, eq. 3-12)."""
    s = F.sin(F.radians(lat))
    return (1 - _E2) * (
        s / (1 - _E2 * s * s) - F.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))


_Q_POLE = (1 - _E2) * (1 / (1 - _E2) - log((1 - _E) / (1 + _E)) / (2 * _E))


def _latitude(q: Column) -> Column:
    """Latitude with the given authalic function (Snyder 1987, eq. 3-18)."""
    beta = F.asin(q / _Q_POLE)
    e4, e6 = _E2**2, _E2**3
    series = (
        beta
        + (_E2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * F.sin(2 * beta)
        + (23 * e4 / 360 + 251 * e6 / 3780) * F.sin(4 * beta)
        + (761 * e6 / 45360) * F.sin(6 * beta)
    )
    return F.degrees(series)


def centroids(zones: DataFrame, equal_area: bool = True, keep: Sequence[str] = ("GEOID",)
              ) -> DataFrame:
    """Area centroid of every zone, by default taken in a cylindrical equal-area projection.

    Works inside the row: no shuffle. Coordinates are taken relative to the first vertex, which
    keeps the shoelace terms of small zones exact.
    """
    def height(p: Column) -> Column:
        return _q(p["lat"]) if equal_area else p["lat"]

    first = F.col("rings")[0][0]
    projected = zones.select(
        *keep,
        first["lon"].alias("__x0"),
        height(first).alias("__y0"),
        F.transform("rings", lambda ring: F.transform(ring, lambda p: F.struct(
            (p["lon"] - first["lon"]).alias("x"),
            (height(p) - height(first)).alias("y")))).alias("__rings"),
    )

    def ring_terms(ring: Column) -> Column:
        starts = F.slice(ring, F.lit(1), F.greatest(F.size(ring) - 1, F.lit(0)))
        ends = F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0)))

        def terms(a: Column, b: Column) -> Column:
            cross = a["x"] * b["y"] - b["x"] * a["y"]
            return F.struct(
                cross.alias("a"),
                ((a["x"] + b["x"]) * cross).alias("mx"),
                ((a["y"] + b["y"]) * cross).alias("my"))
        return F.zip_with(starts, ends, terms)

    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))

    def add(acc: Column, t: Column) -> Column:
        return F.struct((acc["a"] + t["a"]).alias("a"), (acc["mx"] + t["mx"]).alias("mx"),
                        (acc["my"] + t["my"]).alias("my"))

    moments = F.aggregate(F.flatten(F.transform("__rings", ring_terms)), zero, add)
    x = F.col("__x0") + F.try_divide(F.col("__m.mx"), F.col("__m.a") * 3)
    y = F.col("__y0") + F.try_divide(F.col("__m.my"), F.col("__m.a") * 3)
    return projected.withColumn("__m", moments).select(
        *keep, x.alias("lon"), (_latitude(y) if equal_area else y).alias("lat"))


# --------------------------------------------------------------------------
# Edges and grid cells
# --------------------------------------------------------------------------
def _unbounded(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the zones or points and is never sent to every task.

    Its size is estimated from files of a few columns that pack well, or without what ``explode``
    makes of a row, so some millions of rows can pass for few bytes: broadcast, they fill the driver.
    """
    return df.hint("merge")


def zone_edges(zones: DataFrame, keep: Sequence[str] = ("GEOID",)) -> DataFrame:
    """One row per boundary segment of each zone."""
    ring = F.col("__ring")
    segments = F.zip_with(
        F.slice(ring, F.lit(1), F.greatest(F.size(ring) - 1, F.lit(0))),
        F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0))),
        lambda a, b: F.struct(a["lon"].alias("x0"), a["lat"].alias("y0"),
                              b["lon"].alias("x1"), b["lat"].alias("y1")))
    return (
        zones.select(*keep, F.explode("rings").alias("__ring"))
        .select(*keep, F.explode(segments).alias("__e")).select(*keep, "__e.*")
    )


def _cell(c: Column, size: float) -> Column:
    return F.floor(c / F.lit(size)).cast("bigint")


def _cells(low: Column, high: Column, size: float) -> Column:
    return F.explode(F.sequence(_cell(low, size), _cell(high, size)))


_SHIFT = (sqrt(5) - 1) / 2  # of the grid, in cells, so that no border lies on round numbers


def _place(c: Column, size: float) -> Column:
    return F.floor(c / F.lit(size) + F.lit(_SHIFT)).cast("bigint")


def _border(cell: Column, size: float) -> Column:
    """The upper border of a cell."""
    return (cell + 1 - F.lit(_SHIFT)) * F.lit(size)


def _crossing(e: Column, at: Column, along: str, across: str) -> Column:
    """Where the edge has ``along`` = ``at``; only for edges that cross there."""
    a, b = e[f"{along}0"], e[f"{along}1"]
    return (e[f"{across}1"] - e[f"{across}0"]) * (at - a) / (b - a) + e[f"{across}0"]


def zone_cells(zones: DataFrame, size: float, zone_id: str = "GEOID") -> DataFrame:
    """(zone, __band, __col, __edges, __corner): what the grid cells of a zone have of it.

    ``__edges`` are the edges that touch the cell, null if none does, and ``__corner`` says whether
    the cell's upper right corner is inside. An edge is kept once per cell it touches and nowhere
    else; cells between a zone's leftmost and rightmost edge in a band have a row each.
    """
    edge = F.struct("x0", "y0", "x1", "y1")
    slack = size * 1e-6
    banded = zone_edges(zones, [zone_id]).select(zone_id, edge.alias("e")).withColumn(
        "__band", F.explode(F.sequence(
            _place(F.least("e.y0", "e.y1") - slack, size),
            _place(F.greatest("e.y0", "e.y1") + slack, size))))
    # The stretch of the edge inside its band bounds the columns it touches.
    top, bottom = _border(F.col("__band"), size) + slack, _border(F.col("__band") - 1, size) - slack
    e, dy = F.col("e"), F.col("e.y1") - F.col("e.y0")

    def x_at(y: Column) -> Column:
        t = F.coalesce(F.try_divide(y - e["y0"], dy), F.lit(0.0))
        return e["x0"] + (e["x1"] - e["x0"]) * F.least(F.lit(1.0), F.greatest(F.lit(0.0), t))

    low = F.when(dy == 0, F.least("e.x0", "e.x1")).otherwise(F.least(x_at(bottom), x_at(top)))
    high = F.when(dy == 0, F.greatest("e.x0", "e.x1")).otherwise(
        F.greatest(x_at(bottom), x_at(top)))
    line = _border(F.col("__band"), size)
    spans = (e["y0"] > line) != (e["y1"] > line)
    banded = cut(banded.select(
        zone_id, "__band", "e", _place(low - slack, size).alias("__lo"),
        _place(high + slack, size).alias("__hi"),
        F.when(spans, _crossing(e, line, "y", "x")).alias("__x")))
    touched = banded.withColumn("__col", F.explode(F.sequence("__lo", "__hi"))).groupBy(
        zone_id, "__band", "__col").agg(F.collect_list("e").alias("__edges"))
    right = _border(F.col("__col"), size)
    cover = banded.groupBy(zone_id, "__band").agg(
        F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi"),
        F.collect_list("__x").alias("__xs")).withColumn(
            "__col", F.explode(F.sequence("__lo", "__hi"))).select(
                zone_id, "__band", "__col",
                (F.size(F.filter("__xs", lambda x: x > right)) % 2 == 1).alias("__corner"))
    return cover.join(_unbounded(touched), [zone_id, "__band", "__col"], "left").filter(
        "__edges IS NOT NULL OR __corner")


def within(
    points: DataFrame, zones: DataFrame, cell_deg: float = 0.05,
    point_id: str = "point_id", zone_id: str = "GEOID",
) -> DataFrame:
    """(point, zone) pairs for the points inside a zone, by crossing number.

    A point meets the zones of its grid cell and the edges they have there, in one join, and counts
    the edges on the way from it to the right border of the cell, along the border to its upper
    corner, and from there on what the cell knows of the zone. Points on a shared boundary fall to
    one side (half-open rule).
    """
    cells = cut(zone_cells(zones, cell_deg, zone_id))
    located = points.select(
        point_id, F.col("lon").alias("__px"), F.col("lat").alias("__py"),
        _place(F.col("lon"), cell_deg).alias("__col"),
        _place(F.col("lat"), cell_deg).alias("__band"))
    px, py = F.col("__px"), F.col("__py")
    right, top = _border(F.col("__col"), cell_deg), _border(F.col("__band"), cell_deg)

    def crossed(e: Column) -> Column:
        x, y = _crossing(e, py, "y", "x"), _crossing(e, right, "x", "y")
        beside = ((e["y0"] > py) != (e["y1"] > py)) & (px < x) & (x <= right)
        above = ((e["x0"] > right) != (e["x1"] > right)) & (py < y) & (y <= top)
        return beside.cast("int") + above.cast("int")

    met = F.aggregate(F.coalesce("__edges", F.array().cast(cells.schema["__edges"].dataType)),
                      F.col("__corner").cast("int"), lambda n, e: n + crossed(e))
    return located.join(_unbounded(cells), ["__band", "__col"]).filter(met % 2 == 1).select(
        point_id, zone_id)


def _segment_distance(px: Column, py: Column) -> Column:
    """Planar distance from a point to the segment (x0, y0)-(x1, y1)."""
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    along = F.try_divide(
        (px - F.col("x0")) * dx + (py - F.col("y0")) * dy, dx * dx + dy * dy)
    t = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(along, F.lit(0.0))))
    ex, ey = px - (F.col("x0") + t * dx), py - (F.col("y0") + t * dy)
    return F.sqrt(ex * ex + ey * ey)


def nearest(
    points: DataFrame, zones: DataFrame, max_m: float = NEAREST_CAP_M,
    by: str | None = "STATEFP", point_id: str = "point_id", zone_id: str = "GEOID",
) -> DataFrame:
    """The nearest zone closer than ``max_m`` metres, of the same ``by`` value as the point.

    Distance is planar in degrees times metres per degree, and 0 inside a zone. Each edge is
    registered in the grid cells within the cap around it, with cells as wide as the cap, so a
    point compares itself with nearby edges only; farther zones could not qualify anyway. Ties
    go to the smaller zone id.
    """
    reach = max_m / ARC_METERS
    zone_by = [by] if by else []
    edges = zone_edges(zones, [zone_id, *zone_by]).select("*").withColumn(
        "__band", _cells(F.least("y0", "y1") - reach, F.greatest("y0", "y1") + reach, reach))
    # The part of the edge that lies within reach of the band bounds the columns it can serve.
    low, high = F.col("__band") * reach - reach, (F.col("__band") + 1) * reach + reach
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")

    def x_at(y: Column) -> Column:
        t = F.coalesce(F.try_divide(y - F.col("y0"), dy), F.lit(0.0))
        return F.col("x0") + dx * F.least(F.lit(1.0), F.greatest(F.lit(0.0), t))

    flat = dy == 0
    left = F.when(flat, F.least("x0", "x1")).otherwise(F.least(x_at(low), x_at(high)))
    right = F.when(flat, F.greatest("x0", "x1")).otherwise(F.greatest(x_at(low), x_at(high)))
    covered = edges.withColumn("__col", _cells(left - reach, right + reach, reach))
    located = points.select(
        point_id, *zone_by, F.col("lon").alias("__px"), F.col("lat").alias("__py"),
        _cell(F.col("lon"), reach).alias("__col"), _cell(F.col("lat"), reach).alias("__band"))
    distance = _segment_distance(F.col("__px"), F.col("__py"))
    outside = (
        located.join(_unbounded(covered), [*zone_by, "__band", "__col"])
        .select(point_id, zone_id, distance.alias("__d"))
    )
    # The cell must allow a full band of a zone per point; the cap is too fine for that.
    cell = max(reach, 0.05)
    if by:
        pairs = within(points, zones, cell, point_id, zone_id)
        own = points.select(point_id, by)
        theirs = zones.select(zone_id, by)
        inside = pairs.join(_unbounded(own), point_id).join(_unbounded(theirs), [zone_id, by])
    else:
        inside = within(points, zones, cell, point_id, zone_id)
    measured = outside.unionByName(
        inside.select(point_id, zone_id, F.lit(0.0).alias("__d")))
    best = measured.groupBy(point_id).agg(
        F.min(F.struct(F.col("__d").alias("d"), F.col(zone_id).alias("z"))).alias("__best"))
    return best.select(
        point_id, F.col("__best.z").alias(zone_id),
        (F.col("__best.d") * F.lit(ARC_METERS)).alias("dist_m"),
    ).filter(F.col("dist_m") < max_m)


_FANOUT = 16  # cells of a level along each side of a cell of the next
_GLOBE_DEG = 360.0


def _pyramid(
    zones: DataFrame, size: float, by: Sequence[str], zone_id: str,
) -> tuple[DataFrame, list[DataFrame]]:
    """Edges by the finest cell they touch, and the touched cells (.., __band, __col) per level."""
    slack = size * 1e-6
    banded = zone_edges(zones, [zone_id, *by]).withColumn(
        "__band", _cells(F.least("y0", "y1") - slack, F.greatest("y0", "y1") + slack, size))
    dy = F.col("y1") - F.col("y0")

    def x_at(y: Column) -> Column:
        t = F.coalesce(F.try_divide(y - F.col("y0"), dy), F.lit(0.0))
        return F.col("x0") + (F.col("x1") - F.col("x0")) * F.least(
            F.lit(1.0), F.greatest(F.lit(0.0), t))

    ends = (x_at(F.col("__band") * size - slack), x_at((F.col("__band") + 1) * size + slack))
    flat = dy == 0
    finest = cut(banded.withColumn("__col", _cells(
        F.when(flat, F.least("x0", "x1")).otherwise(F.least(*ends)) - slack,
        F.when(flat, F.greatest("x0", "x1")).otherwise(F.greatest(*ends)) + slack, size)))
    levels = [cut(finest.select(*by, "__band", "__col").distinct())]
    while size * _FANOUT ** (len(levels) - 1) < _GLOBE_DEG:
        levels.append(levels[0].select(*by, *[
            F.floor(F.col(c) / _FANOUT ** len(levels)).alias(c) for c in ("__band", "__col")]
        ).distinct())
    return finest, levels


def nearest_any(
    points: DataFrame, zones: DataFrame, first_m: float = NEAREST_CAP_M,
    by: str | None = "STATEFP", point_id: str = "point_id", zone_id: str = "GEOID",
) -> DataFrame:
    """The nearest zone at any distance.

    Points without a zone within ``first_m`` go down a pyramid of grid cells: a level's cells that
    an edge touches are candidates while their near side is not farther than the far side of some
    other candidate. Only the edges of the finest cells left are measured. Each edge is registered
    once for every finest cell it touches, however far away the points are. A point whose ``by``
    has no zone at all comes back with a null zone and distance.
    """
    near = cut(nearest(points, zones, first_m, by, point_id, zone_id))
    left = cut(points.join(_unbounded(near), point_id, "left_anti"))
    if left.isEmpty():
        return near
    keys = [by] if by else []
    size = first_m / ARC_METERS
    finest, levels = _pyramid(zones, size, keys, zone_id)
    px, py = F.col("__px"), F.col("__py")
    found = left.select(point_id, *keys, F.col("lon").alias("__px"), F.col("lat").alias("__py"))
    # The top level has a handful of cells for each value of ``by``.
    top = F.broadcast(levels[-1])
    found = found.join(top, keys) if keys else found.join(
        top.withColumn("__one", F.lit(1)), F.lit(1) == F.col("__one")).drop("__one")
    for k in range(len(levels) - 1, -1, -1):
        width = size * _FANOUT ** k

        def sides(p: Column, cell: str) -> tuple[Column, Column]:
            low, high = F.col(cell) * width, (F.col(cell) + 1) * width
            outside = F.greatest(low - p, p - high, F.lit(0.0))
            return outside, F.greatest(F.abs(p - low), F.abs(p - high))

        (x_near, x_far), (y_near, y_far) = sides(px, "__col"), sides(py, "__band")
        # The candidates of a point are a ring of cells, some dozens at most.
        found = found.withColumns({
            "__least": F.sqrt(x_near * x_near + y_near * y_near),
            "__bound": F.min(F.sqrt(x_far * x_far + y_far * y_far)).over(
                Window.partitionBy(point_id))}).filter(
                    F.col("__least") <= F.col("__bound") * (1 + 1e-9) + 1e-12).drop(
                        "__least", "__bound")
        if k:
            below = levels[k - 1].withColumns({
                f"{c}_up": F.floor(F.col(c) / _FANOUT) for c in ("__band", "__col")})
            found = found.withColumnsRenamed(
                {c: f"{c}_up" for c in ("__band", "__col")}).join(
                    _unbounded(below), [*keys, "__band_up", "__col_up"]).drop("__band_up", "__col_up")
    measured = found.join(_unbounded(finest), [*keys, "__band", "__col"]).groupBy(point_id).agg(
        F.min(F.struct(_segment_distance(px, py).alias("d"), F.col(zone_id).alias("z"))).alias("__best"))
    far = left.select(point_id).join(_unbounded(measured), point_id, "left").select(
        point_id, F.col("__best.z").alias(zone_id),
        (F.col("__best.d") * F.lit(ARC_METERS)).alias("dist_m"))
    return near.unionByName(far)


# --------------------------------------------------------------------------
# Crosswalk
# --------------------------------------------------------------------------
def same_crs(*zones: DataFrame, col: str = "srid") -> DataFrame:
    """Number of reference systems over all tables and whether it is one."""
    codes = reduce(DataFrame.unionByName, [z.select(col).distinct() for z in zones])
    return codes.agg(F.count_distinct(col).alias("n_crs")).withColumn(
        "same_crs", F.col("n_crs") == 1)


def assign_zones(
    zones: DataFrame, pumas: DataFrame, max_m: float = NEAREST_CAP_M, cell_deg: float = 0.05,
) -> DataFrame:
    """PUMA of every zone by its centroid; orphans take the nearest PUMA of their state.

    Zones that no PUMA of the state reaches within the cap are dropped.
    """
    points = cut(
        centroids(zones, keep=("GEOID", "STATEFP")).withColumnRenamed("GEOID", "point_id"))
    areas = pumas.select(F.col("GEOID").alias("PUMA"), "STATEFP", "rings")
    inside = cut(within(points, areas, cell_deg, zone_id="PUMA"))
    orphans = points.join(_unbounded(inside.select("point_id")), "point_id", "left_anti")
    by_distance = nearest(orphans, areas, max_m, zone_id="PUMA").select("point_id", "PUMA")
    links = inside.unionByName(by_distance).withColumnRenamed("point_id", "GEOID")
    return zones.drop("rings").join(_unbounded(links), "GEOID")


def build_crosswalk(
    bg: DataFrame, pumas: DataFrame, max_m: float = NEAREST_CAP_M, region: int = REGION,
    cell_deg: float = 0.05,
) -> DataFrame:
    """Block groups with composed BG, TRACT, COUNTY, STATE and PUMA identifiers."""
    linked = assign_zones(bg, pumas, max_m, cell_deg)
    named = linked.withColumnsRenamed(CROSSWALK_RENAMES).withColumn("REGION", F.lit(region))
    return compose_geoids(named)


def prune_crosswalk(xwalk: DataFrame, data: DataFrame, zone: str) -> DataFrame:
    """Keep the zones that have data; zones whose numbers sum to zero have none."""
    with_data = drop_empty_zones(data).select(zone).distinct()
    return xwalk.join(with_data, zone, "left_semi").select(*xwalk.columns)


def data_without_crosswalk(xwalk: DataFrame, data: DataFrame, zone: str) -> DataFrame:
    """Zones that have data but no crosswalk row."""
    return drop_empty_zones(data).select(zone).distinct().join(xwalk, zone, "left_anti")


def ambiguous_zones(xwalk: DataFrame, zone: str) -> DataFrame:
    """Zones that lie in more than one PUMA."""
    pairs = xwalk.select("PUMA", zone).distinct()
    return pairs.groupBy(zone).agg(F.count(F.lit(1)).alias("n_pumas")).filter("n_pumas > 1")


def dedupe_crosswalk(
    xwalk: DataFrame, zone_points: DataFrame, pumas: DataFrame, zone: str = "TRACT",
    max_m: float = NEAREST_CAP_M,
) -> DataFrame:
    """Leave one PUMA per zone.

    All rows of an ambiguous zone move to the PUMA nearest to the zone's centroid if that is
    within the cap; otherwise only the rows already in the nearest PUMA stay. ``zone_points``
    has the composed zone id, ``STATEFP``, ``lon`` and ``lat``; ``pumas`` has the composed PUMA.
    """
    xwalk = cut(xwalk)
    unclear = ambiguous_zones(xwalk, zone).select(zone)
    points = zone_points.join(_unbounded(unclear), zone, "left_semi").withColumnRenamed(zone, "point_id")
    areas = pumas.withColumnRenamed("PUMA", "__near")
    best = nearest_any(points, areas, max_m, zone_id="__near").select(
        F.col("point_id").alias(zone), "__near", "dist_m")
    joined = xwalk.join(_unbounded(best), zone, "left")
    close = F.col("dist_m") < max_m
    stays = F.col("__near").isNull() | close | (F.col("PUMA") == F.col("__near"))
    moved = F.when(F.coalesce(close, F.lit(False)), F.col("__near")).otherwise(F.col("PUMA"))
    return joined.filter(stays).withColumn("PUMA", moved).select(*xwalk.columns)
