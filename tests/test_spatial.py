import numpy as np
import pytest
from pyspark.sql import functions as F

from popflow.operators import spatial
from popflow.plans.prepare import prepare_crosswalk
from popflow.sources import geometry

DEGREE = 111139.0


def square(x, y, side, clockwise=False):
    ring = [(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]
    return ring[::-1] if clockwise else ring


def zones(spark, items):
    """(id, state, rings) with rings as lists of (lon, lat)."""
    return spark.createDataFrame(
        [(i, s, [[tuple(map(float, p)) for p in ring] for ring in rings]) for i, s, rings in items],
        "GEOID string, STATEFP string, rings array<array<struct<lon: double, lat: double>>>")


def points(spark, items):
    return spark.createDataFrame(items, "point_id long, STATEFP string, lon double, lat double")


@pytest.fixture(scope="module")
def three(spark):
    return zones(spark, [
        ("hole", "09", [square(0, 0, 1), square(0.4, 0.4, 0.2, clockwise=True)]),
        ("next", "09", [square(1, 0, 1)]),
        ("parts", "36", [square(3, 0, 0.5), square(5, 0, 0.5)])])


@pytest.mark.parametrize("cell", [0.05, 0.3, 7.0])
def test_within(spark, rows, three, cell):
    pts = points(spark, [
        (1, "09", 0.1, 0.1), (2, "09", 0.5, 0.5), (3, "09", 1.5, 0.5), (4, "36", 3.2, 0.2),
        (5, "36", 5.2, 0.2), (6, "36", 4.2, 0.2), (7, "09", -0.1, 0.5), (8, "09", 0.39, 0.5)])
    assert rows(spatial.within(pts, three, cell)) == [
        (1, "hole"), (3, "next"), (4, "parts"), (5, "parts"), (8, "hole")]


def test_shared_boundary_belongs_to_one_zone(spark, rows, three):
    pts = points(spark, [(1, "09", 1.0, 0.3), (2, "09", 1.0, 0.7)])
    assert rows(spatial.within(pts, three)) == [(1, "next"), (2, "next")]


def test_within_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    items, shapes = [], []
    for k in range(12):
        cx, cy = rng.random(2) * 2
        angles = np.sort(rng.random(9)) * 2 * np.pi
        radii = 0.1 + rng.random(9) * 0.5
        ring = [(cx + r * np.cos(a), cy + r * np.sin(a)) for a, r in zip(angles, radii)]
        items.append((f"z{k}", "09", [ring + ring[:1]]))
        shapes.append(np.array(ring + ring[:1]))
    pts = rng.random((400, 2)) * 3 - 0.5
    df = points(spark, [(i, "09", float(x), float(y)) for i, (x, y) in enumerate(pts)])
    want = set()
    for i, (x, y) in enumerate(pts):
        for k, s in enumerate(shapes):
            (x0, y0), (x1, y1) = s[:-1].T, s[1:].T
            spans = (y0 > y) != (y1 > y)
            with np.errstate(divide="ignore", invalid="ignore"):
                right = x < (x1 - x0) * (y - y0) / (y1 - y0) + x0
            if np.sum(spans & right) % 2:
                want.add((i, f"z{k}"))
    got = {tuple(r) for r in spatial.within(df, zones(spark, items), 0.11).collect()}
    assert got == want


def test_nearest_within_the_cap(spark, rows):
    z = zones(spark, [("a", "09", [square(0, 0, 0.1)]), ("b", "09", [square(0.12, 0, 0.1)]),
                      ("c", "36", [square(0, 0.101, 0.1)])])
    pts = points(spark, [
        (1, "09", 0.05, 0.05),           # inside a
        (2, "09", 0.105, 0.05),          # 0.005 from a, 0.015 from b
        (3, "09", 0.05, 0.1008),         # nearer to c, which is in another state
        (4, "09", 0.05, -0.0095),        # beyond the cap
        (5, "09", 0.104, -0.003),        # off the corner of a
        (6, "36", 0.05, 0.05)])          # inside a, but a is in another state
    got = {r.point_id: (r.GEOID, r.dist_m / DEGREE) for r in spatial.nearest(pts, z).collect()}
    assert set(got) == {1, 2, 3, 5} and {g for g, _ in got.values()} == {"a"}
    for point, degrees in {1: 0.0, 2: 0.005, 3: 0.0008, 5: 0.005}.items():
        assert got[point][1] == pytest.approx(degrees, abs=1e-9)
    far = {r.point_id: (r.GEOID, r.dist_m) for r in spatial.nearest_any(pts, z).collect()}
    assert len(far) == 6 and far[6][0] == "c" and far[4][0] == "a"
    assert far[4][1] == pytest.approx(0.0095 * DEGREE)


def test_centroids(spark):
    z = zones(spark, [
        ("flat", "09", [square(10, 0, 0.02)]),
        ("hole", "09", [square(0, 0, 1), square(0.5, 0, 0.5, clockwise=True)]),
        ("back", "09", [square(0, 0, 1, clockwise=True)]),
        ("north", "09", [square(20, 40, 1)])])
    planar = {r.GEOID: (r.lon, r.lat) for r in spatial.centroids(z, equal_area=False).collect()}
    assert planar["flat"] == pytest.approx((10.01, 0.01), abs=1e-12)
    assert planar["back"] == pytest.approx((0.5, 0.5))
    assert planar["hole"] == pytest.approx(((0.5 - 0.25 * 0.75) / 0.75, (0.5 - 0.25 * 0.25) / 0.75))
    projected = {r.GEOID: (r.lon, r.lat) for r in spatial.centroids(z).collect()}
    # Halving the area of a one-degree cell: a little below its middle latitude.
    lat = np.degrees(np.arcsin((np.sin(np.radians(40)) + np.sin(np.radians(41))) / 2))
    assert projected["north"][0] == pytest.approx(20.5)
    assert projected["north"][1] == pytest.approx(lat, abs=5e-5)  # by hand on the sphere
    assert projected["north"][1] < 40.5


def test_rings_from_text_and_vertices(spark):
    text = spark.createDataFrame(
        [("MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5,6 5,6 6,5 5), (5.1 5.1,5.2 5.2,5.1 5.1)))",)],
        "wkt string")
    rings = text.select(geometry.rings_from_wkt("wkt").alias("r")).first()["r"]
    assert [len(r) for r in rings] == [4, 4, 3] and tuple(rings[1][1]) == (6.0, 5.0)
    vertices = spark.createDataFrame(
        [("z", "09", 1, 1, 1.0, 0.0), ("z", "09", 0, 0, 9.0, 9.0), ("z", "09", 1, 0, 0.0, 0.0)],
        "GEOID string, STATEFP string, ring_no int, v int, lon double, lat double")
    made = geometry.rings_from_vertices(vertices, ["GEOID", "STATEFP"]).first()["rings"]
    assert [[tuple(p) for p in r] for r in made] == [[(9.0, 9.0)], [(0.0, 0.0), (1.0, 0.0)]]
    named = spark.createDataFrame([(1, 2, 3)], "GEOID20 int, STATEFP10 int, B201 int")
    assert geometry.strip_vintage(named).columns == ["GEOID", "STATEFP", "B1"]


def block_groups(spark, items):
    base = zones(spark, [(g, g[:2], [square(x - 0.001, y - 0.001, 0.002)]) for g, x, y in items])
    return base.select(
        "GEOID", "STATEFP", F.substring("GEOID", 3, 3).alias("COUNTYFP"),
        F.substring("GEOID", 6, 6).alias("TRACTCE"), F.substring("GEOID", 12, 1).alias("BLKGRPCE"),
        F.lit("name").alias("NAMELSAD"), "rings")


def test_crosswalk(spark, rows):
    pumas = zones(spark, [("0900100", "09", [square(0, 0, 0.1)]),
                          ("0900200", "09", [square(0.1, 0, 0.1)]),
                          ("3600100", "36", [square(0, 0.1, 0.1)])])
    bg = block_groups(spark, [
        ("090010001001", 0.05, 0.05), ("090010001002", 0.15, 0.05),   # one tract, two PUMAs
        ("090010002001", 0.15, -0.005),                               # within 1 km
        ("090010003001", 0.15, -0.05),                                # too far
        ("090010004001", 0.03, 0.03), ("360010001001", 0.05, 0.15)])
    tract = zones(spark, [
        ("09001000100", "09", [square(0.02, 0, 0.1)]), ("09001000200", "09", [square(0.14, 0, 0.02)]),
        ("09001000400", "09", [square(0, 0, 0.02)]), ("36001000100", "36", [square(0, 0.1, 0.1)])])
    # The identifiers in this test have five-digit tracts, so they are padded here.
    bg = bg.withColumn("TRACTCE", F.lpad(F.col("TRACTCE"), 6, "0"))
    made = spatial.build_crosswalk(bg, pumas)
    assert {r.PUMA for r in made.collect()} == {900100, 900200, 3600100}
    assert made.count() == 5 and made.select("REGION").distinct().count() == 1
    assert {"BG", "TRACT", "COUNTY", "STATE", "PUMA", "NAMELSAD"} <= set(made.columns)
    unclear = spatial.ambiguous_zones(made, "TRACT").collect()
    assert len(unclear) == 1 and unclear[0]["n_pumas"] == 2
    assert tract.count() == 4


def test_dedupe_moves_or_drops(spark, rows):
    xwalk = spark.createDataFrame(
        [(1, 10, 100), (2, 10, 200), (3, 20, 100), (4, 20, 200), (5, 30, 200)],
        "BG long, TRACT long, PUMA long")
    pumas = zones(spark, [("100", "09", [square(0, 0, 0.1)]), ("200", "09", [square(0.1, 0, 0.1)])])
    pumas = pumas.select(F.col("GEOID").cast("long").alias("PUMA"), "STATEFP", "rings")
    centres = spark.createDataFrame(
        [(10, "09", 0.02, 0.02), (20, "09", 0.25, 0.05), (30, "09", 0.05, 0.05)],
        "TRACT long, STATEFP string, lon double, lat double")
    assert rows(spatial.dedupe_crosswalk(xwalk, centres, pumas)) == [
        (1, 10, 100), (2, 10, 100),  # nearest within the cap: all rows move
        (4, 20, 200),                # nearest beyond it: the others go
        (5, 30, 200)]                # unambiguous: left alone


def test_prune_and_prepare_crosswalk(spark, rows):
    pumas = zones(spark, [("0900100", "09", [square(0, 0, 0.1)]),
                          ("0900200", "09", [square(0.1, 0, 0.1)])])
    bg = block_groups(spark, [("090010001001", 0.05, 0.05), ("090010001002", 0.15, 0.05),
                              ("090010001003", 0.04, 0.04)])
    bg = bg.withColumn("TRACTCE", F.lit("000100")).withColumn(
        "GEOID", F.concat("STATEFP", "COUNTYFP", "TRACTCE", "BLKGRPCE"))
    tract = zones(spark, [("09001000100", "09", [square(0.01, 0.01, 0.05)])])
    data = {
        "BG": spark.createDataFrame(
            [(90010001001, 5), (90010001002, 7), (90010001003, 1)], "BG long, n long"),
        "TRACT": spark.createDataFrame([(9001000100, 13)], "TRACT long, n long"),
        "PUMA": spark.createDataFrame([(900100, 3)], "PUMA long, n long")}
    made = prepare_crosswalk(bg, tract, pumas, data)
    assert rows(made, "BG", "PUMA") == [
        (90010001001, 900100), (90010001002, 900100), (90010001003, 900100)]
    empty = spark.createDataFrame(
        [(90010001001, 1, 0), (90010001002, 1, 7), (90010001003, 1, 2)],
        "BG long, REGION int, n long")
    left = [(90010001002,), (90010001003,)]
    assert rows(spatial.prune_crosswalk(made, empty, "BG"), "BG") == left
    fewer = prepare_crosswalk(bg, tract, pumas, {**data, "BG": empty})
    assert rows(fewer, "BG") == left
    extra = spark.createDataFrame([(1, 4), (2, 0)], "BG long, n long")
    assert rows(spatial.data_without_crosswalk(made, extra, "BG")) == [(1,)]


def test_same_reference_system(spark):
    a = spark.createDataFrame([(4269,)], "srid int")
    b = spark.createDataFrame([(4326,)], "srid int")
    assert tuple(spatial.same_crs(a, a).first()) == (1, True)
    assert tuple(spatial.same_crs(a, b).first()) == (2, False)


def star(rng, x, y, n, size):
    """A star-shaped ring, counter-clockwise."""
    angles = np.sort(rng.uniform(0, 2 * np.pi, n))
    r = rng.uniform(0.2, 1.0, n) * size
    ring = [(float(x + d * np.cos(a)), float(y + d * np.sin(a))) for a, d in zip(angles, r)]
    return [*ring, ring[0]]


def inside(ring, x, y):
    return sum((b > y) != (d > y) and x < (c - a) * (y - b) / (d - b) + a
               for (a, b), (c, d) in zip(ring, ring[1:])) % 2 == 1


def distance(ring, x, y):
    best = np.inf
    for (a, b), (c, d) in zip(ring, ring[1:]):
        dx, dy = c - a, d - b
        t = min(1.0, max(0.0, ((x - a) * dx + (y - b) * dy) / (dx * dx + dy * dy)))
        best = min(best, np.hypot(x - a - t * dx, y - b - t * dy))
    return best


def test_any_shape_against_brute_force(spark):
    """Stars with holes, some much larger than a cell and some much smaller; points also far away."""
    rng = np.random.default_rng(8)
    zones = []
    for i in range(14):
        x, y = rng.uniform(-1, 1, 2).tolist()
        size = [0.02, 0.3, 1.5][i % 3]
        rings = [star(rng, x, y, 30, size)]
        if i % 2:
            rings.append([(x + (a - x) * 0.15, y + (b - y) * 0.15) for a, b in rings[0]][::-1])
        zones.append((f"z{i:02}", "09", rings))
    spots = [(float(a), float(b)) for a, b in np.r_[
        rng.uniform(-2.5, 2.5, (250, 2)), rng.uniform(-60, 60, (12, 2))]]
    spots += [(0.05 * i, 0.05 * i) for i in range(-20, 20)]
    points = [(k, "09", x, y) for k, (x, y) in enumerate(spots)]
    points += [(9999, "36", 0.0, 0.0)]
    areas = spark.createDataFrame(
        zones, "GEOID string, STATEFP string, rings array<array<struct<lon: double, lat: double>>>")
    df = spark.createDataFrame(points, "point_id long, STATEFP string, lon double, lat double")
    want = {(k, z) for k, (x, y) in enumerate(spots) for z, _, rings in zones
            if sum(inside(r, x, y) for r in rings) % 2}
    for cell in (0.05, 0.7):
        assert {tuple(r) for r in spatial.within(df, areas, cell).collect()
                if r.point_id != 9999} == want
    found = {r.point_id: r for r in spatial.nearest_any(df, areas, 5000.0).collect()}
    assert len(found) == len(points) and found[9999].GEOID is None and found[9999].dist_m is None
    for k, (x, y) in enumerate(spots):
        least = min((0.0 if (k, z) in want else min(distance(r, x, y) for r in rings), z)
                    for z, _, rings in zones)
        assert found[k].GEOID == least[1]
        assert found[k].dist_m == pytest.approx(least[0] * spatial.ARC_METERS, abs=1e-6)


def test_nothing_that_grows_is_broadcast(spark):
    """Cells and edges look small to the planner however many a zone covers."""
    zs = zones(spark, [(f"z{i}", "01", [square(i, 0, 0.5)]) for i in range(3)])
    ps = points(spark, [(1, "01", 0.25, 0.25), (2, "01", 1.75, 0.25)])
    for joined in (spatial.within(ps, zs, 0.01), spatial.nearest(ps, zs),
                   spatial.nearest_any(ps, zs)):
        plan = joined._jdf.queryExecution().sparkPlan().toString()
        # The top level of the pyramid has a handful of cells.
        assert plan.count("BroadcastHashJoin") <= ("__band_up" in plan), plan


def test_points_without_a_near_zone_are_not_broadcast(spark):
    """They can be most points; the top of the pyramid is a few cells a state."""
    zs = zones(spark, [(f"z{i}", "01", [square(i, 0, 0.5)]) for i in range(3)])
    ps = points(spark, [(i, "01", 0.25, 40.0 + i) for i in range(3)])
    plan = spatial.nearest_any(ps, zs)._jdf.queryExecution().sparkPlan().toString()
    assert "BuildRight" in plan and "BuildLeft" not in plan, plan
