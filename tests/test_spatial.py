"""Spatial tagging: golden geometry cases and grid join == brute force."""

import random

import pytest

from curbwise.operators.spatial import intersecting_pairs, tag_zones

BOX = [[(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0)]]
BOX_WITH_HOLE = BOX + [[(3.0, 3.0), (7.0, 3.0), (7.0, 7.0), (3.0, 7.0)]]  # hole ring left open


def _lines(spark, rows):
    return spark.createDataFrame([(i, [[{"x": x, "y": y} for x, y in part] for part in parts])
                                  for i, parts in rows],
                                 "id long, path array<array<struct<x:double,y:double>>>")


def _zones(spark, rows):
    return spark.createDataFrame([(oid, z, [[{"x": x, "y": y} for x, y in ring] for ring in rings])
                                  for oid, z, rings in rows],
                                 "objectid long, zone_id string, rings array<array<struct<x:double,y:double>>>")


CASES = {
    1: [[(-5.0, 5.0), (5.0, 5.0)]],            # crosses an edge
    2: [[(-5.0, 15.0), (10.0, 10.0)]],          # touches a vertex
    3: [[(10.0, 2.0), (10.0, 20.0)]],           # collinear with an edge
    4: [[(4.0, 1.0), (6.0, 2.0)]],              # wholly inside (outside the hole)
    5: [[(4.0, 4.0), (6.0, 6.0)]],              # wholly inside the hole
    6: [[(20.0, 20.0), (30.0, 30.0)]],          # far away
}


@pytest.mark.parametrize("cell", [1.0, 3.0, 100.0, None])
def test_golden_geometry(spark, cell):
    zones = _zones(spark, [(1, "A", BOX_WITH_HOLE)])
    pairs = intersecting_pairs(_lines(spark, CASES.items()), "id", "path", zones, "objectid", "rings", cell)
    assert sorted(r.id for r in pairs.collect()) == [1, 2, 3, 4]


def test_two_zones_lowest_objectid_and_none(spark):
    zones = _zones(spark, [(7, "late", BOX), (3, "early", BOX)])
    lines = _lines(spark, [(1, CASES[1]), (2, CASES[6])])
    out = {r.id: r.zone for r in tag_zones(lines, "id", "path", [("zone", zones, "zone_id")], 5.0).collect()}
    assert out == {1: "early", 2: None}


# --- property: grid join equals brute force for any cell size ---------------
def _orient(a, b, c):
    return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])


def _sgn(v):
    return (v > 0) - (v < 0)


def _touch(a, b, c, d):
    if max(min(a[0], b[0]), min(c[0], d[0])) > min(max(a[0], b[0]), max(c[0], d[0])):
        return False
    if max(min(a[1], b[1]), min(c[1], d[1])) > min(max(a[1], b[1]), max(c[1], d[1])):
        return False
    return (_sgn(_orient(c, d, a)) * _sgn(_orient(c, d, b)) <= 0
            and _sgn(_orient(a, b, c)) * _sgn(_orient(a, b, d)) <= 0)


def _inside(p, rings):
    crossings = 0
    for ring in rings:
        pts = ring if ring[0] == ring[-1] else ring + [ring[0]]
        for a, b in zip(pts, pts[1:]):
            if (a[1] > p[1]) != (b[1] > p[1]):
                x = a[0] + (p[1] - a[1]) * (b[0] - a[0]) / (b[1] - a[1])
                if p[0] < x:
                    crossings += 1
    return crossings % 2 == 1


def _brute(lines, polys):
    out = set()
    for lid, parts in lines:
        for pid, _, rings in polys:
            edges = [(a, b) for r in rings for a, b in zip(r if r[0] == r[-1] else r + [r[0]],
                                                           (r if r[0] == r[-1] else r + [r[0]])[1:])]
            hit = any(_touch(a, b, c, d) for part in parts for a, b in zip(part, part[1:]) for c, d in edges)
            hit = hit or any(_inside(part[0], rings) for part in parts)
            if hit:
                out.add((lid, pid))
    return out


def test_grid_join_equals_brute_force(spark):
    rnd = random.Random(7)
    lines = []
    for i in range(150):
        x, y = rnd.randint(0, 200), rnd.randint(0, 200)
        pts = [(float(x), float(y))]
        for _ in range(rnd.randint(1, 4)):
            x, y = x + rnd.randint(-15, 15), y + rnd.randint(-15, 15)
            pts.append((float(x), float(y)))
        lines.append((i, [pts]))
    polys = []
    for j in range(12):
        x0, y0 = rnd.randint(0, 170), rnd.randint(0, 170)
        w, h = rnd.randint(10, 60), rnd.randint(10, 60)
        ring = [(x0, y0), (x0 + w, y0 + rnd.randint(-5, 5)), (x0 + w, y0 + h), (x0 + rnd.randint(0, 5), y0 + h)]
        rings = [[(float(a), float(b)) for a, b in ring]]
        if j % 3 == 0:
            rings.append([(x0 + 3.0, y0 + 3.0), (x0 + w / 2, y0 + 3.0), (x0 + w / 2, y0 + h / 2)])
        polys.append((j, "z", rings))
    expected = _brute(lines, polys)
    ldf, pdf = _lines(spark, lines), _zones(spark, polys)
    for cell in (7.0, 30.0, 1000.0, None):
        got = {(r.id, r.objectid) for r in
               intersecting_pairs(ldf, "id", "path", pdf, "objectid", "rings", cell).collect()}
        assert got == expected, cell


def test_long_edges_explode_only_over_crossed_cells(spark):
    from curbwise.operators.spatial import _with_cells
    edges = spark.createDataFrame([(1, 0, 0.0, 0.0, 1000.0, 1000.0), (2, 0, 0.0, 500.0, 1000.0, 500.0)],
                                  "_id long, _part int, x1 double, y1 double, x2 double, y2 double")
    counts = {r._id: r.n for r in _with_cells(edges, 10.0).groupBy("_id").count()
              .withColumnRenamed("count", "n").collect()}
    # a 100 x 100-cell diagonal touches ~2-3 cells per column, not the 10,201 of its bounding box
    assert counts[1] <= 3 * 101
    assert counts[2] == 101


def _box(x, y, w, h):
    return [[(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]]


def test_tiny_and_huge_zones_and_lines_equal_brute_force(spark):
    """Sizes over nine orders of magnitude, at coordinates in the millions, on one quadtree."""
    rnd, lines, polys = random.Random(11), [], []
    for i in range(120):
        size = 2.0 ** rnd.randint(-12, 18)
        x, y = 3_000_000.0 + rnd.randint(0, 4000) / 4, 10_000_000.0 + rnd.randint(0, 4000) / 4
        pts = [(x, y)]
        for _ in range(rnd.randint(0, 3)):
            pts.append((pts[-1][0] + rnd.choice([-1, 0, 1]) * size, pts[-1][1] + rnd.choice([-1, 0, 1]) * size))
        lines.append((i, [pts]))
    for j in range(60):
        x, y, size = 3_000_000.0 + rnd.randint(0, 4000) / 4, 10_000_000.0 + rnd.randint(0, 4000) / 4, 2.0 ** rnd.randint(-12, 18)
        polys.append((j, "z", _box(x, y, size, size * rnd.choice([1, 2, 0.5]))))
    polys.append((99, "z", _box(2_000_000.0, 9_000_000.0, 2_000_000.0, 2_000_000.0)))  # holds all
    got = intersecting_pairs(_lines(spark, lines), "id", "path", _zones(spark, polys), "objectid", "rings")
    want = _brute(lines, polys)
    assert {(r.id, r.objectid) for r in got.collect()} == want and len(want) > 200


def test_an_edge_gives_a_bounded_number_of_rows(spark):
    """One long edge against a zone of 1e-4, and against a zone that is a point."""
    import time

    from curbwise.operators import spatial as S
    line = _lines(spark, [(1, [[(0.0, 0.0), (18.0, 7.0)]]), (2, [[(5.0, 5.0)]])])
    for side in (1e-4, 0.0):
        zones = _zones(spark, [(1, "A", _box(9.0, 3.5, side, side)), (2, "B", _box(5.0, 5.0, 1e-9, 1e-9))])
        t0 = time.time()
        pairs = {(r.id, r.objectid) for r in intersecting_pairs(line, "id", "path", zones, "objectid", "rings").collect()}
        assert pairs == {(1, 1), (2, 2)} and time.time() - t0 < 10
    edges = spark.createDataFrame([(0.0, 0.0, 18.0, 7.0), (0.0, 0.0, 1e6, 1e6), (3.0, 3.0, 3.0, 3.0), (1e7, 1e7, 1e7 + 1e-9, 1e7)],
                                  "x1 double, y1 double, x2 double, y2 double").withColumn("level", S._edge_level())
    rows = S._with_cells(edges, S._size_of(edges["level"])).groupBy("x1", "x2").count().collect()
    assert len(rows) == 4 and max(r["count"] for r in rows) <= 3 * (S.SPAN + 1)


def test_rows_that_repeat_a_line_id(spark):
    """Two versions of a line are two lines for the parity rule, and the id meets the zone if either does."""
    rnd = random.Random(3)
    lines = []
    for i in range(60):
        for _ in range(rnd.randint(1, 3)):
            x, y = float(rnd.randint(0, 60)), float(rnd.randint(0, 60))
            lines.append((i, [[(x, y), (x + 2, y + 1)]]))
        lines += lines[-1:]  # and an equal row
    polys = [(j, "z", [[(float(a), float(b)) for a, b in ((5 * j, 5), (5 * j + 20, 5), (5 * j + 20, 40), (5 * j, 40))]]) for j in range(6)]
    got = intersecting_pairs(_lines(spark, lines), "id", "path", _zones(spark, polys), "objectid", "rings")
    assert {(r.id, r.objectid) for r in got.collect()} == _brute(lines, polys)


def test_two_versions_of_a_segment_are_tagged_once(spark):
    import datetime as dt

    from curbwise.plans.tagging import tag_segments
    from curbwise.sources.tables import PermitTables
    path = "array<array<struct<x:double,y:double>>>"
    inside = [[{"x": 4.0, "y": 4.0}, {"x": 5.0, "y": 5.0}]]
    segs = spark.createDataFrame([(1, "old", 1, dt.datetime(2024, 1, 1), inside), (1, "new", 2, dt.datetime(2024, 1, 2), inside)],
                                 f"segment_id long, full_street_name string, road_class int, modified_date timestamp_ntz, path {path}")
    zone = spark.createDataFrame([(1, 7.0, [[{"x": x, "y": y} for x, y in BOX[0]]])], f"objectid long, zone_id double, rings {path}")
    t = PermitTables(spark, {"inspector_zone": lambda: zone, "dapcz_zone": lambda: zone.limit(0)})
    assert [tuple(r) for r in tag_segments(t, segs).collect()] == [(1, "new", 2, 7.0, None)]


def test_grid_cell_follows_the_unit_of_the_zones(spark):
    small = [(1, "A", [[(x / 1e5, y / 1e5) for x, y in BOX[0]]])]
    lines = _lines(spark, [(i, [[(x / 1e5, y / 1e5) for x, y in part] for part in parts]) for i, parts in CASES.items()])
    got = tag_zones(lines, "id", "path", [("zone", _zones(spark, small), "zone_id")]).collect()
    assert {r.id for r in got if r.zone} == {1, 2, 3, 4, 5}
