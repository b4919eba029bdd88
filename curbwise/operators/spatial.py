"""Polyline-in-polygon tagging as an equi-join on the cells of a quadtree.

Geometry columns are ``array<array<struct<x double, y double>>>``: parts of a
polyline, or rings of a polygon (outer ring and holes; closed or not).

A polyline intersects a polygon (boundary included) when
  (a) one of its edges touches or crosses one of the polygon's ring edges, or
  (b) it lies wholly inside: then any of its vertices is inside by the
      even-odd rule (which also treats holes correctly).

(a) joins edges on the cells they pass through, then applies the exact
orientation test. (b) joins the first vertex of every part to the cells of polygon
bounding boxes, then to that polygon's ring edges in the vertex's horizontal band,
and counts ray crossings. Both are equi-joins on fine keys (cell, or polygon x
band), so no cross product is formed and a dense cell is split by AQE's skew-join
handling like any other hot join key. All tests are Column expressions; no Python
runs per row.

Cells are powers of four, and every edge has a level by its own extent: the
smallest cells of which it covers at most ``SPAN`` in a row. Two edges meet at the
larger of their two levels, where the longer one has its own cells and the other a
few; both join sides hold one key per level that the other layer has. So tiny and
huge shapes do not share one grid, and an edge gives a bounded number of rows
whatever the other layer holds. With an explicit ``cell_size`` all edges are put
on that one grid instead; the pairs are the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

col = F.col


def _edges(df: DataFrame, id_col: str, geom_col: str, close_rings: bool) -> DataFrame:
    parts = df.select(col(id_col).alias("_id"), F.posexplode(geom_col).alias("_part", "_pts"))
    if close_rings:
        first, last = col("_pts")[0], F.element_at(col("_pts"), -1)
        closed = F.when((first["x"] != last["x"]) | (first["y"] != last["y"]),
                        F.concat(col("_pts"), F.array(first))).otherwise(col("_pts"))
        parts = parts.withColumn("_pts", closed)
    n = F.size("_pts")
    pairs = F.arrays_zip(F.slice("_pts", 1, n - 1).alias("a"), F.slice("_pts", 2, n - 1).alias("b"))
    e = parts.filter(n >= 2).select("_id", "_part", F.explode(pairs).alias("_e"))
    return e.select("_id", "_part",
                    col("_e.a.x").alias("x1"), col("_e.a.y").alias("y1"),
                    col("_e.b.x").alias("x2"), col("_e.b.y").alias("y2"))


SPAN = 16
#: Cell numbers stay below 2^50, so coordinates bound the smallest cells.
_FINEST = 50


def level_of(extent: Column, reach: Column, span: int = SPAN) -> Column:
    """The exponent e of the smallest cell 4^e of which ``extent`` is at most ``span``;
    ``reach`` is the largest coordinate."""
    def log4(c: Column) -> Column:
        return F.log2(c) / 2
    by_extent = F.when(extent > 0, F.ceil(log4(extent / span)))
    by_reach = F.when(reach > 0, F.ceil(log4(reach) - _FINEST / 2))
    return F.coalesce(F.greatest(by_extent, by_reach), F.lit(-_FINEST)).cast("int")


def _size_of(level: Column) -> Column:
    return F.pow(F.lit(4.0), level)


def _edge_level() -> Column:
    extent = F.greatest(F.abs(col("x2") - col("x1")), F.abs(col("y2") - col("y1")))
    return level_of(extent, F.greatest(*[F.abs(col(c)) for c in ("x1", "y1", "x2", "y2")]))


def _levels(df: DataFrame) -> Column:
    """The levels in use, as a lazy subquery: at most a few dozen numbers."""
    return df.agg(F.collect_set("level").alias("levels")).scalar()


def _cell_range(lo: Column, hi: Column, size: float | Column) -> Column:
    return F.sequence(F.floor(lo / F.lit(size)), F.floor(hi / F.lit(size)))


def _with_cells(edges: DataFrame, size: float | Column) -> DataFrame:
    """Each edge once per grid cell it passes through (plus rounding margin).

    Per column strip of the edge's x-range, only the y-range the edge spans
    inside that strip is exploded, so a long diagonal edge yields about
    2 * length / size cells instead of every cell of its bounding box. The
    y-range is widened by a tiny margin, so floating-point rounding can only
    add a neighbouring cell, never drop one; the exact test after the join
    removes the extras.
    """
    g = F.lit(size)
    x1, y1, x2, y2 = F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")
    e = edges.withColumn("cx", F.explode(_cell_range(F.least(x1, x2), F.greatest(x1, x2), size)))
    xa = F.greatest(F.least(x1, x2), F.col("cx") * g)
    xb = F.least(F.greatest(x1, x2), (F.col("cx") + 1) * g)

    def y_at(x):
        return y1 + (x - x1) * (y2 - y1) / (x2 - x1)
    vertical = x1 == x2
    ya = F.when(vertical, F.least(y1, y2)).otherwise(y_at(xa))
    yb = F.when(vertical, F.greatest(y1, y2)).otherwise(y_at(xb))
    margin = g * 1e-9
    lo = F.greatest(F.least(ya, yb) - margin, F.least(y1, y2))
    hi = F.least(F.greatest(ya, yb) + margin, F.greatest(y1, y2))
    return e.withColumn("cy", F.explode(_cell_range(lo, hi, size)))


def _orient(a, b, c) -> str:
    """Twice the signed area of triangle a, b, c (SQL text over column names)."""
    (ax, ay), (bx, by), (cx, cy) = a, b, c
    return f"(({bx} - {ax}) * ({cy} - {ay}) - ({by} - {ay}) * ({cx} - {ax}))"


def edges_touch(a: tuple[str, str, str, str], b: tuple[str, str, str, str]) -> Column:
    """Closed segments a=(x1,y1,x2,y2) and b (column names) touch or cross, collinear included.

    Bounding boxes overlap and each segment's end points are not strictly on
    one side of the other's line. Exact for coordinates whose products are
    exact in doubles. Built as one SQL expression.
    """
    ax1, ay1, ax2, ay2 = a
    bx1, by1, bx2, by2 = b
    p1, p2, q1, q2 = (ax1, ay1), (ax2, ay2), (bx1, by1), (bx2, by2)
    return F.expr(
        f"greatest(least({ax1}, {ax2}), least({bx1}, {bx2})) <= least(greatest({ax1}, {ax2}), greatest({bx1}, {bx2}))"
        f" AND greatest(least({ay1}, {ay2}), least({by1}, {by2})) <= least(greatest({ay1}, {ay2}), greatest({by1}, {by2}))"
        f" AND signum({_orient(q1, q2, p1)}) * signum({_orient(q1, q2, p2)}) <= 0"
        f" AND signum({_orient(p1, p2, q1)}) * signum({_orient(p1, p2, q2)}) <= 0")


def ray_crosses(px: str, py: str, x1: str, y1: str, x2: str, y2: str) -> Column:
    """Edge crosses the ray from (px, py) toward +x (half-open rule, no division)."""
    return F.expr(
        f"(({y1} > {py}) <> ({y2} > {py}))"
        f" AND (({px} - {x1}) * ({y2} - {y1}) - ({py} - {y1}) * ({x2} - {x1})) * signum({y2} - {y1}) < 0")


_XY = ("x1", "y1", "x2", "y2")
_LINE_XY = tuple(f"a{c}" for c in _XY)


def _touch_pairs(le: DataFrame, pe: DataFrame, keys: list[str]) -> DataFrame:
    return le.join(pe, keys, "inner").filter(edges_touch(_LINE_XY, _XY)).select("line", "poly")


def _touching_on_grid(le: DataFrame, pe: DataFrame, size: float | Column) -> DataFrame:
    return _touch_pairs(_with_cells(le, size).select("line", *_LINE_XY, "cx", "cy"), _with_cells(pe, size), ["cx", "cy"])


def _touching_by_levels(le: DataFrame, pe: DataFrame) -> DataFrame:
    """Pairs of edges that touch, each found at the larger level of the two."""
    le, pe = le.withColumn("level", _edge_level()), pe.withColumn("level", _edge_level())

    def at_levels_of(edges: DataFrame, other: Column, same: bool) -> DataFrame:
        """The edges at those levels of the other layer that are not (or not ``same``) below their own."""
        up = col("at") >= col("level") if same else col("at") > col("level")
        return edges.withColumn("at", F.explode(other)).filter(up)

    def cells(edges: DataFrame, *keep: str) -> DataFrame:
        return _with_cells(edges, _size_of(col("at"))).select(*keep, "at", "cx", "cy")

    own = lambda edges: edges.withColumn("at", col("level"))
    keys = ["at", "cx", "cy"]
    # the polygon's edge is the longer one (or of the same level), then the line's
    wide_poly = _touch_pairs(cells(at_levels_of(le, _levels(pe), True), "line", *_LINE_XY), cells(own(pe), "poly", *_XY), keys)
    wide_line = _touch_pairs(cells(own(le), "line", *_LINE_XY), cells(at_levels_of(pe, _levels(le), False), "poly", *_XY), keys)
    return wide_poly.unionByName(wide_line)


def _boxes(pe: DataFrame) -> DataFrame:
    return pe.groupBy("poly").agg(
        F.min(F.least("x1", "x2")).alias("xmin"), F.max(F.greatest("x1", "x2")).alias("xmax"),
        F.min(F.least("y1", "y2")).alias("ymin"), F.max(F.greatest("y1", "y2")).alias("ymax"))


def _odd_crossings(candidates: DataFrame, bands: DataFrame) -> DataFrame:
    """Vertices inside by the even-odd rule: the edges of the vertex's band of that polygon count."""
    return (candidates.join(bands, ["poly", "band"], "inner").filter(ray_crosses("px", "py", *_XY))
            .groupBy("line", "part", "px", "py", "poly").count().filter(col("count") % 2 == 1).select("line", "poly"))


def _in_box() -> Column:
    return col("px").between(col("xmin"), col("xmax")) & col("py").between(col("ymin"), col("ymax"))


def _inside_on_grid(pts: DataFrame, pe: DataFrame, size: float | Column) -> DataFrame:
    at = pts.withColumn("cx", F.floor(col("px") / F.lit(size))).withColumn("cy", F.floor(col("py") / F.lit(size)))
    boxes = (_boxes(pe).withColumn("cx", F.explode(_cell_range(col("xmin"), col("xmax"), size)))
             .withColumn("cy", F.explode(_cell_range(col("ymin"), col("ymax"), size))))
    bands = (pe.filter(col("y1") != col("y2"))
             .withColumn("band", F.explode(_cell_range(F.least("y1", "y2"), F.greatest("y1", "y2"), size)))
             .select("poly", "band", *_XY))
    return _odd_crossings(at.join(boxes, ["cx", "cy"], "inner").filter(_in_box()).withColumn("band", col("cy")), bands)


#: A polygon's box covers at most this many cells in a row, and its edges four times as many bands.
_BOX_SPAN, _BANDS = 4, 64


def _inside_by_levels(pts: DataFrame, pe: DataFrame) -> DataFrame:
    """Vertices inside polygons: boxes at the level of their extent, bands by their height."""
    reach = F.greatest(*[F.abs(col(c)) for c in ("xmin", "xmax", "ymin", "ymax")])
    high = col("ymax") - col("ymin")
    boxes = _boxes(pe).withColumns({"at": level_of(F.greatest(col("xmax") - col("xmin"), high), reach, _BOX_SPAN),
                                    "tall": level_of(high, reach, _BANDS)})
    size, band = _size_of(col("at")), _size_of(col("tall"))
    found = boxes.select(col("at").alias("level"))
    covered = (boxes.withColumn("cx", F.explode(_cell_range(col("xmin"), col("xmax"), size)))
               .withColumn("cy", F.explode(_cell_range(col("ymin"), col("ymax"), size))))
    at = pts.withColumn("at", F.explode(_levels(found)))
    at = at.withColumn("cx", F.floor(col("px") / size)).withColumn("cy", F.floor(col("py") / size))
    candidates = at.join(covered, ["at", "cx", "cy"], "inner").filter(_in_box()).withColumn("band", F.floor(col("py") / band))
    bands = (pe.filter(col("y1") != col("y2")).join(boxes.select("poly", "tall"), "poly")
             .withColumn("band", F.explode(_cell_range(F.least("y1", "y2"), F.greatest("y1", "y2"), band)))
             .select("poly", "band", *_XY))
    return _odd_crossings(candidates, bands)


def intersecting_pairs(lines: DataFrame, line_id: str, line_geom: str,
                       polys: DataFrame, poly_id: str, poly_geom: str,
                       cell_size: float | Column | None = None, distinct: bool = True) -> DataFrame:
    """(line_id, poly_id) pairs whose geometries intersect.

    With ``distinct=False`` a pair may repeat (found in several cells or by
    both tests); callers that aggregate per line anyway skip that shuffle.
    """
    le = _edges(lines, line_id, line_geom, close_rings=False).select(
        col("_id").alias("line"), *[col(c).alias(f"a{c}") for c in _XY], *_XY)
    pe = _edges(polys, poly_id, poly_geom, close_rings=True).select(col("_id").alias("poly"), *_XY)
    # rows that repeat a line id are one vertex each, or crossings would be counted twice
    pts = (lines.select(col(line_id).alias("line"), F.posexplode(line_geom).alias("part", "pts")).filter(F.size("pts") >= 1)
           .select("line", "part", col("pts")[0]["x"].alias("px"), col("pts")[0]["y"].alias("py")).distinct())
    if cell_size is None:
        touching, inside = _touching_by_levels(le, pe), _inside_by_levels(pts, pe)
    else:
        touching, inside = _touching_on_grid(le, pe, cell_size), _inside_on_grid(pts, pe, cell_size)
    pairs = touching.unionByName(inside)
    if distinct:
        pairs = pairs.distinct()
    return pairs.select(col("line").alias(line_id), col("poly").alias(poly_id))


def tag_zones(lines: DataFrame, line_id: str, line_geom: str,
              layers: list[tuple[str, DataFrame, str]], cell_size: float | Column | None = None,
              order_col: str = "objectid") -> DataFrame:
    """``line_id`` of each line with, per zone layer, the intersecting zone of lowest ``order_col``.

    ``layers`` is a list of (output column, zones with ``order_col`` and
    ``rings``, zone value column). All layers share one spatial join (the
    lines are exploded into edges once). Lines meeting no zone of a layer get
    NULL there. The choice among several zones is a ``min`` of the object id
    (partial aggregation), so no line's candidate set is collected.
    """
    polys = None
    for i, (_, zones, _) in enumerate(layers):
        z = zones.select(F.struct(F.lit(i).alias("layer"), col(order_col).alias("oid")).alias("_poly"),
                         col("rings"))
        polys = z if polys is None else polys.unionByName(z)
    pairs = intersecting_pairs(lines, line_id, line_geom, polys, "_poly", "rings", cell_size, distinct=False)
    # lowest object id per (line, layer): a hash aggregate on numbers (partial
    # aggregation; repeated pairs do not matter), the zone value looked up after
    first = (pairs.groupBy(line_id, col("_poly.layer").alias("_layer"))
             .agg(F.min(col("_poly.oid")).alias("_oid")))
    out = lines.select(line_id)  # geometry is not carried through the joins
    for i, (out_col, zones, value_col) in enumerate(layers):
        vals = zones.select(col(order_col).alias("_oid"), col(value_col).alias(out_col))
        best = first.filter(col("_layer") == i).join(vals, "_oid", "inner").select(line_id, out_col)
        out = out.join(best, line_id, "left")
    return out
