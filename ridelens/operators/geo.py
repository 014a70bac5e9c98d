"""Point-in-polygon join and area totals.

Polygons are rows ``(area_id, community, polygon)`` where ``polygon`` is a
GeoJSON MultiPolygon coordinate array ``ARRAY<ARRAY<ARRAY<ARRAY<DOUBLE>>>>``
(parts -> rings -> points -> [lng, lat]); a Polygon is a MultiPolygon with one
part. No geometry library is needed:

1. every polygon is covered by quadtree cells. It starts with the few cells of
   its own size (a power of two in degrees, at most 2 x 2 of them) and splits
   those that more than ``MAX_EDGES`` of its edges pass, down to ``LEAST_SIDE``.
   A cell without edges is wholly inside (kept, nothing to test) or outside (no
   row). Only crowded cells split, so that the rows of the cover are bounded by
   edges times depth, whatever the polygon's area. Splitting needs no shuffle;
2. a cell also knows whether its upper right corner is inside: the point is
   joined to that corner by a path inside the cell, east and then north, and each
   local edge that the path crosses changes sides (even-odd, which handles holes
   and the parts of a MultiPolygon). So a cell holds its own edges only. A point
   on an edge is not *within*. Cell corners are exact binary fractions;
3. points probe the few levels that the cover has, by one equi-join each on the
   cell's number; a cell is one row, so that no join multiplies points. Below a
   proven bound on its rows and edges the cover is broadcast and the points are
   not shuffled. Beyond it the probes run on the distinct cells that hold points,
   and the points join the result once on their own finest cell.

The tests are higher-order functions over a cell's edges; Spark interprets these,
outside generated code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelens.operators._plan import written_map

# Edges that a cell may hold before it splits.
MAX_EDGES = 8
# Sides of cells are powers of two between these exponents (degrees).
LARGEST_SIDE, LEAST_SIDE = 9, -11
# Splits that one pass plans before it writes the cover.
_SPLITS = 4
# Rows of the cover and, apart, edges in it that are broadcast at most
# (about 40 bytes an edge, 100 a row and its attributes).
MAX_EDGE_ROWS = 500_000


# The edges of a ring ``r``, closed if it does not repeat its first point. The
# expressions here are SQL text: each is parsed at once, where Column calls, some
# hundred of them, would be sent to the JVM one by one.
_RING_EDGES = """zip_with(
  slice(r, 1, size(r) - IF(r[0] = r[size(r) - 1], 1, 0)),
  slice(concat(r, slice(r, 1, 1)), 2, size(r) - IF(r[0] = r[size(r) - 1], 1, 0)),
  (p, q) -> named_struct('x1', p[0], 'y1', p[1], 'x2', q[0], 'y2', q[1]))"""


def polygon_edges(areas: DataFrame, attrs: tuple[str, ...] = ()) -> DataFrame:
    """area_id, the ``attrs`` columns and the edges of all rings of each area.
    Rings of fewer than two points have none."""
    edges = f"flatten(transform(filter(flatten(polygon), r -> size(r) >= 2), r -> {_RING_EDGES}))"
    return areas.select("area_id", *attrs, F.expr(edges).alias("edges"))


def _crossings(edges: str, px: str, py: str, ex: str, ey: str) -> str:
    """How many edges the path from (px, py) east to x = ex and from there north
    to y = ey crosses. Points count as a little right of and above where they
    are, more to the right than above; both legs look at the same products, so
    an edge through the bend is counted once."""
    dx, dy = "(e.x2 - e.x1)", "(e.y2 - e.y1)"
    product = lambda x, y: f"(({x} - e.x1) * {dy} - ({y} - e.y1) * {dx})"
    start, bend, end = product(px, py), product(ex, py), product(ex, ey)
    up, right = f"({dy} > 0)", f"({dx} > 0)"
    rising = f"({dy} <> 0 AND {up} = {right})"
    east = f"(e.y1 > {py}) <> (e.y2 > {py}) AND IF({up}, {start} < 0, {start} > 0) AND IF({up}, {bend} >= 0, {bend} <= 0)"
    north = (
        f"(e.x1 > {ex}) <> (e.x2 > {ex}) AND IF({bend} = 0, {rising}, ({bend} > 0) = {right})"
        f" AND IF({end} = 0, NOT {rising}, ({end} < 0) = {right})"
    )
    return f"aggregate({edges}, 0, (n, e) -> n + IF({east}, 1, 0) + IF({north}, 1, 0))"


def _touching(edges: str) -> str:
    """The edges that may meet the closed cell at (x, y) of a side: none that
    does is left out."""
    dx, dy = "(e.x2 - e.x1)", "(e.y2 - e.y1)"
    low = f"((x - e.x1) * {dy} - (y - e.y1) * {dx})"
    # the corners' sides of the line, with room for rounding
    room = f"((abs({dx}) + abs({dy})) * (abs(e.x1) + abs(e.y1) + abs(x) + abs(y) + side) * 1e-12D)"
    return f"""filter({edges}, e -> greatest(e.x1, e.x2) >= x AND least(e.x1, e.x2) <= x + side
      AND greatest(e.y1, e.y2) >= y AND least(e.y1, e.y2) <= y + side
      AND {low} + least(side * {dy}, 0D) + least(-side * {dx}, 0D) <= {room}
      AND {low} + greatest(side * {dy}, 0D) + greatest(-side * {dx}, 0D) >= -{room})"""


def _cells(rows: DataFrame, keep: list[str]) -> DataFrame:
    """Cells from rows with exponent, column and row, the edges ``within`` that
    may touch them, a corner (cx, cy) and whether that is ``known`` inside. Rows
    that ``stay`` are cells already."""
    placed = rows.withColumn("side", F.expr("pow(2D, exponent)")).withColumns({"x": F.expr("column * side"), "y": F.expr("row * side")})
    turns = _crossings("within", "(x + side)", "(y + side)", "cx", "cy")
    return placed.select(
        *keep,
        "exponent",
        "column",
        "row",
        F.expr(f"IF(stay, known, known <> ({turns} % 2 = 1))").alias("inside"),
        F.expr(f"IF(stay, within, {_touching('within')})").alias("edges"),
    )


def quadtree_cover(areas: DataFrame, max_edges: int = MAX_EDGES, attrs: tuple[str, ...] = ("community",)) -> DataFrame:
    """One row per (cell, area): ``exponent`` (the cell's side is 2^exponent
    degrees), ``column`` and ``row``, ``inside`` (its upper right corner),
    ``edges``, area_id and the attributes. Coordinates beyond 2^9 degrees in
    size are refused."""
    keep = ["area_id", *attrs]
    rows = polygon_edges(areas, attrs).where("size(edges) > 0")
    bounds = {
        f"b{c}{k}": F.expr(f"array_{how}(flatten(transform(edges, e -> array(e.{c}1, e.{c}2))))") for c in "xy" for k, how in enumerate(("min", "max"))
    }
    rows = rows.withColumns(bounds)
    refused = "raise_error('coordinates beyond 512 degrees')"
    extent = f"greatest(bx1 - bx0, by1 - by0, {2.0**LEAST_SIDE!r}D)"
    fits = f"greatest(abs(bx0), abs(bx1), abs(by0), abs(by1)) <= {2.0**LARGEST_SIDE!r}D"
    rows = rows.withColumn("exponent", F.expr(f"IF({fits}, least(ceil(log2({extent})), {LARGEST_SIDE}), {refused})").cast("int"))
    rows = rows.withColumn("side", F.expr("pow(2D, exponent)"))
    span = lambda c: F.explode(F.expr(f"sequence(floor(b{c}0 / side), floor(b{c}1 / side))"))
    rows = rows.withColumn("column", span("x")).withColumn("row", span("y"))
    # beyond all edges every place is outside
    far = F.lit(4.0 * 2**LARGEST_SIDE)
    rows = rows.withColumns({"within": F.col("edges"), "cx": far, "cy": far, "known": F.lit(False), "stay": F.lit(False)})
    cells = _cells(rows, keep)
    open_ = f"(size(edges) > {max_edges} AND exponent > {LEAST_SIDE})"
    while True:
        cells = written_map(cells.where("inside OR size(edges) > 0"), "area_cells")
        if not cells.where(open_).limit(1).count():
            return cells
        for _ in range(_SPLITS):
            parts = cells.withColumn("part", F.explode(F.expr(f"IF({open_}, sequence(0, 3), array(-1))")))
            quarters = parts.select(
                *keep,
                F.expr("IF(part < 0, exponent, exponent - 1)").alias("exponent"),
                F.expr("IF(part < 0, column, column * 2 + part % 2)").alias("column"),
                F.expr("IF(part < 0, row, row * 2 + part div 2)").alias("row"),
                F.col("edges").alias("within"),
                F.expr("(column + 1) * pow(2D, exponent)").alias("cx"),
                F.expr("(row + 1) * pow(2D, exponent)").alias("cy"),
                F.col("inside").alias("known"),
                F.expr("part < 0").alias("stay"),
            )
            cells = _cells(quarters, keep).where("inside OR size(edges) > 0")


def _probe(points: DataFrame, levels: list[int], by_level: dict[int, DataFrame], cx: str, cy: str) -> DataFrame:
    """The points with a column ``__at<k>`` for each level: the candidate areas
    of their cell, or NULL. ``cx`` and ``cy`` place a point."""
    for k, e in enumerate(levels):
        side = f"{2.0**e!r}D"
        cells = by_level[e].select(F.col("column").alias("__c"), F.col("row").alias("__r"), F.col("__areas").alias(f"__at{k}"))
        met = F.expr(f"floor({cx} / {side}) = __c AND floor({cy} / {side}) = __r")
        points = points.join(cells, met, "left").drop("__c", "__r")
    return points


def _hits(k: int, attrs: tuple[str, ...]) -> str:
    """The candidate areas of a level that contain the point strictly, without
    their edges."""
    turns = _crossings("a.edges", "__px", "__py", f"__ex{k}", f"__ey{k}")
    on_edge = """exists(a.edges, e -> (e.x2 - e.x1) * (__py - e.y1) = (e.y2 - e.y1) * (__px - e.x1)
      AND __px BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2) AND __py BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2))"""
    fields = ", ".join(f"'{c}', a.{c}" for c in ("area_id", *attrs))
    inside = f"filter(__at{k}, a -> a.inside <> ({turns} % 2 = 1) AND NOT {on_edge})"
    return f"transform({inside}, a -> named_struct({fields}))"


def within_join(
    points: DataFrame,
    areas: DataFrame,
    x: str = "lng",
    y: str = "lat",
    how: str = "left",
    max_edges: int = MAX_EDGES,
    attrs: tuple[str, ...] = ("community",),
    max_broadcast_rows: int = MAX_EDGE_ROWS,
) -> DataFrame:
    """Spatial join of points to the areas containing them.

    Every point keeps the areas of its cells that contain it, so duplicates keep
    their multiplicity. ``how="left"``: a point in no area keeps NULL attributes;
    a point in several areas appears once per area. A point with a NULL, infinite
    or NaN coordinate is in no area."""
    clash = [c for c in ("area_id", *attrs) if c in points.columns]
    if clash:
        raise ValueError(f"points already have columns {clash}; rename them before the spatial join")
    cover = quadtree_cover(areas, max_edges, attrs)
    facts = cover.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.size("edges")).alias("edges"), F.collect_set("exponent").alias("levels")
    ).first()
    levels = sorted(facts.levels)  # between LEAST_SIDE and LARGEST_SIDE
    if not levels:
        types = dict(areas.dtypes)
        none = [F.lit(None).cast(types[c]).alias(c) for c in ("area_id", *attrs)]
        return points.select(*points.columns, *none).where(F.lit(how == "left"))
    area = F.struct("area_id", *attrs, "inside", "edges")
    cells = written_map(cover.groupBy("exponent", "column", "row").agg(F.collect_list(area).alias("__areas")), "cover")
    by_level = {e: cells.where(F.col("exponent") == e).drop("exponent") for e in levels}
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    fine = (F.abs(px) <= 2.0**LARGEST_SIDE) & (F.abs(py) <= 2.0**LARGEST_SIDE)
    placed = points.withColumns({"__px": F.when(fine, px), "__py": F.when(fine, py)})
    if max(facts.rows, facts.edges or 0) <= max_broadcast_rows:
        probed = _probe(placed, levels, {e: F.broadcast(c) for e, c in by_level.items()}, "__px", "__py")
    else:
        # one row for each finest cell that holds points
        least = f"{2.0 ** levels[0]!r}D"
        own = placed.select(F.expr(f"floor(__px / {least})").alias("__x"), F.expr(f"floor(__py / {least})").alias("__y"))
        own = own.where("__x IS NOT NULL AND __y IS NOT NULL").distinct()
        found = _probe(own, levels, by_level, f"(__x * {least})", f"(__y * {least})")
        some = " OR ".join(f"__at{k} IS NOT NULL" for k in range(len(levels)))
        found = written_map(found.where(some), "point_cells")
        probed = placed.join(found, F.expr(f"floor(__px / {least}) = __x AND floor(__py / {least}) = __y"), "left")
    corners = {
        f"__e{c}{k}": F.expr(f"(floor(__p{c} / {2.0**e!r}D) + 1) * {2.0**e!r}D") for k, e in enumerate(levels) for c in "xy"
    }
    types = dict(cover.dtypes)
    nothing = F.array().cast("array<struct<" + ",".join(f"{c}:{types[c]}" for c in ("area_id", *attrs)) + ">>")
    hits = F.concat(*(F.coalesce(F.expr(_hits(k, attrs)), nothing) for k in range(len(levels))))
    opened = (F.explode_outer if how == "left" else F.explode)(hits)
    found = probed.withColumns(corners).select(*points.columns, opened.alias("__area"))
    return found.select(*points.columns, *[F.col(f"__area.{c}").alias(c) for c in ("area_id", *attrs)])


def area_totals(
    points: DataFrame,
    areas: DataFrame,
    n: str = "n_trips",
    x: str = "lng",
    y: str = "lat",
    max_edges: int = MAX_EDGES,
) -> DataFrame:
    """Trips per area with zero for areas without trips.

    Points are tested where they are (map side, see ``within_join``); totals
    are summed per community (``sum(na.rm = TRUE)``, partial aggregation),
    merged onto every area, and a missing total becomes 0.
    """
    hits = within_join(points.select(x, y, n), areas, x, y, how="inner", max_edges=max_edges)
    totals = hits.groupBy("community").agg(F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n))
    return left_merge(areas.select("area_id", "community"), totals, "community").fillna({n: 0})


def left_merge(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """All rows of ``left`` with the matching ``right`` columns, sorted by the
    key as R's ``merge`` returns them (J10)."""
    return left.join(right, on=on, how="left").orderBy(on)
