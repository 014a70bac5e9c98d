"""Point-in-polygon join and area totals."""

import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from ridelens.operators.geo import area_totals, polygon_edges, quadtree_cover, within_join

SQUARE = [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0], [0.0, 0.0]]
HOLE = [[1.0, 1.0], [3.0, 1.0], [3.0, 3.0], [1.0, 3.0], [1.0, 1.0]]
# A "U": concave, open at the top between x = 6.5 and 7.5.
U_SHAPE = [[6.0, 0.0], [8.0, 0.0], [8.0, 3.0], [7.5, 3.0], [7.5, 1.0], [6.5, 1.0], [6.5, 3.0], [6.0, 3.0], [6.0, 0.0]]
PART_A = [[10.0, 0.0], [11.0, 0.0], [11.0, 1.0], [10.0, 1.0]]  # not closed on purpose
PART_B = [[12.0, 0.0], [13.0, 0.0], [13.0, 1.0], [12.0, 1.0], [12.0, 0.0]]


@pytest.fixture()
def areas(spark):
    rows = [
        (0, "holed", [[SQUARE, HOLE]]),
        (1, "concave", [[U_SHAPE]]),
        (2, "multi", [[PART_A], [PART_B]]),
        (3, "empty", [[[[50.0, 50.0], [51.0, 50.0], [51.0, 51.0], [50.0, 50.0]]]]),
    ]
    return spark.createDataFrame(rows, "area_id long, community string, polygon array<array<array<array<double>>>>")


def _inside_ring(px, py, ring):
    c = False
    n = len(ring)
    for i in range(n):
        (x1, y1), (x2, y2) = ring[i], ring[(i + 1) % n]
        if (y1 > py) != (y2 > py) and px < x1 + (py - y1) * (x2 - x1) / (y2 - y1):
            c = not c
    return c


def _brute(px, py, polygon):
    inside = False
    for part in polygon:
        for ring in part:
            if _inside_ring(px, py, ring):
                inside = not inside
    return inside


def test_holes_concave_multipolygon(spark, areas):
    pts = spark.createDataFrame(
        [
            ("in_square", 0.5, 0.5),
            ("in_hole", 2.0, 2.0),
            ("in_u_left", 6.2, 2.0),
            ("in_u_gap", 7.0, 2.0),
            ("in_u_base", 7.0, 0.5),
            ("in_part_a", 10.5, 0.5),
            ("in_part_b", 12.5, 0.5),
            ("between_parts", 11.5, 0.5),
            ("on_edge", 4.0, 2.0),
            ("on_vertex", 0.0, 0.0),
            ("on_hole_edge", 1.0, 2.0),
            ("nowhere", -5.0, -5.0),
            ("null", None, None),
        ],
        "name string, lng double, lat double",
    )
    got = {r.name: r.community for r in within_join(pts, areas).collect()}
    assert got == {
        "in_square": "holed",
        "in_hole": None,
        "in_u_left": "concave",
        "in_u_gap": None,
        "in_u_base": "concave",
        "in_part_a": "multi",
        "in_part_b": "multi",
        "between_parts": None,
        "on_edge": None,
        "on_vertex": None,
        "on_hole_edge": None,
        "nowhere": None,
        "null": None,
    }


def test_random_points_match_brute_force(spark, areas):
    rnd = random.Random(3)
    pts = [(i, rnd.uniform(-1, 14), rnd.uniform(-1, 5)) for i in range(3000)]
    df = spark.createDataFrame(pts, "id int, lng double, lat double")
    polys = {r.area_id: r.polygon for r in areas.collect()}
    expected = sorted((i, a) for i, x, y in pts for a, poly in polys.items() if _brute(x, y, poly))
    for most in (2, 100):
        got = sorted((r.id, r.area_id) for r in within_join(df, areas, max_edges=most).filter(F.col("area_id").isNotNull()).collect())
        assert got == expected


def test_area_totals_zero_fill_and_balance(spark, areas):
    pts = spark.createDataFrame(
        [(0.5, 0.5, 10), (0.5, 0.5, 5), (2.0, 2.0, 7), (12.5, 0.5, 3), (-5.0, -5.0, 1)],
        "lng double, lat double, n_trips long",
    )
    out = {r.community: r.n_trips for r in area_totals(pts, areas).collect()}
    assert out == {"holed": 15, "concave": 0, "multi": 3, "empty": 0}
    unmatched = 7 + 1
    assert sum(out.values()) + unmatched == 26


def test_edges_and_broadcast(spark, areas):
    edges = {r.area_id: len(r.edges) for r in polygon_edges(areas).collect()}
    assert edges == {0: 8, 1: 8, 2: 8, 3: 3}
    pts = spark.createDataFrame([(0.5, 0.5)], "lng double, lat double")
    plan = plan_of(within_join(pts, areas))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_within_join_without_broadcast_equals_broadcast(spark, areas):
    rnd = random.Random(5)
    pts = spark.createDataFrame([(i, rnd.uniform(-1, 14), rnd.uniform(-1, 5)) for i in range(500)], "id int, lng double, lat double")
    a = sorted((r.id, r.area_id) for r in within_join(pts, areas).collect())
    b = sorted((r.id, r.area_id) for r in within_join(pts, areas, max_broadcast_rows=0).collect())
    assert a == b


def _circle(n, x, y, r):
    return [[x + r * math.cos(2 * math.pi * k / n), y + r * math.sin(2 * math.pi * k / n)] for k in range(n)]


def test_cover_grows_with_edges_not_with_area(spark):
    schema = "area_id long, community string, polygon array<array<array<array<double>>>>"
    for n, radius in ((4, 80.0), (600, 80.0), (600, 0.08)):
        areas = spark.createDataFrame([(0, "round", [[_circle(n, 0.3, 0.7, radius)]])], schema)
        cover = quadtree_cover(areas).collect()
        depth = max(r.exponent for r in cover) - min(r.exponent for r in cover) + 1
        assert len(cover) <= n * depth
        assert max(len(r.edges) for r in cover) <= 8


def test_deep_cover_matches_brute_force_on_grid_and_boundary(spark):
    """Vertices and points on cell borders and corners, at every split depth."""
    comb = [[0.0, 0.0], [8.0, 0.0]] + [p for k in range(15, 0, -1) for p in ([k / 2, 0.25 + 3.75 * (k % 2)],)] + [[0.0, 4.0]]
    polys = [(0, "comb", [[comb]]), (1, "ring", [[_circle(200, 2.0, 2.0, 2.0), _circle(90, 2.0, 2.0, 1.0)]]), (2, "dot", [[[[5.0, 5.0]]]])]
    areas = spark.createDataFrame(polys, "area_id long, community string, polygon array<array<array<array<double>>>>")
    pts = [(i, x / 8, y / 8) for i, (x, y) in enumerate((x, y) for x in range(-9, 74) for y in range(-9, 42))]
    df = spark.createDataFrame(pts, "id int, lng double, lat double")

    def on_edge(px, py, poly):
        for part in poly:
            for ring in part:
                for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
                    flat = (x2 - x1) * (py - y1) == (y2 - y1) * (px - x1)
                    if flat and min(x1, x2) <= px <= max(x1, x2) and min(y1, y2) <= py <= max(y1, y2):
                        return True
        return False

    want = sorted((i, a) for i, x, y in pts for a, _, poly in polys if _brute(x, y, poly) and not on_edge(x, y, poly))
    for most in (1,):
        got = sorted((r.id, r.area_id) for r in within_join(df, areas, how="inner", max_edges=most).collect())
        assert got == want
    assert want


def test_no_areas_and_strange_coordinates(spark, areas):
    none = areas.where("area_id < 0")
    pts = spark.createDataFrame([(1, 0.5, 0.5), (2, float("nan"), 0.5), (3, float("inf"), 0.5), (4, None, 0.5), (5, 1e300, 0.5)], "id int, lng double, lat double")
    assert [r.area_id for r in within_join(pts, none).collect()] == [None] * 5
    assert within_join(pts, none, how="inner").count() == 0
    assert {r.id: r.area_id for r in within_join(pts, areas).collect()} == {1: 0, 2: None, 3: None, 4: None, 5: None}
    assert {r.id: r.area_id for r in within_join(pts, areas, max_broadcast_rows=0).collect()} == {1: 0, 2: None, 3: None, 4: None, 5: None}
