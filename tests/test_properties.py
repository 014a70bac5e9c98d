"""Property tests: operators against plain-Python statements of the same rule."""

import math
from collections import Counter
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ridelens.functions.scalar import exact_ratio
from ridelens.operators.clean import drop_all_duplicates
from ridelens.operators.conform import conflict_audit
from ridelens.operators.distribution import histogram
from ridelens.operators.outliers import drop_zscore

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _bins(values, w=2.0):
    lo = min(values)
    out = Counter()
    for x in values:
        k = (x - w / 2) / w
        c = math.ceil(k) * w
        if x == lo and k == math.floor(k):
            c = x + w / 2
        out[c] += 1
    return dict(out)


@SETTINGS
@given(st.lists(st.integers(min_value=-5, max_value=60), min_size=1, max_size=40))
def test_histogram_matches_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "duration int")
    got = {r.bin: r.n for r in histogram(df, "duration", 2.0).collect()}
    assert got == _bins(values)


@SETTINGS
@given(st.lists(st.tuples(st.integers(-10**12, 10**12), st.integers(0, 10**6)), min_size=1, max_size=20))
def test_exact_ratio_matches_decimal(spark, pairs):
    df = spark.createDataFrame(pairs, "a long, b long")
    got = [r.q for r in df.select(exact_ratio("a", "b", 4).alias("q")).collect()]
    for (a, b), q in zip(pairs, got):
        if b == 0:
            assert q is None
            continue
        exp = (Decimal(abs(a)) / Decimal(b)).quantize(Decimal("0.0001"), rounding=ROUND_HALF_UP)
        assert q == float(exp if a >= 0 else -exp)


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.sampled_from("abcdef")), max_size=40))
def test_drop_all_duplicates_matches_counter(spark, keys):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, i int")
    counts = Counter(k for k in keys if k is not None)
    expected = sorted(i for i, k in enumerate(keys) if k is None or counts[k] == 1)
    assert sorted(r.i for r in drop_all_duplicates(df, ["k"]).collect()) == expected


@SETTINGS
@given(st.lists(st.integers(min_value=0, max_value=300), min_size=1, max_size=60))
def test_zscore_sql_form_matches_rule(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x int")
    mean = sum(values) / len(values)
    sd = math.sqrt(sum((v - mean) ** 2 for v in values) / len(values))
    got = sorted(r.i for r in drop_zscore(df, "x").collect())
    # Values whose |z| is within a rounding error of 3 are left out of the comparison.
    near = {i for i, v in enumerate(values) if sd > 0 and abs(abs((v - mean) / sd) - 3) < 1e-9}
    expected = sorted(i for i, v in enumerate(values) if sd == 0 or abs((v - mean) / sd) <= 3)
    assert [i for i in got if i not in near] == [i for i in expected if i not in near]


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["N1", "N2", "N3"]), st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))), min_size=1, max_size=40))
def test_conflict_audit_matches_rule(spark, rows):
    df = spark.createDataFrame(rows, "name string, id string")
    got = {r.name: (r.n_distinct_ids, r.most_popular_id, r.less_popular_id) for r in conflict_audit(df, "name", "id", "id").collect()}
    expected = {}
    for name in {n for n, _ in rows}:
        counts = Counter(i for n, i in rows if n == name)
        # Pair rows in key order, NULL first; which.max / which.min take the first.
        ordered = sorted(counts, key=lambda v: (v is not None, v or ""))
        if len(ordered) > 1:
            most = max(ordered, key=lambda v: counts[v])
            least = min(ordered, key=lambda v: counts[v])
            expected[name] = (len(ordered), most, least)
    assert got == expected


def _star(cx, cy, radii):
    n = len(radii)
    ring = [[cx + r * math.cos(2 * math.pi * i / n), cy + r * math.sin(2 * math.pi * i / n)] for i, r in enumerate(radii)]
    return ring + [ring[0]]


def _even_odd(px, py, polygon):
    inside = False
    for part in polygon:
        for ring in part:
            for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
                if (y1 > py) != (y2 > py) and px < x1 + (py - y1) * (x2 - x1) / (y2 - y1):
                    inside = not inside
    return inside


@SETTINGS
@given(
    st.lists(st.floats(min_value=0.5, max_value=3.0), min_size=3, max_size=12),
    st.lists(st.floats(min_value=0.5, max_value=3.0), min_size=3, max_size=12),
    st.sampled_from([1, 3, 8]),
    st.integers(min_value=0, max_value=10**6),
)
def test_within_join_matches_even_odd(spark, radii_a, radii_b, most, seed):
    from ridelens.operators.geo import within_join

    # Area 0: a concave star with a small hole; area 1: a two-part multipolygon.
    hole = _star(0.0, 0.0, [0.2] * 5)[::-1]
    polys = {0: [[_star(0.0, 0.0, radii_a), hole]], 1: [[_star(8.0, 0.0, radii_b)], [_star(8.0, 8.0, [1.0] * 4)]]}
    areas = spark.createDataFrame(
        [(k, f"a{k}", v) for k, v in polys.items()], "area_id long, community string, polygon array<array<array<array<double>>>>"
    )
    rnd = __import__("random").Random(seed)
    pts = [(i, rnd.uniform(-4, 12), rnd.uniform(-4, 10)) for i in range(200)]
    df = spark.createDataFrame(pts, "id int, lng double, lat double")
    got = sorted((r.id, r.area_id) for r in within_join(df, areas, max_edges=most).filter("area_id IS NOT NULL").collect())
    exp = sorted((i, k) for i, x, y in pts for k, poly in polys.items() if _even_odd(x, y, poly))
    assert got == exp


@SETTINGS
@given(
    st.lists(
        st.tuples(
            st.datetimes(min_value=__import__("datetime").datetime(2023, 1, 1), max_value=__import__("datetime").datetime(2026, 1, 1)),
            st.integers(min_value=-10**11, max_value=10**11),
        ),
        min_size=1,
        max_size=30,
    )
)
def test_minutes_and_seconds_truncate_like_timestampdiff(spark, spans):
    import datetime as dt

    from ridelens.functions.scalar import minutes_between, seconds_between

    rows = [(a, a + dt.timedelta(microseconds=us)) for a, us in spans]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    got = [(r.m, r.s) for r in df.select(minutes_between("a", "b").alias("m"), seconds_between("a", "b").alias("s")).collect()]
    for (a, b), (m, s) in zip(rows, got):
        us = (b - a) // dt.timedelta(microseconds=1)
        assert s == int(us / 10**6) if abs(us) < 2**52 else True
        assert s == (abs(us) // 10**6) * (1 if us >= 0 else -1)
        assert m == (abs(us) // (60 * 10**6)) * (1 if us >= 0 else -1)


@SETTINGS
@given(st.lists(st.integers(min_value=-10**6, max_value=10**6), min_size=1, max_size=40))
def test_to_minutes_rounding_rules(spark, seconds):
    from decimal import ROUND_HALF_UP, Decimal

    from ridelens.functions.scalar import to_minutes

    df = spark.createDataFrame([(s,) for s in seconds], "s int")
    got = [(r.e, r.u) for r in df.select(to_minutes("s", "half_even").alias("e"), to_minutes("s", "half_up").alias("u")).collect()]
    for s, (e, u) in zip(seconds, got):
        assert e == round(Decimal(s) / 60)  # Python rounds half to even
        assert u == float((Decimal(s) / 60).quantize(Decimal(1), rounding=ROUND_HALF_UP))


def _gt(a, b):
    return None if a is None or b is None else a > b


def _or(p, q):
    if p is True or q is True:
        return True
    if p is None or q is None:
        return None
    return False


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.one_of(st.none(), st.integers(0, 5))), max_size=40))
def test_delete_where_matches_three_valued_logic(spark, rows):
    from pyspark.sql import functions as F

    from ridelens.operators.predicates import delete_where

    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "i int, a int, b int")
    got = sorted(r.i for r in delete_where(df, F.col("a") > F.col("b"), F.col("a") == 3).collect())
    # DELETE WHERE a > b OR a = 3 keeps a row unless the predicate is TRUE.
    exp = sorted(i for i, (a, b) in enumerate(rows) if _or(_gt(a, b), None if a is None else a == 3) is not True)
    assert got == exp


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["N1", "N2", ""])), st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))), max_size=40))
def test_canonical_id_matches_update(spark, rows):
    from ridelens.operators.conform import canonical_id

    df = spark.createDataFrame([(n, v, i) for i, (n, v) in enumerate(rows)], "start_station_name string, start_station_id string, x int")
    got = {r.x: r.start_station_id for r in canonical_id(df).collect()}
    main = {}
    for n, v in rows:
        if n is not None and v is not None:
            main[n] = max(main.get(n, v), v)
    # UPDATE ... SET id = main WHERE id != main: NULL ids, NULL names and
    # names without a non-NULL id keep their value.
    exp = {i: (main[n] if (n in main and v is not None and v != main[n]) else v) for i, (n, v) in enumerate(rows)}
    assert got == exp
