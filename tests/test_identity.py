"""Station identity over chains of names and ids."""

import random

from conftest import plan_of, rows
from ridelens.operators.identity import connected_components, station_identity, unify_stations

SCHEMA = "ride int, start_station_name string, start_station_id string, end_station_name string, end_station_id string"


def trips(spark, stops):
    """Two stops a trip, in turn."""
    both = stops if len(stops) % 2 == 0 else [*stops, (None, None)]
    data = [(i, *both[2 * i], *both[2 * i + 1]) for i in range(len(both) // 2)]
    return spark.createDataFrame(data, SCHEMA)


def plain_components(edges):
    label = {}
    for a, b in edges:
        label.setdefault(a, a)
        label.setdefault(b, b)
    again = True
    while again:
        again = False
        for a, b in edges:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                again = True
    return label


def test_components_of_chains_hubs_and_random_graphs(spark):
    rng = random.Random(7)
    chain = [(f"c{i:04d}", f"c{i + 1:04d}") for i in range(300)]
    rng.shuffle(chain)
    hub = [("m", f"h{i}") for i in range(200)] + [(f"h{i}", "z") for i in range(100)]
    loose = [(f"r{rng.randrange(80):02d}", f"r{rng.randrange(80):02d}") for _ in range(55)]
    edges = chain + hub + loose + [("x", "x"), ("x", "x"), ("y", None), (None, None)]
    got = dict(rows(connected_components(spark.createDataFrame(edges, "a string, b string"), "a", "b"), "vertex", "component"))
    assert got == plain_components([e for e in edges if None not in e])
    assert connected_components(spark.createDataFrame([], "a string, b string"), "a", "b").count() == 0


def test_chain_that_one_rewrite_cannot_settle(spark):
    # A-1, A-2, B-2, B-3, C-3: one station; D-9 another; blanks link nothing
    stops = [("A", "1")] * 2 + [("A", "2")] + [("B", "2")] * 4 + [("B", "3")] + [("C", "3")] + [("D", "9")]
    stops += [("", "1"), ("", "9"), (None, "3"), ("D", None), ("E", None), ("", ""), (None, "77")]
    got = {r.component: r for r in station_identity(trips(spark, stops)).collect()}
    assert set(got) == {"1", "9"}
    one = got["1"]
    assert (one.canonical_id, one.canonical_name, one.n_ids, one.n_names, one.n_trips) == ("2", "B", 3, 3, 9)
    fixed = unify_stations(trips(spark, stops))
    assert fixed.columns == trips(spark, stops).columns
    seen = [p for r in fixed.collect() for p in ((r.start_station_name, r.start_station_id), (r.end_station_name, r.end_station_id))]
    key = lambda p: (p[0] or "~", p[1] or "~")
    want = [("B", "2")] * 11 + [("D", "9")] * 3 + [("E", None), ("", ""), (None, "77"), (None, None)]
    assert sorted(seen, key=key) == sorted(want, key=key)


def test_excluded_names_link_but_are_canonical_only_alone(spark):
    stops = [("Public Rack - A", "1")] * 5 + [("A", "1")] + [("Public Rack - Z", "5")]
    got = {r.component: r.canonical_name for r in station_identity(trips(spark, stops), exclude=["Public Rack%"]).collect()}
    assert got == {"1": "A", "5": "Public Rack - Z"}


def test_ties_go_to_the_smaller_value_and_empty_input(spark):
    got = station_identity(trips(spark, [("B", "2"), ("A", "2"), ("A", "1"), ("B", "1")])).collect()
    assert [(r.canonical_id, r.canonical_name) for r in got] == [("1", "A")]
    assert station_identity(trips(spark, [])).count() == 0
    assert unify_stations(trips(spark, [("", None), (None, "")])).count() == 1


def test_hot_station_is_not_shuffled_whole(spark):
    stops = [("A", "1")] * 3000 + [(f"S{i % 40}", f"{i % 55}") for i in range(600)]
    plan = plan_of(unify_stations(trips(spark, stops)))
    assert "Window" not in plan and "BroadcastHashJoin" in plan
