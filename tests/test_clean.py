"""Duplicate keys, audits and the ledger (J1, J2, J11, A1, A2, A25, C1 vs C4 order)."""

from pyspark.sql import functions as F

from ridelens.operators.clean import cleaning_ledger, drop_all_duplicates, duplicate_keys, keep_in, null_audit


def test_drop_all_copies_and_keep_null_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], "k string, v int")
    out = sorted(r.v for r in drop_all_duplicates(df, ["k"]).collect())
    # Every copy of 'a' goes; NULL keys stay, as DELETE ... IN keeps them (T4).
    assert out == [3, 4, 5]
    one = drop_all_duplicates(df, ["k"], keep="one")
    assert one.filter(F.col("k") == "a").count() == 1


def test_drop_all_duplicates_is_idempotent(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), ("c",), ("c",)], "k string")
    once = drop_all_duplicates(df, ["k"])
    twice = drop_all_duplicates(once, ["k"])
    assert sorted(r.k for r in once.collect()) == sorted(r.k for r in twice.collect()) == ["b"]


def test_collation_option(spark):
    df = spark.createDataFrame([("Clark St",), ("CLARK ST",), ("Other",)], "k string")
    binary = drop_all_duplicates(df, ["k"])
    ci = drop_all_duplicates(df, ["k"], collation="UTF8_LCASE")
    assert binary.count() == 3
    assert [r.k for r in ci.collect()] == ["Other"]


def test_keep_in_and_duplicate_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    dups = duplicate_keys(df, ["k"])
    assert [(r.k, r.n_rows) for r in dups.collect()] == [("a", 2)]
    assert sorted(r.v for r in keep_in(df, dups, ["k"]).collect()) == [1, 2]


def test_null_audit_counts_and_empty(spark):
    df = spark.createDataFrame([(None, 1), ("x", None), (None, None)], "a string, b int")
    r = null_audit(df, ["a", "b"]).collect()[0]
    assert (r.a_nulls, r.b_nulls) == (2, 2)
    empty = null_audit(df.limit(0), ["a", "b"]).collect()[0]
    assert empty.a_nulls is None  # SUM over no rows is NULL


def test_ledger_balances(spark):
    df = spark.range(100)
    a = df.filter("id % 2 = 0")
    b = a.filter("id > 10")
    led = cleaning_ledger([("load", df), ("even", a), ("gt10", b)]).orderBy("step_no").collect()
    assert [r.rows_out for r in led] == [100, 50, 44]
    assert [r.removed for r in led] == [None, 50, 6]
    for r in led[1:]:
        assert r.rows_in - r.removed == r.rows_out


def test_clean_then_dedup_order_matters(spark):
    # 'k' has two copies, one of which is cleaned away first: C1 keeps the
    # survivor; C4 (dedup first) removes both.
    df = spark.createDataFrame([("k", 1), ("k", None), ("j", 2)], "ride_id string, x int")
    c1 = drop_all_duplicates(df.dropna(subset=["x"]), ["ride_id"])
    c4 = drop_all_duplicates(df, ["ride_id"]).dropna(subset=["x"])
    assert sorted(r.ride_id for r in c1.collect()) == ["j", "k"]
    assert sorted(r.ride_id for r in c4.collect()) == ["j"]


def test_salted_anti_join_equals_plain(spark):
    # One key holds a third of the rows and is duplicated; the salted plan
    # removes exactly the same rows.
    rows = [("hot", i) for i in range(300)] + [(f"k{i}", i) for i in range(600)] + [("dup", 1), ("dup", 2), (None, 3)]
    df = spark.createDataFrame(rows, "k string, v int")
    plain = sorted((r.k or "", r.v) for r in drop_all_duplicates(df, ["k"]).collect())
    salted = sorted((r.k or "", r.v) for r in drop_all_duplicates(df, ["k"], salt_buckets=8).collect())
    assert plain == salted and len(plain) == 601


def test_keep_one_keeps_rows_without_a_key(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1), ("a", 1), ("b", 3)], "k string, v int")
    one = drop_all_duplicates(df, ["k"], keep="one")
    assert sorted((r.k or "", r.v) for r in one.collect()) == [("", 1), ("", 2), ("a", 1), ("b", 3)]
    none = drop_all_duplicates(df, ["k"])
    assert sorted((r.k or "", r.v) for r in none.collect()) == [("", 1), ("", 2), ("b", 3)]
