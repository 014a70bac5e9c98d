import random
import tracemalloc
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from ridelens.llm import quality
from ridelens.llm.mixing import fit, labelled_domains, mix, rates, resample
from ridelens.llm.quality import keep_good, score_documents

GOOD, MARKS = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa"], ["***", "%%%", "$$$"]


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(400):
        bad, toxic = i % 5 == 0, i % 7 == 0
        words = [rng.choice(GOOD) + (rng.choice(MARKS) if bad else "") for _ in range(rng.randint(8, 40))]
        if toxic:
            words[0] = words[-1] = "vile"
        docs.append((i, " ".join(words), "en", "src0", 1, "x"))
        if i < 300:
            labels.append((i, int(not bad), int(toxic)))
    docs += [(None, None, None, None, None, None), (1000, "", "en", "s", 0, "x"), (1001, "*** " * 30_000, "en", "s", 0, "x"), docs[3]]
    labels += [(None, 1, 0), (2, None, None)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, score string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_held_out_rows_are_told_apart(tables):
    docs, labels = tables
    got = score_documents(docs, labels).collect()
    assert len(got) == docs.count()
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [r for r in got if r.held_out and r.doc_id < 400]
    assert len(held) > 40 and all(r.predicted == int(r.doc_id % 5 != 0) for r in held)
    assert len({r.score for r in got if r.doc_id == 3}) == 1


def test_a_bounded_sample_trains_as_well(tables):
    docs, labels = tables
    held = [r for r in score_documents(docs, labels, max_rows=120).collect() if r.held_out and r.doc_id < 400]
    assert sum(r.predicted == int(r.doc_id % 5 != 0) for r in held) >= 0.95 * len(held)


def test_no_labels_and_no_documents(tables):
    docs, labels = tables
    assert {r.score for r in score_documents(docs, labels.limit(0)).collect()} == {0.5}
    assert score_documents(docs.limit(0), labels).count() == 0


def test_the_filter_keeps_columns_and_good_documents(tables):
    docs, labels = tables
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect() if r.doc_id is not None and r.doc_id < 400]
    assert set(ids) == {i for i in range(400) if i % 5}


def test_expected_tokens_match_the_targets(tables):
    docs, labels = tables
    targets = {"clean": 0.8, "noisy": 0.1, "toxic": 0.1}
    got = mix(docs, labelled_domains(labels), targets).collect()
    assert len(got) == docs.count()
    total = sum(r.n_tokens for r in got)
    for name, weight in targets.items():
        assert abs(sum(r.rate * r.n_tokens * r[f"p_{name}"] for r in got) / total - weight) < 2e-3
    assert all(r.rate >= 0 and r.copies in (int(r.rate), int(r.rate) + 1) for r in got)
    assert all(abs(r.p_clean + r.p_noisy + r.p_toxic - 1) < 1e-9 for r in got)
    twice = [r for r in got if r.doc_id == 3]
    assert len(twice) == 2 and twice[0] == twice[1]


def test_mixing_without_labels_or_rows(tables):
    docs, labels = tables
    none = labelled_domains(labels).limit(0)
    assert all(abs(r.p_clean - 0.5) < 1e-9 for r in mix(docs, none, {"clean": 1.0, "noisy": 1.0}).collect())
    assert mix(docs.limit(0), labelled_domains(labels)).count() == 0
    assert {r.rate for r in mix(docs.where("text = ''"), labelled_domains(labels)).collect()} == {1.0}


def test_resampling_repeats_rows_as_their_copies_say(tables):
    docs, labels = tables
    targets = {"clean": 0.9, "noisy": 0.05, "toxic": 0.05}
    copies = {}
    for r in mix(docs, labelled_domains(labels), targets).collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + r.copies
    out = resample(docs, labelled_domains(labels), targets)
    assert out.columns == docs.columns
    got = {}
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {k: v for k, v in copies.items() if v}


def plain_totals(t, p, target, rounds=200_000):
    """Shares of the domains after plain projected gradients on the squared
    distance, with momentum, until they stand still."""
    total, r = t.sum(), np.ones(len(t))
    a = p * t / total
    step = 1.0 / np.linalg.eigvalsh(a @ a.T)[-1]
    y, k = r, 1.0
    for _ in range(rounds):
        after = np.maximum(0.0, y - step * ((a @ y - target) @ a))
        grown = (1 + np.sqrt(1 + 4 * k * k)) / 2
        y, k = after + (k - 1) / grown * (after - r), grown
        if np.abs(after - r).max() < 1e-13:
            break
        r = after
    return a @ r


@pytest.mark.parametrize("target", [[0.7, 0.2, 0.1], [0.02, 0.08, 0.9], [0.0, 1.0, 0.0], [0.34, 0.33, 0.33]])
def test_the_fit_is_plain_least_squares_whether_targets_can_be_met_or_not(spark, target):
    rng = np.random.Generator(np.random.PCG64(6))
    p = rng.dirichlet([6, 3, 2], 120).T
    t = rng.integers(1, 50, 120).astype(float)
    t[:5] = 0
    rows = [(int(n), *map(float, x)) for n, x in zip(t, p.T)]
    table = spark.createDataFrame(rows, "n_tokens long, p0 double, p1 double, p2 double")
    got = fit(table, target)
    r = rates(p, got.steps)
    shares = p @ (r * t) / t.sum()
    assert (r >= 0).all() and got.converged
    assert np.abs(shares - plain_totals(t, p, np.array(target))).max() < 1e-6
    assert abs(got.residual - np.abs(shares - np.array(target)).max()) < 1e-9


def test_targets_out_of_reach_are_reported(spark):
    docs = spark.createDataFrame([(i, "vile" if i % 100 == 0 else "kind") for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 100 == 0)) for i in range(400)], "doc_id long, quality int, toxic int")
    got = mix(docs, labelled_domains(labels), {"clean": 0.01, "toxic": 0.99}).collect()
    p = np.array([[r.p_clean, r.p_toxic] for r in got]).T
    shares = p @ np.array([r.rate for r in got]) / 400
    assert np.abs(shares - plain_totals(np.ones(400), p, np.array([0.01, 0.99]))).max() < 1e-5
    assert {(r.converged, round(r.residual, 9)) for r in got} == {(True, round(float(np.abs(shares - [0.01, 0.99]).max()), 9))}
    assert got[0].residual > 0.05


def test_one_labelled_row_a_hot_row_and_no_known_label(spark, tables):
    docs, labels = tables
    schema = "doc_id long, quality int, toxic int"
    one = spark.createDataFrame([(1, 1, 0)], schema)
    assert {r.score > 0.5 for r in score_documents(docs.where("doc_id = 1"), one).collect()} == {True}
    unknown = spark.createDataFrame([(1, None, None), (2, None, 0)], schema)
    assert {r.score for r in score_documents(docs, unknown).collect()} == {0.5}
    hot = docs.unionByName(docs.where("doc_id = 1").crossJoin(spark.range(300)).drop("id"))
    texts = hot.selectExpr("doc_id", "text")
    repeated = labels.unionByName(labels.where("doc_id = 1")).unionByName(labels.where("doc_id = 1"))
    rows = quality.labelled_rows(texts, repeated).count()
    assert rows == quality.labelled_rows(docs.selectExpr("doc_id", "text"), labels).count()


def plain_ftrl(rows, labels, alpha, beta, l1, l2, epochs):
    """Follow the regularised leader, one weight at a time."""
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        sign = 1.0 if z[i] > 0 else -1.0
        return -(z[i] - sign * l1) / ((beta + n[i] ** 0.5) / alpha + l2)

    for _ in range(epochs):
        for x, y in zip(rows, labels):
            w = {i: weight(i) for i in x}
            p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - y) * v
                z[i] = z.get(i, 0.0) + g - ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / alpha * w[i]
                n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z}


def test_training_is_plain_ftrl():
    rng = random.Random(3)
    rows = [{i: rng.random() for i in rng.sample(range(40), 6)} for _ in range(800)]
    labels = [int(sum(v for i, v in x.items() if i < 20) > 1.5) for x in rows]
    at = np.array([k for k, x in enumerate(rows) for _ in x])
    slots = np.array([i for x in rows for i in x])
    values = np.array([v for x in rows for v in x.values()])
    weights, bias = quality.ftrl(at, slots, values, np.array(labels, float))
    want = plain_ftrl([{**x, "bias": 1.0} for x in rows], labels, quality.ALPHA, quality.BETA, quality.L1, quality.L2, 3)
    assert abs(bias - want["bias"]) < 1e-9
    assert all(abs(weights[i] - want[i]) < 1e-9 for i in range(40))


def test_word_pairs_tell_what_words_alone_do_not(spark):
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(500):
        good = i % 2
        pairs = [("red", "fox"), ("old", "dog")] if good else [("red", "dog"), ("old", "fox")]
        docs.append((i, " ".join(w for _ in range(12) for w in rng.choice(pairs))))
        labels.append((i, good, 0))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    held = [r for r in score_documents(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect() if r.held_out]
    good, bad = ([r.score for r in held if r.doc_id % 2 == k] for k in (1, 0))
    assert sum(g > b for g in good for b in bad) >= 0.95 * len(good) * len(bad)


def test_features_of_many_texts_are_held_once():
    rng = np.random.Generator(np.random.PCG64(3))
    texts = pd.Series([" ".join(map(str, rng.integers(0, 10**6, 300))) for _ in range(1500)])
    quality.features_of(texts)  # fills the tables of powers
    tracemalloc.start()
    rows, slots, values = quality.features_of(texts)
    now, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert now < 17 * len(rows) + 1e6 and peak < 2 * 16 * len(rows) + 10e6
    whole = quality.features(pa.array(texts))
    assert all(np.array_equal(a, b) for a, b in zip((rows, slots, values), whole))
