import hashlib
import random

import numpy as np

from ridelens.llm.digest import WINDOW, equal_pairs, fingerprint_documents, likeness


def test_equal_pairs_match_a_count_by_hand():
    data = np.array([random.Random(1).randrange(4) for _ in range(70)], np.uint8)
    want = [sum(w[i] == w[j] for j in range(WINDOW) for i in range(j)) for w in (data[k : k + WINDOW] for k in range(55))]
    assert equal_pairs(data).tolist() == want
    assert len(equal_pairs(data[:5])) == 0


def test_rows_follow_each_other_and_likeness_tells(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijklmnopqrsté") for _ in range(rng.randint(2, 9))) for _ in range(900)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([20, 200, 2000]))) for _ in range(40)]
    texts[11] = texts[5]
    docs = spark.createDataFrame([(i * 7, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, fingerprint string").repartition(6)
    got = sorted(fingerprint_documents(docs).collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in got] == [i * 7 for i in range(40)]
    for i, r in enumerate(got):
        cut = len(texts[i]) // 4
        edited = texts[i][: len(texts[i]) - cut] + texts[(i + 1) % 40][:cut]
        assert (r.n_chars, r.edited_sha256) == (len(texts[i]), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited > 0.5 and r.near_next < 0.25
    assert got[11].fingerprint == got[5].fingerprint and got[11].fingerprint != got[4].fingerprint


def test_edge_cases(spark):
    rows = [(None, None), (1, ""), (2, "aaaa" * 100), (3, "abc"), (3, "abd"), (9, "x" * 200_000 + " y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = fingerprint_documents(docs).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.n_chars): r for r in got}
    assert by[None, 0].fingerprint == by[1, 0].fingerprint == "" and by[None, 0].near_next == 1 and by[1, 0].near_next == 0
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    alone = fingerprint_documents(docs.where("doc_id = 2")).collect()
    assert alone[0].near_next == 1
    assert fingerprint_documents(docs.limit(0)).count() == 0


def test_likeness_bounds():
    none, some = np.empty((0, 256), np.uint8), np.full((1, 256), 3, np.uint8)
    assert likeness(none, none) == likeness(some, some) == 1 and likeness(none, some) == 0
