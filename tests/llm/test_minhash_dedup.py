import random
import re

import pytest
from pyspark.sql import functions as F

from ridelens.llm.components import connected_components
from ridelens.llm.minhash_dedup import BLOCK, _open_members, keep_one, near_duplicates, shingle_sets

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(docs):
    """doc_id -> (n_shingles, component) by comparing all pairs."""
    sets = []
    for _, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    root = {d: d for d, _ in docs}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, _) in enumerate(docs):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                x, y = sorted((top(a), top(docs[j][0])))
                root[y] = x
    return {d: (len(s), top(d)) for (d, _), s in zip(docs, sets)}


def corpus(seed, groups=6, copies=14):
    """Texts in groups of copies with more and more words changed."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    docs = []
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.choice([4, 12, 60, 150]))]
        for k in range(copies):
            own = list(base)
            for _ in range(k // 2):
                own[rng.randrange(len(own))] = rng.choice(words)
            docs.append((len(docs) * 3, (" \t\n"[k % 3]).join(w.upper() if k % 2 else w for w in own)))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_all_pairs(spark, seed):
    docs = corpus(seed)
    want = brute_force(docs)
    got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_edge_cases(spark):
    rows = [(1, None, 0), (2, "", 0), (3, " \n", 0), (None, "a b c d e f", 0), (5, "a b c d e f", 0), (6, "A b\tc d e f", 0),
            (6, "A b\tc d e f", 0), (7, "x", 0), (8, "X", 0), (9, "x y " * 40_000, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs).collect()}
    assert got == {(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (None, 2, None, True), (5, 2, 5, True), (6, 2, 5, False),
                   (7, 1, 7, True), (8, 1, 7, False), (9, 2, 9, True)}
    kept = sorted((r.doc_id for r in keep_one(docs).collect()), key=lambda x: (x is not None, x))
    assert kept == [None, 1, 2, 3, 5, 7, 9]
    assert keep_one(docs).columns == docs.columns
    assert near_duplicates(docs.limit(0)).count() == 0


def test_one_id_with_two_texts_is_one_node(spark):
    a, b = "a b c d e f g", "q r s t u v w"
    docs = spark.createDataFrame([(1, a), (2, a), (2, b), (3, b)], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_duplicates(docs).collect()} == {1: 1, 2: 1, 3: 1}


def test_components_of_a_path_a_star_and_nothing(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 130)]
    got = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 130)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_large_buckets_are_dealt_into_blocks_of_all_chunk_pairs(spark):
    n = 2 * BLOCK + 10
    members = spark.range(n).select(F.lit(7).cast("long").alias("key"), F.col("id").alias("node"))
    none = spark.createDataFrame([], "node long, component long")
    blocks = _open_members(members, none).groupBy("block").agg(F.collect_set("side").alias("sides"), F.count("*").alias("n")).collect()
    assert len(blocks) == 6 and {tuple(sorted(r.sides)) for r in blocks} == {(2,), (0, 1)}
    assert max(r.n for r in blocks) < 2.5 * BLOCK


def test_shingle_sets_count_distinct_shingles():
    import pyarrow as pa

    _, at = shingle_sets(pa.array(["a b c d e f", "a a a a a a a", None, "one two"]))
    assert [int(x) for x in at] == [0, 2, 3, 3, 4]


def test_regular_words_with_swapped_letters_are_different(spark):
    """Words that share every polynomial hash modulo 2^64 are no copies."""
    word = lambda n, a, b: "".join(b if bin(i).count("1") % 2 else a for i in range(n))
    values = [word(n, *ab) for n in (1024, 4096) for ab in ("ab", "ba")]
    values += [values[0], " ".join([*"vwxyz", values[0]] * 3), " ".join([*"vwxyz", values[1]] * 3)]
    rows = spark.createDataFrame(list(enumerate(values)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_duplicates(rows).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 3, 4: 0, 5: 5, 6: 6}
