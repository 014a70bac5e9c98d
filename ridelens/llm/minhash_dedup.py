"""Near-duplicate detection with b-bit MinHash.

Method: one pass over the texts gives each document its set of five-word
shingles, 128 minima, 32 band keys of four minima each, and a packed signature
of the two low bits of each minimum. Documents that share a band key are
candidates; the bit counts of their signatures, corrected for chance
collisions, estimate the similarity and drop the clear misses; the rest are
confirmed on the full shingle sets.

Documents with equal sets are one node, so copies cost nothing after the first
pass. Candidates come in rounds, so that a large bucket never yields all its
pairs. First each member meets its bucket's smallest and largest id, and the
links found are joined to components. Buckets that still hold several
components are open: their members get a finer signature, the low bit of 2,048
minima, and each member outside its bucket's main component is compared by bit
counts with the members of other components; its nearest goes to the exact
check, round after round while that joins components, and at last every pair
left above the floor. Every pair of a bucket is thus either compared or already
connected. A large bucket is compared in blocks of ``BLOCK`` members by
different tasks; a pair comes out once, in the first band that it shares.

Edge cases: null, empty or wordless text has no shingles (n_shingles 0), links
with nothing and stays; a null doc_id takes no part, has a null component and
stays; rows with the same doc_id are one node, and each keeps its own
n_shingles; other columns of the input are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelens.llm.components import connected_components
from ridelens.llm.hashing import mix64, rows_of, runs, word_hashes
from ridelens.llm.shared import id_and_text, long_array, materialise, pieces, text_buffer

SHINGLE = 5
#: Link at 100 * intersection >= PERCENT * union.
PERCENT = 75
BANDS, ROWS, BITS = 32, 4, 2
PERMUTATIONS = BANDS * ROWS
#: Estimates below this are dropped without a look at the sets: more than five
#: standard deviations (0.046 at 128 minima of two bits) below 0.75.
ESTIMATE_FLOOR = 0.5
#: Minima of the finer signature, one bit each, and its floor: four standard
#: deviations (0.0146) below 0.75.
FINE, FINE_FLOOR = 2048, 0.69
#: Members of an open bucket that one task compares with as many others.
BLOCK = 4096
#: Ids of candidate documents are broadcast to filter the text scan up to this
#: many (8 bytes each); beyond it the scan is joined by shuffle.
BROADCAST_IDS = 1_000_000

_WORD = np.ones(256, bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_rng = np.random.Generator(np.random.PCG64(20240501))
_XOR = _rng.integers(0, 1 << 64, PERMUTATIONS, np.uint64)
_MUL = _rng.integers(0, 1 << 64, PERMUTATIONS, np.uint64) | np.uint64(1)

_FINE_XOR = _rng.integers(0, 1 << 64, FINE, np.uint64)
_FINE_MUL = _rng.integers(0, 1 << 64, FINE, np.uint64) | np.uint64(1)

_SIGNATURE = "doc_id long, n_shingles long, set_a long, set_b long, s0 long, s1 long, s2 long, s3 long, bands array<long>"


def shingle_sets(column) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, sorted within it, end to end,
    and their n + 1 offsets. Fewer than five words are one shingle."""
    data, offsets = text_buffer(column)
    data = _LOWER[data]
    starts, ends = runs(_WORD[data], offsets)
    words = word_hashes(data, starts, ends)
    at = rows_of(starts, offsets)
    n_words = np.diff(at)
    full = np.zeros(max(0, len(words) - SHINGLE + 1), np.uint64)
    for j in range(SHINGLE):
        full = full * np.uint64(0x9E3779B97F4A7C15) + words[j : j + len(full)]
    full = mix64(full)
    sets, sizes = [], np.zeros(len(n_words), np.int64)
    for i in np.flatnonzero(n_words):
        a, n = at[i], int(n_words[i])
        if n >= SHINGLE:
            own = np.unique(full[a : a + n - SHINGLE + 1])
        else:
            own = np.full(1, n, np.uint64)
            for j in range(n):
                own = own * np.uint64(0xC2B2AE3D27D4EB4F) + words[a + j : a + j + 1]
            own = mix64(own)
        sets.append(own)
        sizes[i] = len(own)
    return (np.concatenate(sets) if sets else np.empty(0, np.uint64)), np.concatenate([[0], np.cumsum(sizes)])


def _minima(shingles: np.ndarray, starts: np.ndarray, xor: np.ndarray = _XOR, mul: np.ndarray = _MUL) -> np.ndarray:
    """The minimum under each permutation, per set; all sets have members."""
    out = np.empty((len(xor), len(starts)), np.uint64)
    # sets in groups of about 64k shingles keep the working array in cache
    cuts = [*np.unique(starts >> 16, return_index=True)[1], len(starts)]
    for a, b in zip(cuts, cuts[1:]):
        own = shingles[starts[a] : starts[b] if b < len(starts) else len(shingles)]
        work, at = np.empty(len(own), np.uint64), starts[a:b] - starts[a]
        for i in range(len(xor)):
            np.bitwise_xor(own, xor[i], out=work)
            np.multiply(work, mul[i], out=work)
            np.minimum.reduceat(work, at, out=out[i, a:b])
    return out


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _SIGNATURE.split(", ")]
    for batch in pieces(batches):
        shingles, offsets = shingle_sets(batch.column("text"))
        sizes = np.diff(offsets)
        some = np.flatnonzero(sizes)
        mins = np.zeros((PERMUTATIONS, len(some)), np.uint64)
        sums = np.zeros((2, len(sizes)), np.uint64)
        if len(some):
            at = offsets[:-1][some]
            mins = _minima(shingles, at)
            sums[0, some] = np.add.reduceat(mix64(shingles), at)
            sums[1, some] = np.add.reduceat(mix64(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)), at)
        mixed = mix64(mins)
        low = mixed & np.uint64((1 << BITS) - 1)
        per = 64 // BITS
        signature = np.zeros((PERMUTATIONS // per, len(sizes)), np.uint64)
        for i in range(PERMUTATIONS):
            signature[i // per, some] |= low[i] << np.uint64(BITS * (i % per))
        keys = np.zeros((BANDS, len(some)), np.uint64)
        for i in range(PERMUTATIONS):
            band = i // ROWS
            keys[band] = mix64(keys[band] * np.uint64(31) + mixed[i] + np.uint64(band + 1))
        filled = np.zeros(len(sizes), np.int64)
        filled[some] = BANDS
        bands = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(filled)]).astype(np.int32)), long_array(np.ascontiguousarray(keys.T).ravel())
        )
        columns = [batch.column("doc_id"), long_array(sizes), long_array(sums[0]), long_array(sums[1])]
        yield pa.RecordBatch.from_arrays([*columns, *(long_array(s) for s in signature), bands], names=names)


def _fine_signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, limit=1 << 20):
        shingles, offsets = shingle_sets(batch.column("text"))
        some = np.flatnonzero(np.diff(offsets))
        if len(some):
            low = (mix64(_minima(shingles, offsets[:-1][some], _FINE_XOR, _FINE_MUL)) & np.uint64(1)).astype(np.uint8)
            packed = np.packbits(low, axis=0).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(some)), pa.array([row.tobytes() for row in packed], pa.binary())],
                names=["node", "fine"],
            )


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one (key, block) after another; they arrive in that order."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        key, block = table["key"].to_numpy(), table["block"].to_numpy()
        cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1])) + 1), table.num_rows]
        if held and (held[-1]["key"][-1].as_py(), held[-1]["block"][-1].as_py()) != (int(key[0]), int(block[0])):
            yield pa.concat_tables(held)
            held = []
        for a, b in zip(cuts, cuts[1:-1]):
            yield pa.concat_tables([*held, table.slice(a, b - a)])
            held = []
        held.append(table.slice(cuts[-2]))
    if held:
        yield pa.concat_tables(held)


def _compare(table: pa.Table, best: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of members of different components whose finer signatures agree:
    for each member outside the main component its nearest, or all."""
    node, component, size, side = (table[c].to_numpy() for c in ("node", "component", "n_shingles", "side"))
    bands = np.stack(table["bands"].to_numpy())
    fine = np.frombuffer(b"".join(table["fine"].to_pylist()), np.uint64).reshape(len(node), -1)
    own_band = int(np.flatnonzero(bands[0] == table["key"][0].as_py())[0])
    for i in np.flatnonzero(~table["in_main"].to_numpy(zero_copy_only=False)):
        # blocks of two different chunks compare one with the other only
        other = np.flatnonzero((component != component[i]) & ((side != side[i]) | (side == 2)))
        small, large = np.minimum(size[other], size[i]), np.maximum(size[other], size[i])
        other = other[100 * small >= PERCENT * large]
        if own_band and len(other):
            other = other[~(bands[other, :own_band] == bands[i, :own_band]).any(axis=1)]
        if not len(other):
            continue
        agree = 1.0 - np.bitwise_count(fine[other] ^ fine[i]).sum(axis=1, dtype=np.int64) / FINE
        similar = 2.0 * agree - 1.0  # less the half that agrees by chance
        found = similar >= FINE_FLOOR
        if best and found.any():
            other = other[[int(np.argmax(similar))]]
        else:
            other = other[found]
        yield np.minimum(node[other], node[i]), np.maximum(node[other], node[i])


def _across(best: bool):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _blocks(batches):
            found = list(_compare(table, best))
            if found:
                pairs = np.unique(np.concatenate([np.stack(x, axis=1) for x in found]), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return compare


def _similar(n_a, n_b):
    """Equal sizes within the threshold: the intersection is at most the
    smaller set, the union at least the larger."""
    return F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * PERCENT


def estimate(a: str, b: str):
    """Similarity of the packed signatures of rows ``a`` and ``b``: the share
    of equal two-bit fields, less the quarter that agree by chance."""
    differing = F.lit(0)
    for i in range(PERMUTATIONS * BITS // 64):
        x = F.col(f"{a}.s{i}").bitwiseXOR(F.col(f"{b}.s{i}"))
        odd = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555))
        differing = differing + F.bit_count(odd)
    chance = 1.0 / (1 << BITS)
    return (1.0 - differing / F.lit(PERMUTATIONS) - chance) / (1.0 - chance)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text_a"):
        sets_a, at_a = shingle_sets(batch.column("text_a"))
        sets_b, at_b = shingle_sets(batch.column("text_b"))
        keep = np.zeros(batch.num_rows, bool)
        for i in range(batch.num_rows):
            a, b = sets_a[at_a[i] : at_a[i + 1]], sets_b[at_b[i] : at_b[i + 1]]
            if not len(a) or not len(b):
                continue
            spot = np.searchsorted(b, a)
            both = int(np.count_nonzero(b[np.minimum(spot, len(b) - 1)] == a))
            keep[i] = 100 * both >= PERCENT * (len(a) + len(b) - both)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))


def confirm(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of ids whose full shingle sets reach the threshold."""
    ids = materialise(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "candidate-ids")
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    texts = docs.join(ids, "doc_id", "left_semi")
    both = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b"
    )
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_confirm, "a long, b long").distinct()


def link(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, links) of a table with doc_id and text. documents: doc_id,
    n_shingles and node (the smallest doc_id with the same set); links: pairs
    a < b of nodes that reach the threshold, enough of them to connect all
    that are connected."""
    table = materialise(docs.mapInArrow(_signatures, _SIGNATURE), "signatures")
    key = ["n_shingles", "set_a", "set_b"]
    live = table.where("n_shingles > 0 AND doc_id IS NOT NULL")
    sets = materialise(live.groupBy(*key).agg(F.min("doc_id").alias("node"), F.count("*").alias("copies")), "sets")
    plain = table.select("doc_id", *key)
    # only sets that occur more than once need a lookup of their node
    shared = plain.join(sets.where("copies > 1").drop("copies"), key, "left")
    documents = materialise(
        shared.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("node", "doc_id")).alias("node")),
        "documents",
    )
    nodes = live.join(sets.select(*key, F.col("node").alias("doc_id")), [*key, "doc_id"], "left_semi")
    nodes = materialise(nodes.withColumnRenamed("doc_id", "node"), "nodes")
    # rows of one doc_id with different texts are one document
    own = documents.where("node IS NOT NULL").select("doc_id", "node").distinct()
    first = own.groupBy("doc_id").agg(F.min("node").alias("a"), F.count("*").alias("n")).where("n > 1")
    same = own.join(first, "doc_id").where("a <> node").select("a", F.col("node").alias("b"))

    in_band = nodes.select("node", F.explode("bands").alias("key"))
    buckets = in_band.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    members = materialise(in_band.join(materialise(buckets, "buckets"), "key").select("key", "node", "low", "high"), "members")
    packed = nodes.select("node", "n_shingles", "s0", "s1", "s2", "s3")

    def likely(pairs: DataFrame) -> DataFrame:
        x, y = packed.alias("x"), packed.alias("y")
        scored = pairs.join(x, F.col("a") == F.col("x.node")).join(y, F.col("b") == F.col("y.node"))
        scored = scored.where(_similar(F.col("x.n_shingles"), F.col("y.n_shingles")))
        return scored.select("a", "b", estimate("x", "y").alias("estimate")).where(F.col("estimate") >= ESTIMATE_FLOOR)

    hubs = members.select("node", F.explode(F.array("low", "high")).alias("hub")).where("node <> hub")
    hubs = hubs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    near = materialise(likely(materialise(hubs, "hub-pairs")).union(same.select("a", "b", F.lit(1.0))), "likely")
    best = materialise(near.groupBy("b").agg(F.max_by("a", "estimate").alias("a")).select("a", "b"), "best")
    links = materialise(confirm(best, docs).union(same), "links")

    component = connected_components(links)
    fine = None
    tried = best
    while True:
        open_ = materialise(_open_members(members, component), "open-members")
        if open_.isEmpty():
            return documents, links
        if fine is None:  # later rounds have no other members
            ids = materialise(open_.select(F.col("node").alias("doc_id")).distinct(), "open-ids")
            texts = docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", "left_semi")
            fine = texts.mapInArrow(_fine_signatures, "node long, fine binary")
            fine = materialise(fine.join(nodes.select("node", "n_shingles", "bands"), "node").dropDuplicates(["node"]), "fine")
        rows = open_.join(fine, "node").repartition("key", "block").sortWithinPartitions("key", "block")
        rows = rows.select("key", "block", "side", "node", "component", "in_main", "n_shingles", "bands", "fine")
        found = rows.mapInArrow(_across(True), "a long, b long").distinct().join(tried, ["a", "b"], "left_anti")
        nearest = materialise(found, "nearest")
        found = materialise(confirm(nearest, docs), "links")
        if found.isEmpty():
            tried = tried.union(nearest)
            break
        tried = materialise(tried.union(nearest), "tried")
        links = materialise(links.union(found), "links")
        component = connected_components(links)
    found = rows.mapInArrow(_across(False), "a long, b long").distinct().join(tried, ["a", "b"], "left_anti")
    links = materialise(links.union(confirm(materialise(found, "rest"), docs)), "links")
    return documents, links


def _open_members(members: DataFrame, component: DataFrame) -> DataFrame:
    """The members of buckets that hold several components: key, block, side,
    node, component, in_main. A bucket of up to BLOCK members is one block of
    side 2; a larger one is dealt into chunks, and each pair of chunks is a
    block whose sides are 0 and 1 (2 for a chunk with itself)."""
    placed = members.select("key", "node").join(component, "node", "left")
    placed = placed.select("key", "node", F.coalesce("component", "node").alias("component"))
    spread = placed.groupBy("key", "component").agg(F.count("*").alias("n"))
    main = spread.groupBy("key").agg(
        F.max_by("component", "n").alias("main"), F.count("*").alias("parts"), F.sum("n").alias("members")
    )
    main = materialise(main.where("parts > 1").drop("parts"), "open-buckets")
    chunks = F.ceil(F.col("members") / BLOCK)
    own = placed.join(main, "key").withColumn("chunks", chunks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")))
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    return dealt.select(
        "key", (low * F.col("chunks") + high).alias("block"), side.alias("side"), "node", "component",
        (F.col("component") == F.col("main")).alias("in_main"),
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (the
    smallest doc_id that links reach, itself included) and kept."""
    documents, links = link(id_and_text(docs, id_col, text_col))
    component = connected_components(links)
    out = documents.join(component, "node", "left")
    smallest = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id"))
    return out.select(
        "doc_id", "n_shingles", smallest.alias("component_id"), (F.col("doc_id").isNull() | (F.col("doc_id") == smallest)).alias("kept")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each near-duplicate group, all columns;
    of rows that repeat a doc_id, one stays."""
    marked = materialise(near_duplicates(docs), "marked")
    gone = marked.where("NOT kept").select("doc_id").distinct()
    repeated = marked.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    repeated = materialise(repeated, "repeated")
    stay = docs.join(materialise(gone, "gone"), "doc_id", "left_anti")
    if repeated.isEmpty():
        return stay
    once = stay.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return stay.join(repeated, "doc_id", "left_anti").unionByName(once)
