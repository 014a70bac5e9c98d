"""Document fingerprints of improbable features in chained Bloom filters.

Method: every window of ``WINDOW`` bytes has a collision entropy, known from the
number of equal byte pairs in it. A first pass counts over all documents how
often each such number occurs; the rarer, the more improbable the window. In
every stretch of ``STRETCH`` neighbouring windows the most improbable one, the
left one of equals, gains a point; windows with ``POINTS`` points, and the most
improbable one of each text, are its features. Windows of almost one byte alone
(more than ``MAX_PAIRS`` equal pairs) are none. Of a text under ``SHORT`` bytes
every window is a feature, and of one under half of that every ``GRAM`` bytes
too, since a short text has few windows. Each feature sets five bits of a
Bloom filter of 2,048 bits; after ``PER_FILTER`` different features a text's
next filter begins. The fingerprint is the filters in hex.

Likeness of two fingerprints: each filter of the shorter chain takes its best
match in the other; a match is the common bits less those expected by chance,
over the most that were possible less the same; filters count by their bits. Of
chains of equal length the mean of both directions counts.

The table of counts is bounded (one number for each possible count of pairs)
and goes to the tasks; texts go once through a shuffle by ranges of doc_id, in
which the first document of each range also follows the range before it.

Edge cases: null and empty texts have the empty fingerprint; two empty ones are
alike (1), an empty one and another are not (0). A text under ``GRAM`` bytes is
one feature. The document after the last is the first; a lone document
follows itself. Null doc_ids come first; rows that repeat a doc_id follow each
other, ordered by text. Other columns are ignored."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelens.llm.hashing import mix64, span_hashes
from ridelens.llm.shared import id_and_text, pieces, text_buffer

WINDOW, STRETCH, POINTS = 16, 32, 8
SHORT, GRAM = 128, 4
PAIRS = WINDOW * (WINDOW - 1) // 2
MAX_PAIRS = PAIRS // 2
BITS, HASHES, PER_FILTER = 2048, 5, 160


def equal_pairs(data: np.ndarray) -> np.ndarray:
    """The number of equal byte pairs in each window of the bytes."""
    n = data.size - WINDOW + 1
    out = np.zeros(max(n, 0), np.int32)
    if n <= 0:
        return out
    for lag in range(1, WINDOW):
        same = np.concatenate([[0], np.cumsum(data[lag:] == data[:-lag], dtype=np.int32)])
        out += same[WINDOW - lag : WINDOW - lag + n] - same[:n]
    return out


def _inside(offsets: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which places begin a stretch of ``size`` that does not cross an offset."""
    fits = np.zeros(n + 1, np.int32)
    long = np.diff(offsets) >= size
    np.add.at(fits, offsets[:-1][long], 1)
    np.add.at(fits, (offsets[1:] - size + 1)[long], -1)
    return np.cumsum(fits)[:n] > 0


def pair_counts(docs: DataFrame) -> np.ndarray:
    """How many windows of all documents have each number of equal pairs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(PAIRS + 1, np.int64)
        for batch in pieces(batches):
            data, offsets = text_buffer(batch.column("text"))
            pairs = equal_pairs(data)
            total += np.bincount(pairs[_inside(offsets, len(pairs), WINDOW)], minlength=PAIRS + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(PAIRS + 1)), pa.array(total)], names=["pairs", "n"])

    rows = docs.select("text").mapInArrow(count, "pairs long, n long").groupBy("pairs").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(PAIRS + 1, np.int64)
    for row in rows:
        out[row.pairs] = row.n
    return out


def rarity_ranks(counts: np.ndarray) -> np.ndarray:
    """0 for the rarest number of pairs, then upwards; none for windows of
    almost one byte alone."""
    order = np.lexsort((np.arange(len(counts)), counts))
    ranks = np.empty(len(counts), np.int64)
    ranks[order] = np.arange(len(counts))
    ranks[MAX_PAIRS + 1 :] = len(counts)
    return ranks


def features(data: np.ndarray, offsets: np.ndarray, ranks: np.ndarray) -> list[np.ndarray]:
    """The hashes of each text's features, different ones, in their order."""
    pairs = equal_pairs(data)
    n = len(pairs)
    out: list[np.ndarray] = [np.empty(0, np.uint64)] * (len(offsets) - 1)
    size = np.diff(offsets)
    grams: dict[int, np.ndarray] = {}
    for i in np.flatnonzero((size > 0) & (size < SHORT // 2)):
        at = np.arange(offsets[i], max(offsets[i] + 1, offsets[i + 1] - GRAM + 1))
        grams[i] = out[i] = np.unique(span_hashes(data, at, np.minimum(at + GRAM, offsets[i + 1])))
    if not n:
        return out
    key = np.where(_inside(offsets, n, WINDOW), ranks[pairs] << 32 | np.arange(n), np.int64(1) << 62)
    best, step = key.copy(), 1
    while step < STRETCH:  # the least key of each stretch, by doubling
        best[: n - step] = np.minimum(best[: n - step], best[step:])
        step *= 2
    best = best[_inside(offsets, n, WINDOW + STRETCH - 1)]
    points = np.bincount(best & 0xFFFFFFFF, minlength=n)[:n]
    chosen = (points >= POINTS) & (ranks[pairs] < len(ranks))
    long = np.flatnonzero(size >= WINDOW)
    least = [int(key[offsets[i] : offsets[i + 1] - WINDOW + 1].min()) & 0xFFFFFFFF for i in long]
    chosen[least] = True
    for i in np.flatnonzero((size >= WINDOW) & (size < SHORT)):
        chosen[offsets[i] : offsets[i + 1] - WINDOW + 1] = True
    at = np.flatnonzero(chosen)
    hashes = span_hashes(data, at, at + WINDOW)
    cuts = np.searchsorted(at, offsets)
    for i in long:
        own = hashes[cuts[i] : cuts[i + 1]]
        own = np.concatenate([own, grams[i]]) if i in grams else own
        out[i] = own[np.sort(np.unique(own, return_index=True)[1])]
    return out


def bloom_chain(hashes: np.ndarray) -> np.ndarray:
    """The filters, one row of BITS / 8 bytes each."""
    if not len(hashes):
        return np.empty((0, BITS // 8), np.uint8)
    row = np.arange(len(hashes)) // PER_FILTER
    bits = np.zeros((row[-1] + 1, BITS), np.uint8)
    mixed = mix64(hashes)
    for _ in range(HASHES):
        bits[row, (mixed & np.uint64(BITS - 1)).astype(np.int64)] = 1
        mixed = mixed >> np.uint64(11)
    return np.packbits(bits, axis=1)


def _toward(x: np.ndarray, y: np.ndarray) -> float:
    common = np.bitwise_count(x[:, None] & y[None]).sum(axis=2, dtype=np.int64)
    a, b = (np.bitwise_count(z).sum(axis=1, dtype=np.int64) for z in (x, y))
    chance = a[:, None] * b[None] / BITS
    most = np.minimum(a[:, None], b[None])
    match = np.clip((common - chance) / np.maximum(most - chance, 1e-9), 0.0, 1.0)
    return float((match.max(axis=1) * a).sum() / a.sum())


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    """0 to 1, of two chains of filters."""
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    if len(x) == len(y) and (x == y).all():
        return 1.0
    if len(x) != len(y):
        return _toward(*sorted((x, y), key=len))
    return (_toward(x, y) + _toward(y, x)) / 2


def chains(texts: list[str], ranks: np.ndarray) -> list[np.ndarray]:
    data, offsets = text_buffer(pa.array(texts, pa.large_string()))
    return [bloom_chain(h) for h in features(data, offsets, ranks)]


def with_next(docs: DataFrame) -> DataFrame:
    """(part, extra, place, doc_id, text) in parts of ascending doc_id: each
    part ends with a row (extra 1) that repeats the first of the next part."""
    spark = docs.sparkSession
    own = docs.withColumn("place", F.coalesce("doc_id", F.lit(-(1 << 63))))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    edges = np.unique(own.approxQuantile("place", [i / n for i in range(1, n)], 0.1 / n) if n > 1 else [])

    @F.pandas_udf("int")
    def part_of(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, place.to_numpy(), side="right"))

    # a row for each part
    firsts = own.select("place").withColumn("part", part_of("place")).groupBy("part").agg(F.min("place").alias("place"))
    firsts = sorted((r.part, r.place) for r in firsts.collect())
    before = [(place, firsts[i - 1][0]) for i, (_, place) in enumerate(firsts)]
    links = spark.createDataFrame(before, "place long, part int")
    repeated = own.join(F.broadcast(links), "place").groupBy("place", "part").agg(
        F.min("doc_id").alias("doc_id"), F.min(F.coalesce("text", F.lit(""))).alias("text")
    )
    columns = ["part", "extra", "place", "doc_id", "text"]
    rows = own.withColumn("part", part_of("place")).withColumn("extra", F.lit(0)).select(columns)
    rows = rows.unionByName(repeated.withColumn("extra", F.lit(1)).select(columns))
    return rows.repartition(n, "part").sortWithinPartitions("part", "extra", "place", F.coalesce("text", F.lit("")))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next of every row of ``docs``."""
    texts = id_and_text(docs)
    ranks = rarity_ranks(pair_counts(texts))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row so far: part, extra, doc_id, text
        for batch in pieces(batches):
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("part", "extra", "doc_id", "text"))))
            rows = [held, *rows] if held else rows
            held = rows[-1]
            own = [i for i, row in enumerate(rows[:-1]) if not row[1]]
            plain = [row[3] or "" for row in rows]
            edited = []
            for i in own:
                cut = len(plain[i]) // 4
                edited.append(plain[i][: len(plain[i]) - cut] + plain[i + 1][:cut])
            found, changed = chains(plain, ranks), chains(edited, ranks)
            out = [
                [rows[i][2] for i in own],
                [len(plain[i]) for i in own],
                [hashlib.sha256(x.encode()).hexdigest() for x in edited],
                [found[i].tobytes().hex() for i in own],
                [x.tobytes().hex() for x in changed],
                [likeness(found[i], x) for i, x in zip(own, changed)],
                [likeness(found[i], found[i + 1]) for i in own],
            ]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], names=names)

    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    names = [c.split()[0] for c in schema.split(", ")]
    return with_next(texts).mapInArrow(digest, schema)
