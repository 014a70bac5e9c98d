"""Quality classifier: logistic regression on hashed word n-grams, trained with
follow-the-regularised-leader (FTRL-proximal) updates, scored as sparse dot
products.

Features: a text is cut into words (letters, digits and non-ASCII characters)
and runs of marks. Each gives its own lower-cased hash; a mark run also its
mark, and a word its shape: whether it is shouted (two or more capitals, no
small letter) and whether it repeats the word before it. The n-grams are the
words, the pairs of neighbouring words, their shapes, and the pairs of
neighbouring shapes (``GROUPS``); each is hashed into
``2**BITS`` slots, and a text's values are its slot shares, so that length
alone does not move the score.

Training: the labelled rows, or of more than ``MAX_LABELLED`` about that many
chosen by a hash of their doc_id (the documented bound of the sample), go to
``SHARDS`` shards. A labelled doc_id that several rows have trains once, with the
smallest of their texts. Each shard runs ``EPOCHS`` passes of FTRL over its rows
(more over few rows), and the model is the mean of the weights of the shards that
have rows.

The model is 2**BITS weights at most and goes to the tasks as such; the texts
never leave their partitions.

Edge cases: null and empty text score the model's bias; a null doc_id is never
held out and never trains; null labels never train; without a training row of
either label the score is 0.5 for all. Labels, language, source and doc_id are
no inputs of a score."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelens.llm.hashing import mix64, rows_of, span_hashes
from ridelens.llm.shared import id_and_text, pieces, text_buffer

BITS = 18
SHARDS, EPOCHS = 4, 3
#: Small shards make more passes, for so many updates at least.
UPDATES = 2000
MAX_LABELLED = 20_000
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-4
#: Groups of features that count.
GROUPS = ("words", "word pairs", "shapes", "shape pairs")
#: Predicted 1 from this score on.
THRESHOLD = 0.3

# byte classes: 0 white space, 1 word byte, 2 mark
_CLASS = np.full(256, 2, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = 0
_CLASS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_UPPER, _SMALL = np.zeros(256, bool), np.zeros(256, bool)
_UPPER[65:91], _SMALL[97:123] = True, True


def features(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, value) of the texts, sorted by row and slot."""
    data, offsets = text_buffer(column)
    n_rows, n = len(offsets) - 1, data.size
    kind = _CLASS[data]
    cut = np.ones(n, bool)
    cut[1:] = kind[1:] != kind[:-1]
    cut[offsets[:-1][offsets[:-1] < n]] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], n)
    solid = kind[starts] > 0
    starts, ends = starts[solid], ends[solid]
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    row = np.repeat(np.arange(n_rows), np.diff(rows_of(starts, offsets)))
    is_word = kind[starts] == 1
    token = span_hashes(_LOWER[data], starts, ends)
    upper = np.concatenate([[0], np.cumsum(_UPPER[data], dtype=np.int64)])
    small = np.concatenate([[0], np.cumsum(_SMALL[data], dtype=np.int64)])
    shouted = is_word & (upper[ends] - upper[starts] >= 2) & (small[ends] == small[starts])
    last = np.maximum.accumulate(np.where(is_word, np.arange(len(row)), -1))
    before = np.concatenate([[-1], last[:-1]])
    repeats = is_word & (before >= 0) & (row[before] == row) & (token[before] == token)
    shape = np.where(is_word, shouted + 2 * repeats, data[starts].astype(np.int64) + 4).astype(np.uint64)
    pair = np.flatnonzero(row[1:] == row[:-1])
    groups = {
        "words": (row, token),
        "word pairs": (row[pair], mix64(token[pair] * np.uint64(0x9E3779B97F4A7C15) + token[pair + 1])),
        "shapes": (row, mix64(shape + np.uint64(1 << 40))),
        "shape pairs": (row[pair], mix64(shape[pair] * np.uint64(512) + shape[pair + 1] + np.uint64(1 << 50))),
    }
    rows, hashes = (np.concatenate(x) for x in zip(*(groups[g] for g in GROUPS)))
    slots = (hashes >> np.uint64(64 - BITS)).astype(np.int64)
    cell, count = np.unique(rows << BITS | slots, return_counts=True)
    rows, slots = cell >> BITS, cell & ((1 << BITS) - 1)
    total = np.bincount(rows, count, n_rows)
    return rows, slots, count / total[rows]


def features_of(texts: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``features``, of many texts, in pieces."""
    columns, first = ([], [], []), 0
    for part in pieces([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])]):
        rows, slots, values = features(part.column("text"))
        for column, own in zip(columns, ((rows + first).astype(np.int32), slots.astype(np.int32), values)):
            column.append(own)
        first += part.num_rows
    out = []
    for column in columns:  # one after the other, so that few are there twice
        out.append(np.concatenate(column))
        column.clear()
    return tuple(out)


def by_share(shares: np.ndarray) -> np.ndarray:
    """Values from slot shares: damped, and scaled so that one learning rate fits all."""
    return np.sqrt(shares) * 4.0


def by_presence(shares: np.ndarray) -> np.ndarray:
    return np.ones(len(shares))


def ftrl(
    rows: np.ndarray, slots: np.ndarray, values: np.ndarray, labels: np.ndarray, alpha: float = ALPHA, l1: float = L1
) -> tuple[np.ndarray, float]:
    """Weights and bias after ``EPOCHS`` passes over the rows in their order,
    or as many as ``UPDATES`` updates take."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    at = np.searchsorted(rows, np.arange(len(labels) + 1, dtype=rows.dtype))

    def weights(i):
        zi = z[i]
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((BETA + np.sqrt(n[i])) / alpha + L2))

    for _ in range(max(EPOCHS, -(-UPDATES // max(1, len(labels))))):
        for k, y in enumerate(labels):
            i = np.append(slots[at[k] : at[k + 1]], 1 << BITS)
            x = np.append(values[at[k] : at[k + 1]], 1.0)
            w = weights(i)
            g = (1.0 / (1.0 + math.exp(-min(35.0, max(-35.0, float(w @ x))))) - y) * x
            s = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - s * w
            n[i] += g * g
    w = weights(np.arange((1 << BITS) + 1))
    return w[:-1], float(w[-1])


def _train_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["order", "label"], kind="stable").reset_index(drop=True)
    rows, slots, shares = features_of(pdf.text)
    weights, bias = ftrl(rows, slots, by_share(shares), pdf.label.to_numpy(float))
    used = np.flatnonzero(weights)
    return pd.DataFrame({"slot": np.append(used, 1 << BITS), "weight": np.append(weights[used], bias)})


def train(labelled: DataFrame) -> np.ndarray:
    """The 2**BITS weights and the bias, learnt from (text, label 0 or 1)."""
    rows = labelled.select(F.coalesce("text", F.lit("")).alias("text"), "label")
    rows = rows.withColumn("order", F.xxhash64("text", F.lit(7)))
    parts = rows.groupBy(F.pmod("order", F.lit(SHARDS)).alias("shard")).applyInPandas(_train_shard, "slot int, weight double")
    sums = parts.groupBy("slot").agg(F.sum("weight").alias("weight"), F.count("*").alias("n")).toPandas()  # 2**BITS + 1 rows at most
    model = np.zeros((1 << BITS) + 1)
    model[sums.slot.to_numpy(int)] = sums.weight.to_numpy()
    shards = sums.n[sums.slot == 1 << BITS]  # each shard with rows has a bias
    return model / max(1, int(shards.sum()))


def scores(column, model: np.ndarray) -> np.ndarray:
    """The probability of label 1 for each text of an Arrow column."""
    return probabilities(column, model[None])[0]


def probabilities(column, models: np.ndarray, valued=by_share) -> np.ndarray:
    """As ``scores``, a row for each of several models."""
    rows, slots, shares = features(column)
    values = valued(shares)
    margin = np.stack([np.bincount(rows, m[slots] * values, len(column)) + m[-1] for m in models])
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -35, 35)))


def held_out(doc_id):
    """Rows whose doc_id, as text, has a crc32 divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_LABELLED) -> DataFrame:
    """(text, label) of the documents that may train: all, or about max_rows."""
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    own = own.where(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    own = own.where(F.col("doc_id").isNotNull()).distinct()
    share = max_rows / max(1, own.count())
    if share < 1:
        own = own.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_000)) < int(share * 1_000_000))
    return once(docs.join(F.broadcast(own), "doc_id"), own, "label")  # own has about max_rows rows at most


def once(rows: DataFrame, own: DataFrame, label: str) -> DataFrame:
    """text and label of the labelled rows, a doc_id that several rows have
    once, with the smallest of their texts. Texts are grouped only if some are
    to be dropped."""
    if rows.select("doc_id").count() > own.count():
        rows = rows.groupBy("doc_id", label).agg(F.min("text").alias("text"))
    return rows.select("text", label)


def score_documents(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_LABELLED) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``."""
    texts = id_and_text(docs)
    model = train(labelled_rows(texts, labels, max_rows))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            out = scores(batch.column("text"), model)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out)], names=["doc_id", "score"])

    scored = texts.mapInArrow(score, "doc_id long, score double")
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_LABELLED) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, all columns."""
    model = train(labelled_rows(id_and_text(docs), labels, max_rows))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            yield batch.filter(pa.array(scores(batch.column("text"), model) >= THRESHOLD))

    return docs.mapInArrow(keep, docs.schema)
