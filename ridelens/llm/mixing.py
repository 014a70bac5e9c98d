"""Mixing sources to target weights by soft membership.

Method: a classifier trained on a labelled table predicts, for every document,
the posterior of each domain. Nonnegative rates r_i (expected copies) are then
fitted so that the expected tokens of each domain, sum r_i t_i p_i over all
documents, match the targets: least squares on the plain distance between the
domains' totals and the targets, by projected gradients from r = 1.

A step is implicit: r becomes max(0, r - p u), where u is the gradient (what the
totals have above the targets) *after* the step, over ``DAMPING``, so that rare
domains need no more steps than common ones. u has one number per domain and
solves a strictly convex equation, by Newton's method with a line search; each
Newton iteration is one distributed pass that adds up a few numbers per pair of
domains. Steps end when the projected gradient is ``TOLERANCE`` at most. When no
rates meet the targets, the totals are the nearest ones possible; ``residual``
(the largest distance of a domain's share from its target) and ``converged`` say
so in every row. A document's rate follows from its posterior and the list of
steps; no rates are stored or sent between the passes.

The classifier is one logistic regression per domain on which hashed word
n-grams a text has, trained as in ``quality`` with a stronger L1 term, so that
words that few rows have weigh nothing; the posteriors are the scores over
their sum. Tokens are words (runs without white space).

``copies`` is the rate's whole part, and one more for the share of documents
that its fraction says, chosen by a hash of doc_id and text.

Edge cases: null and empty texts have no tokens; their rate follows from the
posterior of an empty text. Rows that repeat are rated each, alike. Without
labelled rows all posteriors are equal. Without any token all rates are 1, and
residual is null. A domain that no target names is not a domain; weights are
divided by their sum. Tokens here are words, runs without white space."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelens.llm import quality
from ridelens.llm.hashing import rows_of, runs
from ridelens.llm.shared import id_and_text, materialise, pieces, text_buffer

#: Target shares of the expected tokens by domain.
TARGETS = {"clean": 0.85, "noisy": 0.05, "toxic": 0.10}
SHARDS = 4
ALPHA, L1 = 0.3, 2.0
MAX_LABELLED = 20_000
#: The projected gradient that ends the steps, in shares of all tokens; the number
#: of steps, and of Newton iterations in one, after which the fit counts as not
#: converged.
TOLERANCE, MAX_STEPS, MAX_NEWTON = 1e-9, 12, 60
#: Weight of a step's own size against the distance to the targets.
DAMPING = 1e-6
#: Lengths tried in each Newton iteration.
LENGTHS = (1.0, 0.5, 0.25, 0.125, 1 / 32, 1 / 128, 1 / 1024)

_WORD = np.ones(256, bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False


def domain_of(quality_label: Column, toxic_label: Column) -> Column:
    """The domain that a row of the labels table names."""
    return F.when(toxic_label == 1, "toxic").when(quality_label == 0, "noisy").when(quality_label == 1, "clean")


def _train(labelled: DataFrame, domains: list[str]) -> np.ndarray:
    """Weights, one row per domain, of (text, domain)."""

    def shard(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["order", "domain"], kind="stable").reset_index(drop=True)
        x, slots, shares = quality.features_of(pdf.text)
        out = []
        for k, name in enumerate(domains):
            own = (pdf.domain == name).to_numpy(float)
            weights, bias = quality.ftrl(x, slots, quality.by_presence(shares), own, alpha=ALPHA, l1=L1)
            used = np.flatnonzero(weights)
            cells = {"cell": np.append(used, 1 << quality.BITS), "weight": np.append(weights[used], bias)}
            out.append(pd.DataFrame(cells).assign(domain=k))
        return pd.concat(out)[["domain", "cell", "weight"]]

    rows = labelled.withColumn("order", F.xxhash64("text", F.lit(7)))
    parts = rows.groupBy(F.pmod("order", F.lit(SHARDS)).alias("shard")).applyInPandas(shard, "domain int, cell int, weight double")
    # at most a row for each domain and cell
    mean = parts.groupBy("domain", "cell").agg(F.sum("weight").alias("weight"), F.count("*").alias("n")).toPandas()
    model = np.zeros((len(domains), (1 << quality.BITS) + 1))
    model[mean.domain.to_numpy(int), mean.cell.to_numpy(int)] = mean.weight.to_numpy()
    shards = mean.n[(mean.domain == 0) & (mean.cell == 1 << quality.BITS)]  # each shard with rows has a bias
    return model / max(1, int(shards.sum()))


def posteriors(docs: DataFrame, labelled: DataFrame, domains: list[str], max_rows: int = MAX_LABELLED) -> DataFrame:
    """doc_id, order (a hash of doc_id and text), n_tokens, and the posteriors
    p0, p1, ... of the domains, of every row of ``docs``. ``labelled`` has
    doc_id and domain; of more than max_rows about that many train, chosen by a
    hash of their doc_id."""
    texts = id_and_text(docs)
    own = labelled.where(F.col("domain").isin(domains) & F.col("doc_id").isNotNull()).select("doc_id", "domain").distinct()
    share = max_rows / max(1, own.count())
    if share < 1:
        own = own.where(F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(1_000_000)) < int(share * 1_000_000))
    sample = texts.join(F.broadcast(own), "doc_id")  # own has about max_rows rows at most
    sample = quality.once(sample, own, "domain")
    model = _train(sample.select(F.coalesce("text", F.lit("")).alias("text"), "domain"), domains)
    names = [f"p{k}" for k in range(len(domains))]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            column = batch.column("text")
            data, offsets = text_buffer(column)
            n_tokens = np.diff(rows_of(runs(_WORD[data], offsets)[0], offsets))
            p = quality.probabilities(column, model, quality.by_presence)
            p /= p.sum(axis=0)
            arrays = [batch.column("doc_id"), batch.column("order"), pa.array(n_tokens), *map(pa.array, p)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "order", "n_tokens", *names])

    schema = "doc_id long, order long, n_tokens long, " + ", ".join(f"{n} double" for n in names)
    return texts.withColumn("order", F.xxhash64("doc_id", "text")).mapInArrow(score, schema)


@dataclass
class Fit:
    """The steps, and how it ended."""

    steps: list[np.ndarray]
    residual: float | None
    converged: bool


def rates(p: np.ndarray, steps: list[np.ndarray]) -> np.ndarray:
    """The rates of documents with the posteriors ``p``, a row per domain."""
    r = np.ones(p.shape[1])
    for u in steps:
        r = np.maximum(0.0, r - u @ p)
    return r


def _sums(table: DataFrame, domains: int, of, width: int) -> tuple[np.ndarray, float]:
    """``of(t, p)`` returns ``width`` numbers to be added up over all batches
    of documents (tokens and posteriors), and one to take the largest of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, most = np.zeros(width), 0.0
        for batch in batches:
            if batch.num_rows:
                t = batch.column("n_tokens").to_numpy().astype(float)
                p = np.array([batch.column(f"p{k}").to_numpy() for k in range(domains)]).reshape(domains, len(t))
                part, worst = of(t, p)
                total += part
                most = max(most, worst)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64())), pa.array([most])], names=["sums", "most"])

    parts = table.select("n_tokens", *(f"p{k}" for k in range(domains))).mapInArrow(run, "sums array<double>, most double")
    row = parts.agg(*(F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width)), F.max("most").alias("most")).first()
    return np.array([x or 0.0 for x in row[:-1]]), row.most or 0.0


def fit(table: DataFrame, weights: list[float]) -> Fit:
    """The steps that bring the expected tokens by domain nearest to the
    weights' shares of all tokens."""
    d = len(weights)
    target = np.array(weights, float) / sum(weights)
    total = _sums(table, 0, lambda t, p: (np.array([t.sum()]), 0.0), 1)[0][0]
    if not total:
        return Fit([], None, True)

    def measured(steps: list[np.ndarray], tried: list[np.ndarray]):
        """For each u tried after the steps: half the squared rates, the
        domains' shares, their second moments, all over documents with a rate;
        and the largest move of a document that keeps one (at the first u)."""

        def of(t, p):
            r = rates(p, steps)
            out = []
            for u in tried:
                after = np.maximum(0.0, r - u @ p)
                own = p[:, after > 0] * t[after > 0]
                out += [[0.5 * (t * after * after).sum()], p @ (t * after), (own @ p[:, after > 0].T).ravel()]
            keeps = (rates(p, [*steps, tried[0]]) > 0) & (t > 0)
            return np.concatenate(out), float(np.abs(tried[0] @ p[:, keeps]).max(initial=0.0))

        width = 1 + d + d * d
        sums, move = _sums(table, d, of, width * len(tried))
        each = sums.reshape(len(tried), width) / total
        return [(row[0], row[1 : 1 + d], row[1 + d :].reshape(d, d)) for row in each], move

    steps: list[np.ndarray] = []
    gap = None
    for _ in range(MAX_STEPS):
        u = np.zeros(d)
        ((half, shares, second),), _ = measured(steps, [u])
        for _ in range(MAX_NEWTON):
            slope = DAMPING * u - (shares - target)
            if np.abs(slope).max() <= 1e-14:
                break
            height = half + 0.5 * DAMPING * (u @ u) + u @ target
            towards = np.linalg.solve(second + DAMPING * np.eye(d), slope)
            tried = [u - a * towards for a in LENGTHS]
            found, _ = measured(steps, tried)
            heights = [h + 0.5 * DAMPING * (v @ v) + v @ target for (h, _, _), v in zip(found, tried)]
            slopes = [np.abs(DAMPING * v - (x - target)).max() for (_, x, _), v in zip(found, tried)]
            # by height; near the bottom, where heights are equal but for rounding, by slope
            k = int(np.argmin(heights))
            if heights[k] >= height - 1e-15 * abs(height):
                k = int(np.argmin(slopes))
                if slopes[k] >= np.abs(slope).max():
                    break
            u, (half, shares, second) = tried[k], found[k]
        _, move = measured(steps, [u])
        steps = [*steps, u]
        gap = shares - target
        if DAMPING * move <= TOLERANCE:
            return Fit(steps, float(np.abs(gap).max()), True)
    return Fit(steps, float(np.abs(gap).max()), False)


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """doc_id, order, n_tokens, p_<domain> for each domain, rate and copies of
    every row of ``docs``, with residual and converged of the fit."""
    domains = list(targets)
    table = materialise(posteriors(docs, labelled, domains), "posteriors")
    fitted = fit(table, list(targets.values()))
    names = [f"p{k}" for k in range(len(domains))]

    def rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = np.stack([batch.column(n).to_numpy() for n in names])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rates(p, fitted.steps))], names=[*batch.schema.names, "rate"])

    schema = "doc_id long, order long, n_tokens long, " + ", ".join(f"{n} double" for n in names) + ", rate double"
    named = [F.col(n).alias(f"p_{name}") for n, name in zip(names, domains)]
    out = table.mapInArrow(rated, schema).select("doc_id", "order", "n_tokens", *named, "rate")
    part = F.pmod(F.col("order"), F.lit(1_000_003)) / 1_000_003
    out = out.withColumn("copies", (F.floor("rate") + (part < F.col("rate") - F.floor("rate")).cast("long")).cast("long"))
    return out.withColumn("residual", F.lit(fitted.residual).cast("double")).withColumn("converged", F.lit(fitted.converged))


def labelled_domains(labels: DataFrame) -> DataFrame:
    """doc_id and domain of the labels table, null domains left out."""
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), domain_of(F.col("quality"), F.col("toxic")).alias("domain"))
    return own.where("domain IS NOT NULL")


def resample(docs: DataFrame, labelled: DataFrame, targets: dict[str, float]) -> DataFrame:
    """``docs`` with each row as many times as its copies say, all columns."""
    own = mix(docs, labelled, targets).where("copies <> 1").select("doc_id", "order", "copies").distinct()
    own = own.withColumnRenamed("doc_id", "id").withColumnRenamed("order", "id_order")
    keyed = docs.select(F.struct("*").alias("doc"), F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("key"))
    changed = materialise(own, "copies")
    both = keyed.join(changed, (F.col("key") == F.col("id_order")) & F.col("doc.doc_id").cast("long").eqNullSafe(F.col("id")), "left")
    times = F.coalesce("copies", F.lit(1)).cast("int")
    return both.where(times > 0).select(F.explode(F.array_repeat("doc", times)).alias("doc")).select("doc.*")
