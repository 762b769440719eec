"""Quality by a factorisation machine.

1. Features of a whole text: its words hashed into buckets (log counts, scaled to
   length 1), statistics of its structure in bins, and the length that its row
   states (the only metadata that is a permitted input) in bins.
2. Model: intercept, a weight per feature, and for every pair of features the
   product of their factors. A score takes linear time, as the sum over all pairs
   is half of the squared sum less the sum of squares, factor by factor.
3. Training: rounds over a bounded labelled sample, dealt into parts by a hash. In a round
   every part takes AdaGrad steps of logistic loss from the common model, in
   tasks of their own, and the parts' models are averaged. Texts that are like
   others of the sample share one weight.

Defined results: null and empty texts have no words and are scored by their bins. A null or
missing stated length has a bin of its own. Labels that are null, not 0 or 1,
or of unknown documents are ignored; of repeated labels of a document the highest counts.
Without labels of both kinds all scores are 0.5, so nothing is predicted good.
Texts may have any length. Repeated rows are scored one by one, further columns
pass through.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspan.llm.common import fold, query, table
from fleetspan.llm.toxicity import sigmoid, weighted
from fleetspan.session import materialize

#: Labelled documents the model is fitted on, chosen by a hash of their key.
MAX_LABELLED = 20_000
#: Buckets of words, bins of a statistic, factors of a feature.
BUCKETS, BINS, RANK = 1 << 13, 16, 8
#: Parts of the sample, rounds of averaging, texts of a step.
PARTS, ROUNDS, STEP = 8, 8, 32
RATE, DECAY, START = 0.1, 1e-5, 0.02
#: A text is good from this score on.
THRESHOLD = 0.7
#: Tokens a task remembers.
REMEMBERED = 200_000
MARKS = re.compile(r"[\W\d_]+")
#: Odd factors that make further hashes of one.
MIXERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)

#: Statistics in the order of their bins; shares are binned by their root, sizes by their logarithm.
SHARES = ("distinct", "marks", "capitals", "digits", "letterless", "shouted", "repeated", "commonest", "blank")
SIZES = ("tokens", "token_length", "line_length")
STATED = ("stated_length", "stated_agrees")
FEATURES = BUCKETS + BINS * (len(SHARES) + len(SIZES) + len(STATED))
#: Value of a bin's feature.
BIN_VALUE = 0.5


class Featurizer:
    """Features of texts; tokens seen before are looked up."""

    def __init__(self):
        self.seen: dict[str, tuple[int, ...]] = {}

    def token(self, token: str) -> tuple[int, ...]:
        """Bucket, and counts of marks, capitals, digits, 1 if without letters, 1 if shouted."""
        info = self.seen.get(token)
        if info is None:
            if len(self.seen) > REMEMBERED:
                self.seen.clear()
            word = MARKS.sub("", token)
            digits, capitals = sum(map(str.isdigit, token)), sum(map(str.isupper, word))
            bucket = zlib.crc32((word.lower() or token).encode("utf-8", "replace")) % BUCKETS
            shouted = len(word) > 1 and capitals == len(word)
            info = (bucket, len(token) - len(word) - digits, capitals, digits, not word, shouted, len(token))
            if len(token) <= 64:
                self.seen[token] = info
        return info

    def __call__(self, text: str | None, stated: float | None) -> tuple[np.ndarray, np.ndarray]:
        """Features (distinct, ascending) and their values."""
        text = text or ""
        tokens = text.split()
        counts = Counter(tokens)
        n = max(1, len(tokens))
        if tokens:
            times = np.fromiter(counts.values(), np.int64, len(counts))
            infos = np.array([self.token(t) for t in counts], np.int64)
            words = np.bincount(infos[:, 0], times, BUCKETS)
            marks, capitals, digits, letterless, shouted, size = times @ infos[:, 1:]
            commonest = int(times.max())
        else:
            words = np.zeros(BUCKETS)
            marks = capitals = digits = letterless = shouted = size = commonest = 0
        repeated = sum(map(eq, tokens, tokens[1:]))
        inside = max(1, size)
        shares = (len(counts) / n, marks / inside, capitals / inside, digits / inside, letterless / n, shouted / n, repeated / n, commonest / n, 1 - size / max(1, len(text)))
        sizes = (len(tokens), size / n, len(text) / (1 + text.count("\n")))
        bins = [min(BINS - 1, int(BINS * np.sqrt(s))) for s in shares]
        bins += [min(BINS - 1, int(np.log2(1 + s))) for s in sizes]
        if stated is None or not np.isfinite(stated):
            bins += [BINS - 1, 0]
        else:
            bins += [min(BINS - 2, int(np.log2(1 + max(0.0, stated)) / 2)), 1 + int(np.sign(stated - len(text)) + 1)]
        found = np.flatnonzero(words)
        values = np.log1p(words[found])
        values /= max(1e-12, np.sqrt((values**2).sum()))
        extra = BUCKETS + BINS * np.arange(len(bins)) + np.array(bins)
        return np.concatenate([found, extra]), np.concatenate([values, np.full(len(bins), BIN_VALUE)])


@dataclass(frozen=True)
class Model:
    """Intercept, weight by feature, factors by feature."""

    intercept: float
    weights: np.ndarray
    factors: np.ndarray


def start_model() -> Model:
    return Model(0.0, np.zeros(FEATURES), np.random.default_rng(5).normal(0, START, (FEATURES, RANK)))


def raw_scores(model: Model, features: np.ndarray, values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Score of each text before the sigmoid, and its sums by factor. ``starts`` are the texts' first features; no text is without any."""
    parts = values[:, None] * model.factors[features]
    sums = np.add.reduceat(parts, starts)
    pairs = 0.5 * (sums**2 - np.add.reduceat(parts**2, starts)).sum(1)
    return model.intercept + np.add.reduceat(values * model.weights[features], starts) + pairs, sums


def epoch(model: Model, texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, of: np.ndarray) -> Model:
    """AdaGrad steps over the texts in their order; ``of`` weighs them."""
    weights, factors = model.weights.copy(), model.factors.copy()
    intercept = model.intercept
    power_w, power_f, power_i = np.full(len(weights), 1e-2), np.full(len(factors), 1e-2), 1e-2
    for i in range(0, len(texts), STEP):
        part = texts[i : i + STEP]
        sizes = [len(f) for f, _ in part]
        starts = np.cumsum([0, *sizes[:-1]])
        features, values = np.concatenate([f for f, _ in part]), np.concatenate([v for _, v in part])
        score, sums = raw_scores(Model(intercept, weights, factors), features, values, starts)
        slope = of[i : i + STEP] * (sigmoid(score) - labels[i : i + STEP])
        own = np.repeat(slope, sizes)
        # Steps go to the features of these texts only.
        touched, place = np.unique(features, return_inverse=True)
        step_w = np.bincount(place, own * values, len(touched)) + DECAY * weights[touched]
        each = (own * values)[:, None] * (np.repeat(sums, sizes, axis=0) - values[:, None] * factors[features])
        step_f = np.stack([np.bincount(place, each[:, k], len(touched)) for k in range(each.shape[1])], 1) + DECAY * factors[touched]
        power_w[touched] += step_w**2
        power_f[touched] += (step_f**2).mean(1)
        power_i += slope.sum() ** 2
        weights[touched] -= RATE * step_w / np.sqrt(power_w[touched])
        factors[touched] -= RATE * step_f / np.sqrt(power_f[touched])[:, None]
        intercept -= RATE * slope.sum() / np.sqrt(power_i)
    return Model(float(intercept), weights, factors)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds features, values and the minima of three hashes over five-word shingles."""
    featurize = Featurizer()
    for batch in batches:
        rows, minima = [], []
        for text, stated in zip(batch["text"].to_pylist(), batch["stated"].to_pylist(), strict=True):
            rows.append(featurize(text, stated))
            words = MARKS.sub(" ", (text or "").lower()).split()
            shingles = np.array([zlib.crc32(" ".join(words[i : i + 5]).encode()) for i in range(max(1, len(words) - 4))], np.uint64)
            minima.append([int(((shingles + np.uint64(1)) * np.uint64(m)).min() >> np.uint64(1)) for m in MIXERS])
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch["doc_id"],
                "label": batch["label"],
                "features": pa.array([f for f, _ in rows], pa.list_(pa.int32())),
                "values": pa.array([v for _, v in rows], pa.list_(pa.float64())),
                "minima": pa.array(minima, pa.list_(pa.int64())),
            }
        )


def stated_length(docs: DataFrame) -> Column:
    """The length a row states for its text; null where the table has none."""
    return F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")


def labelled(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """The bounded labelled sample: doc_id, label, features, values, weight and part."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    # At most ``limit`` rows of 12 bytes.
    found = docs.select("doc_id", "text", stated_length(docs).alias("stated")).join(F.broadcast(chosen), "doc_id")
    schema = "doc_id long, label int, features array<int>, values array<double>, minima array<long>"
    found = found.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "stated", "label").mapInArrow(_featured, schema)
    found = weighted(materialize(found, "quality-sample"))
    return found.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(PARTS)))


def _round(model: Model):
    def run(rows: pa.Table) -> pa.Table:
        # In an order of their own, so that the result does not depend on how rows arrive.
        texts = [(np.asarray(f.values), np.asarray(v.values)) for f, v in zip(rows["features"], rows["values"], strict=True)]
        ids, label = rows["doc_id"].to_pylist(), rows["label"].to_numpy()
        order = sorted(range(len(ids)), key=lambda i: (zlib.crc32(b"%d" % ids[i]), ids[i], label[i], len(texts[i][0]), texts[i][0].tobytes()))
        moved = epoch(model, [texts[i] for i in order], label[order].astype(float), rows["weight"].to_numpy()[order])
        return pa.table(
            {
                "part": rows["part"].slice(0, 1),
                "mass": pa.array([float(rows["weight"].to_numpy().sum())]),
                "intercept": pa.array([moved.intercept]),
                "weights": pa.array([moved.weights], pa.list_(pa.float64())),
                "factors": pa.array([moved.factors.ravel()], pa.list_(pa.float64())),
            }
        )

    return run


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED, rounds: int = ROUNDS) -> Model | None:
    """Learn from the labelled rows; the driver holds PARTS models at a time and no texts."""
    sample = materialize(labelled(docs, labels, limit), "quality-weighted")
    if sample.agg(F.count_distinct("label").alias("n")).first()["n"] < 2:
        return None
    model = start_model()
    for _ in range(rounds):
        moved = sample.groupBy("part").applyInArrow(_round(model), "part long, mass double, intercept double, weights array<double>, factors array<double>")
        parts = moved.orderBy("part").toArrow()
        share = parts["mass"].to_numpy() / parts["mass"].to_numpy().sum()
        weights, factors = (np.asarray(parts[c].combine_chunks().flatten()).reshape(len(share), -1) for c in ("weights", "factors"))
        model = Model(float(share @ parts["intercept"].to_numpy()), share @ weights, (share @ factors).reshape(FEATURES, RANK))
    # A feature that the sample does not have keeps the chance values it began with: it says nothing.
    seen = np.zeros(FEATURES, bool)
    seen[sample.select(F.explode("features").alias("f")).distinct().toArrow()["f"].to_numpy()] = True
    return Model(model.intercept, model.weights, np.where(seen[:, None], model.factors, 0.0))


def scorer(model: Model | None, text: Column, stated: Column) -> Column:
    """Score of a text column, 0 to 1."""

    def run(series: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        featurize = Featurizer()
        for texts, lengths in series:
            if model is None or not len(texts):
                yield pd.Series(np.full(len(texts), 0.5))
                continue
            rows = [featurize(t if isinstance(t, str) else None, s) for t, s in zip(texts, lengths, strict=True)]
            out = []
            for i in range(0, len(rows), STEP):
                part = rows[i : i + STEP]
                starts = np.cumsum([0, *(len(f) for f, _ in part[:-1])])
                score, _ = raw_scores(model, np.concatenate([f for f, _ in part]), np.concatenate([v for _, v in part]), starts)
                out.append(sigmoid(score))
            yield pd.Series(np.concatenate(out))

    run.__annotations__ = {"series": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "double")(text, stated)


def score(docs: DataFrame, labels: DataFrame, out: str = "quality_score") -> DataFrame:
    """``docs`` with the score of every text in the column ``out``; labels of held-out rows are not read."""
    model = fit(docs, labels.where(~fold("doc_id", 4, 2)))
    return docs.withColumn(out, scorer(model, F.col("text"), stated_length(docs)))


@query()
def op13_factorisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = score(docs.select("doc_id", "text", "n_chars"), table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id",
        fold("doc_id", 4, 2).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"),
    )
