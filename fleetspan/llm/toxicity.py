"""Toxicity by weak supervision.

0. Copies: a labelled text counts as one over the number of labelled texts like
   it (equal minimum of a hash over its five-word shingles), so that a group of
   copies is not taken for many witnesses.
1. Voters: words (lexicon voters) and word beginnings (pattern voters) that are
   far more frequent in labelled toxic documents than in clean ones.
2. Label model: a generative model of all votes, the given label being one more
   voter. EM estimates prior and accuracies; correlations that the classes do
   not explain lower the weight of voters that say the same thing.
3. Classifier: logistic regression on the voters' counts and densities, trained
   on the posterior labels, scores every whole text.

Defined results: null and empty texts have no words and get the score of the
intercept, below the threshold. Labels that are null, or of unknown documents,
are ignored; of repeated labels of a document the highest counts. Without
labels of both kinds there are no voters and all scores are 0. Texts may have
any length. Repeated rows are scored one by one, further columns pass through.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from fleetspan.llm.common import fold, query, session, table, whole_rows
from fleetspan.session import materialize

#: Labelled rows the model is fitted on, chosen by a hash of their key: the bound of everything the driver sees.
MAX_LABELLED = 20_000
#: Voters of each kind, and the z-score of their log-odds from which they count.
MAX_VOTERS = 96
MIN_Z = 4.0
#: Lengths of word beginnings that pattern voters look at.
BEGINNINGS = (4, 5, 6, 7)
#: A text is toxic from this score on.
THRESHOLD = 0.7
EM_ROUNDS = 50
#: Bounds on the rates at which the given label says toxic: least in clean, least in toxic; most in clean, most in toxic.
GIVEN_RATES = (np.array([0.001, 0.9]), np.array([0.02, 0.999]))
#: Odd factors that make further hashes of one.
MIXERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
WORDS = r"[^\W\d_]+"
#: Distinct words a task remembers.
REMEMBERED = 200_000


@dataclass(frozen=True)
class Model:
    """Voters (``w:word`` or ``p:beginning``) and the weights of the classifier."""

    voters: tuple[str, ...]
    weights: tuple[float, ...]
    #: Accuracies of the label model by voter: P(vote | clean), P(vote | toxic).
    rates: tuple[tuple[float, float], ...] = ()


def signs(word: str) -> list[str]:
    """What a word can be recognised by."""
    return [f"w:{word}", *(f"p:{word[:n]}" for n in BEGINNINGS if len(word) >= n)]


class Counting:
    """Counts the votes in texts; words seen before are looked up."""

    def __init__(self, voters: tuple[str, ...]):
        self.place, self.seen = {v: i for i, v in enumerate(voters)}, {}
        self.words = re.compile(WORDS).findall

    def __call__(self, text: str | None) -> tuple[int, Counter]:
        """Number of words, and how often each voter fires."""
        found = self.words(text.lower()) if text else []
        votes: Counter = Counter()
        seen, place = self.seen, self.place
        if len(seen) > REMEMBERED:
            seen.clear()
        for word, n in Counter(found).items():
            hits = seen.get(word)
            if hits is None:
                hits = seen[word] = tuple(place[s] for s in signs(word) if s in place)
            for voter in hits:
                votes[voter] += n
        return len(found), votes


def features(n_words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Of each text: 1, log counts and share of words by voter, their totals and the length; rows are texts."""
    share = counts / np.maximum(n_words, 1)[:, None]
    total, wide = np.log1p(counts.sum(1, keepdims=True)), np.sqrt(share.sum(1, keepdims=True))
    length = np.log1p(n_words)[:, None] * (total > 0)
    return np.hstack([np.ones((len(counts), 1)), np.log1p(counts), np.sqrt(share), total, wide, length])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _with_minima(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = re.compile(WORDS).findall
    for batch in batches:
        minima = []
        for text in batch["text"].to_pylist():
            found = words((text or "").lower())
            hashes = np.array([xxhash.xxh64_intdigest(" ".join(found[i : i + 5])) for i in range(max(1, len(found) - 4))], np.uint64)
            minima.append([int((hashes * np.uint64(m)).min() >> np.uint64(1)) for m in MIXERS])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(minima, pa.list_(pa.int64()))], [*batch.schema.names, "minima"])


def weighted(sample: DataFrame) -> DataFrame:
    """The sample with ``weight``: one over the size of the largest group of texts that share a minimum."""
    keys = sample.select("doc_id", F.posexplode("minima").alias("i", "minimum")).distinct()
    sizes = keys.groupBy("i", "minimum").agg(F.count("*").alias("n"))
    weights = keys.join(sizes, ["i", "minimum"]).groupBy("doc_id").agg((1 / F.max("n")).alias("weight"))
    # One row per sampled document: bounded like the sample.
    return sample.drop("minima").join(F.broadcast(weights), "doc_id")


def labelled(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """The bounded labelled sample: doc_id, text, toxic, minima; one row per labelled document row."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    # At most ``limit`` rows of 12 bytes.
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    schema = found.select("doc_id", "text", "toxic").schema.add("minima", ArrayType(LongType()))
    return found.select("doc_id", "text", "toxic").mapInArrow(_with_minima, schema)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = re.compile(WORDS).findall
    for batch in batches:
        seen: dict[str, list[float]] = defaultdict(lambda: [0.0, 0.0])
        for text, toxic, weight in zip(*(batch[c].to_pylist() for c in ("text", "toxic", "weight")), strict=True):
            for sign in {s for w in set(words((text or "").lower())) for s in signs(w)}:
                seen[sign][toxic] += weight
        yield pa.RecordBatch.from_arrays(
            [pa.array([*seen], pa.string()), *(pa.array([v[i] for v in seen.values()], pa.float64()) for i in (1, 0))],
            ["sign", "toxic", "clean"],
        )


def choose_voters(sample: DataFrame, limit: int) -> tuple[str, ...]:
    """The signs with the highest z-scores of smoothed log-odds, ``limit`` of each kind."""
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.sum("weight").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return ()
    counts = sample.select("text", "toxic", "weight").mapInArrow(_frequencies, "sign string, toxic double, clean double")
    counts = counts.groupBy("sign").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(a / (toxic - F.col("a") + 0.5)) - F.log(b / (clean - F.col("b") + 0.5))
    error = F.sqrt(1 / a + 1 / b + 1 / (toxic - F.col("a") + 0.5) + 1 / (clean - F.col("b") + 0.5))
    scored = counts.where(F.col("a") >= 3).withColumn("z", odds / error).where(F.col("z") >= MIN_Z)
    best: list[str] = []
    for kind in ("w:", "p:"):
        top = scored.where(F.col("sign").startswith(kind)).orderBy(F.desc("z"), "sign").limit(limit).collect()
        best += [r["sign"] for r in top]
    return tuple(sorted(best))


def _votes(voters: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counting = Counting(voters)
        for batch in batches:
            rows = [counting(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "toxic": batch["toxic"],
                    "weight": batch["weight"],
                    "n_words": pa.array([n for n, _ in rows], pa.int64()),
                    "voter": pa.array([[*v.keys()] for _, v in rows], pa.list_(pa.int32())),
                    "times": pa.array([[*v.values()] for _, v in rows], pa.list_(pa.int32())),
                }
            )

    return run


def label_model(votes: np.ndarray, of: np.ndarray, rounds: int = EM_ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of class 1, vote rates by class, and weights of the voters.

    ``votes`` is 0 or 1 by text and voter. A voter that does not fire abstains,
    which says nothing; only the last one, the given label, votes both ways. The
    balance of the classes is that of the given labels. ``of`` weighs the texts.
    A voter's weight is 1 over the sum of its squared correlations inside the
    classes, itself included, so copies of a voter count once together. The given
    label anchors the classes and keeps its full weight.
    """
    posterior = 0.02 + 0.96 * votes[:, -1]
    weights = np.ones(votes.shape[1])
    balance = np.log((of @ votes[:, -1] + 0.5) / (of @ (1 - votes[:, -1]) + 0.5))
    for step in range(rounds):
        mass = np.array([of @ (1 - posterior), of @ posterior])
        sums = np.vstack([(of * (1 - posterior)) @ votes, (of * posterior) @ votes])
        rates = (sums + 0.1) / (mass + 0.2)[:, None]
        rates[:, -1] = np.clip(rates[:, -1], *GIVEN_RATES)
        if step == 2:  # correlations are estimated once the classes have settled
            left = votes - rates[0] - posterior[:, None] * (rates[1] - rates[0])
            spread = np.sqrt(of @ left**2 / of.sum()) + 1e-9
            correlation = (left.T * of) @ left / of.sum() / np.outer(spread, spread)
            weights[:-1] = 1 / np.maximum(1, (np.maximum(correlation[:-1, :-1], 0) ** 2).sum(0))
        fired = np.log(rates[1] / rates[0]) * weights
        silent = np.zeros_like(fired)
        silent[-1] = np.log((1 - rates[1, -1]) / (1 - rates[0, -1])) * weights[-1]
        logit = balance + votes @ fired + (1 - votes) @ silent
        posterior = sigmoid(logit)
    return posterior, rates, weights


def logistic(x: np.ndarray, y: np.ndarray, of: np.ndarray, penalty: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights by Newton steps; y are probabilities. The intercept is not penalised."""
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[0] = 1e-6
    for _ in range(rounds):
        p = sigmoid(x @ w)
        gradient = x.T @ (of * (p - y)) + ridge * w
        step = np.linalg.solve((x * (of * p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(ridge), gradient)
        w -= step * min(1.0, 4.0 / max(1e-12, float(np.abs(x @ step).max())))
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED, max_voters: int = MAX_VOTERS) -> Model:
    """Learn from the labelled rows; the driver holds votes of at most ``limit`` documents."""
    sample = materialize(labelled(docs, labels, limit), "toxicity-sample")
    sample = materialize(weighted(sample), "toxicity-weighted")
    voters = choose_voters(sample, max_voters)
    if not voters:
        return Model((), ())
    found = sample.select("text", "toxic", "weight").mapInArrow(
        _votes(voters), "toxic int, weight double, n_words long, voter array<int>, times array<int>"
    )
    rows = found.limit(2 * limit).toArrow()
    n_words = rows["n_words"].to_numpy()
    counts = np.zeros((len(n_words), len(voters)), np.float32)
    for i, (v, n) in enumerate(zip(rows["voter"].to_pylist(), rows["times"].to_pylist(), strict=True)):
        counts[i, v] = n
    given = rows["toxic"].to_numpy().astype(float)
    of = rows["weight"].to_numpy()
    posterior, rates, _ = label_model(np.hstack([counts > 0, given[:, None]]).astype(float), of)
    weights = logistic(features(n_words, counts), posterior, of)
    return Model(voters, tuple(weights), tuple(zip(*rates.tolist(), strict=True)))


def scorer(model: Model, text: Column) -> Column:
    """Score of a text column, 0 to 1."""

    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counting, weights = Counting(model.voters), np.array(model.weights)
        for texts in series:
            if not model.voters:
                yield pd.Series(np.zeros(len(texts)))
                continue
            counts, n_words = np.zeros((len(texts), len(model.voters)), np.float32), np.zeros(len(texts))
            for i, value in enumerate(texts):
                n_words[i], votes = counting(value if isinstance(value, str) else None)
                for voter, n in votes.items():
                    counts[i, voter] = n
            yield pd.Series(sigmoid(features(n_words, counts) @ weights))

    run.__annotations__ = {"series": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "double")(text)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``_toxicity`` and ``_held_out``; labels of held-out rows are not read."""
    learn = labels.where(~fold("doc_id", 3, 1))
    model = fit(docs, learn)
    return docs.withColumn("_held_out", fold("doc_id", 3, 1)).withColumn("_toxicity", scorer(model, F.col("text")))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that are not predicted toxic."""
    session(spark)
    found = score(whole_rows(docs, "doc_id", "text"), table(spark, sf_dir, "labels"))
    return found.where(F.col("_toxicity") < THRESHOLD).select("_row.*")


@query()
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id",
        F.col("_held_out").alias("held_out"),
        F.col("_toxicity").alias("score"),
        (F.col("_toxicity") >= THRESHOLD).cast("int").alias("predicted"),
    )
