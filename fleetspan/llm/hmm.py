"""Hidden Markov language model.

Latent states emit word classes (a hash of a word's edges and length); a word
of a class has the share of its add-0.1 count in the class. So the model is
P(words) = sum over state paths of transitions x P(class | state) x P(word |
class), a proper distribution over word sequences that end with an end token.

1. Tasks cut texts into tokens and write them as blocks: per token two bytes
   for the class and one for the word's place among the block's words of that
   class, with the block's own vocabulary and counts.
2. Spark adds up the counts of each word over all blocks and hands them back
   to the blocks that asked, one row per block and word, not per token.
3. Baum-Welch: tasks sum expected counts over all training texts by scaled
   forward and backward passes; partial sums are added on the executors and
   the driver gets a fixed number of matrices of fixed size per round.
4. Scaled forward recursion gives each whole text's exact likelihood.

Defined results: a null text is an empty one: just the end token. Texts may
have any length. Without training rows all counts are 0. Null keys are not
held out. Repeated rows are scored one by one; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetspan.llm.common import fold, query, table
from fleetspan.session import materialize

STATES, CLASSES = 6, 1 << 14
#: Rounds of Baum-Welch over all training texts, and texts that the first guess is made from.
ROUNDS, SEED_TEXTS = 3, 300
#: Tokens of a block, and of the texts that one pass works on together.
BLOCK_TOKENS, PASS_TOKENS = 3_000_000, 400_000
#: Tokens of the corpus distribution that each state's emissions are smoothed with.
SMOOTHING = 200.0
#: Numbers of a piece of the expected counts, and tasks that add up the pieces of all tasks.
PIECE, ADDERS = 8192, 8
#: The class of the end token.
END = CLASSES
ADD = 0.1


def word_class(word: bytes) -> int:
    """Words with equal edges and about equal length share a class."""
    return xxhash.xxh64_intdigest(b"%s|%s|%d" % (word[:3], word[-3:], min(6, len(word)))) % CLASSES


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of texts, and after each block rows of its vocabulary."""
    part, number, tokens = TaskContext.get().partitionId(), 0, 0
    index: dict[bytes, int] = {}  # word -> place in the lists below
    words: list[bytes] = []
    codes: list[int] = []  # class << 32 | place among the block's words of that class
    counts: list[int] = []
    filled: dict[int, int] = {}
    texts: tuple[list, ...] = ([], [], [], [])

    def rows(**columns: list) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        types = {
            "block": pa.string(), "doc_id": key_type, "held_out": pa.bool_(), "classes": pa.binary(), "places": pa.binary(),
            "words": pa.list_(pa.binary()), "codes": pa.list_(pa.int64()), "counts": pa.list_(pa.int64()),
        }
        given = {"block": [f"{part}-{number}"] * n, **columns}
        return pa.RecordBatch.from_arrays([pa.array(given.get(c, [None] * n), t) for c, t in types.items()], [*types])

    def written() -> pa.RecordBatch:
        made = rows(**dict(zip(("doc_id", "held_out", "classes", "places"), texts, strict=True)))
        for column in texts:
            column.clear()
        return made

    def vocabulary() -> Iterator[pa.RecordBatch]:
        for i in range(0, len(words), 20_000):
            s = slice(i, i + 20_000)
            yield rows(words=[words[s]], codes=[codes[s]], counts=[counts[s]])
        for held in (index, words, codes, counts, filled):
            held.clear()

    for batch in batches:
        key_type = batch["doc_id"].type
        for key, held, text in zip(*(batch[c].to_pylist() for c in ("doc_id", "held_out", "text")), strict=True):
            at = []
            for w in (text or b"").lower().split():
                i = index.get(w)
                if i is None:
                    i = index[w] = len(words)
                    c = word_class(w)
                    p = filled[c] = filled.get(c, -1) + 1
                    words.append(w)
                    codes.append(c << 32 | p)
                    counts.append(0)
                at.append(i)
                if not held:
                    counts[i] += 1
            found = np.array([codes[i] for i in at], np.int64)
            place = found & 0xFFFFFFFF
            small = np.uint8 if not len(place) or place.max() < 256 else np.uint32
            row = (key, held, (found >> 32).astype(np.uint16).tobytes(), place.astype(small).tobytes())
            for column, value in zip(texts, row, strict=True):
                column.append(value)
            tokens += len(at)
            if tokens >= BLOCK_TOKENS:
                yield written()
                yield from vocabulary()
                tokens, number = 0, number + 1
        yield written()
    if words:
        yield from vocabulary()


def encode(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Texts as blocks of tokens, and the blocks' vocabularies; written once to the shared folder."""
    rows = docs.select("doc_id", fold("doc_id", 10, 0).alias("held_out"), F.col("text").cast("string").cast("binary").alias("text"))
    key = rows.schema["doc_id"].dataType.simpleString()
    schema = (
        f"block string, doc_id {key}, held_out boolean, classes binary, places binary, "
        "words array<binary>, codes array<long>, counts array<long>"
    )
    both = materialize(rows.mapInArrow(_encode, schema), "hmm-blocks")
    texts = both.where(F.col("classes").isNotNull()).select("block", "doc_id", "held_out", "classes", "places")
    asked = both.where(F.col("words").isNotNull())
    asked = asked.select("block", F.explode(F.arrays_zip("words", "codes", "counts")).alias("w")).select(
        "block", F.col("w.words").alias("word"), F.col("w.codes").alias("code"), F.col("w.counts").alias("count")
    )
    return texts, asked


class Words:
    """Totals of the training words, by class: small enough for the driver whatever the corpus."""

    def __init__(self, totals: DataFrame, texts: int):
        by_class = totals.where("first").groupBy(F.shiftrightunsigned("code", 32).cast("int").alias("class"))
        rows = by_class.agg(F.sum("total").alias("n"), F.sum((F.col("total") > 0).cast("long")).alias("v")).toArrow()
        self.n, self.v = np.zeros(CLASSES + 1, np.int64), np.zeros(CLASSES + 1, np.int64)
        at = rows["class"].to_numpy()
        self.n[at], self.v[at] = rows["n"].to_numpy(), rows["v"].to_numpy()
        self.texts = texts
        self.n[END], self.v[END] = texts, int(texts > 0)

    @property
    def share(self) -> np.ndarray:
        """Smoothed share of each class in the training tokens."""
        return (self.n + ADD * (self.v + 1)) / (self.n + ADD * (self.v + 1)).sum()


def lengthwise(rows: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Texts of about equal length together: their places, lengths, and tokens in order of time."""
    lengths = np.array([len(r) for r in rows])
    order = np.argsort(-lengths, kind="stable")
    start = 0
    while start < len(order):
        end = start + max(1, int(np.searchsorted(np.cumsum(lengths[order[start:]]), PASS_TOKENS, "right")))
        part = order[start:end]
        steps = np.concatenate([np.arange(lengths[i]) for i in part])
        flat = np.concatenate([rows[i] for i in part])
        yield part, lengths[part], flat[np.argsort(steps, kind="stable")]
        start = end


class Chain:
    """Initial, transition and emission probabilities."""

    def __init__(self, initial: np.ndarray, step: np.ndarray, emit: np.ndarray):
        self.initial, self.step, self.emit = initial, step, emit  # emit: class x state

    def forward(self, lengths: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Scaled forward variables, scales, log10 likelihoods, and where each time starts.

        ``lengths`` fall, so the texts still running at a time come first.
        """
        running = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), "right")
        starts = np.concatenate([[0], np.cumsum(running)])
        alpha = self.emit[tokens]
        scale = np.empty(len(tokens))
        total = np.zeros(len(lengths))
        for t in range(len(running)):
            a = alpha[starts[t] : starts[t + 1]]
            n = len(a)
            a *= self.initial if t == 0 else alpha[starts[t - 1] : starts[t - 1] + n] @ self.step
            c = scale[starts[t] : starts[t + 1]] = a @ np.ones(a.shape[1])
            a /= c[:, None]
        logs = np.log10(scale)
        for t in range(len(running)):
            total[: running[t]] += logs[starts[t] : starts[t + 1]]
        return alpha, scale, total, starts

    def expected(self, lengths: np.ndarray, tokens: np.ndarray, into: Counts) -> None:
        """Add the expected counts of these texts."""
        alpha, scale, total, starts = self.forward(lengths, tokens)
        emitted = self.emit[tokens] / scale[:, None]
        beta, back = np.ones((len(lengths), alpha.shape[1])), self.step.T.copy()
        moves = np.zeros_like(self.step)
        for t in range(len(starts) - 2, -1, -1):
            n = starts[t + 1] - starts[t]
            weighted = emitted[starts[t] : starts[t + 1]] * beta[:n]
            alpha[starts[t] : starts[t + 1]] *= beta[:n]  # now the posterior of the states
            if t:
                moves += alpha[starts[t - 1] : starts[t - 1] + n].T @ weighted
                beta[:n] = weighted @ back
        into.step += moves * self.step
        into.initial += alpha[: starts[1]].sum(0)
        for k in range(alpha.shape[1]):
            into.emit[:, k] += np.bincount(tokens, alpha[:, k], CLASSES + 1)
        into.score += total.sum()


class Counts:
    """Expected counts of a Baum-Welch round."""

    def __init__(self, states: int = STATES):
        self.initial, self.step = np.zeros(states), np.zeros((states, states))
        self.emit, self.score = np.zeros((CLASSES + 1, states)), np.zeros(1)

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in (self.initial, self.step, self.emit, self.score)])

    def load(self, flat: np.ndarray) -> Counts:
        at = 0
        for p in (self.initial, self.step, self.emit, self.score):
            p += flat[at : at + p.size].reshape(p.shape)
            at += p.size
        return self

    def chain(self, share: np.ndarray) -> Chain:
        """Smoothed probabilities from the counts."""
        initial = (self.initial + 1) / (self.initial + 1).sum()
        step = (self.step + 1) / (self.step + 1).sum(1, keepdims=True)
        emit = self.emit + SMOOTHING * share[:, None]
        return Chain(initial, step, emit / emit.sum(0))


def _classes(raw: bytes) -> np.ndarray:
    return np.append(np.frombuffer(raw, np.uint16), np.uint16(END)).astype(np.int64)


def _round(chain: Chain):
    """Expected counts of the texts of a task, in pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, rows, tokens = Counts(len(chain.initial)), [], 0

        def work() -> None:
            for _, lengths, part in lengthwise(rows):
                chain.expected(lengths, part, counts)
            rows.clear()

        for batch in batches:
            for raw in batch["classes"].to_pylist():
                rows.append(_classes(raw))
                tokens += len(rows[-1])
                if tokens >= BLOCK_TOKENS:
                    work()
                    tokens = 0
        work()
        flat = counts.flat()
        pieces = [flat[i : i + PIECE] for i in range(0, len(flat), PIECE)]
        yield pa.RecordBatch.from_pydict(
            {"piece": pa.array(range(len(pieces)), pa.int32()), "raw": pa.array([p.tobytes() for p in pieces], pa.binary())}
        )

    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, raw in zip(batch["piece"].to_pylist(), batch["raw"].to_pylist(), strict=True):
            total[piece] = total.get(piece, 0) + np.frombuffer(raw)
    yield pa.RecordBatch.from_pydict(
        {"piece": pa.array([*total], pa.int32()), "raw": pa.array([p.tobytes() for p in total.values()], pa.binary())}
    )


def first_guess(sample: list[np.ndarray], share: np.ndarray, states: int = STATES) -> Chain:
    """States as the parts of a mixture of whole texts, fitted on a few of them."""
    counts = Counts(states)
    draw = np.random.default_rng(5)
    seen = np.array([np.bincount(r, minlength=CLASSES + 1) for r in sample], float) if sample else np.zeros((0, CLASSES + 1))
    if len(seen):
        unit = np.sqrt(seen / np.maximum(1, seen.sum(1, keepdims=True)))
        seeds = [int(seen.sum(1).argmax())]
        while len(seeds) < min(states, len(seen)):  # texts unlike those chosen before
            seeds.append(int((unit @ unit[seeds].T).max(1).argmin()))
        part = np.full((len(seen), states), 1e-3)
        part[np.arange(len(seen)), (unit @ unit[seeds].T).argmax(1)] = 1
        for _ in range(10):
            part /= part.sum(1, keepdims=True)
            emit = part.T @ seen + 50 * share
            logs = seen @ np.log(emit / emit.sum(1, keepdims=True)).T + np.log(part.sum(0) + 1)
            part = np.exp(np.clip(logs - logs.max(1, keepdims=True), -30, 0))
        part /= part.sum(1, keepdims=True)
        counts.emit += (part.T @ seen).T
        counts.initial += part.sum(0)
        counts.step += 0.95 * np.diag(part.T @ seen.sum(1)) + 0.05 * seen.sum() / states**2
    counts.emit *= 1 + 0.01 * draw.random(counts.emit.shape)
    return counts.chain(share)


def train(texts: DataFrame, share: np.ndarray, rounds: int = ROUNDS) -> Chain:
    """Baum-Welch over all training texts."""
    learn = texts.where(~F.col("held_out")).select("classes")
    chosen = learn.where(F.length("classes") > 0).orderBy(F.xxhash64("classes")).limit(SEED_TEXTS).collect()
    chain = first_guess([_classes(r["classes"]) for r in chosen], share)
    for _ in range(rounds if chosen else 0):
        parts = learn.mapInArrow(_round(chain), "piece int, raw binary").repartition(ADDERS, "piece")
        pieces = {r["piece"]: np.frombuffer(r["raw"]) for r in parts.mapInArrow(_add, "piece int, raw binary").collect()}
        if pieces:
            chain = Counts().load(np.concatenate([pieces[i] for i in sorted(pieces)])).chain(share)
    return chain


def _score(chain: Chain, words: Words, n: int, v: int):
    """Scores of the texts of a block, given the totals of its words."""
    in_class = np.log10(words.n + ADD * (words.v + 1))
    in_all = np.log10(n + ADD * (v + 1))
    end = np.log10(words.texts + ADD)

    def run(texts: pd.DataFrame, totals: pd.DataFrame) -> pd.DataFrame:
        texts = texts.reset_index(drop=True)
        codes, found = totals["code"].to_numpy(np.int64), totals["total"].to_numpy(np.int64)
        order = np.argsort(codes)
        codes, found = codes[order], found[order]
        rows = [_classes(raw) for raw in texts["classes"]]
        sizes = np.array([len(r) - 1 for r in rows])
        place = [np.frombuffer(p, np.uint8 if len(p) == k else np.uint32).astype(np.int64) for p, k in zip(texts["places"], sizes, strict=True)]
        asked = np.concatenate([np.zeros(0, np.int64), *(r[:-1] for r in rows)]) << 32
        asked |= np.concatenate([np.zeros(0, np.int64), *place])
        count = found[np.searchsorted(codes, asked)] if len(codes) else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(rows)), sizes)
        logs = np.log10(count + ADD)
        total = np.bincount(owner, logs, len(rows)) + end
        within = total - np.bincount(owner, in_class[asked >> 32], len(rows)) - in_class[END]
        score = np.zeros(len(rows))
        for part, lengths, tokens in lengthwise(rows):
            score[part] = chain.forward(lengths, tokens)[2]
        return pd.DataFrame(
            {
                "doc_id": texts["doc_id"],
                "held_out": texts["held_out"],
                "n_tokens": sizes + 1,
                "n_known": np.bincount(owner, count > 0, len(rows)).astype(np.int64) + int(words.texts > 0),
                "train_tokens": n,
                "base_score": total - (sizes + 1) * in_all,
                "score": score + within,
            }
        )

    return run


def score(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Scores of every row, learned from the rows that are not held out."""
    texts, asked = encode(docs)
    by_word = Window.partitionBy("word")
    totals = asked.select(
        "block",
        "code",
        F.sum("count").over(by_word).alias("total"),
        (F.row_number().over(by_word.orderBy("block")) == 1).alias("first"),
    )
    totals = materialize(totals, "hmm-totals")
    words = Words(totals, texts.where(~F.col("held_out")).count())
    chain = train(texts, words.share, rounds)
    n, v = int(words.n.sum()), int(words.v.sum())
    key = texts.schema["doc_id"].dataType.simpleString()
    return (
        texts.groupBy("block")
        .cogroup(totals.select("block", "code", "total").groupBy("block"))
        .applyInPandas(
            _score(chain, words, n, v),
            f"doc_id {key}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
        )
    )


@query()
def op3_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
