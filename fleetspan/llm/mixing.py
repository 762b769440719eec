"""Mixing to target weights with soft membership.

A naive Bayes classifier, learned from a labelled table, gives each document
posteriors over the domains. Nonnegative rates (how often a document is to be
used) are then fitted so that the expected tokens of each domain, the sum of
rate x tokens x posterior, meet the targets: least squares by projected
gradient. Each round sums K + K^2 numbers over all documents and sends K numbers
back; the rates themselves never leave the executors. Gradients are scaled by
the inverse of the domains' second moments over the documents in use. Only DataFrame functions are used.

Defined results: null and empty texts have no tokens and get the posteriors
of their features and a rate like any other row. Labels that are null or of
unknown documents are ignored; of repeated labels of a document the smallest
domain counts. Without labels the target domains are equally likely. A target
for a domain that no label names is ignored; a domain without a target has
target 0. Rates for an empty table are an empty table. Repeated rows are
rated one by one; further columns pass through; no row is dropped.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspan.llm.common import query, session, table, whole_rows
from fleetspan.session import materialize

#: Labelled documents that the classifier is fitted on, chosen by a hash of their key.
MAX_LABELLED = 10_000
#: Telling words of each domain, and the z-score from which a word is telling.
WORDS_PER_DOMAIN = 48
MIN_Z = 4.0
#: Most domains; the driver holds a few numbers for each pair of them.
MAX_DOMAINS = 64
#: Rounds of the projected gradient at most, rounds between two written states, and the miss at which it ends.
ROUNDS, ROUNDS_WRITTEN, TOLERANCE = 60, 6, 1e-6
#: Bins of each feature.
BINS = {"length": 24, "variety": 11, "symbols": 11, "capitals": 11}

# Symbols that running text hardly has, marks around words, and capital letters.
SYMBOLS = "!#$%&*|<>{}[]=_~^\\@"
MARKS = ".,;:!?\"'()[]{}|#$%&*"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Runs of what is neither a symbol nor a capital letter.
UNCOUNTED = r"[^A-Z!#$%&*|<>{}\[\]=_~^\\@]+"

#: Targets of the registered query by domain of the labels.
TARGETS = {"good": 0.85, "low": 0.1, "toxic": 0.05}


def label_domains(labels: DataFrame) -> DataFrame:
    """doc_id and domain of a table with quality and toxic: toxic before low before good."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "good")
    return labels.select("doc_id", domain.alias("domain"))


def tokens_of(text: str) -> Column:
    """Tokens of a text column: what stands between white space."""
    return F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"\s+"), lambda w: w != "")


def words_of(tokens: str) -> Column:
    """Lower-case tokens without the marks around them."""
    return F.transform(tokens, lambda w: F.lower(F.btrim(w, F.lit(MARKS))))


def telling_words(sample: DataFrame, domains: list[str], per_domain: int = WORDS_PER_DOMAIN) -> list[str]:
    """Words with the highest z-scores of log-odds of a domain against the others.

    ``sample``: domain, text. Texts with the same minimum of a hash over their
    five-word windows count once, so copies aren't many witnesses.
    """
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("tokens") - 4))
    texts = (
        sample.withColumn("tokens", tokens_of("text"))
        .withColumn("minimum", F.array_min(F.transform(starts, lambda i: F.xxhash64(F.slice("tokens", i, 5)))))
        .groupBy("domain", "minimum")
        .agg(F.any_value("tokens").alias("tokens"))
    )
    texts = texts.select("domain", F.array_distinct(words_of(F.array_distinct("tokens"))).alias("words"))
    texts = materialize(texts, "mixing-sample")
    sizes = {r["domain"]: r["n"] for r in texts.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    every = sum(sizes.values())
    counts = texts.select("domain", F.explode("words").alias("word")).where(F.length("word") > 1)
    counts = counts.groupBy("word").pivot("domain", domains).count().na.fill(0)
    counts = counts.withColumn("all", sum(F.col(f"`{d}`") for d in domains)).where(F.col("all") >= 5)
    found: set[str] = set()
    for d in domains:
        n, m = sizes.get(d, 0), every - sizes.get(d, 0)
        a, b = F.col(f"`{d}`") + 0.5, F.col("all") - F.col(f"`{d}`") + 0.5
        odds = F.log(a / (n + 1 - a)) - F.log(b / (m + 1 - b))
        error = F.sqrt(1 / a + 1 / b + 1 / (n + 1 - a) + 1 / (m + 1 - b))
        top = counts.select("word", (odds / error).alias("z")).where(F.col("z") >= MIN_Z)
        found |= {r["word"] for r in top.orderBy(F.desc("z"), "word").limit(per_domain).collect()}
    return sorted(found)


def with_features(docs: DataFrame, vocabulary: list[str], text: str = "text") -> DataFrame:
    """``docs`` with ``_tokens``, a bin of each feature and ``_hits``, the telling words."""
    value = F.coalesce(F.col(text), F.lit(""))
    tenth = lambda x: F.least(F.ceil(F.cbrt(x) * 10), F.lit(10)).cast("int")
    # What is used twice is a column of its own; characters are counted in the few that are left.
    parts = docs.withColumns(
        {
            "_parts": tokens_of(text),
            "_size": F.greatest(F.length(value), F.lit(1)),
            "_counted": F.regexp_replace(value, UNCOUNTED, ""),
        }
    ).withColumns(
        {
            "_tokens": F.size("_parts").cast("long"),
            "_distinct": F.array_distinct("_parts"),
            "_raised": F.length(F.translate("_counted", SYMBOLS, "")),
        }
    )
    variety = F.size("_distinct") / F.greatest(F.col("_tokens"), F.lit(1))
    # Words that several tokens give are found once.
    hits = F.array_intersect(words_of("_distinct"), F.array(*map(F.lit, vocabulary))) if vocabulary else F.array().cast("array<string>")
    return parts.withColumns(
        {
            "_hits": hits,
            "_length": F.least(F.floor(F.log2(F.col("_tokens") + 1)), F.lit(23)).cast("int"),
            "_variety": F.ceil(variety * 10).cast("int"),
            "_symbols": tenth((F.length("_counted") - F.col("_raised")) / F.col("_size")),
            "_capitals": tenth(F.col("_raised") / F.col("_size")),
        }
    ).drop("_parts", "_size", "_counted", "_distinct", "_raised")


class Classifier:
    """Naive Bayes: prior, bins and telling words, as column expressions."""

    def __init__(self, domains: list[str], vocabulary: list[str], rows: list, sizes: dict[str, int]):
        self.domains, self.vocabulary = domains, vocabulary
        seen = {(r["feature"], r["domain"], r["bin"]): r["n"] for r in rows}
        total = sum(sizes.values())
        self.prior = [math.log((sizes.get(d, 0) + 1) / (total + len(domains))) for d in domains]
        self.bins = {
            f: [[math.log((seen.get((f, d, str(b)), 0) + 0.5) / (sizes.get(d, 0) + 0.5 * n)) for b in range(n)] for d in domains]
            for f, n in BINS.items()
        }
        self.present = [
            [math.log((seen.get(("word", d, w), 0) + 0.1) / (sizes.get(d, 0) + 0.2)) for w in vocabulary] for d in domains
        ]

    def gains(self) -> Column:
        """The evidence of each word of ``_hits`` for each domain, against its mean over domains."""
        dealt: list[list[Column]] = [[] for _ in self.vocabulary]
        for w, logs in zip(self.vocabulary, zip(*self.present, strict=True), strict=True):
            mean = sum(logs) / len(logs)
            dealt[zlib.crc32(w.encode()) % len(dealt)] += [F.lit(w), F.array(*(F.lit(x - mean) for x in logs))]
        # A map is searched from its beginning, so the words are dealt over as many maps.
        maps = F.array(*(F.create_map(*pairs).cast("map<string,array<double>>") for pairs in dealt))
        place = lambda w: (F.crc32(w.cast("binary")) % len(dealt)).cast("int") + 1
        return F.transform("_hits", lambda w: F.element_at(F.element_at(maps, place(w)), w))

    def logits(self) -> list[Column]:
        """Log of the joint probability of each domain, from the bins and ``_gains``; absent words say nothing."""
        out = []
        for k in range(len(self.domains)):
            logit = F.lit(self.prior[k])
            for f, logs in self.bins.items():
                logit = logit + F.element_at(F.array(*map(F.lit, logs[k])), F.col(f"_{f}") + 1)
            if self.vocabulary:
                logit = logit + _total("_gains", k)
            out.append(logit)
        return out


def _total(gains: str, k: int) -> Column:
    """Sum of the gains for the k-th domain."""
    return F.aggregate(gains, F.lit(0.0), lambda s, g: s + F.element_at(g, k + 1))


def train(docs: DataFrame, labelled: DataFrame, domains: list[str], text: str = "text") -> Classifier:
    """Learn from a bounded number of labelled documents (doc_id, domain)."""
    known = labelled.where(F.col("domain").isin(domains) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.min("domain").alias("domain"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    # At most MAX_LABELLED rows of an id and a short text.
    sample = docs.select("doc_id", F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id").select("domain", "text")
    sample = materialize(sample, "mixing-labelled")
    vocabulary = telling_words(sample, domains)
    found = materialize(with_features(sample, vocabulary).drop("text"), "mixing-training")
    bins = [F.struct(F.lit(f).alias("feature"), F.col(f"_{f}").cast("string").alias("bin")) for f in BINS]
    words = F.transform("_hits", lambda w: F.struct(F.lit("word").alias("feature"), w.alias("bin")))
    rows = found.select("domain", F.explode(F.concat(F.array(*bins), words)).alias("s")).groupBy("domain", "s.feature", "s.bin")
    sizes = {r["domain"]: r["n"] for r in found.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    # Domains x (bins + vocabulary) rows at most.
    return Classifier(domains, vocabulary, rows.agg(F.count("*").alias("n")).collect(), sizes)


def with_posteriors(docs: DataFrame, classifier: Classifier, text: str = "text") -> DataFrame:
    """``docs`` with ``_tokens`` and ``_posteriors`` (in the order of the domains)."""
    found = with_features(docs, classifier.vocabulary, text)
    if classifier.vocabulary:
        found = found.withColumn("_gains", classifier.gains())
    found = found.withColumn("_logits", F.array(*classifier.logits()))
    found = found.withColumn("_odds", F.transform("_logits", lambda x: F.exp(x - F.array_max("_logits"))))
    total = F.aggregate("_odds", F.lit(0.0), lambda a, x: a + x)
    found = found.withColumn("_posteriors", F.transform("_odds", lambda x: x / total))
    return found.drop("_logits", "_odds", "_hits", "_gains", *(f"_{f}" for f in BINS))


def fit_rates(docs: DataFrame, targets: list[float], budget: float | None = None) -> DataFrame:
    """``docs`` with ``_rate``: nonnegative least squares on ``_tokens`` and ``_posteriors``.

    ``budget`` is the wanted number of tokens, by default as many as there are.
    ``docs`` is read once a round and should be a written table.
    """
    k = len(targets)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    state = docs.withColumn("_rate", F.lit(1.0))
    p = [F.element_at("_posteriors", i + 1) for i in range(k)]
    current, pending, every, wanted = F.col("_rate"), 0, None, np.zeros(k)
    for _ in range(ROUNDS):
        sums = state.select(current.alias("r"), "_tokens", "_posteriors")
        used = F.when(F.col("r") > 0, F.col("_tokens")).otherwise(0)
        got = sums.agg(
            F.sum("_tokens").alias("n"),
            *(F.sum(F.col("_tokens") * p[i] * F.col("r")).alias(f"s{i}") for i in range(k)),
            *(F.sum(used * p[i] * p[j]).alias(f"m{i}_{j}") for i, j in pairs),
        ).first()
        if not got["n"]:
            return state
        second = np.array([[got[f"m{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)])
        if every is None:  # the first round, where all rates are 1
            every, wanted = second, np.array(targets) / (sum(targets) or 1.0) * (budget or got["n"])
        miss = np.array([got[f"s{i}"] for i in range(k)]) - wanted
        if np.abs(miss).sum() <= TOLERANCE * wanted.sum():
            break
        # Rates at zero do not answer to the step, so the others' moments scale it; a share of all keeps it bounded.
        scale = np.linalg.pinv(0.9 * second + 0.1 * every + 1e-9 * got["n"] * np.eye(k))
        gradient = scale @ miss
        step = sum((p[i] * F.lit(float(gradient[i])) for i in range(k)), F.lit(0.0))
        current, pending = F.greatest(F.lit(0.0), current - step), pending + 1
        if pending == ROUNDS_WRITTEN:
            state, current, pending = materialize(state.withColumn("_rate", current), "mixing-rates"), F.col("_rate"), 0
    return state.withColumn("_rate", current)


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``_tokens``, ``_posteriors`` and ``_rate``; domains are in the order of their names.

    ``labelled``: doc_id and domain. ``keep_text``: whether the text stays.
    """
    domains = sorted(targets)
    if len(domains) > MAX_DOMAINS:
        raise ValueError(f"at most {MAX_DOMAINS} domains")
    found = with_posteriors(docs, train(docs, labelled, domains, text), text)
    found = materialize(found if keep_text else found.drop(text), "mixing-posteriors")
    return fit_rates(found, [targets[d] for d in domains])


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: all documents with ``n_tokens`` and ``rate``."""
    session(spark)
    rows = whole_rows(docs, "doc_id", "text", without=("n_tokens", "rate"))
    # The text is needed in the row only, where all of it stays.
    found = mix(rows, label_domains(table(spark, sf_dir, "labels")), TARGETS, keep_text=False)
    return found.select("_row.*", F.col("_tokens").alias("n_tokens"), F.col("_rate").alias("rate"))


@query()
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    found = mix(docs, label_domains(table(spark, sf_dir, "labels")), TARGETS, keep_text=False)
    shares = [F.element_at("_posteriors", i + 1).alias(f"p_{d}") for i, d in enumerate(sorted(TARGETS))]
    return found.select("doc_id", "source", F.col("_tokens").alias("n_tokens"), *shares, F.col("_rate").alias("rate"))
