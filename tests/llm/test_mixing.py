import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetspan.llm import mixing

DOCS = "doc_id long, text string, rate string, `odd name` int"


def made(spark):
    good = [(i, f"plain words number {'abcdefghij'[i % 10]} of text that goes on and on with words {'klmnop'[i % 6]}", "x", 1) for i in range(60)]
    low = [(100 + i, "BUY!!! NOW$$$ " * (3 + i % 5), "x", 1) for i in range(40)]
    odd = [(200, None, None, None), (201, "", "x", 1), (None, "no key", "x", 1), (1, good[1][1], "x", 1), (202, "word " * 30_000, "x", 1)]
    labels = [(i, "good") for i in range(0, 60, 2)] + [(100 + i, "low") for i in range(0, 40, 2)] + [(None, "good"), (999, "low"), (3, None)]
    return spark.createDataFrame(good + low + odd, DOCS), spark.createDataFrame(labels, "doc_id long, domain string")


def test_rates_meet_targets_and_keep_every_row(spark):
    docs, labels = made(spark)
    rows = mixing.mix(docs, labels, {"good": 0.4, "low": 0.6}).collect()
    assert len(rows) == docs.count()
    n = np.array([r["_tokens"] for r in rows], float)
    p = np.array([r["_posteriors"] for r in rows])
    rate = np.array([r["_rate"] for r in rows])
    assert (rate >= 0).all() and np.allclose(p.sum(1), 1)
    total = (n * rate) @ p
    assert np.allclose(total / total.sum(), [0.4, 0.6], atol=1e-4)
    by_key = {r["doc_id"]: r for r in rows}
    assert by_key[1]["_posteriors"][0] > 0.9 and by_key[101]["_posteriors"][1] > 0.9
    assert by_key[200]["_tokens"] == by_key[201]["_tokens"] == 0 and by_key[202]["_tokens"] == 30_000
    assert by_key[1]["odd name"] == 1


def test_rates_against_plain_projected_gradient(spark):
    draw = np.random.default_rng(1)
    n, p = draw.integers(1, 50, 40), draw.dirichlet([0.5, 0.5, 0.5], 40)
    docs = spark.createDataFrame([(i, int(a), [float(x) for x in b]) for i, (a, b) in enumerate(zip(n, p))], "doc_id long, _tokens long, _posteriors array<double>")
    targets = [0.7, 0.2, 0.1]
    rows = mixing.fit_rates(docs, targets).orderBy("doc_id").collect()
    rate = np.array([r["_rate"] for r in rows])
    a = (n[:, None] * p).T
    assert np.abs(a @ rate - np.array(targets) * n.sum()).sum() < 1e-4 * n.sum()
    r, l = np.ones(40), np.linalg.norm(a, 2) ** 2
    for _ in range(20_000):
        r = np.maximum(0, r - a.T @ (a @ r - np.array(targets) * n.sum()) / l)
    assert np.allclose(a @ r, a @ rate, rtol=1e-3)


def test_empty_tables(spark):
    docs, labels = made(spark)
    assert mixing.mix(docs.limit(0), labels, {"good": 1.0}).count() == 0
    rows = mixing.mix(docs, labels.limit(0), {"good": 0.5, "low": 0.5}).collect()
    assert len(rows) == docs.count() and all(abs(r["_rate"] - 1) < 0.5 for r in rows)


def test_features_of_texts_without_letters(spark):
    docs = spark.createDataFrame([(0, None), (1, ""), (2, " "), (3, "$$"), (4, "AB")], "doc_id long, text string")
    rows = mixing.with_features(docs, ["ab"]).orderBy("doc_id").collect()
    assert [(r["_tokens"], r["_symbols"], r["_capitals"]) for r in rows] == [(0, 0, 0), (0, 0, 0), (0, 0, 0), (1, 10, 0), (1, 0, 10)]


def by_hand(words):
    classifier = mixing.Classifier.__new__(mixing.Classifier)
    classifier.domains, classifier.vocabulary = ["a", "b", "c"], words
    classifier.prior, classifier.bins = [-1.0, -2.0, -3.0], {f: [[0.5 * k + 0.1 * b for b in range(n)] for k in range(3)] for f, n in mixing.BINS.items()}
    classifier.present = [[-((i * (k + 2)) % 7) / 3 for i in range(len(words))] for k in range(3)]
    return classifier


def test_features_and_gains_against_plain_python(spark):
    words = [f"w{chr(97 + i % 26)}{i}" for i in range(60)] + ["straße", "ñu"]
    classifier = by_hand(words)
    draw = np.random.default_rng(3)
    odd = ["STRASSE Straße (straße) \"Ñu\", ñu!\tNo\n\n[x]^\\ @a_b~ <i>{=} 😀Ab", "... !!! ...", "", None]
    texts = [" ".join(draw.choice([*words, "other", "Wa0,", "(WB1)", "##"], 40)) for _ in range(20)] + odd
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in mixing.with_posteriors(docs, classifier).collect():
        text = row["text"] or ""
        tokens = text.split()
        found = {w.strip(mixing.MARKS).lower() for w in tokens} & set(words)
        share = lambda marks: min(10, int(np.ceil(np.cbrt(sum(c in marks for c in text) / max(1, len(text))) * 10)))  # noqa: B023, E731
        bins = {"length": int(np.log2(len(tokens) + 1)), "variety": int(np.ceil(len(set(tokens)) / max(1, len(tokens)) * 10))}
        bins |= {"symbols": share(mixing.SYMBOLS), "capitals": share(mixing.CAPITALS)}
        logits = np.array([classifier.prior[k] + sum(classifier.bins[f][k][b] for f, b in bins.items()) for k in range(3)])
        for w in found:
            logs = np.array([p[words.index(w)] for p in classifier.present])
            logits += logs - logs.mean()
        odds = np.exp(logits - logits.max())
        assert row["_tokens"] == len(tokens) and np.allclose(row["_posteriors"], odds / odds.sum())


def test_work_on_whole_texts_is_done_once(spark):
    docs, _ = made(spark)
    plan = mixing.with_posteriors(docs, by_hand(["plain", "words"])).drop("text")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_distinct(") == plan.count("split(") == plan.count("regexp_replace(") == 1
    assert "translate(text" not in plan and "translate(coalesce(" not in plan


def test_too_many_domains(spark):
    docs, labels = made(spark)
    with pytest.raises(ValueError):
        mixing.mix(docs, labels, {f"d{i}": 1.0 for i in range(mixing.MAX_DOMAINS + 1)})


def test_no_python_in_the_plan(spark):
    docs, labels = made(spark)
    plan = mixing.mix(docs, labels, {"good": 0.5, "low": 0.5})._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and F is not None
