import zlib

import numpy as np
from pyspark.sql import functions as F

from fleetspan.llm import toxicity

SCHEMA = "doc_id long, text string, lang string, score double"
CLEAN = "the weather in the valley was mild and people of the town went out to the fields with bread".split()


def made(spark):
    draw = np.random.default_rng(4)
    rows, labels = [], []
    for i in range(400):
        words = [str(w) for w in draw.choice(CLEAN, 25)] + [f"n{draw.integers(1000)}"]
        bad = i % 5 == 0
        if bad:
            for _ in range(3):
                words.insert(int(draw.integers(len(words))), str(draw.choice(["vilewort", "grotling", "gruntabc", "gruntxyz"])))
        rows.append((i, " ".join(words), "en", 0.0))
        labels.append((i, 1, int(bad)))
    rows += [(1000, None, "en", 0.0), (1001, "", None, 0.0), (None, "vilewort grotling " + rows[1][1], "en", 0.0), (0, rows[0][1], "en", 0.0)]
    rows += [(1002, "bread " * 50_000, "en", 0.0)]
    labels += [(None, 1, 1), (5000, 1, 1), (7, 1, None)]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows


def test_held_out_accuracy_and_odd_rows(spark):
    docs, labels, rows = made(spark)
    out = toxicity.score(docs, labels).collect()
    assert len(out) == len(rows)
    held = [r for r in out if r._held_out and r.doc_id < 400]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in held)
    right = [(r._toxicity >= toxicity.THRESHOLD) == (r.doc_id % 5 == 0) for r in held]
    assert np.mean(right) > 0.97
    by_key = {r.doc_id: r for r in out}
    assert by_key[None]._toxicity > 0.7 and not by_key[None]._held_out
    assert all(0 <= r._toxicity <= 1 for r in out)
    assert max(by_key[k]._toxicity for k in (1000, 1001, 1002)) < 0.7


def test_no_labels(spark):
    docs, labels, _ = made(spark)
    assert toxicity.score(docs, labels.limit(0)).where(F.col("_toxicity") != 0).count() == 0
    assert toxicity.score(docs, labels.where("toxic = 1")).where(F.col("_toxicity") != 0).count() == 0
    assert toxicity.score(docs.limit(0), labels).count() == 0


def test_label_model_finds_accuracies_and_copies():
    draw = np.random.default_rng(5)
    y = draw.random(4000) < 0.3
    rates = [(0.02, 0.6), (0.05, 0.4), (0.01, 0.3)]
    votes = np.array([np.where(y, draw.random(4000) < b, draw.random(4000) < a) for a, b in rates]).T
    votes = np.hstack([votes, votes[:, :1], np.where(draw.random(4000) < 0.01, ~y, y)[:, None]]).astype(float)
    posterior, found, weights = toxicity.label_model(votes, np.ones(4000))
    assert ((posterior > 0.5) == y).mean() > 0.95
    assert np.allclose(found[1, :3], [b for _, b in rates], atol=0.08)
    assert weights[0] < 0.65 and weights[3] < 0.65 < weights[2]  # the copied voter counts once
