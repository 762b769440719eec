import itertools

import numpy as np

from fleetspan.llm import quality
from fleetspan.llm.common import fold

SF_DIR = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.score(docs, labels).withColumn("held", fold("doc_id", 4, 2)).join(labels, "doc_id")
    rows = [(r.quality_score >= quality.THRESHOLD, r.quality) for r in found.where("held").collect()]
    good, bad = ([p for p, q in rows if q == label] for label in (1, 0))
    assert np.mean(good) >= 0.98 and 1 - np.mean(bad) >= 0.95


def test_sum_of_squares_is_the_sum_over_all_pairs():
    draw = np.random.default_rng(2)
    model = quality.Model(0.3, draw.normal(size=quality.FEATURES), draw.normal(size=(quality.FEATURES, quality.RANK)))
    texts = [quality.Featurizer()(t, s) for t, s in [("The cat | sat on THE mat!!", 26.0), ("", None), (None, 3.0), ("ab " * 500, 1500.0)]]
    starts = np.cumsum([0, *(len(f) for f, _ in texts[:-1])])
    got, _ = quality.raw_scores(model, np.concatenate([f for f, _ in texts]), np.concatenate([v for _, v in texts]), starts)
    for score, (features, values) in zip(got, texts, strict=True):
        want = model.intercept + sum(model.weights[f] * v for f, v in zip(features, values, strict=True))
        for (f, v), (g, w) in itertools.combinations(zip(features, values, strict=True), 2):
            want += (model.factors[f] @ model.factors[g]) * v * w
        assert np.isclose(score, want)


def test_steps_follow_the_gradient():
    """One small step lowers the loss of a text by what the derivatives say."""
    model = quality.start_model()
    text = [quality.Featurizer()("some plain words here", 21.0)]
    before, _ = quality.raw_scores(model, *text[0], np.array([0]))
    after, _ = quality.raw_scores(quality.epoch(model, text, np.array([1.0]), np.ones(1)), *text[0], np.array([0]))
    assert after[0] > before[0]


def test_odd_rows(spark):
    bad, good = "$$$ ### | | | %%% word*** " * 5, "a plain sentence about rivers and other quiet things. "
    docs = [(i, (bad if i % 2 else good) + f"number {i}", len(good), "x") for i in range(200)]
    docs += [(None, good, None, "x"), (1000, None, None, "x"), (1001, "", 0, None), (1002, "w " * 40_000, 80_000, "x"), docs[4], docs[4]]
    frame = spark.createDataFrame(docs, "doc_id long, text string, n_chars long, weight string")
    labels = [(i, 1 - i % 2) for i in range(150)] + [(0, None), (None, 1), (5000, 1), (2, 1), (7, 7)]
    labels = spark.createDataFrame([(*r, "y") for r in labels], "doc_id long, quality int, text string")
    got = quality.score(frame, labels)
    assert got.columns == [*frame.columns, "quality_score"]
    rows = got.collect()
    assert len(rows) == len(docs) and all(0 <= r.quality_score <= 1 for r in rows)
    scores = {r.doc_id: r.quality_score for r in rows}
    assert all((scores[i] >= 0.7) == (i % 2 == 0) for i in range(150, 200))
    assert {r.weight for r in rows} == {"x", None}
    assert all(r.quality_score == 0.5 for r in quality.score(frame, labels.limit(0)).collect())
    assert quality.score(frame.limit(0), labels).count() == 0
    assert quality.score(frame.drop("n_chars"), labels).count() == len(docs)
