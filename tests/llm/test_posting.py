import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fleetspan.llm import posting

SCHEMA = "vec_id long, embedding array<float>, list int, score double"


def brute(rows, k):
    ids = np.array([r[0] for r in rows])
    vectors = np.array([r[1] for r in rows], np.float32).astype(float)
    out = {}
    for q in sorted({i for i in ids if i % 100 == 0}):
        best = {}
        for v in vectors[ids == q]:
            for i, d in zip(ids, np.sqrt(((vectors - v) ** 2).sum(1)), strict=True):
                if i != q:
                    best[i] = min(d, best.get(i, d))
        out[q] = sorted((d, i) for i, d in best.items())[:k]
    return out


def test_small_shards_and_batches(spark, monkeypatch):
    monkeypatch.setattr(posting, "SHARD", 32)
    monkeypatch.setattr(posting, "ASKED", 2)
    test_copies_ties_and_vectors_that_take_no_part(spark)


def test_the_graph_finds_what_lies_within_the_ratio():
    draw = np.random.default_rng(10)
    sample = draw.normal(size=(6000, 24))
    points = posting.fit_centroids(sample, 500)
    queries = draw.normal(size=(200, 24))
    for ratio in (1.0, 1.1, 1.3, 9.0):
        got = posting.Centroids(points).within(queries, ratio)
        want = [set(np.flatnonzero(r <= ratio * (1 + 1e-12)).tolist()) for r in posting.ratios(points, queries)]
        assert all(set(g) <= w for g, w in zip(got, want, strict=True))
        assert np.mean([len(set(g) & w) / len(w) for g, w in zip(got, want, strict=True)]) > 0.99


def test_copies_ties_and_vectors_that_take_no_part(spark):
    draw = np.random.default_rng(8)
    vectors = draw.normal(size=(30, 8)).astype(np.float32)
    rows = [(i, [float(x) for x in vectors[i % 30 if i < 400 else 0]]) for i in range(700)]  # groups of copies, one of them large
    odd = [(800, None), (900, [0.0] * 8), (1000, [float("nan")] + [1.0] * 7), (1100, [None] + [1.0] * 7), (1200, [1.0] * 5), (None, rows[0][1]), (1300, [float("inf")] * 8)]
    frame = spark.createDataFrame([(*r, 1, 0.5) for r in [*rows, *odd, rows[100]]], SCHEMA)
    got = {}
    for r in posting.search(frame, F.col("id") % 100 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id, r["rank"]))
    want = brute(rows, 10)
    assert set(got) == set(want)
    for q, found in got.items():
        assert [r for _, _, r in found] == [*range(1, len(found) + 1)]
        assert [i for _, i, _ in found] == [i for _, i in want[q]]
        assert np.allclose([s for s, _, _ in found], [s for s, _ in want[q]], atol=0, rtol=1e-15)


def test_recall(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    got = {}
    for r in posting.search(frame, F.col("id") % 100 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = brute(rows, 10)
    assert np.mean([len(got[q] & {i for _, i in w}) / len(w) for q, w in want.items()]) >= 0.9


def test_few_and_none(spark):
    frame = spark.createDataFrame([(0, [1.0, 2.0], 1, 0.0), (1, [1.0, 3.0], 1, 0.0)], SCHEMA)
    assert [(r.query_id, r.vec_id, r.score) for r in posting.search(frame, F.col("id") == 0).collect()] == [(0, 1, 1.0)]
    assert posting.search(frame.limit(0), F.col("id") == 0).count() == 0
    assert posting.search(frame.limit(1), F.col("id") == 0).count() == 0


def test_lists_are_balanced():
    draw = np.random.default_rng(9)
    sample = np.vstack([draw.normal(size=(3000, 16)), 0.05 * draw.normal(size=(3000, 16)) + 2])
    points = posting.fit_centroids(sample, 24)
    own = [x[0] for x in posting.Centroids(points).lists(sample)]
    size = np.bincount(own, minlength=24)
    assert size.max() < 3 * size.mean()


@pytest.mark.parametrize(("n", "step"), [(50_000, 250), (500_000, 2500)])
def test_recall_does_not_fall_with_size(spark, tmp_path, n, step):
    vectors = np.random.default_rng(n).normal(size=(n, 64)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    ids = np.arange(n)
    column = pa.FixedSizeListArray.from_arrays(pa.array(vectors.ravel()), 64).cast(pa.list_(pa.float32()))
    pq.write_table(pa.table({"vec_id": ids, "embedding": column}), tmp_path / "vectors.parquet", row_group_size=n // 8)
    frame = spark.read.parquet(str(tmp_path / "vectors.parquet")).repartition(8)
    got = {}
    for r in posting.search(frame, F.col("id") % step == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    queries = ids[::step]
    distance = posting.squared(vectors[queries].astype(float), vectors.astype(float))
    distance[np.arange(len(queries)), queries] = np.inf
    want = np.argpartition(distance, 9, axis=1)[:, :10]
    recall = np.mean([len(got[q] & set(w.tolist())) / 10 for q, w in zip(queries.tolist(), want, strict=True)])
    assert recall >= 0.9, recall
