import numpy as np
from pyspark.sql import functions as F

from fleetspan.llm import covertree

SCHEMA = "id long, label long, vector array<double>, list int, score double, cell int"


def brute(rows, positives=5, negatives=10):
    """Triples of every anchor (id divisible by 100) from plain whole-number products."""
    rows = {i: (label, [int(x) for x in v]) for i, label, v in rows}
    out = []
    for a, (label, v) in rows.items():
        if a % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w, strict=True)), i, other) for i, (other, w) in rows.items() if i != a]
        for p, positive, _ in sorted(s for s in scored if s[2] == label)[:positives]:
            fits = sorted(s for s in scored if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p)
            out += [(a, positive, r, i, -p, -s) for r, (s, i, _) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def mined(spark, rows):
    frame = spark.createDataFrame([(*r, 7, 0.5, 3) for r in rows], SCHEMA)
    return sorted(map(tuple, covertree.mine(frame, F.col("id") % 100 == 0).collect()))


def clustered(n, width=6, seed=4):
    draw = np.random.default_rng(seed)
    centers = draw.normal(0, 40, (8, width))
    return [(i, int(draw.integers(4)), [float(np.floor(x)) for x in centers[i % 8] + draw.normal(0, 12, width)]) for i in range(n)]


def test_every_triple(spark):
    rows = clustered(900)
    assert mined(spark, rows) == brute(rows)


def test_copies_ties_and_rows_that_take_no_part(spark):
    rows = clustered(300)
    rows += [(i, i % 3, rows[100][2]) for i in range(1000, 1600)]  # one large group of copies, in three labels
    odd = [(None, 1, rows[0][2]), (1700, None, rows[0][2]), (1800, 1, None), (1900, 1, [None] * 6), (2000, 1, [float("nan")] * 6)]
    odd += [(2100, 1, [float("inf")] + [0.0] * 5), (2200, 1, [1.0]), (2300, 1, []), (2400, 1, [1e30] + [0.0] * 5)]
    zero = [(2500, 2, [0.0] * 6), (2501, 2, [0.0] * 6)]
    # Of a repeated id the smallest label and vector count.
    again = [rows[7], (8, 9, [1.0] * 6)]
    assert mined(spark, rows + odd + zero + again) == brute(rows + zero)


def test_many_shards_blocks_and_wide_numbers(spark, monkeypatch):
    monkeypatch.setattr(covertree, "SHARD", 40)
    monkeypatch.setattr(covertree, "BLOCK", 16)
    monkeypatch.setattr(covertree, "CELL_SIZE", 100)
    monkeypatch.setattr(covertree, "LEAF", 8)
    rows = [(i * 5, label, [x * 70_000 for x in v]) for i, label, v in clustered(600)]  # squares beyond 2^53 in all
    assert mined(spark, rows) == brute(rows)


def test_few_and_none(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, 1, [1.0, 2.0])]) == []
    assert mined(spark, [(0, 1, [2.0, 0.0]), (1, 1, [5.0, 0.0]), (2, 2, [4.0, 1.0]), (3, 2, [-1.0, 0.0])]) == [(0, 1, 1, 2, 10, 8)]


def test_bounds_hold():
    draw = np.random.default_rng(1)
    rows, queries = draw.integers(-300, 300, (500, 8)), draw.integers(-300, 300, (20, 8))
    norm = float(np.sqrt((rows**2).sum(1).max()))
    points = covertree.augmented(rows, norm)
    chosen, _, own = covertree.farthest_first(points, 12)
    radii = np.array([np.arccos(np.clip(points[own == i] @ points[c], -1, 1)).max() for i, c in enumerate(chosen)])
    length = np.sqrt((queries**2).sum(1))
    low, most = covertree.bounds(queries / length[:, None], length * norm, points[chosen], radii)
    score = queries @ rows.T
    assert (score <= most[:, own]).all() and (score >= low[:, own]).all()
