import re
import zlib
from collections import Counter
from itertools import product

import numpy as np

from fleetspan.llm import hmm

SCHEMA = "doc_id long, text string, score double, block string"


def words(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def test_forward_is_the_sum_over_paths():
    draw = np.random.default_rng(2)
    k, classes = 3, hmm.CLASSES + 1
    emit = np.zeros((classes, k))
    emit[:5] = draw.dirichlet(np.ones(5), k).T
    chain = hmm.Chain(draw.dirichlet(np.ones(k)), draw.dirichlet(np.ones(k), k), emit)
    rows = [draw.integers(0, 5, n) for n in (6, 1, 4, 4, 2)]
    for part, lengths, tokens in hmm.lengthwise(rows):
        got = chain.forward(lengths, tokens)[2]
        for i, value in zip(part, got, strict=True):
            total = 0.0
            for path in product(range(k), repeat=len(rows[i])):
                p = chain.initial[path[0]] * emit[rows[i][0], path[0]]
                for t in range(1, len(path)):
                    p *= chain.step[path[t - 1], path[t]] * emit[rows[i][t], path[t]]
                total += p
            assert np.isclose(value, np.log10(total))


def test_expected_counts_against_paths_and_gain():
    draw = np.random.default_rng(3)
    k = 2
    emit = np.zeros((hmm.CLASSES + 1, k))
    emit[:4] = draw.dirichlet(np.ones(4), k).T
    chain = hmm.Chain(draw.dirichlet(np.ones(k)), draw.dirichlet(np.ones(k), k), emit)
    rows = [draw.integers(0, 4, n) for n in (5, 3, 1)]
    got, step, first, seen = hmm.Counts(k), np.zeros((k, k)), np.zeros(k), np.zeros((4, k))
    for _, lengths, tokens in hmm.lengthwise(rows):
        chain.expected(lengths, tokens, got)
    for row in rows:
        weights = {}
        for path in product(range(k), repeat=len(row)):
            p = chain.initial[path[0]] * emit[row[0], path[0]]
            for t in range(1, len(path)):
                p *= chain.step[path[t - 1], path[t]] * emit[row[t], path[t]]
            weights[path] = p
        total = sum(weights.values())
        for path, p in weights.items():
            first[path[0]] += p / total
            for t, s in enumerate(path):
                seen[row[t], s] += p / total
                if t:
                    step[path[t - 1], s] += p / total
    assert np.allclose(got.step, step) and np.allclose(got.initial, first) and np.allclose(got.emit[:4], seen)


def test_scores_of_odd_texts(spark):
    rows = [(i, "the cat SAT on the mat " * (i % 4 + 1) if i % 2 else "der hund und die katze " * (i % 3 + 1), 0.0, "b") for i in range(60)]
    rows += [(100, None, 0.0, "b"), (101, "", 0.0, "b"), (102, "zzz unseen\tWORDS here", 0.0, "b"), (None, "the cat", 0.0, "b"), (1, "the cat", 0.0, "b")]
    rows += [(103, " ".join(f"w{i}" for i in range(30_000)), 0.0, "b"), (104, " \n ", 0.0, "b")]
    out = hmm.score(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == len(rows)
    learn = [r for r in rows if r[0] is None or zlib.crc32(str(r[0]).encode()) % 10]
    counts = Counter(w for r in learn for w in words(r[1]))
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for key, text, _, _ in rows:
        found = words(text)
        base = sum(np.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in found)
        want[key, len(found), sum(counts[w] > 0 for w in found), round(base, 6)] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in out) == want
    assert all(r.train_tokens == n and r.score < 0 for r in out)
    known = [r for r in out if r.doc_id is not None and r.doc_id < 60 and r.held_out]
    assert known and sum(r.score for r in known) > sum(r.base_score for r in known)


def test_empty_and_untrained(spark):
    assert hmm.score(spark.createDataFrame([], SCHEMA)).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    row = hmm.score(spark.createDataFrame([(held, "one two", 0.0, "b")], SCHEMA)).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.held_out) == (3, 0, 0, True) and np.isfinite(row.score)


def test_model_is_a_distribution(spark):
    """Words of a class share its probability: known words and one unseen word add up to 1."""
    words_ = hmm.Words.__new__(hmm.Words)
    words_.n, words_.v = np.array([5, 0, 3]), np.array([2, 0, 1])
    share = [sum((c + hmm.ADD) / (words_.n[k] + hmm.ADD * (words_.v[k] + 1)) for c in seen) for k, seen in ((0, (4, 1, 0)), (1, (0,)), (2, (3, 0)))]
    assert np.allclose(share, 1)
