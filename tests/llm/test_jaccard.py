import re

import numpy as np

from fleetspan.llm import jaccard

SCHEMA = "doc_id long, text string, key string, band string"


def shingles(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    n = min(5, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else frozenset()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    links = [
        {j for j in range(len(rows)) if j != i and sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])} for i in range(len(rows))
    ]
    group = [*range(len(rows))]
    for _ in rows:
        for i, near in enumerate(links):
            low = min([group[i], *(group[j] for j in near)])
            for j in (i, *near):
                group[j] = min(group[j], low)
    return links, group


def made():
    draw = np.random.default_rng(11)
    base = lambda: [f"w{x}" for x in draw.integers(0, 5000, 120)]
    rows = []
    shared = base()[:80]
    for _ in range(25):
        words = base()
        rows.append(words)
        for edits in (0, 1, 2, 3):  # from equal to about the threshold
            copy = [*words]
            for at in draw.integers(0, 120, edits):
                copy[at] = "edited"
            rows.append(copy)
    rows += [shared + base()[:40] for _ in range(100)]  # a passage that many texts share
    crowd = base()
    for i in range(150):  # near copies of one text, all different
        copy = [*crowd]
        copy[i % 120] = f"x{i}"
        rows.append(copy)
    texts = [(i, " ".join(r)) for i, r in enumerate(rows)]
    texts += [(1000, None), (1001, ""), (1002, "two words"), (1003, "Two, words!"), (1004, "!!!"), (1004, None), (3, texts[3][1]), (1005, "w1 " * 20_000)]
    return texts


def test_links_and_groups_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    monkeypatch.setattr(jaccard, "SMALL_BUCKET", 8)
    monkeypatch.setattr(jaccard, "TILE", 64)
    rows = made()
    links, group = brute(rows)
    out = jaccard.join(spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)).collect()
    sets = {}
    for i, (_, t) in enumerate(rows):
        sets.setdefault(shingles(t) or i, []).append(i)
    first = {}
    for i, (key, _) in enumerate(rows):
        first[group[i]] = min(first.get(group[i], key), key)
    want = sorted((rows[i][0], first[group[i]], len(links[i])) for i in range(len(rows)))
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in out) == want


def test_null_ids_and_empty(spark):
    rows = [(None, "one two three four five six"), (None, "one two three four five six"), (5, "one two three four five six"), (None, "alone here")]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    out = sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in jaccard.join(frame).collect())
    assert out == [("5", "5", 2), ("None", "5", 2), ("None", "5", 2), ("None", "None", 0)]
    assert jaccard.join(frame.limit(0)).count() == 0
    kept = jaccard.one_of_each(spark, frame, "")
    # One of each group stays, those without an id included; one with an id goes before.
    assert kept.columns == frame.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("5", rows[2][1]), ("None", "alone here")]


def test_bands_reach_the_target():
    bands = jaccard.bands_for(0.8, jaccard.ROWS, jaccard.TARGET_RECALL)
    assert 1 - (1 - 0.8**jaccard.ROWS) ** bands >= jaccard.TARGET_RECALL
    assert 1 - (1 - 0.8**jaccard.ROWS) ** (bands - 1) < jaccard.TARGET_RECALL


def test_stage_keeps_one_of_each_group(spark):
    rows = made()
    _, group = brute(rows)
    kept = jaccard.one_of_each(spark, spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA), "")
    first = {}
    for i, (key, _) in enumerate(rows):
        first[group[i]] = min(first.get(group[i], key), key)
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted({*first.values()})


def test_components_of_long_chains_settle_fast(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "MAX_ROUNDS", 16)
    order = np.random.default_rng(13).permutation(1500).tolist()
    edges = [(a, b) for chain in (order[:1000], order[1000:]) for a, b in zip(chain, chain[1:])] + [(order[0], order[1])]
    found = {r.node: r.root for r in jaccard.components(spark.createDataFrame(edges, "a long, b long"), "chain").collect()}
    assert found == {n: min(chain) for chain in (order[:1000], order[1000:]) for n in chain}


def test_components_with_a_busy_node_and_a_hot_root(spark):
    """A star of which most nodes are part, chains that end in it, and many pairs."""
    edges = [(i, 3) for i in range(4, 2000)] + [(3, 3), (3, 2), (2, 1)]
    edges += [(5000 + i, 5001 + i) for i in range(50)] + [(5000, 1999)] + [(10_000 + 2 * i, 10_001 + 2 * i) for i in range(300)]
    frame = spark.createDataFrame(edges, "a long, b long")
    assert jaccard._hot(frame, "b") == [3]
    found = {r.node: r.root for r in jaccard.components(frame, "star").collect()}
    want = dict.fromkeys([*range(1, 2000), *range(5000, 5051)], 1) | {10_000 + i: 10_000 + i // 2 * 2 for i in range(600)}
    assert found == want


def test_pairs_of_like_size_meet_once(spark, monkeypatch):
    """Every pair that its sizes allow meets in one pair of blocks; sets are sent less often than to all blocks of the component."""
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 8000)
    draw = np.random.default_rng(5)
    sizes = np.exp(draw.uniform(np.log(4), np.log(4000), 600)).astype(int).tolist() + [4, 5, 16, 20, 64, 80, 256, 320, 9000, 10_000_000]
    rows = [(str(i).encode(), b"r" if i % 10 else b"s", 1, n) for i, n in enumerate(sizes)] + [(b"x", b"t", 1, 3), (b"y", b"t", 1, 900)]
    wanted = spark.createDataFrame(rows, "node binary, root binary, copies long, n long")
    met, sent, held = {}, 0, {}
    for r in jaccard.dealt(wanted, 0.8, [b"r"]).collect():
        held.setdefault((bytes(r.root), r.i, r.j), []).append((bytes(r.node), r.block))
        sent += 1
    for (root, i, j), members in held.items():
        for a, x in members:
            for b, y in members:
                if a < b and (i == j or x != y):
                    met[a, b] = met.get((a, b), 0) + 1
    of = {r[0]: r for r in rows}
    need = {(a, b) for a in of for b in of if a < b and of[a][1] == of[b][1] and min(of[a][3], of[b][3]) >= 0.8 * max(of[a][3], of[b][3])}
    assert need <= met.keys() and set(met.values()) == {1} and (b"x", b"y") in met
    assert sent < 0.5 * 600 * 600 / 16
