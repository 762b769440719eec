import re
import zlib
from collections import Counter

import numpy as np

from fleetspan.llm import spelling
from fleetspan.session import materialize


def counted(docs):
    """Words of all documents, taken one by one."""
    found = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            if doc_id is not None and (h := zlib.crc32(f"{doc_id}:{run}".encode())) % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def one_error(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words):
    near = {w: [x for x in words if one_error(w, x)] for w in words}
    best = {w: min(x, key=lambda v: (-words[v], v)) for w, x in near.items() if x}
    form = {w: b for w, b in best.items() if words[b] >= 5 * words[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items())


def rows_of(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def test_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    docs += [(None, "Straßen straßen STRASSEN " * 3), (5, None), (6, ""), (7, "no words 1234 $$"), (8, "x" * 30_000 + " ")]
    docs += [(9, ("y" * 3000 + " ") * 6), (10, ("y" * 2999 + " ") * 40)] + docs[:20]
    frame = spark.createDataFrame([(d, t, "w", 1) for d, t in docs], "doc_id long, text string, word string, n int")
    words = materialize(spelling.vocabulary(frame), "test-words")
    want = counted(docs)
    assert {r.word: r.n for r in words.collect()} == want
    assert len(want) > 100
    assert rows_of(spelling.variants(words)) == brute(want)


def random_words(seed=3, n=400):
    draw = np.random.default_rng(seed)
    words = {}
    for _ in range(n):  # few letters and one beginning, so that halves are shared and errors are common
        w = "abcabc" + "".join(draw.choice(list("abü"), draw.integers(0, 6)))
        words[w] = int(5 ** draw.integers(1, 7))
        words["".join(draw.choice(list("abü"), draw.integers(6, 9)))] = int(draw.integers(5, 200))
    return words


def test_hot_halves_are_cut(spark):
    words = random_words()
    frame = materialize(spark.createDataFrame([*words.items()], "word string, n long"), "test-random")
    want = brute(words)
    assert sum(r[1] is not None for r in want) > 50
    assert rows_of(spelling.variants(frame)) == want
    assert rows_of(spelling.variants(frame, index_size=300)) == want


def test_chains_of_forms(spark):
    words = {"a" * 6 + "b" * i: 5 ** (i + 1) for i in range(9)}
    frame = materialize(spark.createDataFrame([*words.items()], "word string, n long"), "test-chain")
    got = rows_of(spelling.variants(frame))
    assert got == brute(words)
    assert {r[2] for r in got} == {"a" * 6 + "b" * 8}


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(materialize(spelling.vocabulary(none), "test-none")).count() == 0


def test_counting_tasks_give_up_words_in_parts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 3)
    docs = [(i, "alphabet alphabets letters vowels consonant") for i in range(8)]
    got = spelling.vocabulary(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r.word: r.n for r in got.collect()} == counted(docs)


def test_index_ranks_are_those_of_sorted_suffixes():
    words = ["abab", "baba", "aab", "b"]
    points, lengths = spelling._symbols(words)
    index = spelling.Suffixes(points - ord("a") + 1, lengths)
    suffixes = sorted(w[i:] for w in words for i in range(len(w) + 1))
    for pattern in ("ab", "b", "ba", "aab", "bb"):
        lo, hi = np.array([0]), np.array([index.n])
        for c in reversed(pattern):
            lo, hi = index.extend(np.array([ord(c) - ord("a") + 1]), lo, hi)
        assert hi[0] - lo[0] == sum(s.startswith(pattern) for s in suffixes)
