"""Spelling variants by search schemes on a bidirectional FM-index of the vocabulary.

1. Words are counted over all documents, per task before the shuffle.
2. One error leaves one half of a word untouched. So words are dealt by half: a
   word that asks meets the words that begin like its first half, and those that
   end like its second one. A half that too many words share is cut into parts
   on both sides.
3. A task builds an FM-index of its delimited words, read forwards for the second
   halves and backwards for the first ones: the two directions of the index. All
   words that ask take their steps together: the delimiter and the exact half
   narrow an interval of suffix ranks, and the search goes on across the other
   half with one replaced or inserted code point. An interval that reaches the
   delimiter again is a near word. A deletion is an insertion seen from the
   other word, so both directions of such a pair are written.
4. Each word's most frequent near word is its form, if frequent enough; roots
   follow the forms by pointer doubling.

Defined results: null texts hold no words; in a document without an id no code
point is deleted. Repeated documents count again. Ties between forms go to the
smaller word in code-point order. Words may have any length. Without words the
result is empty; further columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspan.llm.common import query, table
from fleetspan.session import materialize

#: Shortest word, and least number of its occurrences.
MIN_LENGTH, MIN_COUNT = 6, 5
#: A form occurs so many times as often as the word.
RATIO = 5
#: One in so many runs loses a code point.
DAMAGE = 199
#: Code points of an index, above which a half that words share is cut.
INDEX_SIZE = 200_000
#: Distinct words and bytes of them that a counting task holds.
HELD_WORDS, HELD_BYTES = 500_000, 64 << 20
#: Words that search together.
TOGETHER = 4096
#: Runs of a-z and U+00C0 to U+00FF in UTF-8, of MIN_LENGTH code points at least: shorter ones can't become words.
RUNS = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf]){%d,}" % MIN_LENGTH)


def words_of(doc_id: int | None, text: bytes) -> Counter:
    """Words of a text with their counts; ``text`` is UTF-8."""
    found: Counter = Counter()
    # bytes.lower changes A-Z only.
    runs = Counter(RUNS.findall(text.lower()))
    if doc_id is None:
        return runs
    start = zlib.crc32(b"%d:" % doc_id)
    for run, n in runs.items():
        h = zlib.crc32(run, start)
        if h % DAMAGE == 0:
            points = run.decode()
            at = h % len(points)
            if len(points) <= MIN_LENGTH:
                continue
            run = (points[:at] + points[at + 1 :]).encode()
        found[run] += n
    return found


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter = Counter()
    size = 0

    def partial() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.binary()).cast(pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist(), strict=True):
            if not text:
                continue
            total.update(words_of(doc_id, text))
            # Every new word came from the text, so its length bounds what was added.
            size += len(text)
            if len(total) > HELD_WORDS or size > HELD_BYTES:
                if size > HELD_BYTES:
                    size = sum(map(len, total))
                if len(total) > HELD_WORDS or size > HELD_BYTES // 2:
                    yield partial()
                    total.clear()
                    size = 0
    yield partial()


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n: all words of the documents that are long and frequent enough."""
    counts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_count, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


class Suffixes:
    """FM-index of words, searched from their last code point to their first.

    Every word ends in a delimiter of its own, smaller than all code points.
    ``ranks`` holds (symbol, place in the Burrows-Wheeler transform) as sorted
    numbers: the place of (c, i) among them is the rank of the first suffix that
    begins with c followed by a suffix of rank i or more.
    """

    def __init__(self, points: np.ndarray, lengths: np.ndarray):
        """``points`` are symbols from 1 on of all words, one after the other."""
        self.words, ends = len(lengths), np.cumsum(lengths + 1)
        n = self.n = int(ends[-1]) if len(ends) else 0
        text = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        inside[ends - 1] = False
        text[inside] = points
        order = self._order(text, inside, int(lengths.max(initial=0)))
        before = text[order - 1]
        before[order == 0] = 0
        self.symbols = int(text.max(initial=0))
        self.transform = before
        places = np.argsort(before, kind="stable")
        self.ranks = before[places] * n + places
        # Suffixes that are whole words: those after a delimiter.
        self.whole = places[: self.words]
        starts = np.concatenate([[0], ends[:-1]])
        self.word_at = np.searchsorted(starts, order[self.whole])

    @staticmethod
    def _order(text: np.ndarray, inside: np.ndarray, longest: int) -> np.ndarray:
        """Ranks of the suffixes up to their delimiters, by doubling."""
        n, ends = len(text), np.cumsum(~inside)
        key = np.where(inside, text + (ends[-1] if n else 0), ends - 1)
        step = 1
        while True:
            order = np.argsort(key, kind="stable")
            sorted_ = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.concatenate([[0], sorted_[1:] != sorted_[:-1]])) if n else 0
            if not n or rank[order[-1]] == n - 1 or step > longest:
                return order
            # Beyond its delimiter a suffix is never compared: the delimiter's rank is its own.
            key = rank * (n + 1)
            key[:-step] += rank[step:] + 1
            step *= 2

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals after one more symbol in front."""
        base = symbol * self.n
        return np.searchsorted(self.ranks, base + lo), np.searchsorted(self.ranks, base + hi)

    def children(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
        """Every symbol that stands in front of an interval: place of the interval, symbol, new interval."""
        size = hi - lo
        few = np.flatnonzero(size <= self.symbols)
        many = np.flatnonzero(size > self.symbols)
        at = np.repeat(few, size[few])
        place = np.arange(len(at)) - np.repeat(np.cumsum(size[few]) - size[few], size[few]) + lo[at]
        seen = np.unique(at * (self.symbols + 1) + self.transform[place])
        at, symbol = np.divmod(seen, self.symbols + 1)
        at = np.concatenate([at, np.repeat(many, self.symbols)])
        symbol = np.concatenate([symbol, np.tile(np.arange(1, self.symbols + 1), len(many))])
        at, symbol = at[symbol > 0], symbol[symbol > 0]
        low, high = self.extend(symbol, lo[at], hi[at])
        there = high > low
        return at[there], symbol[there], low[there], high[there]

    def finish(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each interval, the word that begins there, if any: place of the interval, word."""
        first, last = np.searchsorted(self.whole, lo), np.searchsorted(self.whole, hi)
        # Words are distinct, so one interval holds one whole word at most.
        there = np.flatnonzero(last > first)
        return there, self.word_at[first[there]]


def near(index: Suffixes, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (asking word, indexed word) with one error after the first ``exact`` symbols.

    ``flat`` holds the symbols of the asking words in the order in which they are
    consumed, that is, from their end; symbols unknown to the index are 0. The
    indexed word has one symbol replaced or one more.
    """
    found_q: list[np.ndarray] = []
    found_w: list[np.ndarray] = []
    q = np.arange(len(lengths))
    lo, hi = np.zeros(len(q), np.int64), np.full(len(q), index.words, np.int64)
    for t in range(int(exact.max(initial=0))):
        stay = exact[q] <= t
        symbol = np.where(stay, 0, flat[np.minimum(starts[q] + t, len(flat) - 1)])
        low, high = index.extend(symbol, lo, hi)
        lo, hi = np.where(stay, lo, low), np.where(stay, hi, high)
        kept = stay | ((symbol > 0) & (hi > lo))
        q, lo, hi = q[kept], lo[kept], hi[kept]
    t = exact[q]
    while len(q):
        # One error here, then the rest of the word exactly.
        at, symbol, low, high = index.children(lo, hi)
        wanted = np.where(t < lengths[q], flat[np.minimum(starts[q] + t, len(flat) - 1)], 0)
        # Putting in what comes next anyway is putting it in later.
        other = symbol != wanted[at]
        eq, et, el, eh = q[at[other]], t[at[other]], low[other], high[other]
        replaced = et < lengths[eq]
        eq, et = np.concatenate([eq, eq[replaced]]), np.concatenate([et, et[replaced] + 1])
        el, eh = np.concatenate([el, el[replaced]]), np.concatenate([eh, eh[replaced]])
        while len(eq):
            done = et == lengths[eq]
            if done.any():
                there, word = index.finish(el[done], eh[done])
                found_q.append(eq[done][there])
                found_w.append(word)
                eq, et, el, eh = eq[~done], et[~done], el[~done], eh[~done]
            symbol_ = flat[starts[eq] + et] if len(eq) else eq
            el, eh = index.extend(symbol_, el, eh)
            alive = (symbol_ > 0) & (eh > el)
            eq, et, el, eh = eq[alive], et[alive] + 1, el[alive], eh[alive]
        # No error yet.
        same = ~other
        q, t, lo, hi = q[at[same]], t[at[same]] + 1, low[same], high[same]
        still = t <= lengths[q]
        q, t, lo, hi = q[still], t[still], lo[still], hi[still]
    none = np.zeros(0, np.int64)
    return np.concatenate(found_q or [none]), np.concatenate(found_w or [none])


def _symbols(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, and their lengths."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    return flat, np.array([len(w) for w in words], np.int64)


def near_words(words: list[str], indexed: np.ndarray, asking: np.ndarray, backwards: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of (asking, indexed) words with one error in the half that is searched.

    Forwards that is the first half, the second one being exact; ``backwards``
    words are turned around, so it is the second.
    """
    own = np.flatnonzero(indexed)
    # The index is searched from the end, so it holds turned words where the first half is exact.
    points, lengths = _symbols([words[i][::-1] if backwards else words[i] for i in own])
    alphabet, codes = np.unique(points, return_inverse=True)
    if not len(own):
        return own, own
    index = Suffixes(codes + 1, lengths)
    left, right = [], []
    ask = np.flatnonzero(asking)
    for i in range(0, len(ask), TOGETHER):
        part = ask[i : i + TOGETHER]
        points, lengths = _symbols([words[j] if backwards else words[j][::-1] for j in part])
        place = np.minimum(np.searchsorted(alphabet, points), len(alphabet) - 1)
        flat = np.where(alphabet[place] == points, place + 1, 0)
        exact = lengths // 2 if backwards else lengths - lengths // 2
        q, w = near(index, flat, np.cumsum(lengths) - lengths, lengths, exact)
        left.append(part[q])
        right.append(own[w])
    none = np.zeros(0, np.int64)
    return np.concatenate(left or [none]), np.concatenate(right or [none])


def _near_pairs(rows: pa.Table) -> pa.Table:
    merged = rows.group_by("word").aggregate([("n", "max"), ("indexed", "max"), ("asking", "max")])
    words, n = merged["word"].to_pylist(), merged["n_max"].to_numpy()
    flags = (merged[c].to_numpy(zero_copy_only=False) for c in ("indexed_max", "asking_max"))
    q, w = near_words(words, *flags, rows["first"][0].as_py())
    lengths = np.array([len(x) for x in words], np.int64)
    longer = lengths[w] > lengths[q]
    q, w = np.concatenate([q, w[longer]]), np.concatenate([w, q[longer]])
    texts = merged["word"].combine_chunks()
    return pa.table({"word": texts.take(pa.array(q)), "near": texts.take(pa.array(w)), "near_n": pa.array(n[w], pa.int64())})


def near_pairs(words: DataFrame, index_size: int = INDEX_SIZE) -> DataFrame:
    """word, near, near_n of all pairs of ``words`` (word, n; written, distinct) with one error; both directions, once each."""
    length = F.length("word")

    # A word asks by its own halves; words one longer must meet it there, so a word is also indexed by those halves that it would have without a code point.
    def keys(own: str, less: str, first: bool) -> list:
        def cut(h: str):
            return F.expr(f"left(word, cast({h} as int))" if first else f"right(word, cast({h} as int))")

        return [
            F.struct(F.lit(first).alias("first"), cut(own).alias("half"), F.lit(True).alias("asking")),
            F.when(F.expr(f"{own} <> {less}"), F.struct(F.lit(first).alias("first"), cut(less).alias("half"), F.lit(False).alias("asking"))),
        ]

    own = keys("floor(length(word) / 2)", "floor((length(word) - 1) / 2)", True)
    own += keys("ceil(length(word) / 2)", "ceil((length(word) - 1) / 2)", False)
    dealt = words.withColumn("key", F.explode(F.filter(F.array(*own), lambda k: k.isNotNull())))
    dealt = dealt.select("word", "n", "key.first", "key.half", "key.asking")
    total = words.agg(F.sum(length).alias("size")).first()["size"] or 0
    buckets = max(1, math.ceil(3 * total / index_size))
    sizes = dealt.groupBy("first", "half").agg(F.ceil(F.sum(length) / index_size).cast("int").alias("cuts"))
    # Halves above the size: fewer than there are buckets.
    hot = sizes.where(F.col("cuts") > 1)
    dealt = dealt.join(hot, ["first", "half"], "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
    own_cut = F.pmod(F.xxhash64("word"), F.col("cuts")).cast("int")
    every = F.sequence(F.lit(0), F.col("cuts") - 1)
    as_index = F.transform(every, lambda b: F.struct(own_cut.alias("cut"), b.alias("batch"), F.lit(True).alias("indexed"), F.lit(False).alias("asking")))
    as_asking = F.transform(every, lambda c: F.struct(c.alias("cut"), own_cut.alias("batch"), F.lit(False).alias("indexed"), F.col("asking").alias("asking")))
    alone = F.array(F.struct(F.lit(0).alias("cut"), F.lit(0).alias("batch"), F.lit(True).alias("indexed"), F.col("asking").alias("asking")))
    roles = F.when(F.col("cuts") == 1, alone).when(F.col("asking"), F.concat(as_index, as_asking)).otherwise(as_index)
    bucket = F.pmod(F.xxhash64("first", "half"), F.lit(buckets)).alias("bucket")
    rows = dealt.select("word", "n", "first", bucket, F.explode(roles).alias("role")).select("first", "bucket", "role.cut", "role.batch", "word", "n", "role.indexed", "role.asking")
    found = rows.groupBy("first", "bucket", "cut", "batch").applyInArrow(_near_pairs, "word string, near string, near_n long")
    # An error between the halves is found from both. One shuffle by word serves this and the counts.
    return found.repartition("word").dropDuplicates(["word", "near"])


def variants(words: DataFrame, ratio: int = RATIO, index_size: int = INDEX_SIZE) -> DataFrame:
    """word, form, root, n, n_near, form_n of ``words`` (word, n; written, distinct)."""
    pairs = near_pairs(words, index_size)
    # Strings are compared by their bytes, which is code-point order.
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("near"))).alias("best"))
    frequent = -F.col("best.m") >= ratio * F.col("n")
    found = words.join(best, "word", "left").select(
        "word",
        F.when(frequent, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, -F.col("best.m")).alias("form_n"),
    )
    found = materialize(found, "spelling-forms")
    links = found.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    # Each step multiplies the count, so chains are short and their length is known beforehand.
    most = words.agg(F.max("n").alias("n"), F.min("n").alias("least")).first()
    steps = math.log(max(1, (most["n"] or 1) / max(1, most["least"] or 1)), ratio)
    for _ in range(math.ceil(math.log2(max(1, steps)))):
        further = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = materialize(links.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")
    return found.join(links, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


@query()
def op12_search_scheme(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(materialize(vocabulary(table(spark, sf_dir, "documents")), "spelling-words"))
