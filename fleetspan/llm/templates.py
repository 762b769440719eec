"""Benchmark decontamination with canonical templates.

Words are lower-cased; numbers (in digits or spelled out), units after numbers and names (capitalised,
not all capitals, inside a sentence) become typed placeholders whose values are kept as slots.
A capitalised word that begins a sentence may be a name or not, so its windows
are hashed in both readings, as a word and as a name, on both sides.
Adjacent names are one placeholder, and so are adjacent spelled-out numbers.
Hashes of template windows of documents and benchmark items are joined. A
document contains an item if windows on one diagonal (the same shift between
item and document) and on those at most SHIFTS beside it cover enough of it and
the slots are consistent: a value of the item always stands for the same value
in the document. So a verbatim copy is found, one with words put in or left out, and also a question with exchanged numbers and names.
Words that begin sentences and spelled-out numbers need not be slots at all
("one of them"): where their exchange contradicts other slots, only their windows
are not counted.

A window of few literal words says little: its placeholders stand for nothing
but themselves, so it is hashed with its values and matches verbatim only. Values
map one to one, else the window that contradicts is not counted. An item shorter
than a window is a window of its own length, all verbatim.

A fixed-size bitmap of the benchmark's window hashes keeps windows that cannot
join out of the shuffle; it lets all others pass, so nothing is lost.

Defined results: null and empty texts have no windows. Items of fewer than
MIN_SHORT words cannot be told from chance and match nothing. Null ids never
match; the pipeline's stage gives documents without one a number of their own.
Rows with the same doc_id count as one document, items with the same id as one
item. Texts may have any length. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspan.llm.common import query, session, table, whole_rows, with_ids

#: Tokens of a window.
WINDOW = 8
#: Words that a window must have besides its placeholders, else its values count; fewest words of a short item.
MIN_LITERAL, MIN_SHORT = 3, 4
#: Diagonals to each side that count together: words that edits of a copy may put in or leave out.
SHIFTS = 16
#: Share of an item's windows that a document must hold.
MIN_COVERAGE = 0.5
#: Bits of the bitmap: 4 million, half a megabyte, whatever the benchmark's size.
BITMAP_BITS = 1 << 22
REMEMBERED = 200_000

# Units of measure, by full name and symbol.
UNITS = """
mm cm m km inch inches foot feet yard yards mile miles mg g kg ton tons tonne tonnes ounce ounces pound pounds ml cl l
liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year
years percent degree degrees celsius fahrenheit kelvin watt watts kw kwh volt volts amp amps hz khz mhz ghz byte bytes
kb mb gb tb dollar dollars euro euros cent cents pence mph kph meter meters metre metres kilometer kilometers
kilometre kilometres kilogram kilograms gram grams
"""

# Numbers spelled out.
NUMBERS = """
zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen
nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen
"""
#: Characters of texts that are turned into tokens at once.
AT_ONCE = 1 << 20

_WORD, _NUMBER, _UNIT, _NAME, _END, _SPELLED = range(6)


class Canonical:
    """Turns texts into template tokens; tokens seen before are looked up."""

    def __init__(self):
        self.find = re.compile(r"[^\W\d_]+|\d+(?:[.,]\d+)*|[.!?:\n]").findall
        self.units, self.numbers = frozenset(UNITS.split()), frozenset(NUMBERS.split())
        self.marks = np.array([0, *(xxhash.xxh64_intdigest(f"<{k}>") for k in ("num", "unit", "name"))], np.uint64)
        self._forget()

    def _forget(self):
        self.seen, self.n = {}, 0
        self.hashes, self.kinds = np.zeros(1024, np.uint64), np.zeros(1024, np.int8)

    def _learn(self, token: str) -> int:
        lower = token.lower()
        kind = _END if token in ".!?:\n" else _NUMBER if token[0].isdigit() else _UNIT if lower in self.units else _WORD
        kind = _SPELLED if lower in self.numbers else kind
        if kind == _WORD and len(token) > 1 and token[0] != lower[0] and token[1:] == lower[1:]:
            kind = _NAME
        if self.n == len(self.hashes):
            self.hashes, self.kinds = (np.concatenate([x, np.zeros_like(x)]) for x in (self.hashes, self.kinds))
        place = self.seen[token] = self.n
        self.hashes[place], self.kinds[place] = xxhash.xxh64_intdigest(lower), kind
        self.n += 1
        return place

    def __call__(self, texts: list[str]) -> list[Reading]:
        """The texts read twice: words that begin sentences as words, and as names where they are capitalised."""
        if self.n > REMEMBERED:
            self._forget()
        tokens, sizes = [], []
        for text in texts:
            found = self.find(text)
            tokens.append(".")  # a text begins a sentence
            tokens += found
            sizes.append(len(found) + 1)
        get, learn = self.seen.get, self._learn
        places = np.array([p if (p := get(t)) is not None else learn(t) for t in tokens], np.int64)
        kinds = self.kinds[places]
        before = np.concatenate([np.array([_END], np.int8), kinds[:-1]])
        first = (kinds == _NAME) & (before == _END)
        kinds[(kinds == _UNIT) & (before != _NUMBER) & (before != _SPELLED)] = _WORD
        soft = first | (kinds == _SPELLED) | ((kinds == _UNIT) & (before == _SPELLED))
        kept = np.flatnonzero(kinds != _END)
        text = np.repeat(np.arange(len(texts)), sizes)[kept]
        kinds, soft, first, hashes = kinds[kept], soft[kept], first[kept], self.hashes[places[kept]]
        spelled = kinds == _SPELLED
        kinds[spelled] = _NUMBER
        follows = np.concatenate([[False], np.diff(kept) == 1])[: len(kept)]
        words = [tokens[i] for i in kept]
        readings, place = [], None
        for literal in (True, False):
            read = np.where(first & literal, _WORD, kinds)
            run = (read == _NAME) + 2 * spelled
            joins = follows & (run > 0) & (run == np.concatenate([[0], run[:-1]])[: len(run)])
            if place is None:  # places are those of the first reading; the second has no further tokens
                place = np.cumsum(~joins)
                place -= place[np.searchsorted(text, text)]
            readings.append(Reading(self.marks, words, text, place, read, hashes, soft, first, np.flatnonzero(~joins)))
        return readings


class Reading:
    """Template tokens of texts: text, place in it, hash, slot or not, whether a slot may be none, and whether readings differ."""

    def __init__(self, marks, words, text, place, kinds, hashes, soft, first, starts):
        self.words, self.starts, self.ends = words, starts, np.append(starts[1:], len(words))
        self.text, self.place, self.first = text[starts], place[starts], first[starts]
        self.slots = kinds[starts] != _WORD
        # A name of several words may stand in part elsewhere.
        self.soft = soft[starts] | (self.slots & (self.ends - starts > 1))
        self.hashes = np.where(self.slots, marks[np.where(self.slots, kinds[starts], 0)], hashes[starts])
        self.own, self.word_text = hashes, text

    def literal(self) -> np.ndarray:
        """Hash of what each token says, slot or not."""
        if not len(self.starts):
            return self.hashes
        with np.errstate(over="ignore"):
            return np.add.reduceat(self.own * np.uint64(0x9E3779B97F4A7C15), self.starts) + np.uint64(1)

    def codes(self, window: int) -> np.ndarray:
        """Hash of each window: of its template, or of its values where that has few words."""
        codes = rolling(self.hashes, window)
        words = np.concatenate([[0], np.cumsum(~self.slots)])
        few = np.flatnonzero(words[window:] - words[:-window] < MIN_LITERAL) if len(codes) else []
        if len(few):
            parts = self.literal()[few[:, None] + np.arange(window)]
            codes[few] = [rolling(p, window)[0] for p in parts] if len(few) < 16 else _rows(parts)
        return codes

    def value(self, i: int) -> str:
        return " ".join(self.words[self.starts[i] : self.ends[i]]).lower()


def rolling(hashes: np.ndarray, window: int) -> np.ndarray:
    """Hash of each window of tokens."""
    if len(hashes) < window:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(hashes) - window + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(window):
            total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[k : len(hashes) - window + 1 + k]
            total ^= total >> np.uint64(29)
    return total


def _rows(parts: np.ndarray) -> np.ndarray:
    """``rolling`` of many windows, each a row."""
    total = np.zeros(len(parts), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(parts.shape[1]):
            total = total * np.uint64(0x9E3779B97F4A7C15) + parts[:, k]
            total ^= total >> np.uint64(29)
    return total


def _short(read: Reading, lengths: tuple[int, ...], whole: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """First words and hashes of verbatim windows of each of the lengths; ``whole``: of texts that are no longer than that."""
    for n in lengths:
        codes = rolling(read.own, n) ^ np.uint64(n)
        used = read.word_text[: len(codes)] == read.word_text[n - 1 :][: len(codes)]
        if whole:
            first = np.searchsorted(read.word_text, read.word_text[: len(codes)])
            last = np.searchsorted(read.word_text, read.word_text[: len(codes)], "right")
            used &= last - first == n
        at = np.flatnonzero(used)
        yield at, codes[at]


def _parts(keys: list[int], texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Texts with their keys, about AT_ONCE characters together."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= AT_ONCE or i == len(texts) - 1:
            yield keys[start : i + 1], texts[start : i + 1]
            start, size = i + 1, 0


def _windows(window: int, bitmap: bytes | None, lengths: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canonical = Canonical()
        bits = None if bitmap is None else np.unpackbits(np.frombuffer(bitmap, np.uint8)).astype(bool)
        for batch in batches:
            for keys, texts in _parts(batch["id"].to_pylist(), batch["text"].to_pylist()):
                for other, read in enumerate(canonical(texts)):
                    for at, codes in _short(read, () if other else lengths, bits is None):
                        if bits is not None:
                            kept = bits[codes % np.uint64(BITMAP_BITS)]
                            at, codes = at[kept], codes[kept]
                        if len(at):
                            none = pa.array([[]] * len(at), pa.list_(pa.string()))
                            place = pa.array(at - np.searchsorted(read.word_text, read.word_text[at]), pa.int32())
                            ids = pa.array(np.array(keys, np.int64)[read.word_text[at]])
                            yield pa.RecordBatch.from_arrays([ids, place, pa.array(codes.view(np.int64)), none, none.cast(pa.list_(pa.bool_()))], NAMES)
                    codes = read.codes(window)
                    used = read.text[: len(codes)] == read.text[window - 1 :]
                    if other:  # only windows that differ between the readings
                        differ = np.concatenate([[0], np.cumsum(read.first)])
                        used &= differ[window:] > differ[: len(codes)]
                    if bits is not None:
                        used &= bits[codes % np.uint64(BITMAP_BITS)]
                    hits = np.flatnonzero(used)
                    if not len(hits):
                        continue
                    at = np.flatnonzero(read.slots)
                    low, high = np.searchsorted(at, hits), np.searchsorted(at, hits + window)
                    slots = [[(read.value(i), bool(read.soft[i])) for i in at[a:b].tolist()] for a, b in zip(low, high, strict=True)]
                    arrays = [
                        pa.array(np.array(keys, np.int64)[read.text[hits]]),
                        pa.array(read.place[hits], pa.int32()),
                        pa.array(codes[hits].view(np.int64)),
                        pa.array([[v for v, _ in w] for w in slots], pa.list_(pa.string())),
                        pa.array([[f for _, f in w] for w in slots], pa.list_(pa.bool_())),
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, NAMES)

    return run


NAMES = ["id", "place", "code", "slots", "soft"]
WINDOWS = "id long, place int, code long, slots array<string>, soft array<boolean>"


def windows(df: DataFrame, key: str, text: str, window: int = WINDOW, bitmap: bytes | None = None, lengths: tuple[int, ...] | None = None) -> DataFrame:
    """Template windows: id, place, code, slots, soft (whether a slot may be none); those that the bitmap rules out are left away.

    ``lengths`` are those of short items; without a bitmap, of items themselves, texts shorter than a window are one window of their length.
    """
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).dropna()
    short = tuple(range(min(MIN_SHORT, window), window)) if lengths is None else lengths
    return rows.mapInArrow(_windows(window, bitmap, short), WINDOWS)


def short_lengths(items: DataFrame, window: int) -> tuple[int, ...]:
    """Numbers of words of the items that are shorter than a window: at most ``window`` numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canonical = Canonical()
        for batch in batches:
            sizes = {len(canonical([t])[0].words) for t in batch["text"].to_pylist()}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(n for n in sizes if MIN_SHORT <= n < window), pa.int32())], ["n"])

    return tuple(sorted(r["n"] for r in items.select("text").dropna().mapInArrow(run, "n int").distinct().collect()))


def bitmap_of(codes: DataFrame) -> bytes:
    """Bitmap of a column ``code``; at most BITMAP_BITS numbers come to the driver."""
    # The code as an unsigned number, so that tasks find the same bit.
    place = F.pmod(F.col("code"), F.lit(BITMAP_BITS)).cast("int").alias("bit")
    found = codes.select(place).distinct().toArrow()["bit"].to_numpy()
    bits = np.zeros(BITMAP_BITS, np.uint8)
    bits[found] = 1
    return np.packbits(bits).tobytes()


def _covered(at: dict[int, list[tuple]], anchor: int) -> tuple[set[int], dict[str, set[str]]] | None:
    """Item places that agree with the slots on a diagonal, and the values of their slots; None if the diagonal contradicts itself."""
    places: set[int] = set()
    values: dict[str, set[str]] = {}
    firm: dict[str, set[str]] = {}

    def agree(found: list[tuple]) -> bool:
        """Whether the slots that are surely slots agree with those before."""
        said = {a: set(v) for a, v in firm.items()}
        for _, slots in found:
            for a, b, soft in slots:
                if not soft:
                    said.setdefault(a, set()).add(b)
        return all(len(v) == 1 for v in said.values())

    stands: dict[str, str] = {}

    def take(found: list[tuple]) -> None:
        for place, slots in found:
            # Two values of the item do not become one; a window that says so does not count.
            if any(stands.get(b, a) != a for a, b, _ in slots):
                continue
            stands.update({b: a for a, b, _ in slots})
            places.add(place)
            for a, b, soft in slots:
                values.setdefault(a, set()).add(b)
                if not soft:
                    firm.setdefault(a, set()).add(b)

    as_words = [w for w in at[anchor] if not any(soft and a != b for a, b, soft in w[1])]
    if not agree(as_words):
        return None
    take(as_words)
    for shift in sorted((s for s in at if abs(s - anchor) <= SHIFTS), key=lambda s: (abs(s - anchor), s)):
        further = [w for w in at[shift] if w[0] not in places]
        if not agree(further):
            continue
        said = {a: set(v) for a, v in values.items()}
        for _, slots in further:
            for a, b, _ in slots:
                said.setdefault(a, set()).add(b)
        take([w for w in further if all(soft and a == b or said[a] == {b} for a, b, soft in w[1])])
    return places, values


def _score(min_coverage: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, item, n_item, found in zip(*(batch[c].to_pylist() for c in ("doc_id", "item_id", "n_item", "found")), strict=True):
                at: dict[int, list[tuple]] = {}
                for w in found:
                    slots = [(s["a"], s["b"], s["soft"]) for s in w["slots"]]
                    at.setdefault(w["shift"], []).append((w["item_place"], slots))
                for anchor in at:
                    covered = _covered(at, anchor)
                    if covered and len(covered[0]) >= min_coverage * n_item:
                        n, values = len(covered[0]), covered[1]
                        rows.append((doc, item, anchor, n, n / n_item, len(values), all(v == {a} for a, v in values.items())))
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.bool_())
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "shift", "n_windows", "coverage", "n_slots", "verbatim"])

    return run


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    min_coverage: float = MIN_COVERAGE,
    doc_key: str = "doc_id",
    item_key: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """One row per document and benchmark item that it contains.

    Columns: doc_id, item_id, n_windows (matching windows of the item on the best
    diagonal and those beside it), coverage (their share), n_slots (distinct slot values compared),
    verbatim (no slot value was exchanged).
    """
    items = windows(benchmark, item_key, text, window)
    sizes = items.groupBy("id").agg(F.countDistinct("place").alias("n_item")).withColumnRenamed("id", "item_id")
    lengths = short_lengths(benchmark.select(F.col(text).alias("text")), window)
    found = windows(docs, doc_key, text, window, bitmap_of(items.select("code")), lengths)
    right = items.select(
        F.col("id").alias("item_id"), F.col("place").alias("item_place"), "code", F.col("slots").alias("item_slots"), F.col("soft").alias("item_soft")
    ).distinct()
    pairs = found.join(right, "code").withColumn("shift", F.col("place") - F.col("item_place"))
    # Each diagonal lies with all those at most SHIFTS beside it in one of two overlapping bands; a row holds a band, never a whole document.
    band = F.floor(F.col("shift") / (2 * SHIFTS)).cast("int")
    pairs = pairs.withColumn("band", F.explode(F.array(band, band - 1)))
    # A window has at most ``window`` slots, and an item so many windows: the sets stay small.
    slots = F.zip_with("item_slots", "slots", lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    slots = F.zip_with(slots, F.zip_with("item_soft", "soft", lambda a, b: a | b), lambda s, soft: F.struct(s["a"].alias("a"), s["b"].alias("b"), soft.alias("soft")))
    grouped = pairs.groupBy(F.col("id").alias("doc_id"), "item_id", "band").agg(
        F.countDistinct("item_place").alias("n_places"),
        F.collect_set(F.struct("shift", "item_place", slots.alias("slots"))).alias("found"),
    )
    enough = grouped.join(sizes, "item_id").where(F.col("n_places") >= min_coverage * F.col("n_item")).select("doc_id", "item_id", "n_item", "found")
    scored = enough.mapInArrow(_score(min_coverage), "doc_id long, item_id long, shift int, n_windows int, coverage double, n_slots int, verbatim boolean")
    best = F.max_by(F.struct("n_windows", "coverage", "n_slots", "verbatim"), F.struct("n_windows", "verbatim", -F.col("shift")))
    return scored.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.*")


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that contain no benchmark item."""
    session(spark)
    rows = with_ids(whole_rows(docs, "doc_id", "text"), "templates-named")
    found = leaks(rows, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("_leak")).distinct()
    return rows.join(found, F.col("doc_id") == F.col("_leak"), "left_anti").select("_row.*")


@query()
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
