"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. The vector of a letter trigram
is the product of its letters' vectors, each rotated by its place, so order
counts. A text is the sum of its trigram vectors, a language the sum of its
training texts; the prediction is the language with the highest cosine.

Defined results: a null text, or one without a letter, is ``und`` with score
0. Texts may have any length and are read whole. Without training rows all
texts are ``und``. Of equal cosines the first language in the alphabet wins.
Repeated rows are predicted one by one, further columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspan.llm.common import fold, query, session, table, whole_rows

#: Components of a vector.
DIMENSIONS = 1024
#: Symbols: 0 stands between words, 1-26 are a-z, other letters share the rest by code point.
SYMBOLS = 64
SEED = 20_011
UNKNOWN = "und"
#: Languages whose counts a task holds at a time.
HELD_LANGUAGES = 16


class Vectors:
    """Random letter vectors and the tables made from them; each task builds its own."""

    def __init__(self, dimensions: int = DIMENSIONS):
        letters = np.random.default_rng(SEED).integers(0, 2, (SYMBOLS, dimensions), dtype=np.int8) * 2 - 1
        first, second = np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1)
        self.dimensions, self.third = dimensions, letters
        self.pairs = (first[:, None, :] * second[None, :, :]).reshape(SYMBOLS * SYMBOLS, dimensions)
        self.symbols = self._symbols(np.arange(0x10000))

    @staticmethod
    def _symbols(points: np.ndarray) -> np.ndarray:
        """Symbol of each code point, 0 if it is no letter."""
        letters = np.fromiter((chr(c).isalpha() for c in points.tolist()), bool, len(points))
        latin = (points >= 97) & (points <= 122)
        return np.where(latin, points - 96, np.where(letters, 27 + points % (SYMBOLS - 27), 0)).astype(np.int64)

    def trigrams(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the distinct trigrams inside words, edges included, and how often each occurs."""
        if not text:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
        row = np.zeros(len(points) + 2, np.int64)
        row[1:-1] = self.symbols[np.minimum(points, 0xFFFF)]
        beyond = np.flatnonzero(points > 0xFFFF)
        row[1 + beyond] = self._symbols(points[beyond].astype(np.int64))
        middle = row[1:-1] > 0
        codes = (row[:-2] * SYMBOLS + row[1:-1]) * SYMBOLS + row[2:]
        return np.unique(codes[middle], return_counts=True)

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sum of trigram vectors, taken in bounded pieces."""
        total = np.zeros(self.dimensions)
        for i in range(0, len(codes), 1024):
            part = codes[i : i + 1024]
            vectors = self.pairs[part // SYMBOLS] * self.third[part % SYMBOLS]
            total += counts[i : i + 1024].astype(np.float32) @ vectors.astype(np.float32)
        return total


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}
    vectors = Vectors(1)

    def out() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            codes = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(codes), "code": codes, "n": counts[codes]})
        held.clear()

    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
            if lang not in held and len(held) == HELD_LANGUAGES:
                yield from out()
            counts = held.setdefault(lang, np.zeros(SYMBOLS**3, np.int64))
            codes, n = vectors.trigrams(text)
            counts[codes] += n
    yield from out()


def fit(docs: DataFrame, lang: str = "lang", text: str = "text", dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """Unit vector of each language from all rows of ``docs`` with a language and a text.

    Tasks count trigrams per language and the counts are added up by Spark. Only
    one vector per language comes to the driver.
    """
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).dropna()
    counts = rows.mapInArrow(_count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))

    def profile(part: pd.DataFrame) -> pd.DataFrame:
        vector = Vectors(dimensions).bundle(part["code"].to_numpy(), part["n"].to_numpy())
        return pd.DataFrame({"lang": part["lang"].iloc[:1], "vector": [vector.tolist()]})

    # A group is one language: SYMBOLS^3 counts at most.
    vectors = counts.groupBy("lang").applyInPandas(profile, "lang string, vector array<double>").collect()
    found = {r["lang"]: np.asarray(r["vector"]) for r in vectors}
    return {k: found[k] / n for k in sorted(found) if (n := np.linalg.norm(found[k])) > 0}


def predictor(profiles: dict[str, np.ndarray], text: Column, dimensions: int = DIMENSIONS) -> Column:
    """A struct (lang_pred, score) for a text column."""
    names = [*profiles]
    matrix = np.array([*profiles.values()]) if names else np.zeros((0, dimensions))

    def predict(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        vectors = Vectors(dimensions)
        for texts in series:
            langs, scores = [], []
            for value in texts:
                codes, counts = vectors.trigrams(value if isinstance(value, str) else None)
                vector = vectors.bundle(codes, counts) if len(codes) and names else np.zeros(dimensions)
                norm = np.linalg.norm(vector)
                cosines = matrix @ vector / norm if norm else np.zeros(len(names))
                best = int(cosines.argmax()) if norm else -1
                langs.append(names[best] if best >= 0 else UNKNOWN)
                scores.append(min(1.0, max(0.0, float(cosines[best]))) if best >= 0 else 0.0)
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    return F.pandas_udf(_typed(predict), "lang_pred string, score double")(text)


def _typed(function):
    function.__annotations__ = {"series": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return function


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> DataFrame:
    """``docs`` with ``_language`` (lang_pred, score) and ``_held_out``, learned from the other folds of ``docs``."""
    held = docs.withColumn("_held_out", fold(key, 4, 2))
    profiles = fit(held.where(~F.col("_held_out")), lang, text)
    return held.withColumn("_language", predictor(profiles, F.col(text)))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents in one of the learned languages; ``und`` goes."""
    session(spark)
    found = identify(whole_rows(docs, "doc_id", "text", "lang"))
    return found.where(F.col("_language.lang_pred") != UNKNOWN).select("_row.*")


@query()
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("_held_out").alias("held_out"), "_language.lang_pred", "_language.score")
