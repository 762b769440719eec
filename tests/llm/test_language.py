import zlib

import numpy as np

from fleetspan.llm import language

SCHEMA = "doc_id long, text string, lang string, lang_pred string, score double"
WORDS = {
    "en": "the house and river with other things that were brought there".split(),
    "de": "das haus und der fluss mit anderen dingen die schön gebracht wurden".split(),
    "el": "το σπίτι και το ποτάμι με άλλα πράγματα που έφεραν εκεί".split(),
}


def made(spark):
    draw = np.random.default_rng(10)
    rows = [(i, " ".join(draw.choice(WORDS[k], 12)), k, "x", 9.0) for i in range(240) for k in [("en", "de", "el")[i % 3]]]
    odd = [(1000, None, "en", "x", 9.0), (1001, "", "de", "x", 9.0), (1002, "123 !!! 456", "en", "x", 9.0), (None, "the river", None, "x", 9.0)]
    odd += [(1003, "haus und fluss " * 40_000, None, "x", 9.0), (0, rows[0][1], "en", "x", 9.0), (1004, "𐐨𐐩 the house", None, "x", 9.0)]
    return spark.createDataFrame(rows + odd, SCHEMA), rows + odd


def test_held_out_accuracy_and_odd_rows(spark):
    docs, rows = made(spark)
    out = language.identify(docs).collect()
    assert len(out) == len(rows)
    held = [r for r in out if r._held_out and r.doc_id < 240]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in held)
    assert np.mean([r._language.lang_pred == r.lang for r in held]) > 0.98
    found = {r.doc_id: r._language for r in out}
    assert all(found[k] == ("und", 0.0) for k in (1000, 1001, 1002))
    assert found[None].lang_pred == found[1004].lang_pred == "en" and found[1003].lang_pred == "de"
    assert all(0 <= r._language.score <= 1 for r in out)


def test_untrained_and_empty(spark):
    docs, _ = made(spark)
    only = docs.withColumn("lang", docs["lang"].substr(100, 1)).where("lang is null")
    assert {r._language.lang_pred for r in language.identify(only).collect()} == {"und"}
    assert language.identify(docs.limit(0)).count() == 0


def test_stage_keeps_columns_and_known_languages(spark):
    docs, rows = made(spark)
    kept = language.known_language(spark, docs, "")
    assert kept.columns == docs.columns
    assert kept.count() == len(rows) - 3


def test_vectors_against_the_definition():
    vectors = language.Vectors(64)
    letters = vectors.third
    codes, counts = vectors.trigrams("ab")
    a, b, edge = letters[1].astype(int), letters[2].astype(int), letters[0].astype(int)
    want = np.roll(edge, 2) * np.roll(a, 1) * b + np.roll(a, 2) * np.roll(b, 1) * edge
    assert np.allclose(vectors.bundle(codes, counts), want)
