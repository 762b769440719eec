import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline

QUESTION = "the seven old sailors asked how many barrels of salted fish the northern harbour had sold before winter came and why"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    draw = np.random.default_rng(12)
    words = [f"{a}{b}{c}" for a in ("ber", "tol", "min", "gra") for b in "aeiou" for c in ("nd", "st", "rk", "lm", "ve")]
    docs = [(i, " ".join(draw.choice(words, 60)), "en", f"src{i % 3}", 0) for i in range(300)]
    docs = [(i, t + " vileword grotling vileword" if i % 10 == 0 else t, *r) for i, t, *r in docs]
    docs += [(1000, docs[1][1], "en", "src0", 0), (1001, docs[2][1] + " extra", "en", "src0", 0)]  # copies
    docs += [(1002, docs[3][1][:150] + ". " + QUESTION, "en", "src1", 0), (1003, "1234 5678 !!", "en", "src1", 0), (1004, None, None, "src1", 0)]
    labels = [(i, 1 if i % 7 else 0, int(i % 10 == 0)) for i in range(300)]
    at = tmp_path_factory.mktemp("pipeline")
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, QUESTION)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at)


def test_stages_one_by_one_and_run(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, left = docs.columns, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        left.append({r.doc_id for r in docs.select("doc_id").collect()})
    clean = {i for i in range(300) if i % 10} | {1000, 1001, 1002}
    assert left[0] == {*range(300), 1000, 1001, 1002}
    assert left[1] == clean
    assert left[2] == clean - {1000, 1001}
    assert left[3] == left[4] == clean - {1000, 1001, 1002}
    assert all(r.rate >= 0 and r.n_tokens > 0 for r in docs.collect())
    assert {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()} == left[4]


def test_columns_of_any_name_pass_and_rows_without_an_id_are_judged(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id <= 60 or doc_id >= 1000")
    names = ["a.b", "_held_out", "_language", "_toxicity", "_tokens", "_rate", "_posteriors", "key", "n", "class_id", "item_id", "weight", "odd `name"]
    for i, name in enumerate(names):
        docs = docs.withColumn(name, F.lit(i))
    text = docs.where("doc_id = 5").first()["text"]
    unnamed = docs.where("doc_id = 7").drop("doc_id").withColumn("doc_id", F.lit(None).cast("long")).select(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns])
    more = [unnamed.withColumn("text", F.lit(t)) for t in (text, text[:200] + ". " + QUESTION, text + " vileword grotling vileword")]
    docs = docs.unionByName(more[0]).unionByName(more[1]).unionByName(more[2])
    columns, schema = docs.columns, docs.schema
    docs = docs.select("*").persist()
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, folder)
        assert docs.columns[: len(columns)] == columns
        assert [f.dataType for f in docs.schema][: len(columns)] == [f.dataType for f in schema]
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    rows = docs.collect()
    assert rows and all(tuple(r[len(columns) - len(names) : len(columns)]) == tuple(range(len(names))) for r in rows)
    # A copy, a leak and a toxic text, all without an id.
    assert None not in {r.doc_id for r in rows}
    assert 5 in {r.doc_id for r in rows}
