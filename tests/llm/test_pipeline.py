"""The pipeline's stages on a small corpus, each held against what it must do."""

import random

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
pytest.importorskip("public_tokenizers")
import __spark_entry__  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def test_stages_are_the_listed_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeats", "personal_data", "packing"]
    assert "pipeline" in __spark_entry__.queries()


def test_pipeline_on_the_small_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
        out = spark.createDataFrame(out.collect(), docs.schema)
        rows[name] = out.collect()
        docs = out
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    kept = {r.doc_id for r in rows["quality"]}
    clean = [i for i, q in quality.items() if q == 1]
    assert sum(i in kept for i in clean) >= 0.97 * len(clean)
    assert sum(i in kept for i, q in quality.items() if q == 0) <= 0.2 * sum(q == 0 for q in quality.values()) + 1
    assert len({r.text for r in rows["near_duplicates"]}) == len(rows["near_duplicates"])
    assert len(rows["repeats"]) == len(rows["near_duplicates"])
    assert not any("@mail" in r.text for r in rows["personal_data"])
    assert all(r.n_chars == len(r.text) for r in rows["personal_data"])


def test_run_packs_all_documents(spark):
    out = corpus_pipeline.run(spark, SMALL).collect()
    assert len({r.doc_id for r in out}) > 100
    assert all(r.length <= 1024 for r in out)


def test_stages_take_nulls_and_empty_tables(spark, tmp_path):
    rng = random.Random(1)
    text = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(80)) + "."
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, text(), None, None, 1) for i in range(30)] + [(30, None, "en", "s", None), (None, "", None, None, 0)], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().count() == 31  # the two empty texts are copies
    empty = tmp_path / "empty"
    spark.createDataFrame([], schema).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{empty}/labels.parquet")
    assert corpus_pipeline.run(spark, str(empty)).count() == 0
