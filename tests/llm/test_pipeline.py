"""The pipeline's stages, each on its own input."""

import corpus_pipeline as pipeline
from docsift.llm import op2_packing
from tests.conftest import SF

STAGES = dict(pipeline.STAGES)


def test_stages_keep_columns_and_clean_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
        if name != "near_dedup":
            assert out.count() >= 0.9 * docs.count(), name


def small(spark, *rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, lang_pred string")


def test_decisions_take_effect(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    docs = small(spark, (1, "plain words of a clean document"), (2, "plain words of a clean document"), (3, None), (4, "1234 !!"), (5, f"before {item} after"), (6, "here token = abcdef0123456789 there"), (None, "also a clean one, without an id"), (1, "plain words of a clean document"))
    ids = lambda df: sorted((r["doc_id"] or -1) for r in df.collect())
    assert ids(STAGES["language"](spark, docs, SF)) == [-1, 1, 1, 2, 5, 6]
    assert ids(STAGES["near_dedup"](spark, docs.where("doc_id is null or doc_id not in (3, 4)"), SF)) == [-1, 1, 5, 6]
    assert 5 not in ids(STAGES["decontaminate"](spark, docs, SF)) and len(ids(STAGES["decontaminate"](spark, docs, SF))) == 7
    out = {r["doc_id"]: r["text"] for r in STAGES["secrets"](spark, docs, SF).collect()}
    assert out[6] == "here [secret] there" and out[5] == f"before {item} after" and out[3] is None
    assert set(op2_packing.best_fit_packing(docs).columns) == set(STAGES["pack"](spark, docs, SF).columns)


def test_whole_run(spark):
    out = pipeline.run(spark, SF)
    assert {"doc_id", "piece", "start", "length", "sequence_id", "offset"} <= set(out.columns)
    kept = out.select("doc_id").distinct().count()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert 0.7 * docs.select("text").distinct().count() <= kept <= docs.count()
