"""A training-data pipeline of five stages over documents.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which run() writes to the shared folder and reads again as the next
stage's docs.  Rows keep the columns of documents until the last stage, whatever other
columns there are and whatever their names.

language      op 6: drops texts without a language (null, or without a letter)
near_dedup    op 9: keeps one document of each component of SimHash fingerprints at most three bits apart
decontaminate op 1: drops documents that hold a benchmark phrase
secrets       op 7: replaces secrets by a mark, so no document is lost
pack          op 2: places all documents in sequences
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.llm import op1_decontamination, op2_packing, op6_language, op7_secrets, op9_simhash
from docsift.llm.common import cleanup, free_name, mark, stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language. Null, empty and letterless texts go, and all where no label can be learned; repeated rows stay; a null id is no label to learn from."""
    model = op6_language.fit(docs.select("doc_id", "text", "lang"))
    lang, score = free_name(docs, "stage_lang"), free_name(docs, "stage_score")
    found = op6_language.predict(docs, model, lang_col=lang, score_col=score)
    return found.where(F.col(lang) != op6_language.UNKNOWN).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component, that of the least id (ties: of the least text hash); of repeated rows, and of null, empty or wordless texts, one stays."""
    return op9_simhash.one_of_each_component(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark phrase. Null and empty texts hold none and stay; repeated rows share their fate; without benchmark items all stay."""
    return op1_decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret. Null and empty texts stay as they are; repeated rows are redacted alike; other columns (n_chars too) are kept."""
    return op7_secrets.redact(docs, op7_secrets.fit(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences. A null or empty text is one piece, the end id; repeated rows are packed each; very long texts are cut."""
    return op2_packing.best_fit_packing(docs)


STAGES = [("language", language), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("secrets", secrets), ("pack", pack)]

#: Trained models and packing have no SQL twin; tests/llm checks the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. A stage's own tables are removed when its rows are written, the last stage's by common.cleanup() when its rows are."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        since = mark()
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        cleanup(spark, since, keep=docs)
    return STAGES[-1][1](spark, docs, sf_dir)
