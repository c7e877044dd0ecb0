"""A training corpus from raw documents: STAGES in order, each on all that the one before it kept.

A stage is (name, function); the function takes (spark, docs, sf_dir) and
returns a DataFrame. ``run`` writes each stage's result to the shared
checkpoint folder and gives it to the next. All stages but the last return
the columns of ``documents``; the last returns the token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valorem.llm import byte_bpe, decontaminate, language_id, line_dedup, simhash
from valorem.llm.common import doc_crc, stored, table

#: Least posterior probability with which a document's language counts as known.
MIN_LANGUAGE_SCORE = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told. Those without letters, without text or between languages go.

    The model learns from the labels of the documents whose crc32(doc_id) mod 4 is not 2, as in op9.
    """
    model = language_id.train(docs.filter((doc_crc(F.col("doc_id")) % 4) != 2))
    told = language_id.identify(docs.select(*docs.columns), model)
    return (told.filter((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE))
            .select(*docs.columns))


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that precede in equal or nearly equal form; documents of which nothing is left go."""
    left = line_dedup.dedup_lines(docs, counts=False)
    left = left.filter(F.col("text").rlike(r"\S"))
    return left.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the least doc_id) of each group of SimHash near-duplicates."""
    return simhash.one_per_group(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, ids."""
    return byte_bpe.round_trip(docs, with_ids=True, share=byte_bpe.PIPELINE_SHARE)


STAGES = [
    ("language_id", known_language),
    ("line_dedup", distinct_lines),
    ("simhash", one_of_each_group),
    ("decontamination", without_benchmark),
    ("byte_bpe", tokens),
]

#: The language model, SimHash and BPE have no SQL form; tests/llm/test_pipeline.py holds the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
