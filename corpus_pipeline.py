"""A corpus-cleaning pipeline over ``documents``: five stages, each one of the operators.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the one before has
kept; its result is written as Parquet to the shared folder and read again as the next
one's ``docs``. All stages but the last return the columns of ``documents``.

* toxicity: rows that the classifier (fitted on this stage's rows and ``labels``) scores at or
  above its threshold go; unlabelled documents are judged like any other.
* line_dedup: boilerplate lines of each source go from the texts (``n_chars`` follows).
* simhash: of each near-duplicate group the document of the smallest doc_id stays.
* decontamination: documents that hold a benchmark passage go.
* bpe: token counts and digests of the ids and of the decoded text, per remaining document.

``ORACLE_SQL`` is None: a trained classifier, fingerprints and BPE are beyond SQL; the
stages are tested against brute-force versions in ``tests/llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinesift.llm import bpe, decontam, line_dedup, simhash, toxicity
from cinesift.llm.common import DOCUMENT_COLUMNS, shared_path, table
from cinesift.session import drop_scratch, scratch_mark


def _document_columns(docs: DataFrame) -> DataFrame:
    return docs.select(*DOCUMENT_COLUMNS)


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = _document_columns(docs)
    model = toxicity.fit(docs, toxicity.training_rows(table(spark, sf_dir, "labels")))
    return toxicity.reject_toxic(docs, model)


def stage_line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_boilerplate(_document_columns(docs)).withColumn(
        "n_chars", F.char_length("text").cast("long"))


def stage_simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one_of_each_group(_document_columns(docs))


def stage_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(_document_columns(docs), table(spark, sf_dir, "benchmark"))


def stage_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs)


STAGES = [
    ("toxicity", stage_toxicity),
    ("line_dedup", stage_line_dedup),
    ("simhash", stage_simhash),
    ("decontamination", stage_decontamination),
    ("bpe", stage_bpe),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Whatever a stage wrote on its way, and its input if that was a stage's
    output, is deleted once its own output is written."""
    docs, mark = table(spark, sf_dir, "documents"), scratch_mark(spark)
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = shared_path(spark, name)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        drop_scratch(spark, mark, keep=(path,))
    return docs
