"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from cinesift.llm import (
    ann, bpe, centroids, decontam, html_text, line_dedup, pii, secret_scan, sharding, simhash, toxicity, turns, warc)
from cinesift.llm.common import table


def op1_secret_scan(spark, sf_dir):
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op2_bpe(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op3_decontamination(spark, sf_dir):
    return decontam.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_posting_lists(spark, sf_dir):
    vectors = ann.usable(table(spark, sf_dir, "embeddings"))
    return ann.search(vectors, F.col("vec_id") % 100 == 0)


def op5_toxicity(spark, sf_dir):
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_html_text(spark, sf_dir):
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op7_personal_data(spark, sf_dir):
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op8_warc(spark, sf_dir):
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op9_line_dedup(spark, sf_dir):
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


def op10_simhash(spark, sf_dir):
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op11_centroids(spark, sf_dir):
    return centroids.cluster(centroids.scaled(table(spark, sf_dir, "embeddings")))


def op12_conversation_repair(spark, sf_dir):
    return turns.damage_and_repair(table(spark, sf_dir, "conversations"))


def op13_sharding(spark, sf_dir):
    return sharding.shard_plan(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_bpe, op3_decontamination, op4_posting_lists, op5_toxicity, op6_html_text,
    op7_personal_data, op8_warc, op9_line_dedup, op10_simhash, op11_centroids, op12_conversation_repair, op13_sharding)}

ORACLE_SQL: dict[str, str] = {
    "op8_warc": warc.ORACLE, "op9_line_dedup": line_dedup.ORACLE, "op11_centroids": centroids.ORACLE,
    "op12_conversation_repair": turns.ORACLE, "op13_sharding": sharding.ORACLE}
