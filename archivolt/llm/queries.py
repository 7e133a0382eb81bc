"""The queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archivolt.llm import authored, entities, leakage, mixture, neardup, pii, scanfix, spans
from archivolt.llm.oracles import ORACLES as ORACLES
from archivolt.llm.texts import records
from archivolt.runtime import spread, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", "source"))


@query
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_record_pairs(records(spark, d))


@query
def p1_groups(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_groups(records(spark, d))


@query
def p1_links(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_links(records(spark, d))


def _scanned(spark: SparkSession, d: str) -> tuple[DataFrame, scanfix.Editor, DataFrame | None]:
    documents = table(spark, d, "documents")
    editor, rest = scanfix.trained_editor(documents.select(F.col("doc_id").alias("id"), "text"), table(spark, d, "clean_samples"))
    return scanfix.scanned_records(documents, table(spark, d, "messages"), table(spark, d, "search_results")), editor, rest


@query
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return scanfix.scan_findings(*_scanned(spark, d))


@query
def p2_repaired(spark: SparkSession, d: str) -> DataFrame:
    return scanfix.repaired_texts(*_scanned(spark, d))


@query
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return authored.new_lines(spread(table(spark, d, "messages").select("msg_id", "body")))


@query
def p3_authored(spark: SparkSession, d: str) -> DataFrame:
    return authored.new_text(spread(table(spark, d, "messages").select("msg_id", "body")))


@query
def p3_raw(spark: SparkSession, d: str) -> DataFrame:
    """The new text of the complete mails, where a message has one."""
    return authored.new_text(spread(table(spark, d, "messages").where("raw_text <> ''").select("msg_id", "raw_text")), "raw_text", headed=True)


def _personal(spark: SparkSession, d: str) -> tuple[DataFrame, pii.Finder]:
    documents, messages = table(spark, d, "documents"), table(spark, d, "messages")
    texts = spread(documents.select(F.lit("d").alias("rec"), F.col("doc_id").alias("id"), "text"))
    texts = texts.unionByName(spread(messages.select(F.lit("m").alias("rec"), F.col("msg_id").alias("id"), F.col("body").alias("text"))))
    return texts, pii.trained_finder(documents, messages)


@query
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return pii.findings(*_personal(spark, d))


@query
def p5_redacted(spark: SparkSession, d: str) -> DataFrame:
    return pii.redacted(*_personal(spark, d))


@query
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return entities.linked_pairs(*entities.spellings(table(spark, d, "documents"), table(spark, d, "messages")))


@query
def p6_clusters(spark: SparkSession, d: str) -> DataFrame:
    return entities.linked_names(*entities.spellings(table(spark, d, "documents"), table(spark, d, "messages")))


@query
def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked_items(_documents(spark, d), table(spark, d, "eval_items")).where("kind = 'verbatim'").select("item_id", F.col("id").alias("doc_id"))


@query
def p7_leaks(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked_items(_documents(spark, d), table(spark, d, "eval_items"))


@query
def p8_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixture.mix_sources(mixture.token_counts(_documents(spark, d)), table(spark, d, "mix_targets"))[0]


@query
def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixture.mix_sources(mixture.token_counts(_documents(spark, d)), table(spark, d, "mix_targets"))[1]


@query
def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return spans.shared_span_pairs(_documents(spark, d))


@query
def p9_shared(spark: SparkSession, d: str) -> DataFrame:
    return spans.shared_shares(_documents(spark, d))


@query
def p9_units(spark: SparkSession, d: str) -> DataFrame:
    return spans.unit_dedup(_documents(spark, d)).drop("removed")
