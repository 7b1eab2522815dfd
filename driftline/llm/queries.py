"""Queries of the text problems p5 to p8, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from driftline.core.tables import table
from driftline.llm import language, leak, mixture, pii


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return pii.pii_in_captures(table(spark, d, "webhook_captures"), pii.name_parts(table(spark, d, "people")))


def p5_redacted(spark: SparkSession, d: str) -> DataFrame:
    return pii.redacted_captures(table(spark, d, "webhook_captures"), pii.name_parts(table(spark, d, "people")))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    items = ((r.item_id, r.text) for r in table(spark, d, "eval_items").select("item_id", "text").toLocalIterator())
    return leak.leaked_items(table(spark, d, "documents"), items)


def p7_selection(spark: SparkSession, d: str) -> DataFrame:
    return mixture.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    targets = table(spark, d, "mix_targets")
    return mixture.shares(mixture.mix(table(spark, d, "documents"), targets), targets)


def _model(spark: SparkSession, d: str) -> language.Model:
    return language.trained(table(spark, d, "documents"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return language.label_corrections(table(spark, d, "documents"), _model(spark, d))


def p8_languages(spark: SparkSession, d: str) -> DataFrame:
    return language.detected_languages(table(spark, d, "documents"), _model(spark, d))


QUERIES = {f.__name__: f for f in (p5_found, p5_redacted, p6_found, p7_selection, p7_shares, p8_found, p8_languages)}
ORACLES: dict[str, str] = {}
