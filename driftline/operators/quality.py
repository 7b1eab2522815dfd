"""Checks that run before a table is published: spread, floors, references, policies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.core.scan import bucket_folds, time_buckets


def spread(carriers: DataFrame, key: str, holder: str) -> DataFrame:
    """key, holders: on how many distinct holders a key occurs.

    Copies within a holder are folded first, so a key with a third of all rows is counted from its
    distinct pairs, which map-side combination brings together.
    """
    return carriers.select(key, holder).distinct().groupBy(key).agg(F.count("*").alias("holders"))


def spread_breaches(spreads: DataFrame, key: str, limit: int = 30, baseline: DataFrame | None = None) -> DataFrame:
    """Keys on more than ``limit`` holders, and on more than a baseline (key, allowed) grants them."""
    over = spreads.filter(F.col("holders") > limit)
    if baseline is None:
        return over
    return over.join(baseline, key, "left").filter("allowed IS NULL OR holders > allowed").drop("allowed")


def row_floor(before: DataFrame, after: DataFrame, key: str, pct: int = 40, least: int = 20) -> DataFrame:
    """Tables that lost too much: fewer than was * (1 - pct / 100) rows now, of at least ``least`` before.

    A table that is absent on one side is new or deleted, not truncated: an inner join leaves it out.
    """
    a, b = before.groupBy(key).agg(F.count("*").alias("was")), after.groupBy(key).agg(F.count("*").alias("now"))
    return a.join(b, key).filter((F.col("was") >= least) & (F.col("now") * 100 < F.col("was") * (100 - pct)))


def absent_references(refs: DataFrame, present: DataFrame) -> DataFrame:
    """References (ref, kind) of which no artifact of an acceptable kind (present: id, kind) exists.

    A table reference needs a table, a page reference a page, a link either.
    """
    wanted = refs.withColumn("need", F.explode(F.when(F.col("kind") == "link", F.array(F.lit("table"), F.lit("page"))).otherwise(F.array("kind"))))
    have = present.select(F.col("id").alias("ref"), F.col("kind").alias("need")).distinct()
    found = wanted.join(have, ["ref", "need"], "left_semi").select("ref", "kind").distinct()
    return refs.join(found, ["ref", "kind"], "left_anti")


def census(refs: DataFrame, absent: DataFrame) -> DataFrame:
    """kind, referenced and absent ids, and occurrences of absent ones."""
    a = refs.groupBy("kind").agg(F.countDistinct("ref").alias("referenced"))
    b = absent.groupBy("kind").agg(F.countDistinct("ref").alias("absent"), F.count("*").alias("occurrences"))
    return a.join(b, "kind", "left").na.fill(0, ["absent", "occurrences"])


# fixed values: reasons an exclusion may have; ``deliberate`` ones also need a note
REASONS = ("deleted", "archived", "not_a_db", "db404", "no_access", "deliberate")


def checked_exclusions(exclusions: DataFrame) -> DataFrame:
    """Exclusions, refused as a whole if any has a reason outside REASONS or is deliberate without a note."""
    bad = ~F.coalesce(F.col("reason").isin(*REASONS), F.lit(False)) | ((F.col("reason") == "deliberate") & (F.coalesce(F.trim("note"), F.lit("")) == ""))
    message = F.concat(F.lit("exclusion refused: "), F.coalesce("id", F.lit("null")))
    return exclusions.withColumn("reason", F.when(bad, F.raise_error(message).cast("string")).otherwise(F.col("reason")))


def run_floor(now: DataFrame, floors: DataFrame, key: str, least_pct: int = 90) -> DataFrame:
    """key, n, floor, verdict, next_floor: inconclusive if nothing is there or less than ``least_pct`` % of the floor; a bad run leaves the floor as it is."""
    both = floors.join(now, key, "full_outer").select(key, F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("floor", F.lit(0)).alias("floor"))
    bad = (F.col("n") == 0) | (F.col("n") * 100 < F.col("floor") * least_pct)
    return both.select("*", F.when(bad, "inconclusive").otherwise("ok").alias("verdict"), F.when(bad, F.col("floor")).otherwise(F.col("n")).alias("next_floor"))


def first_class(classes: list[tuple[str, Column]], other: str = "other") -> Column:
    """The name of the first condition that holds."""
    out = F.lit(other)
    for name, condition in reversed(classes):
        out = F.when(condition, name).otherwise(out)
    return out


def probe_policy(rows: DataFrame, key: str, enriched: Column, least: int = 300, pct: int = 5) -> DataFrame:
    """key, total, rich, mode: ``some`` for big tables of which few rows are enriched, else ``all``."""
    t = rows.groupBy(key).agg(F.count("*").alias("total"), F.count_if(enriched).alias("rich"))
    return t.withColumn("mode", F.when((F.col("total") >= least) & (F.col("rich") * 100 < F.col("total") * pct), "some").otherwise("all"))


def gap_stats(events: DataFrame, key: str, at_us: str) -> DataFrame:
    """key, n, max_gap_us, last_us: the longest silence between consecutive events, and the last event.  Events without a time are counted only.

    A key is cut into hours.  The longest silence within hours comes from a window over each, that between
    hours from the first and last event of each, so no task sorts all events of a key.
    """
    rows, _, refined = time_buckets(events.filter(F.col(at_us).isNotNull()).select(key, F.col(at_us).alias("_us")).distinct(), key, "_us")
    inside = Window.partitionBy(key, "bucket").orderBy("_us")
    within = rows.withColumn("_gap", F.col("_us") - F.lag("_us").over(inside)).groupBy(key).agg(F.max("_gap").alias("_g"))
    ends = bucket_folds(rows, key, {"first": F.min("_us"), "last": F.max("_us")}, {"first": F.min, "last": F.max}, refined)
    between = ends.groupBy(key).agg(F.max(F.col("first") - F.col("before_last")).alias("_h"), F.max("last").alias("last_us"))
    n = events.groupBy(key).agg(F.count("*").alias("n"))
    return n.join(within, key, "left").join(between, key, "left").select(key, "n", F.greatest("_g", "_h").alias("max_gap_us"), "last_us")


def silent(events: DataFrame, key: str, at_us: str, now_us: int, most_us: int) -> DataFrame:
    """key, silence_us of the keys that nothing was heard of for longer than they were ever silent before, and ``most_us`` at least."""
    g = gap_stats(events, key, at_us).withColumn("silence_us", F.lit(now_us) - F.col("last_us"))
    return g.filter((F.col("silence_us") >= most_us) & (F.col("max_gap_us").isNull() | (F.col("silence_us") > F.col("max_gap_us")))).select(key, "silence_us")


def several_homes(holders: DataFrame, key: str, home: str) -> DataFrame:
    """Keys held by more than one home: key, homes, first_home."""
    return holders.filter(F.col(key).isNotNull()).groupBy(key).agg(F.countDistinct(home).alias("homes"), F.min(home).alias("first_home")).filter("homes > 1")


def not_covered(left: DataFrame, right: DataFrame, key: str, words: str) -> DataFrame:
    """key, missing: how many distinct words of the left text the right text of the same key lacks (all of them if there is none)."""
    both = left.select(key, F.col(words).alias("_a")).join(right.select(key, F.col(words).alias("_b")), key, "left")
    missing = F.size(F.array_except("_a", F.coalesce("_b", F.array().cast("array<string>"))))
    return both.select(key, missing.alias("missing")).filter("missing > 0")


def word_set(c: Column) -> Column:
    """The distinct words of a text in small letters."""
    return F.array_distinct(F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: w != ""))


def uncovered_properties(properties: DataFrame, documents: DataFrame, key: str) -> DataFrame:
    """Properties (key, name, value) that the document of their key does not cover: it has no table row of that name, and not all words of the value.

    A key without a document covers nothing but values without words; empty values need no cover.
    """
    docs = documents.select(key, "document", word_set(F.col("document")).alias("_words"))
    both = properties.filter("value <> ''").join(docs, key, "left")
    named = F.coalesce(F.contains("document", F.concat(F.lit("| "), F.col("name"), F.lit(" |"))), F.lit(False))
    there = F.size(F.array_except(word_set(F.col("value")), F.coalesce("_words", F.array().cast("array<string>")))) == 0
    return both.filter(~(named | there)).select(*properties.columns)


def replaced_documents(old: DataFrame, properties: DataFrame, documents: DataFrame, probed: DataFrame, key: str) -> DataFrame:
    """Keys of ``old`` documents that may go: probed, with a document now that covers every property the old one had."""
    missing = uncovered_properties(properties, documents, key).select(key).distinct()
    return old.select(key).distinct().join(probed.select(key), key, "left_semi").join(documents.select(key), key, "left_semi").join(missing, key, "left_anti")
