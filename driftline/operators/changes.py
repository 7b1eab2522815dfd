"""Comparing snapshots of keyed tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.core.store import cut
from driftline.functions.keys import norm_id
from driftline.operators.versions import precedence


def in_force(records: DataFrame, at: str | None = None, fields: list[str] | None = None) -> DataFrame:
    """The record in force of every page at an instant (or now): page_id and the chosen fields.

    One aggregation with map-side combination; a page with very many records costs a task one row per map task.
    """
    fields = fields or ["title", "parent_type", "parent_id", "last_edited_time", "archived", "in_trash", "url", "swept_at"]
    seen = records.filter("swept_at IS NOT NULL AND id IS NOT NULL")
    if at is not None:
        seen = seen.filter(F.col("swept_at") <= F.lit(at).cast("timestamp"))
    rec = F.struct(*precedence(), F.struct(*fields).alias("content"))
    best = seen.groupBy(norm_id("id").alias("page_id")).agg(F.max(rec).alias("rec"))
    return best.select("page_id", *[F.col(f"rec.content.{f}").alias(f) for f in fields])


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, fields: list[str], drift: str | None = None) -> DataFrame:
    """key, change: ``added``, ``changed`` (a field differs, nulls being values, or ``drift`` differs where both have it), ``deleted`` or ``same``.

    Keys are unique on both sides.  An empty old side is a first snapshot: nothing counts as added, all as changed.
    """
    a = old.select(F.col(key), F.struct(*fields).alias("was"), (F.col(drift) if drift else F.lit(None)).alias("old_drift"))
    b = new.select(F.col(key), F.struct(*fields).alias("now"), (F.col(drift) if drift else F.lit(None)).alias("new_drift"))
    first = old.limit(1).count() == 0
    drifted = F.col("old_drift").isNotNull() & F.col("new_drift").isNotNull() & (F.col("old_drift") != F.col("new_drift"))
    change = (
        F.when(F.col("now").isNull(), "deleted")
        .when(F.col("was").isNull(), "changed" if first else "added")
        .when(~F.col("was").eqNullSafe(F.col("now")) | F.coalesce(drifted, F.lit(False)), "changed")
        .otherwise("same")
    )
    return a.join(b, key, "full_outer").select(key, change.alias("change"))


def positions(df: DataFrame, order: list[Column], name: str = "pos") -> DataFrame:
    """Rows numbered from 0 in a total order without one task sorting all of them.

    Range partitions are sorted, counted and numbered from the sum of the counts before them; the written
    copy in between keeps both steps on the same rows.
    """
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_in", F.monotonically_increasing_id())
    held = cut(sorted_.select(*df.columns, F.shiftright("_in", 33).cast("int").alias("_part"), F.col("_in").bitwiseAND(F.lit((1 << 33) - 1)).alias("_row")), "positions")
    counts = held.groupBy("_part").agg(F.count("*").alias("n")).orderBy("_part").collect()  # one row a partition
    before, starts = 0, []
    for r in counts:
        starts.append((r["_part"], before))
        before += r["n"]
    offsets = df.sparkSession.createDataFrame(starts, "_part int, _before bigint")
    return held.join(F.broadcast(offsets), "_part").select(*df.columns, (F.col("_before") + F.col("_row")).alias(name))


def ordered_merge(old: DataFrame, new: DataFrame, key: str, created: str) -> DataFrame:
    """Order of a rewritten table: surviving keys as they stood (old ``pos``), then new ones by creation time, then key."""
    both = new.join(old.select(key, F.col("pos").alias("_old")), key, "left")
    return positions(both.select(key, "_old", created), [F.col("_old").asc_nulls_last(), F.col(created).asc_nulls_last(), F.col(key).asc()]).select(key, "pos")


def multiset_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of one side that the other lacks, copies counted: the columns and ``side``."""
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))


def resolve_columns(existing: list[str], in_rows: list[str], in_schema: list[str]) -> list[tuple[str, int, str]]:
    """(column, position, fate) of a rewritten table: existing order kept, columns gone from both rows and schema dropped, new ones appended in schema order, then as first seen."""
    known = set(in_rows) | set(in_schema)
    kept = [c for c in existing if c in known]
    new = [c for c in in_schema if c not in existing] + [c for c in in_rows if c not in existing and c not in in_schema]
    out = [(c, i, "kept" if c in set(in_rows) else "schema only") for i, c in enumerate(kept)]
    out += [(c, len(kept) + i, "added") for i, c in enumerate(dict.fromkeys(new))]
    return out + [(c, -1, "dropped") for c in existing if c not in known]


def union_sources(sources: list[DataFrame]) -> DataFrame:
    """All rows of one logical table; columns missing in a source are null.  No source at all is an error, never an empty table."""
    if not sources:
        raise ValueError("a table without sources cannot be told from a failed listing")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def first_wins(specs: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key: the one of the smallest ``order`` (unique within a key)."""
    rest = [c for c in specs.columns if c not in (key, order)]
    best = specs.groupBy(key).agg(F.min(F.struct(order, *rest)).alias("b"))
    return best.select(key, f"b.{order}", *[F.col(f"b.{c}").alias(c) for c in rest])


def split_matched(left: DataFrame, right: DataFrame, key: str, flag: str = "matched") -> DataFrame:
    """Lookup that keeps what finds nothing, marked, instead of losing it."""
    return left.join(right.withColumn(flag, F.lit(True)), key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def unanswered(candidates: DataFrame, key: str, answered: list[DataFrame]) -> DataFrame:
    """Distinct candidates that none of the sets of already answered keys holds."""
    return reduce(lambda a, b: a.join(b.select(key), key, "left_anti"), answered, candidates.select(key).distinct())


def completed_lists(short: DataFrame, full: DataFrame, key: str, items: str, cap: int) -> DataFrame:
    """key, items, state of lists of which a first look returned ``cap`` items at most (short: key, items, has_more; full: key, items).

    Lists that say they go on, or have exactly ``cap`` items, are looked up: ``refetched`` with what the lookup has,
    ``short`` (as they were, and to be reported) where it fails.  The others are ``complete``.
    """
    asked = F.coalesce("has_more", F.lit(False)) | (F.size(items) == cap)
    both = short.join(full.select(key, F.col(items).alias("_full")), key, "left")
    state = F.when(~F.coalesce(asked, F.lit(False)), "complete").when(F.col("_full").isNotNull(), "refetched").otherwise("short")
    return both.select(key, F.when(state == "refetched", F.col("_full")).otherwise(F.col(items)).alias(items), state.alias("state"))
