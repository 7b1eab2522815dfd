"""Coverage of a mirror: references written in documents, what of them is settled, and closing the gaps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.core.store import cut

# fixed values: shapes of the lines that stand for a sub-document, by kind and name, and lines that name none
_ID = "([0-9a-f]{32})"
SHAPES = [
    ("child_database", "db_long", rf"^\s*- 🗄️ \*\*.*?\*\* — database `{_ID}` \(rows in workspace/_databases/\)\s*$"),
    ("child_database", "db_long_csv", rf"^\s*- 🗄️ \*\*.*?\*\* — database `{_ID}` \(rows in CSV export\)\s*$"),
    ("child_database", "db_short", rf"^\s*- 🗄️ [^`]*?\s*`{_ID}`\s*$"),
    ("sub_page", "page_long", rf"^\s*- 📄 \*\*.*?\*\* — sub-page `{_ID}`\s*$"),
    ("sub_page", "page_long_status", rf"^\s*- 📄 \*\*.*?\*\* — sub-page `{_ID}` \((?:have|MISSING)\) → `.*`\s*$"),
    ("sub_page", "page_short", rf"^\s*- 📄 [^`]*?\s*`{_ID}`\s*$"),
    ("link_to_page", "link_to_page", rf"^\s*- 🔗 link to `{_ID}`\s*$"),
]
BLIND = [("idless_db", rf"^\s*- 🗄️ (?![^`]*`{_ID}`)"), ("idless_page", rf"^\s*- 📄 (?![^`]*`{_ID}`)"), ("unhandled", r"^\s*<!-- unhandled block type: ")]
#: Kinds of artifact that satisfy a reference.
NEEDS = {"child_database": ["table"], "sub_page": ["page"], "link_to_page": ["table", "page"]}


def references(lines: DataFrame, text: str = "text") -> DataFrame:
    """The lines that refer to something, with kind, shape and id: the first shape that fits."""
    # most lines are no item at all
    few = lines.filter(F.ltrim(F.col(text)).startswith("- "))
    first = F.coalesce(*[F.when(F.col(text).rlike(rx), F.struct(F.lit(k).alias("kind"), F.lit(s).alias("shape"), F.regexp_extract(text, rx, 1).alias("ref"))) for k, s, rx in SHAPES])
    # as the only element of an array, so that it is evaluated once
    return few.select("*", F.explode(F.array(first)).alias("_ref")).filter("_ref IS NOT NULL").select(*lines.columns, "_ref.*")


def blind_spots(lines: DataFrame, text: str = "text") -> DataFrame:
    """spot, lines: lines that refer to something which cannot be resolved to an id."""
    spot = F.lit(None).cast("string")
    for name, rx in reversed(BLIND):
        spot = F.when(F.col(text).rlike(rx), name).otherwise(spot)
    return lines.select(spot.alias("spot")).filter("spot IS NOT NULL").groupBy("spot").agg(F.count("*").alias("lines"))


def _needs(kind: Column) -> Column:
    return F.element_at(F.create_map(*[x for k, v in NEEDS.items() for x in (F.lit(k), F.array(*[F.lit(n) for n in v]))]), kind)


def absent(refs: DataFrame, present: DataFrame) -> DataFrame:
    """References (ref, kind, ...) of which no artifact of a kind that satisfies them is there (present: id, kind of artifact)."""
    have = present.groupBy("id").agg(F.collect_set("kind").alias("_have"))  # two kinds at most
    both = refs.join(have, refs["ref"] == have["id"], "left")
    return both.filter(F.col("_have").isNull() | ~F.arrays_overlap("_have", _needs(F.col("kind")))).select(*refs.columns)


def settled(items: DataFrame, progress: DataFrame, present: DataFrame, excluded: DataFrame) -> DataFrame:
    """Items (ref, kind) with ``state``: excluded (excluded: ref), settled if done (progress: ref, state) and its artifact is there, ``lost`` if done but gone, failed, or open."""
    have = present.groupBy(F.col("id").alias("ref")).agg(F.collect_set("kind").alias("_have"))
    p = progress.groupBy("ref").agg(F.max("state").alias("_p"))  # 'failed' is after 'done'
    x = excluded.select("ref").distinct().withColumn("_x", F.lit(True))
    both = items.join(have, "ref", "left").join(p, "ref", "left").join(x, "ref", "left")
    there = F.coalesce(F.arrays_overlap("_have", _needs(F.col("kind"))), F.lit(False))
    state = F.when(F.col("_x"), "excluded").when((F.col("_p") == "done") & there, "settled").when(F.col("_p") == "done", "lost").when(F.col("_p") == "failed", "failed").otherwise("open")
    return both.select(*items.columns, state.alias("state"))


def close_gaps(
    start: DataFrame, capture: Callable[[DataFrame], DataFrame], refer: Callable[[DataFrame], DataFrame], present: DataFrame, excluded: DataFrame, budget: int | None = None
) -> DataFrame:
    """Capture what is referred to and absent, look at the new artifacts only, and go on with what they refer to, until nothing is left or ``budget`` items were asked for.

    start: ref, kind; capture: items to (ref, kind of artifact) of those it got; refer: artifacts (ref) to the references (ref, kind) in them.
    Returns ref, round, got: every item asked for, once.  An item that could not be got is not asked for again.
    """
    asked, have, todo, spent, k = None, present.select("id", "kind"), start.select("ref", "kind").distinct(), 0, 0
    while True:
        k += 1
        todo = absent(todo, have).join(excluded.select("ref"), "ref", "left_anti")
        if asked is not None:
            todo = todo.join(asked.select("ref"), "ref", "left_anti")
        todo = todo.groupBy("ref").agg(F.min("kind").alias("kind"))
        if budget is not None:
            todo = todo.orderBy("ref").limit(max(0, budget - spent))
        todo = cut(todo, "gaps")
        n = todo.count()
        if not n:
            return asked if asked is not None else todo.select("ref", F.lit(0).alias("round"), F.lit(False).alias("got"))
        spent += n
        got = cut(capture(todo), "captured")
        mine = todo.join(got.select("ref").distinct().withColumn("_g", F.lit(True)), "ref", "left").select("ref", F.lit(k).alias("round"), F.coalesce("_g", F.lit(False)).alias("got"))
        asked = cut(mine if asked is None else asked.unionByName(mine), "asked")
        have = cut(have.unionByName(got.select(F.col("ref").alias("id"), "kind")), "have")
        todo = refer(got.select("ref").distinct())
