"""Queries of a mirror's coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftline.core.tables import table
from driftline.functions.keys import norm_id
from driftline.operators import coverage as V
from driftline.operators import schedule as S
from driftline.plans.changes import _pages, force_sql


def _lines(spark, d):
    """The line that stands for each link block in a document; the writers of a third each spelled it in their own way, some without an id."""
    b = table(spark, d, "blocks").filter("block_type IN ('child_database', 'child_page', 'link_to_page')")
    title = F.coalesce(F.get_json_object("payload", "$.title"), F.lit("untitled"))
    ident, way = norm_id("block_id"), F.col("block_no") % 4
    tick = lambda c: F.concat(F.lit("`"), c, F.lit("`"))
    db = (
        F.when(way == 0, F.concat(F.lit("- 🗄️ **"), title, F.lit("** — database "), tick(ident), F.lit(" (rows in workspace/_databases/)")))
        .when(way == 1, F.concat(F.lit("  - 🗄️ **"), title, F.lit("** — database "), tick(ident), F.lit(" (rows in CSV export)")))
        .when(way == 2, F.concat(F.lit("- 🗄️ "), title, F.lit(" "), tick(ident)))
        .otherwise(F.concat(F.lit("- 🗄️ "), title))
    )
    page = (
        F.when(way == 0, F.concat(F.lit("- 📄 **"), title, F.lit("** — sub-page "), tick(ident)))
        .when(way == 1, F.concat(F.lit("- 📄 **"), title, F.lit("** — sub-page "), tick(ident), F.lit(" (MISSING) → `x.md`")))
        .when(way == 2, F.concat(F.lit("- 📄 "), title, F.lit(" "), tick(ident)))
        .otherwise(F.concat(F.lit("- 📄 "), title))
    )
    target = norm_id(F.coalesce(F.get_json_object("payload", "$.page_id"), F.get_json_object("payload", "$.database_id")))
    link = F.concat(F.lit("- 🔗 link to "), tick(target))
    line = F.when(F.col("block_type") == "child_database", db).when(F.col("block_type") == "child_page", page).otherwise(link)
    return b.select("block_no", norm_id("page_id").alias("page"), F.explode(F.array(line)).alias("text")).filter("text IS NOT NULL")


def _present(spark, d):
    """Artifacts that were captured by then: live databases, and pages whose record in force is not in the trash."""
    pages = _pages(spark, d, None, ["in_trash"]).filter("NOT coalesce(in_trash, false)").select(F.col("page_id").alias("id"), F.lit("page").alias("kind"))
    return pages.unionByName(table(spark, d, "databases").filter("deleted_at IS NULL").select(norm_id("db_id").alias("id"), F.lit("table").alias("kind")))


def ref_shapes(spark, d):
    """References in documents by kind and shape, and how many of them point at nothing."""
    refs = V.references(_lines(spark, d))
    n = refs.groupBy("kind", "shape").agg(F.count("*").alias("refs"), F.countDistinct("ref").alias("ids"))
    gone = V.absent(refs, _present(spark, d)).groupBy("kind", "shape").agg(F.count("*").alias("absent"))
    return n.join(gone, ["kind", "shape"], "left").na.fill(0, ["absent"])


def ref_blind_spots(spark, d):
    return V.blind_spots(_lines(spark, d))


def absent_refs(spark, d):
    """Absent ids per kind with the number of lines that refer to them."""
    return V.absent(V.references(_lines(spark, d)), _present(spark, d)).groupBy("kind", "ref").agg(F.count("*").alias("lines"))


def _items(spark, d):
    return V.references(_lines(spark, d)).select("ref", "kind").distinct()


def _progress(spark, d):
    """What an earlier backfill noted: trees it fetched, databases it knew."""
    done = table(spark, d, "block_trees").select(norm_id("page_id").alias("ref"), F.lit("done").alias("state"))
    dbs = table(spark, d, "databases").select(norm_id("db_id").alias("ref"), F.when(F.col("title").isNull(), "failed").otherwise("done").alias("state"))
    return done.unionByName(dbs)


def _excluded(spark, d):
    return table(spark, d, "pages_metadata").filter("archived").select(norm_id("id").alias("ref")).distinct()


def settled_items(spark, d):
    return V.settled(_items(spark, d), _progress(spark, d), _present(spark, d), _excluded(spark, d)).groupBy("kind", "state").agg(F.count("*").alias("items"))


def next_slice(spark, d):
    """The next 40 items a backfill with that budget takes: what is not settled, tables first, then by id."""
    s = V.settled(_items(spark, d), _progress(spark, d), _present(spark, d), _excluded(spark, d))
    order = F.when(F.col("kind") == "child_database", 0).when(F.col("kind") == "sub_page", 1).otherwise(2)
    return S.due_slice(s.select("ref", "kind"), s.filter("state IN ('settled', 'excluded')"), ["ref", "kind"], [order, F.col("kind"), F.col("ref")], 40)


def gap_closure(spark, d):
    """Pages to be captured, starting from the link blocks of pages that were never edited since: each captured page is looked at for links, until nothing new is referred to."""
    lines = V.references(_lines(spark, d)).select("page", "ref", "kind")
    refs = lines.filter("kind = 'link_to_page'")
    first = refs.filter(F.col("page").rlike("^[0-3]")).select("ref", "kind")
    pages = table(spark, d, "pages_metadata").select(norm_id("id").alias("ref")).distinct().withColumn("kind", F.lit("page"))
    none = spark.createDataFrame([], "id string, kind string")
    out = V.close_gaps(first, lambda items: pages.join(items.select("ref"), "ref", "left_semi"), lambda got: refs.join(got.withColumnRenamed("ref", "page"), "page").select("ref", "kind"), none, spark.createDataFrame([], "ref string"))
    return out.select("ref", "round", "got")


QUERIES = {f.__name__: f for f in (ref_shapes, ref_blind_spots, absent_refs, settled_items, next_slice, gap_closure)}

_ID = "lower(replace({}, '-', ''))"
_LINES = f"""lines AS (SELECT block_no, page, kind AS k, way, CASE kind WHEN 'link_to_page' THEN {_ID.format("coalesce(json_extract_string(payload, '$.page_id'), json_extract_string(payload, '$.database_id'))")} ELSE {_ID.format("block_id")} END AS id
    FROM (SELECT block_no, {_ID.format("page_id")} AS page, block_type AS kind, block_no % 4 AS way, payload, block_id FROM blocks WHERE block_type IN ('child_database', 'child_page', 'link_to_page'))),
  refs AS (SELECT page, CASE k WHEN 'child_page' THEN 'sub_page' ELSE k END AS kind, id AS ref, CASE k WHEN 'link_to_page' THEN 'link_to_page' WHEN 'child_database' THEN ['db_long', 'db_long_csv', 'db_short'][way + 1] ELSE ['page_long', 'page_long_status', 'page_short'][way + 1] END AS shape
    FROM lines WHERE regexp_full_match(id, '[0-9a-f]{{32}}') AND (k = 'link_to_page' OR way < 3))"""
_PRESENT = f"""{force_sql("n")}, present AS (SELECT page_id AS id, 'page' AS kind FROM n WHERE NOT coalesce(in_trash, false) UNION SELECT {_ID.format("db_id")}, 'table' FROM databases WHERE deleted_at IS NULL)"""
_THERE = "EXISTS (SELECT 1 FROM present p WHERE p.id = r.ref AND (r.kind = 'link_to_page' OR (r.kind = 'child_database' AND p.kind = 'table') OR (r.kind = 'sub_page' AND p.kind = 'page')))"
_SETTLED = f"""{_LINES}, {_PRESENT}, prog AS (SELECT ref, max(state) AS p FROM (SELECT {_ID.format("page_id")} AS ref, 'done' AS state FROM block_trees UNION ALL SELECT {_ID.format("db_id")}, CASE WHEN title IS NULL THEN 'failed' ELSE 'done' END FROM databases) GROUP BY 1),
  st AS (SELECT r.ref, r.kind, CASE WHEN r.ref IN (SELECT {_ID.format("id")} FROM pages_metadata WHERE archived AND id IS NOT NULL) THEN 'excluded' WHEN p = 'done' AND {_THERE} THEN 'settled' WHEN p = 'done' THEN 'lost' WHEN p = 'failed' THEN 'failed' ELSE 'open' END AS state
    FROM (SELECT DISTINCT ref, kind FROM refs) r LEFT JOIN prog ON prog.ref = r.ref)"""
ORACLES = {
    "ref_shapes": f"WITH {_LINES}, {_PRESENT} SELECT kind, shape, count(*) AS refs, count(DISTINCT ref) AS ids, count(*) FILTER (NOT {_THERE}) AS absent FROM refs r GROUP BY ALL",
    "ref_blind_spots": f"WITH {_LINES} SELECT CASE k WHEN 'child_database' THEN 'idless_db' ELSE 'idless_page' END AS spot, count(*) AS lines FROM lines WHERE k <> 'link_to_page' AND (way = 3 OR NOT regexp_full_match(id, '[0-9a-f]{{32}}')) AND id IS NOT NULL GROUP BY 1",
    "absent_refs": f"WITH {_LINES}, {_PRESENT} SELECT kind, ref, count(*) AS lines FROM refs r WHERE NOT {_THERE} GROUP BY ALL",
    "settled_items": f"WITH {_SETTLED} SELECT kind, state, count(*) AS items FROM st GROUP BY ALL",
    "next_slice": f"WITH {_SETTLED} SELECT ref, kind FROM st WHERE state NOT IN ('settled', 'excluded') ORDER BY CASE kind WHEN 'child_database' THEN 0 WHEN 'sub_page' THEN 1 ELSE 2 END, kind, ref LIMIT 40",
    "gap_closure": f"""WITH RECURSIVE {_LINES}, l AS (SELECT page, ref FROM refs WHERE kind = 'link_to_page'), pg AS (SELECT DISTINCT {_ID.format("id")} AS id FROM pages_metadata),
      r(ref, round) USING KEY (ref) AS (SELECT DISTINCT ref, 1 FROM l WHERE regexp_matches(page, '^[0-3]')
        UNION SELECT l.ref, min(r.round) + 1 FROM r JOIN pg ON pg.id = r.ref JOIN l ON l.page = r.ref WHERE NOT EXISTS (SELECT 1 FROM recurring.r AS x WHERE x.ref = l.ref) GROUP BY 1)
      SELECT ref, round, ref IN (SELECT id FROM pg) AS got FROM r""",
}
