"""Queries of the general training-data problems p1 to p4, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.core.store import work_dir
from driftline.core.tables import table
from driftline.functions.keys import norm_id
from driftline.operators import ledger, messages, nested, orphans

RUN_PATHS = ["image.caption", "callout.rich_text", "bulleted_list_item.rich_text"]


def _deltas(spark: SparkSession, d: str) -> DataFrame:
    return orphans.workspace_deltas(table(spark, d, "blocks"), table(spark, d, "pages_metadata"), table(spark, d, "databases"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_references(_deltas(spark, d)).withColumnRenamed("ref_no", "block_no")


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_report(_deltas(spark, d))


def p1_current(spark: SparkSession, d: str) -> DataFrame:
    """Today's orphans from counts that are kept over three runs; of a block listed again the latest listing counts."""
    tables = [table(spark, d, t) for t in ("blocks", "pages_metadata", "databases")]
    return orphans.current_orphans(*tables, work_dir(spark, "orphan-counts"), ["2025-12-01 00:00:00", "2026-06-01 00:00:00"])


def tracked_fields() -> list:
    """Fields of a page record whose change makes it a changed record."""
    return [
        F.col("title"),
        norm_id("parent_id").alias("parent_id"),
        F.coalesce("archived", F.lit(False)).alias("archived"),
        F.coalesce("in_trash", F.lit(False)).alias("in_trash"),
    ]


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return ledger.process_increments(table(spark, d, "pages_metadata"), table(spark, d, "sweep_runs"), work_dir(spark, "increments"), tracked_fields())


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return messages.surplus_copies(table(spark, d, "webhook_captures"), work_dir(spark, "messages"))


def p3_kept(spark: SparkSession, d: str) -> DataFrame:
    kept = messages.kept_messages(table(spark, d, "webhook_captures"), work_dir(spark, "messages"))
    return kept.select("delivery_no", "entity_id", "captured_at")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.text_runs(table(spark, d, "block_trees"), RUN_PATHS)


def p4_blocks(spark: SparkSession, d: str) -> DataFrame:
    trees = table(spark, d, "block_trees")
    rows = nested.shred(trees, nested.analysed_plan(trees), {nested.BLOCK})
    return nested.flat_table(rows, nested.BLOCK, ["type", "has_children"]).select(
        "tree_no", "row_no", "parent_table", "parent_row", "block_id", "parent_id", F.col("pos"), F.col("type").alias("block_type"), "has_children"
    )


def p4_runs(spark: SparkSession, d: str) -> DataFrame:
    """Text runs of any kind with the row of the table they belong to."""
    trees = table(spark, d, "block_trees")
    rows = nested.shred(trees, nested.analysed_plan(trees), {"rich_text", "caption"})
    return rows.select(
        "tree_no", "table_name", "row_no", "parent_table", "parent_row", "block_id", "parent_id", "field_path", "pos",
        F.col("columns")["plain_text"].alias("plain_text"), F.col("columns")["href"].alias("href"),
    )


def p4_block_rows(spark: SparkSession, d: str) -> DataFrame:
    """The block table without its row numbers: what each block says of itself, and where it stands."""
    return p4_blocks(spark, d).select("tree_no", "block_id", "parent_id", "pos", "block_type", "has_children")


def p4_links(spark: SparkSession, d: str) -> DataFrame:
    """Every table of the shredded records with its parent tables, and how many rows have no parent row (none may)."""
    trees = table(spark, d, "block_trees")
    return nested.links(nested.shred(trees, nested.analysed_plan(trees)))


QUERIES = {f.__name__: f for f in (p1_found, p1_report, p1_current, p2_found, p3_found, p3_kept, p4_found, p4_blocks, p4_block_rows, p4_runs, p4_links)}

_REFS = """refs AS (
  SELECT block_no, listed_at, target_table, needs_db, lower(replace(ref, '-', '')) AS key FROM (
    SELECT block_no, listed_at, 'databases' AS target_table, true AS needs_db, block_id AS ref FROM blocks WHERE block_type = 'child_database'
    UNION ALL
    SELECT block_no, listed_at, 'pages_metadata', false, json_extract_string(payload, '$.page_id') FROM blocks WHERE block_type = 'link_to_page'
    UNION ALL
    SELECT block_no, listed_at, 'databases', false, json_extract_string(payload, '$.database_id') FROM blocks WHERE block_type = 'link_to_page'
  ) WHERE ref IS NOT NULL
), recs AS (
  SELECT lower(replace(id, '-', '')) AS key, swept_at, delivery_no, coalesce(archived, false) OR coalesce(in_trash, false) AS gone,
    TRY_CAST(last_edited_time AS TIMESTAMPTZ) AS edit, title, lower(replace(parent_id, '-', '')) AS parent,
    coalesce(archived, false) AS archived, coalesce(in_trash, false) AS in_trash
  FROM pages_metadata
)"""
_P1 = f"""WITH {_REFS}, pages AS (
  SELECT r.block_no, r.target_table, arg_max(p.gone, row(coalesce(epoch_us(p.edit), -9000000000000000000), p.swept_at, p.delivery_no)) AS gone
  FROM refs r JOIN recs p ON p.key = r.key AND p.swept_at <= r.listed_at GROUP BY ALL
), dbs AS (
  SELECT DISTINCT r.block_no, r.target_table FROM refs r JOIN databases d
  ON lower(replace(d.db_id, '-', '')) = r.key AND d.captured_at <= r.listed_at AND (d.deleted_at IS NULL OR d.deleted_at > r.listed_at)
)
SELECT r.block_no, r.target_table, strftime(r.listed_at AT TIME ZONE 'UTC', '%Y-%m') AS period
FROM refs r LEFT JOIN pages p USING (block_no, target_table) LEFT JOIN dbs d USING (block_no, target_table)
WHERE d.block_no IS NULL AND (r.needs_db OR p.block_no IS NULL OR p.gone)"""
_P1_CURRENT = f"""WITH {_REFS}, pages AS (
  SELECT key, arg_max(gone, row(coalesce(epoch_us(edit), -9000000000000000000), swept_at, delivery_no)) AS gone FROM recs GROUP BY key
), dbs AS (SELECT DISTINCT lower(replace(db_id, '-', '')) AS key FROM databases WHERE captured_at IS NOT NULL AND deleted_at IS NULL)
SELECT r.key, r.target_table, count(*) AS refs FROM refs r LEFT JOIN pages p USING (key) LEFT JOIN dbs d USING (key)
WHERE d.key IS NULL AND (r.needs_db OR p.key IS NULL OR p.gone) AND r.block_no IN (
  SELECT block_no FROM (SELECT block_no, block_id, row_number() OVER (PARTITION BY lower(replace(page_id, '-', '')), lower(replace(block_id, '-', '')) ORDER BY listed_at DESC NULLS LAST, block_no DESC) AS n
    FROM blocks WHERE block_type IN ('child_database', 'link_to_page')) WHERE block_id IS NULL OR n = 1) GROUP BY ALL"""
_P2 = f"""WITH {_REFS}, ok AS (
  SELECT run_no, started_at, lag(started_at) OVER (ORDER BY started_at) AS since FROM sweep_runs WHERE outcome = 'ok'
), best AS (
  SELECT o.run_no, o.started_at, p.key, arg_max({{'e': edit, 't': title, 'p': parent, 'a': archived, 'i': in_trash}},
    row(coalesce(epoch_us(edit), -9000000000000000000), swept_at, delivery_no)) AS rec,
    max(row(coalesce(epoch_us(edit), -9000000000000000000), swept_at, delivery_no)) AS ord
  FROM recs p JOIN ok o ON p.swept_at <= o.started_at AND (o.since IS NULL OR p.swept_at > o.since) GROUP BY ALL
), force AS (
  SELECT run_no, started_at, key, arg_max(rec, ord) OVER (PARTITION BY key ORDER BY started_at) AS now FROM best
), steps AS (SELECT *, lag(now) OVER (PARTITION BY key ORDER BY started_at) AS before, row_number() OVER (PARTITION BY key ORDER BY started_at) AS n FROM force)
SELECT run_no, key AS page_id FROM steps WHERE n = 1 OR now IS DISTINCT FROM before"""
_MESSAGES = """messages AS (
  SELECT *, min(delivery_no) OVER (PARTITION BY e, t, c) AS first_no FROM (
    SELECT *, lower(replace(entity_id, '-', '')) AS e, coalesce(CAST(epoch_us(TRY_CAST(captured_at AS TIMESTAMPTZ)) AS VARCHAR), captured_at) AS t,
      list_sort(list_distinct([lower(replace(x.id, '-', '')) for x in comments if x.id IS NOT NULL])) AS c
    FROM webhook_captures))"""
_BLOCKS = """b AS (SELECT tree_no, CAST(body AS JSON) AS j FROM block_trees WHERE json_valid(body)),
  listed AS (SELECT tree_no, '' AS parent, j -> '$.blocks' AS blocks FROM b
    UNION ALL SELECT tree_no, lower(replace(e.key, '-', '')), e.value FROM b, json_each(CASE WHEN json_type(j -> '$.children') = 'OBJECT' THEN j -> '$.children' ELSE '{}' END) AS e),
  block AS (SELECT tree_no, parent, unnest(from_json(blocks, '["JSON"]')) AS x FROM listed WHERE json_type(blocks) = 'ARRAY'
    UNION ALL SELECT tree_no, parent, unnest(from_json(kids, '["JSON"]')) FROM (SELECT tree_no, lower(replace(coalesce(x ->> '$.id', ''), '-', '')) AS parent, json_extract(x, '$."' || (x ->> '$.type') || '".children') AS kids FROM block)
      WHERE json_type(kids) = 'ARRAY')"""
_P4 = f"""WITH RECURSIVE {_BLOCKS}, runs AS (SELECT tree_no, parent, lower(replace(coalesce(x ->> '$.id', ''), '-', '')) AS id, p, json_extract(x, '$.' || p) AS r FROM block, (VALUES {", ".join(f"('{p}')" for p in RUN_PATHS)}) AS v(p)),
  each_run AS (SELECT tree_no, parent, id, p, unnest(from_json(r, '["JSON"]')) AS one, generate_subscripts(from_json(r, '["JSON"]'), 1) - 1 AS i FROM runs WHERE json_type(r) = 'ARRAY')
SELECT tree_no, id AS block_id, parent AS parent_id, p AS field_path, i AS run_pos FROM each_run WHERE coalesce(one ->> '$.plain_text', '') <> ''"""
_AT = "generate_subscripts(from_json({0}, '[\"JSON\"]'), 1) - 1"
_P4_ROWS = f"""WITH RECURSIVE {_BLOCKS.partition("block AS (")[0]}block AS (SELECT tree_no, parent, unnest(from_json(blocks, '["JSON"]')) AS x, {_AT.format("blocks")} AS pos FROM listed WHERE json_type(blocks) = 'ARRAY'
    UNION ALL SELECT tree_no, parent, unnest(from_json(kids, '["JSON"]')), {_AT.format("kids")} FROM (SELECT tree_no, lower(replace(coalesce(x ->> '$.id', ''), '-', '')) AS parent, json_extract(x, '$."' || (x ->> '$.type') || '".children') AS kids FROM block)
      WHERE json_type(kids) = 'ARRAY')
SELECT tree_no, lower(replace(coalesce(x ->> '$.id', ''), '-', '')) AS block_id, parent AS parent_id, pos, x ->> '$.type' AS block_type, x ->> '$.has_children' AS has_children FROM block WHERE json_type(x) = 'OBJECT'"""
ORACLES = {
    "p4_block_rows": _P4_ROWS,
    "p4_found": _P4,
    "p1_found": _P1,
    "p1_report": f"SELECT target_table, period, count(*) AS orphans FROM ({_P1}) GROUP BY ALL",
    "p1_current": _P1_CURRENT,
    "p2_found": _P2,
    "p3_found": f"WITH {_MESSAGES} SELECT first_no, delivery_no AS copy_no FROM messages WHERE delivery_no <> first_no",
    "p3_kept": f"WITH {_MESSAGES} SELECT delivery_no, entity_id, captured_at FROM messages WHERE delivery_no = first_no",
}
