"""Queries of the checks before publishing."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftline.core.tables import table
from driftline.functions import text as X
from driftline.functions.keys import micros, norm_id
from driftline.operators import quality as Q
from driftline.plans.changes import EARLIER, _pages, force_sql


def _lines(spark, d):
    return table(spark, d, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line")).filter("trim(line) <> ''").select("doc_id", F.trim("line").alias("line"))


def spread_breaches(spark, d):
    return Q.spread_breaches(Q.spread(_lines(spark, d), "line", "doc_id"), "line", 30)


def spread_baseline(spark, d):
    spreads = Q.spread(_lines(spark, d), "line", "doc_id")
    baseline = spreads.filter(F.col("line").startswith("#")).select("line", F.col("holders").alias("allowed"))
    return Q.spread_breaches(spreads, "line", 30, baseline)


def _refs(spark, d):
    b = table(spark, d, "blocks")
    link = lambda f: b.filter("block_type = 'link_to_page'").select("page_id", F.get_json_object("payload", f"$.{f}").alias("ref"), F.lit("link").alias("kind"))
    own = lambda t, k: b.filter(F.col("block_type") == t).select("page_id", F.col("block_id").alias("ref"), F.lit(k).alias("kind"))
    rows = own("child_database", "table").union(own("child_page", "page")).union(link("page_id")).union(link("database_id"))
    return rows.filter("ref IS NOT NULL").select("page_id", norm_id("ref").alias("ref"), "kind")


def _present(spark, d):
    pages = table(spark, d, "pages_metadata").select(norm_id("id").alias("id"), F.lit("page").alias("kind"))
    return pages.union(table(spark, d, "databases").select(norm_id("db_id").alias("id"), F.lit("table").alias("kind")))


def ref_absent(spark, d):
    return Q.absent_references(_refs(spark, d), _present(spark, d)).groupBy("ref", "kind").agg(F.count("*").alias("occurrences"))


def ref_census(spark, d):
    refs = _refs(spark, d)
    return Q.census(refs, Q.absent_references(refs, _present(spark, d)))


def ref_absent_excluded(spark, d):
    known = table(spark, d, "databases").filter("deleted_at IS NOT NULL").select(norm_id("db_id").alias("id"), F.lit("deleted").alias("reason"), F.lit(None).cast("string").alias("note"))
    trashed = _pages(spark, d, None, ["in_trash"]).filter("in_trash").select(F.col("page_id").alias("id"), F.lit("deliberate").alias("reason"), F.lit("in trash").alias("note"))
    excluded = Q.checked_exclusions(known.union(trashed)).filter("reason IS NOT NULL").select(F.col("id").alias("ref"))
    live = _pages(spark, d, None, ["in_trash"]).filter("NOT coalesce(in_trash, false)").select(F.col("page_id").alias("id"), F.lit("page").alias("kind"))
    tables = table(spark, d, "databases").filter("deleted_at IS NULL").select(norm_id("db_id").alias("id"), F.lit("table").alias("kind"))
    absent = Q.absent_references(_refs(spark, d), live.union(tables)).select("ref", "kind").distinct()
    return absent.join(excluded, "ref", "left_anti")


def referenced_floor(spark, d):
    b = table(spark, d, "blocks").filter("block_type IN ('link_to_page', 'child_database')").withColumn("source", F.concat_ws("/", "block_type", "page_id"))
    month = lambda m, n: b.filter(F.date_format("listed_at", "yyyy-MM") == m).groupBy("source").agg(F.count("*").alias(n))
    return Q.run_floor(month("2026-06", "n"), month("2026-05", "floor"), "source")


def blind_spots(spark, d):
    classes = [
        ("mark", F.col("line").rlike(r"`c:[0-9a-f]+`")), ("fence", F.col("line").startswith("```")), ("table", F.col("line").startswith("|")),
        ("quote", F.col("line").startswith(">")), ("heading", F.col("line").startswith("#")),
    ]
    return _lines(spark, d).groupBy(Q.first_class(classes).alias("kind")).agg(F.count("*").alias("lines"))


def endpoint_counts(spark, d):
    """Requests by source and family, with totals a source and over all; the paths are those a capture would have been fetched by."""
    w = table(spark, d, "webhook_captures")
    ent = norm_id("entity_id")
    path = F.when(F.col("entity_type") == "block", F.concat(F.lit("/v1/blocks/"), ent, F.lit("/children"))).when(F.col("entity_type") == "page", F.concat(F.lit("/v1/pages/"), ent)).otherwise("/x")
    rows = w.select("entity_type", X.endpoint_class(path).alias("family"))
    return rows.rollup("entity_type", "family").agg(F.count("*").alias("requests"))


def row_floor(spark, d):
    """Parents that lost too many live pages: of the pages that ever lay below them, how many are live there now."""
    pages = _pages(spark, d, None, ["parent_id", "archived", "in_trash"])
    live = pages.filter("NOT coalesce(archived, false) AND NOT coalesce(in_trash, false)").select(norm_id("parent_id").alias("db"))
    was = table(spark, d, "pages_metadata").filter("parent_id <> '' AND id IS NOT NULL").select(norm_id("parent_id").alias("db"), norm_id("id").alias("page")).distinct()
    return Q.row_floor(was.select("db"), live, "db", 20, 20)


def snapshot_floor(spark, d):
    """Parents that lost too many live pages between two snapshots."""
    live = lambda at: _pages(spark, d, at, ["parent_id", "archived", "in_trash"]).filter("NOT coalesce(archived, false) AND NOT coalesce(in_trash, false)").select(norm_id("parent_id").alias("db"))
    return Q.row_floor(live(EARLIER), live(None), "db", 5, 5)


def silent_users(spark, d):
    """Users of whom nothing was heard for longer than ever before, when the log ended."""
    e = table(spark, d, "events").select("user_id", micros("ts").alias("us"))
    now = e.agg(F.max("us")).first()[0]
    return Q.silent(e, "user_id", "us", now or 0, 3_600_000_000)


def probe_policy(spark, d):
    commented = table(spark, d, "webhook_captures").select(norm_id("page_id").alias("page_id")).distinct().withColumn("rich", F.lit(True))
    pages = _pages(spark, d, None, ["parent_id"]).select("page_id", norm_id("parent_id").alias("db")).join(commented, "page_id", "left")
    return Q.probe_policy(pages, "db", F.col("rich"), 100, 5)


def gap_stats(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", micros("ts").alias("us"))
    return Q.gap_stats(e, "user_id", "us").select("user_id", "n", "max_gap_us")


def run_report(spark, d):
    """One row of counters a run outcome, worst first by what failed."""
    r = table(spark, d, "sweep_runs").withColumn("secs", F.unix_seconds("ended_at") - F.unix_seconds("started_at"))
    return r.groupBy("outcome").agg(F.count("*").alias("runs"), F.max("secs").alias("longest_s"), F.count_if(F.col("ended_at").isNull()).alias("no_end"))


def event_routing(spark, d):
    e = table(spark, d, "events")
    queue = F.when(F.col("event_type") == "error", "dead_letter").when(F.get_json_object("props", "$.k").cast("int") >= 50, "priority").otherwise("normal")
    return e.groupBy(queue.alias("queue"), "event_type").agg(F.count("*").alias("events"))


def path_classes(spark, d):
    p = _pages(spark, d, None, ["url", "parent_type"]).select("page_id", F.concat_ws("/", "parent_type", F.substring_index("url", "/", -1)).alias("path"))
    cls = Q.first_class([("foreign", F.col("path").startswith("block_id/")), ("engine", F.col("path").startswith("database_id/")), ("staged", F.col("path").startswith("workspace/"))])
    return p.groupBy(cls.alias("owner")).agg(F.count("*").alias("pages"))


def set_containment(spark, d):
    """Tracked words of the earlier title that the title now lacks."""
    words = F.array_distinct(F.filter(F.split(F.lower("title"), "[^a-z0-9]+"), lambda w: w != ""))
    side = lambda at: _pages(spark, d, at, ["title"]).filter("title IS NOT NULL").select("page_id", words.alias("words"))
    return Q.not_covered(side(EARLIER), side(None), "page_id", "words")


def covered_drop(spark, d):
    """Documents that an earlier one with the same text covers wholly.  Texts are compared by a digest of 256 bits."""
    docs = table(spark, d, "documents").filter("trim(text) <> ''").select("doc_id", F.sha2("text", 256).alias("digest"))
    first = docs.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return docs.join(first, "digest").filter("doc_id <> first_id").select("doc_id", "first_id")


QUERIES = {
    f.__name__: f
    for f in (
        spread_breaches, spread_baseline, ref_absent, ref_census, ref_absent_excluded, referenced_floor, blind_spots, endpoint_counts, row_floor, snapshot_floor, silent_users, probe_policy, gap_stats,
        run_report, event_routing, path_classes, set_containment, covered_drop,
    )
}

_ID = "lower(replace({}, '-', ''))"
_LINES = "lines AS (SELECT doc_id, trim(l) AS line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents) WHERE trim(l) <> '')"
_SPREAD = f"WITH {_LINES}, s AS (SELECT line, count(DISTINCT doc_id) AS holders FROM lines GROUP BY 1)"
_REFS = f"""refs AS (SELECT page_id, {_ID.format("ref")} AS ref, kind FROM (
  SELECT page_id, block_id AS ref, 'table' AS kind FROM blocks WHERE block_type = 'child_database' UNION ALL SELECT page_id, block_id, 'page' FROM blocks WHERE block_type = 'child_page'
  UNION ALL SELECT page_id, json_extract_string(payload, '$.page_id'), 'link' FROM blocks WHERE block_type = 'link_to_page'
  UNION ALL SELECT page_id, json_extract_string(payload, '$.database_id'), 'link' FROM blocks WHERE block_type = 'link_to_page') WHERE ref IS NOT NULL),
  present AS (SELECT {_ID.format("id")} AS id, 'page' AS kind FROM pages_metadata UNION SELECT {_ID.format("db_id")}, 'table' FROM databases),
  absent AS (SELECT * FROM refs r WHERE NOT EXISTS (SELECT 1 FROM present p WHERE p.id = r.ref AND (r.kind = 'link' OR r.kind = p.kind)))"""
ORACLES = {
    "spread_breaches": f"{_SPREAD} SELECT * FROM s WHERE holders > 30",
    "spread_baseline": f"{_SPREAD} SELECT * FROM s WHERE holders > 30 AND NOT starts_with(line, '#')",
    "ref_absent": f"WITH {_REFS} SELECT ref, kind, count(*) AS occurrences FROM absent GROUP BY ALL",
    "ref_census": f"""WITH {_REFS} SELECT kind, count(DISTINCT ref) AS referenced, (SELECT count(DISTINCT a.ref) FROM absent a WHERE a.kind = refs.kind) AS absent,
      (SELECT count(*) FROM absent a WHERE a.kind = refs.kind) AS occurrences FROM refs GROUP BY kind""",
    "ref_absent_excluded": f"""WITH {_REFS}, {force_sql("n")}, live AS (SELECT page_id AS id, 'page' AS kind FROM n WHERE NOT coalesce(in_trash, false)
      UNION SELECT {_ID.format("db_id")}, 'table' FROM databases WHERE deleted_at IS NULL)
      SELECT DISTINCT ref, kind FROM refs r WHERE NOT EXISTS (SELECT 1 FROM live p WHERE p.id = r.ref AND (r.kind = 'link' OR r.kind = p.kind))
      AND ref NOT IN (SELECT {_ID.format("db_id")} FROM databases WHERE deleted_at IS NOT NULL) AND ref NOT IN (SELECT page_id FROM n WHERE in_trash)""",
    "referenced_floor": """WITH m AS (SELECT concat_ws('/', block_type, page_id) AS source, strftime(listed_at AT TIME ZONE 'UTC', '%Y-%m') AS m FROM blocks WHERE block_type IN ('link_to_page', 'child_database')),
      j AS (SELECT source, count(*) FILTER (m = '2026-06') AS n, count(*) FILTER (m = '2026-05') AS floor FROM m WHERE m IN ('2026-05', '2026-06') GROUP BY 1)
      SELECT *, CASE WHEN n = 0 OR n * 100 < floor * 90 THEN 'inconclusive' ELSE 'ok' END AS verdict, CASE WHEN n = 0 OR n * 100 < floor * 90 THEN floor ELSE n END AS next_floor FROM j""",
    "blind_spots": f"""WITH {_LINES} SELECT CASE WHEN regexp_matches(line, '`c:[0-9a-f]+`') THEN 'mark' WHEN starts_with(line, '```') THEN 'fence' WHEN starts_with(line, '|') THEN 'table'
      WHEN starts_with(line, '>') THEN 'quote' WHEN starts_with(line, '#') THEN 'heading' ELSE 'other' END AS kind, count(*) AS lines FROM lines GROUP BY 1""",
    "endpoint_counts": """SELECT entity_type, CASE entity_type WHEN 'block' THEN 'block_children' WHEN 'page' THEN 'page' ELSE 'other' END AS family, count(*) AS requests
      FROM webhook_captures GROUP BY ROLLUP (entity_type, 2)""",
    "row_floor": f"""WITH {force_sql("n")}, a AS (SELECT {_ID.format("parent_id")} AS db, count(DISTINCT {_ID.format("id")}) AS was FROM pages_metadata WHERE parent_id <> '' GROUP BY 1),
      b AS (SELECT {_ID.format("parent_id")} AS db, count(*) AS now FROM n WHERE NOT coalesce(archived, false) AND NOT coalesce(in_trash, false) GROUP BY 1)
      SELECT db, was, now FROM a JOIN b USING (db) WHERE was >= 20 AND now * 100 < was * 80""",
    "snapshot_floor": f"""WITH {force_sql("o", EARLIER)}, {force_sql("n")}, a AS (SELECT {_ID.format("parent_id")} AS db, count(*) AS was FROM o WHERE NOT coalesce(archived, false) AND NOT coalesce(in_trash, false) GROUP BY 1),
      b AS (SELECT {_ID.format("parent_id")} AS db, count(*) AS now FROM n WHERE NOT coalesce(archived, false) AND NOT coalesce(in_trash, false) GROUP BY 1)
      SELECT db, was, now FROM a JOIN b USING (db) WHERE was >= 5 AND now * 100 < was * 95""",
    "silent_users": """WITH g AS (SELECT user_id, max(gap) AS gap, max(us) AS last FROM (SELECT user_id, epoch_us(ts) AS us, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS gap FROM events) GROUP BY 1)
      SELECT user_id, (SELECT max(epoch_us(ts)) FROM events) - last AS silence_us FROM g WHERE (SELECT max(epoch_us(ts)) FROM events) - last >= 3600000000 AND (gap IS NULL OR (SELECT max(epoch_us(ts)) FROM events) - last > gap)""",
    "probe_policy": f"""WITH {force_sql("n")}, t AS (SELECT {_ID.format("parent_id")} AS db, count(*) AS total, count(*) FILTER (page_id IN (SELECT {_ID.format("page_id")} FROM webhook_captures)) AS rich FROM n GROUP BY 1)
      SELECT *, CASE WHEN total >= 100 AND rich * 100 < total * 5 THEN 'some' ELSE 'all' END AS mode FROM t""",
    "gap_stats": """SELECT user_id, count(*) AS n, max(gap) AS max_gap_us FROM (SELECT user_id, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events) GROUP BY 1""",
    "run_report": """SELECT outcome, count(*) AS runs, max(epoch_us(date_trunc('second', ended_at)) // 1000000 - epoch_us(date_trunc('second', started_at)) // 1000000) AS longest_s,
      count(*) FILTER (ended_at IS NULL) AS no_end FROM sweep_runs GROUP BY 1""",
    "event_routing": """SELECT CASE WHEN event_type = 'error' THEN 'dead_letter' WHEN CAST(json_extract_string(props, '$.k') AS INT) >= 50 THEN 'priority' ELSE 'normal' END AS queue, event_type, count(*) AS events
      FROM events GROUP BY ALL""",
    "path_classes": f"""WITH {force_sql("n")} SELECT CASE parent_type WHEN 'block_id' THEN 'foreign' WHEN 'database_id' THEN 'engine' WHEN 'workspace' THEN 'staged' ELSE 'other' END AS owner, count(*) AS pages FROM n GROUP BY 1""",
    "set_containment": f"""WITH {force_sql("o", EARLIER)}, {force_sql("n")}, w AS (SELECT o.page_id, list_distinct(list_filter(regexp_split_to_array(lower(o.title), '[^a-z0-9]+'), lambda x: x <> '')) AS a,
      list_distinct(list_filter(regexp_split_to_array(lower(coalesce(n.title, '')), '[^a-z0-9]+'), lambda x: x <> '')) AS b FROM o LEFT JOIN n USING (page_id) WHERE o.title IS NOT NULL)
      SELECT page_id, len(list_filter(a, lambda x: NOT list_contains(b, x))) AS missing FROM w WHERE len(list_filter(a, lambda x: NOT list_contains(b, x))) > 0""",
    "covered_drop": "SELECT doc_id, first_id FROM (SELECT doc_id, text, min(doc_id) OVER (PARTITION BY text) AS first_id FROM documents) WHERE doc_id <> first_id AND trim(text) <> ''",
}
