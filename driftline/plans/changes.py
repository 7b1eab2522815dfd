"""Queries that compare snapshots of the mirror."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.core.tables import table
from driftline.functions import text as X
from driftline.functions.keys import instant, micros, norm_id
from driftline.operators import changes as C

#: The earlier of two snapshots that the queries compare.
EARLIER = "2026-06-01 00:00:00"
FIELDS = ["title", "parent_id", "archived", "in_trash", "last_edited_time"]


def _pages(spark: SparkSession, d: str, at: str | None = None, fields: list[str] | None = None) -> DataFrame:
    return C.in_force(table(spark, d, "pages_metadata"), at, fields)


def snapshot_diff_rows(spark, d):
    return C.snapshot_diff(_pages(spark, d, EARLIER), _pages(spark, d), "page_id", ["title", "parent_id", "archived", "in_trash"], "last_edited_time")


def snapshot_diff(spark, d):
    return snapshot_diff_rows(spark, d).groupBy("change").agg(F.count("*").alias("pages"))


def diff_verdict(spark, d):
    c = lambda k: F.count_if(F.col("change") == k)
    one = snapshot_diff_rows(spark, d).agg(c("added").alias("added"), c("changed").alias("changed"), c("deleted").alias("deleted"))
    return one.select("*", (F.col("added") + F.col("changed") + F.col("deleted") > 0).alias("any_change"), F.format_string("+%d ~%d -%d", "added", "changed", "deleted").alias("summary"))


def ordered_merge(spark, d):
    old = C.positions(_pages(spark, d, EARLIER, ["created_time"]).select("page_id", "created_time"), [F.col("page_id")])
    return C.ordered_merge(old, _pages(spark, d, None, ["created_time"]), "page_id", "created_time")


def state_drift(spark, d):
    state = _pages(spark, d, EARLIER, ["last_edited_time"]).select("page_id", instant("last_edited_time").alias("was"))
    now = _pages(spark, d, None, ["last_edited_time"]).select("page_id", instant("last_edited_time").alias("now"))
    both = now.join(state, "page_id", "left")
    return both.filter("was IS NOT NULL AND now IS NOT NULL AND was <> now").select("page_id", micros("was").alias("was_us"), micros("now").alias("now_us"))


def meta_change(spark, d):
    a, b = _pages(spark, d, EARLIER, FIELDS), _pages(spark, d, None, FIELDS)
    both = a.select("page_id", F.struct(*FIELDS).alias("a")).join(b.select("page_id", F.struct(*FIELDS).alias("b")), "page_id", "full_outer")
    differs = [F.when(~F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}")), F.lit(f)) for f in FIELDS]
    names = F.array_join(F.array_compact(F.array(*differs)), ",")
    state = F.when(F.col("a").isNull(), "new").when(F.col("b").isNull(), "gone").when(names != "", "changed")
    return both.select("page_id", state.alias("state"), F.when(state == "changed", names).alias("fields")).filter("state IS NOT NULL")


def deletion_candidates(spark, d):
    """Pages no longer listed that a second reading confirms as gone."""
    was, now = _pages(spark, d, EARLIER, ["archived"]), _pages(spark, d, None, ["archived", "in_trash"])
    live = now.filter("NOT (coalesce(archived, false) OR coalesce(in_trash, false))")
    missing = was.select("page_id").join(live.select("page_id"), "page_id", "left_anti")
    confirmed = now.filter("coalesce(in_trash, false)").select("page_id")
    return missing.join(confirmed, "page_id", "left_semi")


def validate_diff(spark, d):
    cols = ["page_id", "title"]
    return C.multiset_diff(_pages(spark, d, EARLIER, ["title"]).select(cols), _pages(spark, d, None, ["title"]).select(cols))


def column_resolution(spark, d):
    names = {t: table(spark, d, t).columns for t in ("pages_metadata", "databases", "blocks")}
    rows = C.resolve_columns(names["pages_metadata"], names["databases"] + ["id", "title"], names["blocks"])
    return spark.createDataFrame(rows, "column_name string, pos int, fate string")


def schema_merge_first_wins(spark, d):
    specs = [(c, i, t, k) for i, t in enumerate(("pages_metadata", "blocks", "documents")) for c, k in table(spark, d, t).dtypes]
    one = C.first_wins(spark.createDataFrame(specs, "name string, source_pos int, source string, type string"), "name", "source_pos")
    return one.select("name", "source_pos", "source")


def union_sources(spark, d):
    a = table(spark, d, "customer").select(F.lit("customer").alias("source"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, d, "supplier").select(F.lit("supplier").alias("source"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    return C.union_sources([a, b])


def lookup_skip(spark, d):
    pages = _pages(spark, d, None, ["parent_type", "parent_id"]).filter("parent_type = 'database_id'").select("page_id", norm_id("parent_id").alias("db_key"))
    found = C.split_matched(pages, table(spark, d, "databases").select(norm_id("db_id").alias("db_key")), "db_key")
    return found.groupBy("db_key", "matched").agg(F.count("*").alias("pages"))


def discovery_filter(spark, d):
    parents = table(spark, d, "pages_metadata").filter("parent_id <> ''").select(norm_id("parent_id").alias("key"))
    known = table(spark, d, "databases").select(norm_id("db_id").alias("key"))
    pages = table(spark, d, "pages_metadata").select(norm_id("id").alias("key"))
    listed = table(spark, d, "blocks").filter("block_id IS NOT NULL").select(norm_id("block_id").alias("key"))
    return C.unanswered(parents, "key", [known, pages, listed])


def scope_filter(spark, d):
    """Content pages that are not gone, in tables whose title names the scope."""
    pages = _pages(spark, d, None, ["title", "parent_type", "archived", "in_trash"])
    kept = pages.filter(F.col("parent_type").isin("page_id", "block_id", "workspace") & ~F.coalesce("archived", F.lit(False)) & ~F.coalesce("in_trash", F.lit(False)))
    return kept.filter(F.lower("title").contains("notes") | F.col("page_id").contains("notes")).select("page_id", "title")


def targets(spark, d):
    pages = _pages(spark, d, None, ["parent_type", "in_trash"]).filter("parent_type <> 'database_id' AND NOT coalesce(in_trash, false)").select("page_id")
    commented = table(spark, d, "webhook_captures").filter("page_id IS NOT NULL").select(norm_id("page_id").alias("page_id"))
    done = table(spark, d, "block_trees").select(norm_id("page_id").alias("page_id"))
    return pages.union(commented).distinct().join(done, "page_id", "left_anti")


def watermark(spark, d):
    m = table(spark, d, "pages_metadata")
    return m.groupBy("parent_type").agg(F.max(micros(instant("last_edited_time"))).alias("high_us"), F.min(F.coalesce(micros(instant("last_edited_time")), F.lit(0))).alias("oldest_us"))


def page_meta(spark, d):
    m = _pages(spark, d, None, ["title", "parent_type", "parent_id", "created_time", "last_edited_time", "created_by", "last_edited_by", "url", "public_url", "icon", "has_cover", "archived", "in_trash"])
    return m.select(
        "page_id", F.coalesce("title", F.lit("")).alias("title"), "parent_type", micros(instant("created_time")).alias("created_us"), micros(instant("last_edited_time")).alias("edited_us"), "created_by", "last_edited_by",
        "url", F.coalesce("public_url", F.lit("")).alias("public_url"), F.coalesce("has_cover", F.lit(False)).alias("has_cover"), X.time_span("created_time", "last_edited_time").alias("span"), X.dashed("page_id").alias("dashed_id"), X.file_name("title").alias("file_name"), X.slug("title").alias("slug"),
        F.when(F.col("parent_type") == "workspace", "workspace").otherwise(norm_id("parent_id")).alias("parent"),
        F.substring_index("url", "/", -1).alias("url_tail"), F.coalesce(F.nullif(F.col("icon"), F.lit("")), F.lit("none")).alias("icon"),
        F.coalesce("archived", F.lit(False)).alias("archived"), F.coalesce("in_trash", F.lit(False)).alias("in_trash"),
    )


def id_dash(spark, d):
    b = table(spark, d, "blocks").select("block_no", "block_id")
    return b.select("block_no", X.dashed("block_id").alias("dashed"), norm_id("block_id").alias("bare"), X.is_id(norm_id("block_id")).alias("valid"))


def user_dim(spark, d):
    who = table(spark, d, "webhook_captures").select("delivery_no", F.posexplode("comments").alias("pos", "c")).select("delivery_no", "pos", F.col("c.author_id").alias("user_id"))
    people = table(spark, d, "people").select("user_id", "full_name", "kind")  # small: Catalyst broadcasts it by its size
    name = F.coalesce("full_name", F.when(F.col("kind") == "bot", "(bot)"), "user_id")
    return who.join(people, "user_id", "left").select("delivery_no", "pos", name.alias("who"))


def catalog_single_source(spark, d):
    docs = table(spark, d, "documents").filter("parent_id IS NOT NULL AND source IS NOT NULL")
    return docs.groupBy(norm_id("parent_id").alias("db")).agg(F.countDistinct("source").alias("n"), F.min("source").alias("source"), F.count("*").alias("docs")).filter("n = 1").drop("n")


def minute_edge(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    scan = e.filter("event_type = 'view'").groupBy("user_id").agg(F.max("ts").alias("scan"))
    return e.join(scan, "user_id").filter("ts <= scan AND ts >= scan - INTERVAL 150 SECONDS").select("event_id", "user_id")


def snapshot_pair(spark, d):
    count = lambda at, n: _pages(spark, d, at, ["parent_id"]).groupBy(norm_id("parent_id").alias("db")).agg(F.count("*").alias(n))
    return count(EARLIER, "was").join(count(None, "now"), "db", "full_outer").na.fill(0, ["was", "now"])


QUERIES = {
    f.__name__: f
    for f in (
        snapshot_diff, snapshot_diff_rows, diff_verdict, ordered_merge, state_drift, meta_change, deletion_candidates, validate_diff, column_resolution,
        schema_merge_first_wins, union_sources, lookup_skip, discovery_filter, scope_filter, targets, watermark, page_meta, id_dash, user_dim,
        catalog_single_source, minute_edge, snapshot_pair,
    )
}

_ID = "lower(replace({}, '-', ''))"
_ORD = "row(coalesce(epoch_us(TRY_CAST(last_edited_time AS TIMESTAMPTZ)), -9000000000000000000), swept_at, delivery_no)"


def force_sql(name: str, at: str | None = None) -> str:
    """A common table expression with the record in force of every page."""
    when = f"WHERE swept_at <= TIMESTAMPTZ '{at}+00'" if at else ""
    return f"""{name} AS (SELECT page_id, r.* FROM (SELECT lower(replace(id, '-', '')) AS page_id, arg_max({{'title': title, 'parent_type': parent_type, 'parent_id': parent_id,
      'last_edited_time': last_edited_time, 'archived': archived, 'in_trash': in_trash, 'url': url, 'swept_at': swept_at, 'icon': icon, 'has_cover': has_cover, 'created_time': created_time,
      'public_url': public_url, 'created_by': created_by, 'last_edited_by': last_edited_by}}, {_ORD}) AS r
      FROM pages_metadata {when} GROUP BY 1))"""


_BOTH = f"WITH {force_sql('o', EARLIER)}, {force_sql('n')}"
_DIFF = f"""{_BOTH} SELECT coalesce(o.page_id, n.page_id) AS page_id, CASE WHEN n.page_id IS NULL THEN 'deleted' WHEN o.page_id IS NULL THEN 'added'
  WHEN o.title IS DISTINCT FROM n.title OR o.parent_id IS DISTINCT FROM n.parent_id OR o.archived IS DISTINCT FROM n.archived OR o.in_trash IS DISTINCT FROM n.in_trash
  OR o.last_edited_time <> n.last_edited_time THEN 'changed' ELSE 'same' END AS change FROM o FULL JOIN n ON o.page_id = n.page_id"""
_TS = "TRY_CAST({} AS TIMESTAMPTZ)"
ORACLES = {
    "snapshot_diff_rows": _DIFF,
    "snapshot_diff": f"SELECT change, count(*) AS pages FROM ({_DIFF}) GROUP BY 1",
    "diff_verdict": f"""SELECT *, added + changed + deleted > 0 AS any_change, format('+{{}} ~{{}} -{{}}', added, changed, deleted) AS summary FROM (
      SELECT count(*) FILTER (change = 'added') AS added, count(*) FILTER (change = 'changed') AS changed, count(*) FILTER (change = 'deleted') AS deleted FROM ({_DIFF}))""",
    "ordered_merge": f"""{_BOTH}, p AS (SELECT page_id, row_number() OVER (ORDER BY page_id) AS k FROM o)
      SELECT n.page_id, row_number() OVER (ORDER BY k NULLS LAST, n.created_time NULLS LAST, n.page_id) - 1 AS pos FROM n LEFT JOIN p USING (page_id)""",
    "state_drift": f"""{_BOTH} SELECT page_id, epoch_us(a) AS was_us, epoch_us(b) AS now_us FROM (SELECT n.page_id, {_TS.format("o.last_edited_time")} AS a, {_TS.format("n.last_edited_time")} AS b
      FROM n JOIN o USING (page_id)) WHERE a <> b""",
    "meta_change": f"""{_BOTH}, j AS (SELECT coalesce(o.page_id, n.page_id) AS page_id, CASE WHEN o.page_id IS NULL THEN 'new' WHEN n.page_id IS NULL THEN 'gone' END AS s,
      list_filter([{", ".join(f"CASE WHEN o.{f} IS DISTINCT FROM n.{f} THEN '{f}' END" for f in FIELDS)}], lambda x: x IS NOT NULL) AS f FROM o FULL JOIN n ON o.page_id = n.page_id)
      SELECT page_id, coalesce(s, 'changed') AS state, CASE WHEN s IS NULL THEN array_to_string(f, ',') END AS fields FROM j WHERE s IS NOT NULL OR len(f) > 0""",
    "deletion_candidates": f"""{_BOTH} SELECT o.page_id FROM o JOIN n USING (page_id) WHERE coalesce(n.in_trash, false)""",
    "validate_diff": f"""{_BOTH} SELECT *, 'left' AS side FROM (SELECT page_id, title FROM o EXCEPT ALL SELECT page_id, title FROM n)
      UNION ALL SELECT *, 'right' FROM (SELECT page_id, title FROM n EXCEPT ALL SELECT page_id, title FROM o)""",
    "column_resolution": """WITH p AS (SELECT column_name, row_number() OVER () AS i FROM (DESCRIBE SELECT * FROM pages_metadata)),
      r AS (SELECT column_name, row_number() OVER () AS i FROM (DESCRIBE SELECT * FROM databases) UNION ALL SELECT 'id', 98 UNION ALL SELECT 'title', 99),
      s AS (SELECT column_name, row_number() OVER () AS i FROM (DESCRIBE SELECT * FROM blocks)), known AS (SELECT column_name FROM r UNION SELECT column_name FROM s),
      kept AS (SELECT column_name, row_number() OVER (ORDER BY i) - 1 AS pos FROM p WHERE column_name IN (FROM known)),
      new AS (SELECT column_name, min(o) AS o FROM (SELECT column_name, i AS o FROM s UNION ALL SELECT column_name, 1000 + i FROM r WHERE column_name NOT IN (SELECT column_name FROM s))
        WHERE column_name NOT IN (SELECT column_name FROM p) GROUP BY 1)
      SELECT column_name, pos, CASE WHEN column_name IN (SELECT column_name FROM r) THEN 'kept' ELSE 'schema only' END AS fate FROM kept
      UNION ALL SELECT column_name, (SELECT count(*) FROM kept) + row_number() OVER (ORDER BY o) - 1, 'added' FROM new
      UNION ALL SELECT column_name, -1, 'dropped' FROM p WHERE column_name NOT IN (FROM known)""",
    "schema_merge_first_wins": """WITH a AS (SELECT column_name AS name, 0 AS source_pos, 'pages_metadata' AS source FROM (DESCRIBE SELECT * FROM pages_metadata)
      UNION ALL SELECT column_name, 1, 'blocks' FROM (DESCRIBE SELECT * FROM blocks) UNION ALL SELECT column_name, 2, 'documents' FROM (DESCRIBE SELECT * FROM documents))
      SELECT name, min(source_pos) AS source_pos, arg_min(source, source_pos) AS source FROM a GROUP BY name""",
    "union_sources": """SELECT 'customer' AS source, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment FROM customer
      UNION ALL SELECT 'supplier', s_name, s_nationkey, NULL FROM supplier""",
    "lookup_skip": f"""WITH {force_sql("n")} SELECT k AS db_key, d.db IS NOT NULL AS matched, count(*) AS pages FROM (SELECT {_ID.format("parent_id")} AS k FROM n WHERE parent_type = 'database_id')
      LEFT JOIN (SELECT {_ID.format("db_id")} AS db FROM databases) d ON d.db = k GROUP BY ALL""",
    "discovery_filter": f"""SELECT DISTINCT {_ID.format("parent_id")} AS key FROM pages_metadata WHERE parent_id <> '' AND {_ID.format("parent_id")} NOT IN (SELECT {_ID.format("db_id")} FROM databases)
      AND {_ID.format("parent_id")} NOT IN (SELECT {_ID.format("id")} FROM pages_metadata) AND {_ID.format("parent_id")} NOT IN (SELECT {_ID.format("block_id")} FROM blocks WHERE block_id IS NOT NULL)""",
    "scope_filter": f"""WITH {force_sql("n")} SELECT page_id, title FROM n WHERE parent_type IN ('page_id', 'block_id', 'workspace') AND NOT coalesce(archived, false) AND NOT coalesce(in_trash, false)
      AND (contains(lower(title), 'notes') OR contains(page_id, 'notes'))""",
    "targets": f"""WITH {force_sql("n")} SELECT page_id FROM n WHERE parent_type <> 'database_id' AND NOT coalesce(in_trash, false) UNION SELECT {_ID.format("page_id")} FROM webhook_captures WHERE page_id IS NOT NULL
      EXCEPT SELECT {_ID.format("page_id")} FROM block_trees""",
    "watermark": f"""SELECT parent_type, max(epoch_us({_TS.format("last_edited_time")})) AS high_us, min(coalesce(epoch_us({_TS.format("last_edited_time")}), 0)) AS oldest_us FROM pages_metadata GROUP BY 1""",
    "page_meta": f"""WITH {force_sql("n")} SELECT page_id, concat(page_id[1:8], '-', page_id[9:12], '-', page_id[13:16], '-', page_id[17:20], '-', page_id[21:32]) AS dashed_id,
      coalesce(nullif(rtrim(left(regexp_replace(regexp_replace(regexp_replace(trim(title), '[\\\\/:*?"<>|\\x00-\\x1f]', ' ', 'g'), '^[. ]+|[. ]+$', '', 'g'), ' +', ' ', 'g'), 150)), ''), 'untitled') AS file_name,
      left(regexp_replace(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 50) AS slug,
      CASE WHEN parent_type = 'workspace' THEN 'workspace' ELSE {_ID.format("parent_id")} END AS parent, split_part(url, '/', -1) AS url_tail, coalesce(nullif(icon, ''), 'none') AS icon,
      coalesce(archived, false) AS archived, coalesce(in_trash, false) AS in_trash, coalesce(title, '') AS title, parent_type, epoch_us(TRY_CAST(created_time AS TIMESTAMPTZ)) AS created_us,
      epoch_us(TRY_CAST(last_edited_time AS TIMESTAMPTZ)) AS edited_us, created_by, last_edited_by, url, coalesce(public_url, '') AS public_url, coalesce(has_cover, false) AS has_cover,
      CASE WHEN last_edited_time IS NULL THEN created_time WHEN left(created_time, 10) = left(last_edited_time, 10) AND length(last_edited_time) > 11 THEN concat(created_time, ' → ', substring(last_edited_time, 12))
        ELSE created_time || ' → ' || last_edited_time END AS span FROM n""",
    "id_dash": f"""SELECT block_no, CASE WHEN length(b) = 32 THEN concat(b[1:8], '-', b[9:12], '-', b[13:16], '-', b[17:20], '-', b[21:32]) ELSE block_id END AS dashed, lower(b) AS bare,
      regexp_full_match(lower(b), '[0-9a-f]{{32}}') AS valid FROM (SELECT block_no, block_id, replace(block_id, '-', '') AS b FROM blocks)""",
    "user_dim": """SELECT delivery_no, pos, coalesce(p.full_name, CASE WHEN p.kind = 'bot' THEN '(bot)' END, u) AS who FROM (
      SELECT delivery_no, unnest(comments).author_id AS u, generate_subscripts(comments, 1) - 1 AS pos FROM webhook_captures) LEFT JOIN people p ON p.user_id = u""",
    "catalog_single_source": f"""SELECT {_ID.format("parent_id")} AS db, min(source) AS source, count(*) AS docs FROM documents WHERE parent_id IS NOT NULL AND source IS NOT NULL
      GROUP BY 1 HAVING count(DISTINCT source) = 1""",
    "minute_edge": """SELECT event_id, e.user_id FROM events e JOIN (SELECT user_id, max(ts) AS scan FROM events WHERE event_type = 'view' GROUP BY 1) s USING (user_id)
      WHERE ts <= scan AND ts >= scan - INTERVAL 150 SECOND""",
    "snapshot_pair": f"""{_BOTH}, a AS (SELECT {_ID.format("parent_id")} AS db, count(*) AS was FROM o GROUP BY 1), b AS (SELECT {_ID.format("parent_id")} AS db, count(*) AS now FROM n GROUP BY 1)
      SELECT coalesce(a.db, b.db) AS db, coalesce(was, 0) AS was, coalesce(now, 0) AS now FROM a FULL JOIN b ON a.db = b.db""",
}
