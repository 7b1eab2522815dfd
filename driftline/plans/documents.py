"""Queries of documents and their upkeep: listings, comment and schema documents, trees, links, alarms."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftline.core.tables import table
from driftline.functions import text as X
from driftline.functions.keys import micros, norm_id
from driftline.operators import comments as M
from driftline.operators import schedule as S
from driftline.plans import comments as PC
from driftline.plans import schedule as PS
from driftline.plans.changes import EARLIER, _pages, force_sql
from driftline.sources import sinks

#: Blocks that one listing of a page returns at most.
MOST_BLOCKS = 20


def block_listing(spark, d):
    """The listing of each page in depth-first order up to a cap: whether it is truncated, and partial (a block says it has children, but none are there)."""
    order = PS.tree_order(spark, d).select("page_id", "id", "path")
    at = S.group_positions(order, ["page_id"], ["path"])
    b = table(spark, d, "blocks").filter("block_id IS NOT NULL")
    said = b.groupBy("page_id", norm_id("block_id").alias("id")).agg(F.min(F.struct("block_no", "has_children")).getField("has_children").alias("has"))
    kids = PS._blocks(spark, d).filter("parent IS NOT NULL").select("page_id", F.col("parent").alias("id")).distinct().withColumn("kid", F.lit(True))
    rows = at.filter(F.col("rn") <= MOST_BLOCKS).join(said, ["page_id", "id"]).join(kids, ["page_id", "id"], "left")
    n = at.groupBy("page_id").agg(F.count("*").alias("blocks"))
    listed = rows.groupBy("page_id").agg(F.count("*").alias("listed"), F.coalesce(F.max(F.col("has") & F.col("kid").isNull()), F.lit(False)).alias("partial"))
    return n.join(listed, "page_id").select("page_id", "listed", "partial", (F.col("blocks") > F.col("listed")).alias("truncated"))


def comment_documents(spark, d):
    """One section a page with its comments and how many are open; those of table rows go to the row's own document."""
    rows = M.keep_first(PC._rows(spark, d).filter("cid IS NOT NULL AND text IS NOT NULL"), "cid", PC._ORDER)
    done = F.when(F.col("resolved"), F.to_date("at"))
    line = M.bullet(F.col("text"), F.coalesce("author", F.lit("?")), F.substring("created", 1, 10), F.col("cid"), done)
    pages = _pages(spark, d, None, ["title", "parent_type"]).select(F.col("page_id").alias("home"), "title", "parent_type")
    per = rows.withColumns({"k": F.struct("delivery_no", "pos", line.alias("line")), "open": ~F.col("resolved")}).groupBy("home").agg(F.sort_array(F.collect_list("k")).alias("ks"), F.count("*").alias("n"), F.count_if("open").alias("o"))
    both = per.join(pages, "home", "left")
    head = F.concat(F.lit("## "), F.coalesce(F.nullif(F.trim("title"), F.lit("")), F.lit("(untitled)")), F.lit(" `"), F.col("home"), F.lit("`\n"))
    body = F.array_join(F.transform("ks", lambda x: x["line"]), "\n")
    trailer = F.concat(F.lit("\n\n"), F.col("n").cast("string"), F.lit(" comments, "), F.col("o").cast("string"), F.lit(" open"))
    route = F.when(F.col("parent_type").isNull(), "unplaced").when(F.col("parent_type") == "database_id", "row").otherwise("page")
    return both.select("home", route.alias("route"), F.sha2(F.concat(head, body, trailer), 256).alias("sha"), F.col("n").alias("comments"))


def schema_documents(spark, d):
    names = ("pages_metadata", "blocks", "databases", "documents")
    rows = [(t, i, n) for t in names for i, n in enumerate(table(spark, d, t).columns)]
    return sinks.schema_document(spark.createDataFrame(rows, "table_name string, pos int, column_name string"), "table_name", "pos", "column_name")


def _row_documents(spark, d, at):
    p = _pages(spark, d, at, ["title", "parent_type", "url"])
    docs = sinks.row_documents(p, "page_id", "title", ["parent_type", "url"])
    stamped = docs.join(p.select("page_id", F.concat(X.file_name("title"), F.lit(" "), F.col("page_id"), F.lit(".md")).alias("path")), "page_id")
    text = sinks.with_stamp(F.col("document"), F.lit(at or "now"), "<!-- enrichment -->", F.lit(None).cast("string"))
    return stamped.select("page_id", "path", sinks.without_stamp(text).alias("document"))


def document_sync(spark, d):
    """What a run has to do with the document of each page since the one before."""
    return sinks.document_changes(_row_documents(spark, d, EARLIER), _row_documents(spark, d, None), "page_id").groupBy("verdict").agg(F.count("*").alias("documents"))


def _old_properties(spark, d):
    p = _pages(spark, d, EARLIER, ["title", "parent_type", "url", "public_url"])
    one = lambda c: F.struct(F.lit(c).alias("name"), F.coalesce(c, F.lit("")).alias("value"))
    return p.select("page_id", F.explode(F.array(*[one(c) for c in ("title", "parent_type", "url", "public_url")])).alias("x")).select("page_id", "x.*").filter("value <> ''")


def uncovered_properties(spark, d):
    """Properties of the earlier documents that the documents of today do not cover."""
    from driftline.operators.quality import uncovered_properties as uncovered

    return uncovered(_old_properties(spark, d), _row_documents(spark, d, None), "page_id").select("page_id", "name")


def replaced_documents(spark, d):
    """Earlier documents that today's replace: their page was fetched, and every property is covered."""
    from driftline.operators.quality import replaced_documents as replaced

    probed = table(spark, d, "block_trees").select(norm_id("page_id").alias("page_id"))
    return replaced(_row_documents(spark, d, EARLIER), _old_properties(spark, d), _row_documents(spark, d, None), probed, "page_id")


def tree_levels(spark, d):
    """Folders of three levels (kind of parent, parent, page) with the pages below, twenty a folder, equal names told apart by id."""
    p = _pages(spark, d, None, ["title", "parent_type", "parent_id"]).select("page_id", "parent_type", norm_id("parent_id").alias("parent"), F.lower(X.file_name("title")).alias("name"))
    twins = p.groupBy("parent_type", "parent", "name").agg(F.count("*").alias("n")).filter("n > 1").drop("n").withColumn("twin", F.lit(True))
    named = p.join(twins, ["parent_type", "parent", "name"], "left")
    shown = named.select("parent_type", F.concat_ws("/", "parent_type", "parent").alias("folder"), "page_id", F.when(F.col("twin"), F.concat("name", F.lit(" "), F.substring("page_id", 1, 8))).otherwise(F.col("name")).alias("name"))
    return S.top_and_more(shown, "folder", [F.col("name"), F.col("page_id")], 20).select("folder", "name", "rn", "more")


def relative_links(spark, d):
    """Link blocks as paths relative to the document they stand in: pages below the folder of their parent, databases below their own."""
    p = _pages(spark, d, None, ["title", "parent_type", "parent_id"])
    path = F.concat_ws("/", F.when(F.col("parent_type") == "database_id", "_databases").otherwise("workspace"), F.when(F.col("parent_id") != "", norm_id("parent_id")), F.concat(X.file_name("title"), F.lit(" "), F.col("page_id"), F.lit(".md")))
    at = p.select(F.col("page_id").alias("id"), path.alias("path"))
    b = table(spark, d, "blocks").filter("block_type = 'link_to_page'").select("block_no", norm_id("page_id").alias("from_id"), norm_id(F.get_json_object("payload", "$.page_id")).alias("to_id"))
    both = b.join(at.select(F.col("id").alias("from_id"), F.col("path").alias("a")), "from_id").join(at.select(F.col("id").alias("to_id"), F.col("path").alias("b")), "to_id")
    return both.select("block_no", X.relative_path("b", "a").alias("link"))


def _misfiled(spark, d):
    """The comments, and of every third one a later copy filed under another page, every other copy under an id of its own."""
    rows = PC._rows(spark, d).filter("home IS NOT NULL").select("delivery_no", "pos", "cid", "thread", "home", "at")
    copy = rows.filter("delivery_no % 3 = 0").withColumns({"cid": F.when(F.col("delivery_no") % 2 == 0, F.col("cid")).otherwise(F.concat(F.lit("x"), F.col("cid"))), "home": F.reverse("home"), "delivery_no": F.col("delivery_no") + 10**12})
    return rows.unionByName(copy)


def thread_repair(spark, d):
    """Where each stored comment belongs: on the page of its thread."""
    rows = _misfiled(spark, d)
    return M.repair_homes(rows, M.thread_homes(rows)).groupBy("fate").agg(F.count("*").alias("comments"), F.countDistinct("thread").alias("threads"))


def multi_home_ids(spark, d):
    """Comment ids that more than one page holds, with the page of their thread."""
    rows = _misfiled(spark, d)
    several = rows.filter("cid IS NOT NULL").groupBy("cid").agg(F.countDistinct("home").alias("homes"), F.min("thread").alias("thread")).filter("homes > 1")
    return several.join(M.thread_homes(rows), "thread", "left").select("cid", "homes", "owner")


def audit_pool(spark, d):
    """The rescan clock of the pages that are not in the trash, and the thirtieth of them that is due."""
    clock = table(spark, d, "block_trees").groupBy(norm_id("page_id").alias("page_id")).agg(F.max("fetched_at").alias("last"))
    alive = _pages(spark, d, None, ["in_trash"]).filter("NOT coalesce(in_trash, false)")
    return S.oldest_share(S.audit_pool(clock, alive, "page_id", "last"), "last", "page_id", 30).select("page_id", "pos")


def pending_discovery(spark, d):
    """Parents that earlier records named, or later ones, and that are still unknown."""
    at = F.lit(EARLIER).cast("timestamp")
    m = table(spark, d, "pages_metadata").filter("parent_id <> ''").select(norm_id("parent_id").alias("key"), "swept_at")
    known = table(spark, d, "databases").select(norm_id("db_id").alias("key")).union(table(spark, d, "pages_metadata").filter("id IS NOT NULL").select(norm_id("id").alias("key")))
    return S.carried_over(m.filter(F.col("swept_at") < at), m.filter(F.col("swept_at") >= at), known, "key")


def run_alarms(spark, d):
    """Alarms of the nightly runs two days after the last one began."""
    r = table(spark, d, "sweep_runs").select("run_no", micros("started_at").alias("started_us"), micros("ended_at").alias("ended_us"), "outcome")
    now = (r.agg(F.max("started_us")).first()[0] or 0) + 2 * 86_400_000_000
    return S.run_alarms(r, now, 6 * 3600, 36 * 3600, 1)


def breach_order(spark, d):
    """Lines on more than ten documents, worst first, then by their small letters."""
    from driftline.operators.changes import positions
    from driftline.operators.quality import spread
    from driftline.plans.quality import _lines

    s = spread(_lines(spark, d), "line", "doc_id").filter("holders > 10")
    return positions(s, [F.col("holders").desc(), F.lower("line"), F.col("line")]).select("line", "holders", "pos")


def probe_rows(spark, d):
    """Pages to be looked at: all of tables with mode ``all``, of the others those that are commented or were edited since EARLIER."""
    from driftline.functions.keys import instant
    from driftline.operators.quality import probe_policy

    commented = table(spark, d, "webhook_captures").select(norm_id("page_id").alias("page_id")).distinct().withColumn("rich", F.lit(True))
    pages = _pages(spark, d, None, ["parent_id", "last_edited_time"]).select("page_id", norm_id("parent_id").alias("db"), instant("last_edited_time").alias("edited")).join(commented, "page_id", "left")
    policy = probe_policy(pages, "db", F.col("rich"), 100, 5).select("db", "mode")
    newer = F.coalesce(F.col("edited") >= F.lit(EARLIER).cast("timestamp"), F.lit(False))
    return pages.join(policy, "db").filter((F.col("mode") == "all") | F.col("rich") | newer).groupBy("db", "mode").agg(F.count("*").alias("pages"))


def endpoint_families(spark, d):
    """Requests of every family; which one a block would have been fetched by goes by its number here."""
    i = norm_id("block_id")
    paths = [
        F.concat(F.lit("/v1/blocks/"), i, F.lit("/children")), F.concat(F.lit("/v1/blocks/"), i), F.concat(F.lit("/v1/databases/"), i, F.lit("/query")), F.concat(F.lit("/v1/data_sources/"), i, F.lit("/query")),
        F.concat(F.lit("/v1/data_sources/"), i), F.concat(F.lit("/v1/pages/"), i, F.lit("/properties/x")), F.concat(F.lit("/v1/pages/"), i), F.concat(F.lit("/v1/comments?block_id="), i), F.lit("/v1/users/me"), F.lit("/v1/search"),
        F.lit("/api/v3/x"), F.concat(F.lit("/other/v1/pages/"), i),
    ]
    b = table(spark, d, "blocks").select(F.get(F.array(*paths), (F.col("block_no") % len(paths)).cast("int")).alias("path")).filter("path IS NOT NULL")
    return b.select(X.endpoint_class("path").alias("family")).groupBy("family").agg(F.count("*").alias("requests"))


QUERIES = {
    f.__name__: f
    for f in (
        block_listing, comment_documents, schema_documents, document_sync, uncovered_properties, replaced_documents, tree_levels, relative_links, thread_repair, multi_home_ids, audit_pool, pending_discovery, run_alarms, breach_order, probe_rows, endpoint_families,
    )
}

_ID = "lower(replace({}, '-', ''))"
_NAME = """coalesce(nullif(rtrim(left(regexp_replace(regexp_replace(regexp_replace(trim({0}), '[\\\\/:*?"<>|\\x00-\\x1f]', ' ', 'g'), '^[. ]+|[. ]+$', '', 'g'), ' +', ' ', 'g'), 150)), ''), 'untitled')"""
_DOC = """concat_ws(chr(10), '# ' || coalesce(nullif(trim({0}.title), ''), 'untitled'), '| property | value |' || chr(10) || '|---|---|',
  nullif(concat_ws(chr(10), CASE WHEN {0}.parent_type <> '' THEN '| parent_type | ' || {0}.parent_type || ' |' END, CASE WHEN {0}.url <> '' THEN '| url | ' || replace({0}.url, '|', '\\|') || ' |' END), ''))"""
_WORDS = "list_distinct(list_filter(regexp_split_to_array(lower({0}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> ''))"
_UNCOVERED = f"""{force_sql("o", EARLIER)}, {force_sql("n")}, p AS (SELECT page_id, unnest(['title', 'parent_type', 'url', 'public_url']) AS name, unnest([coalesce(title, ''), coalesce(parent_type, ''), coalesce(url, ''), coalesce(public_url, '')]) AS value FROM o),
  doc AS (SELECT page_id, {_DOC.format("n")} || chr(10) || chr(10) || '<!-- enrichment -->' || chr(10) AS document FROM n),
  miss AS (SELECT p.page_id, name FROM p LEFT JOIN doc USING (page_id) WHERE value <> '' AND NOT (coalesce(contains(document, '| ' || name || ' |'), false) OR len(list_filter({_WORDS.format("value")}, lambda w: NOT list_contains({_WORDS.format("coalesce(document, '')")}, w))) = 0))"""
_THREADS = f"""{PC._ROWS}, filed AS (SELECT delivery_no, pos, cid, thread, home, seen FROM rows WHERE home IS NOT NULL UNION ALL
    SELECT delivery_no + 1000000000000, pos, CASE WHEN delivery_no % 2 = 0 THEN cid ELSE 'x' || cid END, thread, reverse(home), seen FROM rows WHERE home IS NOT NULL AND delivery_no % 3 = 0),
  owners AS (SELECT thread, arg_min(home, row(CASE WHEN seen IS NULL THEN 1 ELSE 0 END, delivery_no, pos)) AS owner FROM filed WHERE thread IS NOT NULL GROUP BY 1)"""
ORACLES = {
    "uncovered_properties": f"WITH {_UNCOVERED} SELECT * FROM miss",
    "replaced_documents": f"""WITH {_UNCOVERED} SELECT page_id FROM o WHERE page_id IN (SELECT {_ID.format("page_id")} FROM block_trees) AND page_id IN (SELECT page_id FROM n) AND page_id NOT IN (SELECT page_id FROM miss)""",
    "block_listing": f"""WITH RECURSIVE {PS._TREE}, ord AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY path) AS rn FROM t),
      has AS (SELECT page_id, {_ID.format("block_id")} AS id, arg_min(has_children, block_no) AS has FROM blocks WHERE block_id IS NOT NULL GROUP BY 1, 2), kid AS (SELECT DISTINCT page_id, parent AS id FROM b WHERE parent IS NOT NULL)
      SELECT ord.page_id, count(*) FILTER (rn <= {MOST_BLOCKS}) AS listed, coalesce(bool_or(rn <= {MOST_BLOCKS} AND has.has AND kid.id IS NULL), false) AS partial, count(*) > {MOST_BLOCKS} AS truncated
      FROM ord JOIN has ON has.page_id = ord.page_id AND has.id = ord.id LEFT JOIN kid ON kid.page_id = ord.page_id AND kid.id = ord.id GROUP BY 1""",
    "comment_documents": f"""WITH {PC._ROWS}, {force_sql("n")}, f AS (SELECT *, concat('- **', coalesce(author, '?'), '** (', left(created, 10), '): ', replace(text, chr(10), chr(10) || '  '),
        CASE WHEN resolved AND seen IS NOT NULL THEN strftime(seen AT TIME ZONE 'UTC', ' (resolved %Y-%m-%d)') ELSE '' END, ' `c:', cid, '`') AS line
        FROM (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY delivery_no, pos) AS k FROM rows WHERE cid IS NOT NULL AND text IS NOT NULL) WHERE k = 1),
      p AS (SELECT home, string_agg(line, chr(10) ORDER BY delivery_no, pos) AS body, count(*) AS n, count(*) FILTER (NOT resolved) AS o FROM f GROUP BY 1)
      SELECT home, CASE WHEN parent_type IS NULL THEN 'unplaced' WHEN parent_type = 'database_id' THEN 'row' ELSE 'page' END AS route,
        sha256(concat('## ', coalesce(nullif(trim(title), ''), '(untitled)'), ' `', home, '`', chr(10), body, chr(10), chr(10), p.n, ' comments, ', o, ' open')) AS sha, p.n AS comments FROM p LEFT JOIN n ON n.page_id = p.home""",
    "schema_documents": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '## {t}' || chr(10) || chr(10) || '| # | column |' || chr(10) || '|---|---|' || chr(10) || string_agg('| ' || i || ' | ' || column_name || ' |', chr(10) ORDER BY i) AS document FROM (SELECT row_number() OVER () AS i, column_name FROM (DESCRIBE SELECT * FROM {t}))"
        for t in ("pages_metadata", "blocks", "databases", "documents")
    ),
    "document_sync": f"""WITH {force_sql("o", EARLIER)}, {force_sql("n")}, j AS (SELECT o.page_id AS a, n.page_id AS b, {_NAME.format("o.title")} = {_NAME.format("n.title")} AS p, {_DOC.format("o")} = {_DOC.format("n")} AS t FROM o FULL JOIN n ON o.page_id = n.page_id)
      SELECT CASE WHEN a IS NULL THEN 'write' WHEN b IS NULL THEN 'remove' WHEN p AND t THEN 'keep' WHEN p THEN 'write' WHEN t THEN 'rename' ELSE 'move' END AS verdict, count(*) AS documents FROM j GROUP BY 1""",
    "tree_levels": f"""WITH {force_sql("n")}, p AS (SELECT page_id, parent_type, {_ID.format("parent_id")} AS parent, lower({_NAME.format("title")}) AS name FROM n),
      s AS (SELECT concat_ws('/', parent_type, parent) AS folder, page_id, CASE WHEN parent_type IS NOT NULL AND parent IS NOT NULL AND count(*) OVER (PARTITION BY parent_type, parent, name) > 1 THEN name || ' ' || left(page_id, 8) ELSE name END AS name FROM p)
      SELECT folder, name, rn, greatest(k - 20, 0) AS more FROM (SELECT *, row_number() OVER (PARTITION BY folder ORDER BY name, page_id) AS rn, count(*) OVER (PARTITION BY folder) AS k FROM s) WHERE rn <= 20""",
    "relative_links": f"""WITH {force_sql("n")}, p AS (SELECT page_id AS id, CASE WHEN parent_type = 'database_id' THEN '_databases' ELSE 'workspace' END AS top, nullif({_ID.format("parent_id")}, '') AS par, concat({_NAME.format("title")}, ' ', page_id, '.md') AS name FROM n),
      l AS (SELECT block_no, {_ID.format("page_id")} AS f, {_ID.format("json_extract_string(payload, '$.page_id')")} AS t FROM blocks WHERE block_type = 'link_to_page')
      SELECT block_no, CASE WHEN a.top IS DISTINCT FROM b.top THEN concat(CASE WHEN a.par IS NULL THEN '../' ELSE '../../' END, b.top, '/', b.par || '/', b.name) WHEN a.par IS NULL THEN concat(b.par || '/', b.name)
        WHEN a.par = b.par THEN b.name ELSE concat('../', b.par || '/', b.name) END AS link FROM l JOIN p a ON a.id = l.f JOIN p b ON b.id = l.t""",
    "thread_repair": f"""WITH {_THREADS}, x AS (SELECT f.*, owner, CASE WHEN owner IS NULL OR owner = home THEN 'keep' WHEN EXISTS (SELECT 1 FROM filed r2 WHERE r2.home = owner AND r2.cid = f.cid) THEN 'drop' ELSE 'move' END AS fate FROM filed f LEFT JOIN owners ON owners.thread = f.thread)
      SELECT fate, count(*) AS comments, count(DISTINCT thread) AS threads FROM x GROUP BY 1""",
    "multi_home_ids": f"""WITH {_THREADS}, s AS (SELECT cid, count(DISTINCT home) AS homes, min(thread) AS thread FROM filed WHERE cid IS NOT NULL GROUP BY 1 HAVING count(DISTINCT home) > 1) SELECT cid, homes, owner FROM s LEFT JOIN owners USING (thread)""",
    "audit_pool": f"""WITH {force_sql("n")}, c AS (SELECT {_ID.format("page_id")} AS page_id, max(fetched_at) AS last FROM block_trees GROUP BY 1), p AS (SELECT n.page_id, last FROM n LEFT JOIN c USING (page_id) WHERE NOT coalesce(in_trash, false))
      SELECT page_id, pos FROM (SELECT page_id, row_number() OVER (ORDER BY last NULLS FIRST, page_id) - 1 AS pos, count(*) OVER () AS n FROM p) WHERE pos < ceil(n / 30.0)""",
    "pending_discovery": f"""SELECT DISTINCT {_ID.format("parent_id")} AS key FROM pages_metadata WHERE parent_id <> '' AND swept_at IS NOT NULL AND {_ID.format("parent_id")} NOT IN (SELECT {_ID.format("db_id")} FROM databases)
      AND {_ID.format("parent_id")} NOT IN (SELECT {_ID.format("id")} FROM pages_metadata WHERE id IS NOT NULL)""",
    "run_alarms": """WITH r AS (SELECT run_no, epoch_us(started_at) AS s, epoch_us(ended_at) AS e, outcome FROM sweep_runs), x AS (SELECT max(s) + 172800000000 AS now, max(e) FILTER (outcome = 'ok') AS ok, max(s) AS last, arg_max(e IS NULL, row(s, run_no)) AS hangs, max(run_no) FILTER (outcome = 'ok') AS ok_no FROM r)
      SELECT 'no success' AS alarm, ok AS since_us FROM x WHERE ok IS NULL OR now - ok >= 21600000000 UNION ALL SELECT 'no start', last FROM x WHERE now - last >= 129600000000 UNION ALL SELECT 'never ended', last FROM x WHERE hangs
      UNION ALL SELECT 'failures', min(s) FROM r, x WHERE ok_no IS NULL OR run_no > ok_no HAVING count(*) >= 1""",
    "breach_order": """WITH l AS (SELECT doc_id, trim(l) AS line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents) WHERE trim(l) <> ''), s AS (SELECT line, count(DISTINCT doc_id) AS holders FROM l GROUP BY 1 HAVING count(DISTINCT doc_id) > 10)
      SELECT line, holders, row_number() OVER (ORDER BY holders DESC, lower(line), line) - 1 AS pos FROM s""",
    "probe_rows": f"""WITH {force_sql("n")}, p AS (SELECT {_ID.format("parent_id")} AS db, page_id IN (SELECT {_ID.format("page_id")} FROM webhook_captures) AS rich, coalesce(TRY_CAST(last_edited_time AS TIMESTAMPTZ) >= TIMESTAMPTZ '{EARLIER}+00', false) AS newer FROM n),
      m AS (SELECT db, CASE WHEN count(*) >= 100 AND count(*) FILTER (rich) * 100 < count(*) * 5 THEN 'some' ELSE 'all' END AS mode FROM p GROUP BY 1) SELECT db, mode, count(*) AS pages FROM p JOIN m USING (db) WHERE mode = 'all' OR rich OR newer GROUP BY ALL""",
    "endpoint_families": """SELECT ['block_children', 'block', 'source_query', 'source_query', 'source', 'property', 'page', 'comments', 'users', 'search', 'internal', 'other'][(block_no % 12) + 1] AS family, count(*) AS requests
      FROM blocks WHERE block_id IS NOT NULL OR block_no % 12 IN (8, 9, 10) GROUP BY 1""",
}
