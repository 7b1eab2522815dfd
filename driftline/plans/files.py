"""Queries of cells, documents, files and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftline.core.store import work_dir
from driftline.core.tables import table
from driftline.functions import cells
from driftline.functions import text as X
from driftline.functions.keys import micros, norm_id
from driftline.operators import changes as C
from driftline.operators import markdown as MD
from driftline.sources import files, paged, sinks
from driftline.streaming import fold


def cell_flatten(spark, d):
    """Typed properties built from each page record, and the cells they flatten to."""
    p = table(spark, d, "pages_metadata")
    opt = {"ignoreNullFields": "false"}
    prop = lambda kind, v: F.to_json(F.struct(F.lit(kind).alias("type"), v.alias(kind)), opt)
    text = lambda c: F.array(F.struct(F.col(c).alias("plain_text")))
    named = lambda c: F.struct(F.col(c).alias("name"))
    made = {
        "title": prop("title", text("title")), "kind": prop("select", named("parent_type")), "number": prop("number", F.col("delivery_no")),
        "span": prop("date", F.struct(F.substring("created_time", 1, 10).alias("start"), F.substring("last_edited_time", 1, 10).alias("end"))),
        "editor": prop("people", F.array(F.struct(F.col("id"), F.col("last_edited_by").alias("name")))), "cover": prop("checkbox", F.col("has_cover")),
        "url": prop("url", F.col("url")), "parent": prop("relation", F.array(F.struct(F.col("parent_id").alias("id")))),
        "tags": prop("multi_select", F.array(named("parent_type"), named("icon"))), "no": prop("unique_id", F.struct(F.lit("REC").alias("prefix"), F.col("delivery_no").alias("number"))),
        "author": prop("created_by", F.struct(F.col("created_by").alias("name"), F.col("id"))), "sum": prop("formula", F.struct(F.lit("boolean").alias("type"), F.col("has_cover").alias("boolean"))),
    }
    return cells.flatten_cells(p, ["delivery_no"], made, {"sum"})


def cell_types(spark, d):
    """The other property types: what each record would hold in them, and their cells."""
    p = table(spark, d, "pages_metadata")
    opt = {"ignoreNullFields": "false"}
    prop = lambda kind, v: F.to_json(F.struct(F.lit(kind).alias("type"), v.alias(kind)), opt)
    run = lambda c: F.struct(c.alias("plain_text"))
    file = lambda n, e, f: F.struct(n.alias("name"), F.struct(e.alias("url")).alias("external"), F.struct(f.alias("url")).alias("file"))
    none = F.lit(None).cast("string")
    made = {
        "rich": prop("rich_text", F.array(run(F.col("title")), run(F.lit(" / ")), run(F.col("icon")))), "mail": prop("email", F.concat("parent_type", F.lit("@mail.example"))), "phone": prop("phone_number", F.col("delivery_no").cast("string")),
        "state": prop("status", F.struct(F.col("parent_type").alias("name"))), "files": prop("files", F.array(file(F.col("icon"), F.col("url"), none), file(F.lit(""), none, F.col("public_url")))), "by": prop("last_edited_by", F.struct(none.alias("name"), F.col("id"))),
        "made_at": prop("created_time", F.col("created_time")), "edited_at": prop("last_edited_time", F.col("last_edited_time")), "checked": prop("verification", F.struct(F.col("parent_type").alias("state"))), "press": prop("button", none),
        "day": prop("date", F.struct(F.substring("created_time", 1, 10).alias("start"), none.alias("end"))), "half": prop("number", F.col("delivery_no") % 1000 / 2), "odd": prop("location", F.struct(F.col("delivery_no").alias("n"))),
        "total": prop("rollup", F.struct(F.lit("number").alias("type"), F.col("delivery_no").alias("number"))), "list": prop("rollup", F.struct(F.lit("array").alias("type"), F.array(F.struct(F.lit("select").alias("type"), F.struct(F.col("parent_type").alias("name")).alias("select"))).alias("array"))),
        "says": prop("formula", F.struct(F.lit("string").alias("type"), F.col("title").alias("string"))), "broken": F.concat(F.lit("{"), F.col("delivery_no").cast("string")),
    }
    return cells.flatten_cells(p, ["delivery_no"], made, {"total", "list", "says"})


def table_render(spark, d):
    """Records per parent type as a pipe table, archived and live; a null ``archived`` is read as false."""
    p = table(spark, d, "pages_metadata").withColumn("archived", F.coalesce("archived", F.lit(False)))
    n = p.groupBy("parent_type").pivot("archived", ["true", "false"]).count().na.fill(0)
    row = F.concat(F.lit("| "), F.coalesce("parent_type", F.lit("")), F.lit(" | "), F.col("true").cast("string"), F.lit(" | "), F.col("false").cast("string"), F.lit(" |"))
    lines = n.agg(F.array_join(F.sort_array(F.collect_list(row)), "\n").alias("body"))  # one row per parent type
    return lines.select(F.concat(F.lit("| parent | archived | live |\n|---|---|---|\n"), "body").alias("markdown"))


def blocks_render(spark, d):
    return MD.rendered(table(spark, d, "block_trees"))


def md_parse(spark, d):
    return MD.parsed(table(spark, d, "documents"), "doc_id", "text")


def md_headings(spark, d):
    """Blocks of each type that a document begins with a sign: what the lines say without their text being read."""
    lines = table(spark, d, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    t = F.trim("line")
    kind = (
        F.when(t.rlike(r"^#( |$)"), "heading_1").when(t.rlike(r"^##( |$)"), "heading_2").when(t.rlike(r"^#{3,6}( |$)"), "heading_3")
        .when(t.rlike(r"^- \[[ xX]\]( |$)"), "to_do").when(t == "---", "divider").when(t.rlike(r"^-( |$)"), "bulleted_list_item").when(t.rlike(r"^\d+\.( |$)"), "numbered_list_item")
    )
    return lines.withColumn("type", kind).filter("type IS NOT NULL").groupBy("type").agg(F.count("*").alias("blocks"), F.countDistinct("doc_id").alias("docs"))


def roundtrip(spark, d):
    return MD.round_trips(table(spark, d, "block_trees"))


def text_scalars(spark, d):
    """Scalar functions over whole texts: slugs, cells, escapes and their inverses, lines that begin a block."""
    docs = table(spark, d, "documents")
    guarded = X.guard_lines("text")
    return docs.select(
        "doc_id", X.slug("text").alias("slug"), F.sha2(X.md_cell("text"), 256).alias("cell"), F.size(F.filter(F.split("text", "\n"), X.starts_block)).alias("starts"),
        F.sha2(X.escape_md("text"), 256).alias("escaped"), F.sha2(X.unescape_md(X.escape_md("text")), 256).alias("unescaped"), F.length(guarded).alias("guarded_len"),
        F.sha2(X.unguard_lines(guarded), 256).alias("unguarded"), F.length(X.mask_stamps("text")).alias("masked_len"), X.comment_mark("text").alias("mark"), F.sha2("text", 256).alias("sha"),
    )


def plain_runs(spark, d):
    c = table(spark, d, "webhook_captures").select("delivery_no", F.posexplode("comments").alias("pos", "c"))
    return c.filter("c.rich_text IS NOT NULL").select("delivery_no", "pos", (X.plain_text("c.rich_text") == F.col("c.text")).alias("agrees"), F.size("c.rich_text").alias("runs"))


def url_clean(spark, d):
    b = table(spark, d, "pages_metadata").filter("url IS NOT NULL")
    signed = F.concat("url", F.lit("?v="), F.col("delivery_no").cast("string"), F.lit("&X-Amz-Date=1&token=abc&p=2#top"))
    return b.select("delivery_no", X.strip_credentials(signed).alias("url"))


def link_rewrite(spark, d):
    """Link blocks with the path of their target where the mirror has it, else with the bare id.

    The target is a page, database or comment; a database's folder lies below ``_databases``, a deleted database is not
    in the mirror.  Whichever field holds the id, a database is looked for first.  Blocks that name no id have no row.
    """
    pages = C.in_force(table(spark, d, "pages_metadata"), None, ["title"]).select(F.col("page_id").alias("target"), X.file_name("title").alias("name"))
    dbs = table(spark, d, "databases").filter("deleted_at IS NULL").groupBy(norm_id("db_id").alias("target")).agg(F.min(X.file_name("title")).alias("db_name"))
    ids = [F.nullif(norm_id(F.get_json_object("payload", f"$.{k}")), F.lit("")) for k in ("page_id", "database_id", "comment_id")]
    b = table(spark, d, "blocks").filter("block_type = 'link_to_page'").select("block_no", F.coalesce(*ids).alias("target")).filter("target IS NOT NULL")
    path = (
        F.when(F.col("db_name").isNotNull(), F.concat(F.lit("workspace/_databases/"), "db_name", F.lit(" "), "target"))
        .when(F.col("name").isNotNull(), F.concat(F.lit("workspace/"), "name", F.lit(" "), "target", F.lit(".md")))
        .otherwise(F.col("target"))
    )
    return b.join(dbs, "target", "left").join(pages, "target", "left").select("block_no", path.alias("link"))


def page_document(spark, d):
    """Title, property table and body of each page with a block tree; only the last fetch of a page in the mirror is rendered."""
    pages = C.in_force(table(spark, d, "pages_metadata"), None, ["title", "parent_type", "url"])
    t = table(spark, d, "block_trees")
    last = t.groupBy(norm_id("page_id").alias("page_id")).agg(F.max(F.struct("fetched_at", "tree_no")).getField("tree_no").alias("tree_no"))
    wanted = last.join(pages, "page_id")
    body = MD.rendered(t.join(wanted.select("tree_no"), "tree_no", "left_semi"))
    return sinks.row_documents(wanted.join(body, "tree_no"), "page_id", "title", ["parent_type", "url"], F.col("markdown"))


def schema_rows(spark, d):
    rows = [(t, i, n) for t in ("pages_metadata", "blocks", "databases", "documents") for i, n in enumerate(table(spark, d, t).columns)]
    return spark.createDataFrame(rows, "table_name string, pos int, column_name string")


def csv_roundtrip(spark, d):
    """Documents as they come back from CSV; their texts by digest."""
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("_row_id"), "text", F.coalesce("source", F.lit("")).alias("source"))
    path = work_dir(spark, "csv")
    sinks.write_table_csv(docs, path, [F.col("_row_id")])
    back = files.read_table_csv(spark, path, ["_row_id", "text", "source"])
    return back.select("_row_id", F.sha2("text", 256).alias("sha"), "source")


def jsonl_last_wins(spark, d):
    """Page metadata as JSON lines with positions, read back: the last line of each page and its first position."""
    path = work_dir(spark, "jsonl")
    m = table(spark, d, "pages_metadata").select(norm_id("id").alias("id"), F.col("delivery_no").alias("line_no"), "title", "parent_type")
    sinks.append_log(m, path)
    return files.read_jsonl(spark, path, "id string, line_no bigint, title string, parent_type string", "id").select("id", "line_no", "title", "first_line")


def path_index(spark, d):
    p = table(spark, d, "pages_metadata").select(F.concat(F.when(F.col("parent_type") == "database_id", "_databases/").otherwise("workspace/"), X.file_name("title"), F.lit(" "), norm_id("id"), F.when(F.col("has_cover"), ".md").otherwise("")).alias("path"))
    return files.artifact_index(p.distinct()).groupBy("kind").agg(F.count("*").alias("files"), F.countDistinct("id").alias("ids"))


def doc_sections(spark, d):
    s = files.document_sections(table(spark, d, "documents"), "doc_id", "text")
    return s.filter("section_no > 0").select("doc_id", "section_no", "title")


def log_prefilter(spark, d):
    """Latest error per user, from events as JSON lines: the substring test comes before the parse."""
    e = table(spark, d, "events")
    lines = e.select(F.to_json(F.struct("event_id", "user_id", "event_type", micros("ts").alias("us"))).alias("value"))
    got = files.read_events(lines, '"error"', "event_id bigint, user_id bigint, event_type string, us bigint")
    return got.filter("event_type = 'error'").groupBy("user_id").agg(F.max(F.struct("us", "event_id")).alias("m")).select("user_id", "m.us", "m.event_id")


def windowed_scan(spark, d):
    """All events through the paged source, 1,000 rows at a time."""
    spark.dataSource.register(paged.PagedSource)
    got = spark.read.format("paged").schema("event_id bigint, ts timestamp_ntz, user_id bigint").options(path=f"{d}/events.parquet", key="event_id", at="ts", cap="1000", windowRows="2000").load()
    return got.select("event_id", "user_id", micros("ts").alias("us"))


def listing_order(spark, d):
    """Comments per anchor block in order of the listing, the first three of each."""
    c = table(spark, d, "webhook_captures").select(norm_id("entity_id").alias("entity"), "delivery_no", F.posexplode("comments").alias("pos", "c"))
    from driftline.operators.schedule import top_and_more

    return top_and_more(c.select("entity", "delivery_no", "pos"), "entity", [F.col("delivery_no"), F.col("pos")], 3).select("entity", "delivery_no", "pos", "rn", "more")


def _log_lines(spark, d):
    key = F.concat_ws("/", "user_id", "event_type")
    return table(spark, d, "events").select(key.alias("key"), micros("ts").alias("at_us"), F.col("event_id").alias("serial"), F.get_json_object("props", "$.k").alias("value"), (F.col("event_type") == "purchase").alias("deleted"))


def stream_fold(spark, d):
    """Events as a change log through the streaming fold; purchases are tombstones."""
    root = work_dir(spark, "stream")
    _log_lines(spark, d).write.json(f"{root}/log")
    return fold.fold_stream(spark, f"{root}/log", root).select("key", "at_us", "serial", "value", "deleted")


QUERIES = {
    f.__name__: f
    for f in (
        cell_flatten, cell_types, table_render, blocks_render, md_parse, md_headings, roundtrip, text_scalars, plain_runs, url_clean, link_rewrite, page_document, schema_rows, csv_roundtrip,
        jsonl_last_wins, path_index, doc_sections, log_prefilter, windowed_scan, listing_order, stream_fold,
    )
}

_ID = "lower(replace({}, '-', ''))"
_NAME = """coalesce(nullif(rtrim(left(regexp_replace(regexp_replace(regexp_replace(trim({0}), '[\\\\/:*?"<>|\\x00-\\x1f]', ' ', 'g'), '^[. ]+|[. ]+$', '', 'g'), ' +', ' ', 'g'), 150)), ''), 'untitled')"""
_FORCE = f"""n AS (SELECT {_ID.format("id")} AS page_id, arg_max({{'title': title}}, row(coalesce(epoch_us(TRY_CAST(last_edited_time AS TIMESTAMPTZ)), -9000000000000000000), swept_at, delivery_no)) AS r FROM pages_metadata GROUP BY 1)"""
_LEAD = r"(?:#{1,6}(?: |$)|-(?: |$)|\d+\.(?: |$)|>(?: |$)|\||\$\$|!\[|---\s*$)"
ORACLES = {
    "cell_flatten": """SELECT delivery_no, coalesce(title, '') AS title, coalesce(parent_type, '') AS kind, CAST(delivery_no AS VARCHAR) AS number, concat_ws(' → ', left(created_time, 10), left(last_edited_time, 10)) AS span,
      coalesce(nullif(last_edited_by, ''), id) AS editor, CASE WHEN has_cover THEN 'true' ELSE 'false' END AS cover, coalesce(url, '') AS url, coalesce(parent_id, '') AS parent,
      concat_ws(', ', parent_type, icon) AS tags, 'REC-' || delivery_no AS no, coalesce(nullif(created_by, ''), id) AS author, CASE WHEN has_cover THEN 'True' WHEN NOT has_cover THEN 'False' ELSE 'None' END AS sum FROM pages_metadata""",
    "cell_types": """SELECT delivery_no, concat(title, ' / ', icon) AS rich, coalesce(parent_type || '@mail.example', '') AS mail, CAST(delivery_no AS VARCHAR) AS phone, coalesce(parent_type, '') AS state,
      concat_ws(', ', coalesce(nullif(icon, ''), url), public_url) AS files, coalesce(id, '') AS by, coalesce(created_time, '') AS made_at, coalesce(last_edited_time, '') AS edited_at, coalesce(parent_type, '') AS checked, '' AS press,
      coalesce(left(created_time, 10), '') AS day, CAST((delivery_no % 1000) / 2 AS VARCHAR) AS half, concat('{"n":', delivery_no, '}') AS odd, CAST(delivery_no AS VARCHAR) AS total,
      coalesce(parent_type, '') AS list, coalesce(title, 'None') AS says, concat('{', delivery_no) AS broken FROM pages_metadata""",
    "table_render": """SELECT '| parent | archived | live |' || chr(10) || '|---|---|---|' || chr(10) || string_agg(l, chr(10) ORDER BY l) AS markdown FROM (
      SELECT concat('| ', parent_type, ' | ', count(*) FILTER (coalesce(archived, false)), ' | ', count(*) FILTER (NOT coalesce(archived, false)), ' |') AS l FROM pages_metadata GROUP BY parent_type)""",
    "md_headings": r"""WITH l AS (SELECT doc_id, trim(l, ' ') AS t FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents)),
      k AS (SELECT doc_id, CASE WHEN regexp_matches(t, '^#( |$)') THEN 'heading_1' WHEN regexp_matches(t, '^##( |$)') THEN 'heading_2' WHEN regexp_matches(t, '^#{3,6}( |$)') THEN 'heading_3'
        WHEN regexp_matches(t, '^- \[[ xX]\]( |$)') THEN 'to_do' WHEN t = '---' THEN 'divider' WHEN regexp_matches(t, '^-( |$)') THEN 'bulleted_list_item' WHEN regexp_matches(t, '^\d+\.( |$)') THEN 'numbered_list_item' END AS type FROM l)
      SELECT type, count(*) AS blocks, count(DISTINCT doc_id) AS docs FROM k WHERE type IS NOT NULL GROUP BY 1""",
    "text_scalars": rf"""SELECT doc_id, left(regexp_replace(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 50) AS slug, sha256(replace(replace(replace(text, chr(13), ''), chr(10), ' '), '|', '\|')) AS cell,
      len(list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '^\s*(?:{_LEAD}|```|<!--|<details)'))) AS starts, sha256(regexp_replace(text, '([\\`*~<\[\]])', '\\\1', 'g')) AS escaped, sha256(text) AS unescaped,
      length(text) + len(list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '^\\*{_LEAD}'))) AS guarded_len, sha256(text) AS unguarded,
      length(regexp_replace(text, '\d{{4}}-\d{{2}}-\d{{2}}(?:[T ]\d{{2}}:\d{{2}}(?::\d{{2}}(?:\.\d+)?)?(?:Z|[+-]\d{{2}}:?\d{{2}})?)?', '<stamp>', 'g')) AS masked_len,
      nullif(regexp_extract(text, '`c:([0-9a-f]+)`', 1), '') AS mark, sha256(text) AS sha FROM documents""",
    "plain_runs": """SELECT delivery_no, pos, array_to_string([x.plain_text for x in c.rich_text], '') = c.text AS agrees, len(c.rich_text) AS runs FROM (
      SELECT delivery_no, unnest(comments) AS c, generate_subscripts(comments, 1) - 1 AS pos FROM webhook_captures) WHERE c.rich_text IS NOT NULL""",
    "url_clean": "SELECT delivery_no, concat(url, '?v=', delivery_no, '&p=2#top') AS url FROM pages_metadata WHERE url IS NOT NULL",
    "link_rewrite": f"""WITH {_FORCE}, l AS (SELECT block_no, coalesce({", ".join(f"nullif({_ID.format(f'json_extract_string(payload, {chr(39)}$.{k}{chr(39)})')}, '')" for k in ("page_id", "database_id", "comment_id"))}) AS t
      FROM blocks WHERE block_type = 'link_to_page'), dbs AS (SELECT {_ID.format("db_id")} AS id, min({_NAME.format("title")}) AS name FROM databases WHERE deleted_at IS NULL GROUP BY 1)
      SELECT block_no, CASE WHEN dbs.id IS NOT NULL THEN concat('workspace/_databases/', dbs.name, ' ', t) WHEN page_id IS NOT NULL THEN concat('workspace/', {_NAME.format("r.title")}, ' ', t, '.md') ELSE t END AS link
      FROM l LEFT JOIN dbs ON dbs.id = l.t LEFT JOIN n ON n.page_id = l.t WHERE t IS NOT NULL""",
    "schema_rows": " UNION ALL ".join(f"SELECT '{t}' AS table_name, row_number() OVER () - 1 AS pos, column_name FROM (DESCRIBE SELECT * FROM {t})" for t in ("pages_metadata", "blocks", "databases", "documents")),
    "csv_roundtrip": "SELECT CAST(doc_id AS VARCHAR) AS _row_id, sha256(coalesce(text, '')) AS sha, coalesce(source, '') AS source FROM documents",
    "jsonl_last_wins": f"""SELECT id, max(line_no) AS line_no, arg_max({{'t': title}}, line_no).t AS title, min(line_no) AS first_line FROM (SELECT {_ID.format("id")} AS id, delivery_no AS line_no, title FROM pages_metadata) GROUP BY 1""",
    "path_index": f"""SELECT kind, count(*) AS files, count(DISTINCT id) AS ids FROM (SELECT DISTINCT parent_type = 'database_id' AS p, {_NAME.format("title")} AS name, {_ID.format("id")} AS id, CASE WHEN has_cover THEN 'document' ELSE 'folder' END AS kind FROM pages_metadata) GROUP BY 1""",
    "doc_sections": """SELECT doc_id, i AS section_no, trim(regexp_replace(split_part(p[i + 1], chr(10), 1), '\\s*`[^`]*`\\s*$', '')) AS title FROM (
      SELECT doc_id, p, unnest(range(1, len(p))) AS i FROM (SELECT doc_id, string_split(chr(10) || text, chr(10) || '## ') AS p FROM documents))""",
    "log_prefilter": "SELECT user_id, max(epoch_us(ts)) AS us, arg_max(event_id, row(ts, event_id)) AS event_id FROM events WHERE event_type = 'error' GROUP BY 1",
    "windowed_scan": "SELECT event_id, user_id, epoch_us(ts) AS us FROM events",
    "listing_order": f"""SELECT entity, delivery_no, pos, rn, greatest(n - 3, 0) AS more FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY delivery_no, pos) AS rn, count(*) OVER (PARTITION BY entity) AS n FROM (
      SELECT {_ID.format("entity_id")} AS entity, delivery_no, generate_subscripts(comments, 1) - 1 AS pos FROM webhook_captures)) WHERE rn <= 3""",
    "stream_fold": """SELECT concat_ws('/', user_id, event_type) AS key, max(epoch_us(ts)) FILTER (event_type <> 'purchase') AS at_us, arg_max(event_id, row(ts, event_id)) FILTER (event_type <> 'purchase') AS serial,
      arg_max(json_extract_string(props, '$.k'), row(ts, event_id)) FILTER (event_type <> 'purchase') AS value, bool_or(event_type = 'purchase') AS deleted FROM events GROUP BY 1""",
}
