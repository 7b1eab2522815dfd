"""Queries of the comment histories."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftline.core.store import cut
from driftline.core.tables import table
from driftline.functions import text as X
from driftline.functions.keys import norm_id
from driftline.operators import changes as C
from driftline.operators import comments as M
from driftline.plans.changes import EARLIER, _pages, force_sql

TODAY = "2026-10-01"


def _rows(spark, d):
    return M.comment_rows(table(spark, d, "webhook_captures"))


def _scans(spark, d):
    return table(spark, d, "block_trees").groupBy(norm_id("page_id").alias("home")).agg(F.max("fetched_at").alias("scan_at"))


def _early(spark, d):
    return _rows(spark, d).filter(F.col("at") < F.lit(EARLIER).cast("timestamp"))


def _late(spark, d):
    return _rows(spark, d).filter(F.col("at") >= F.lit(EARLIER).cast("timestamp"))


_ORDER = ["delivery_no", "pos"]


def latest_wins(spark, d):
    rows = _rows(spark, d).filter("cid IS NOT NULL")
    last = M.latest_by(rows, ["cid"], [F.col("at"), F.col("delivery_no"), F.col("pos")], ["text", "delivery_no"])
    return last.select("cid", "text", "delivery_no")


def keep_first_dedup(spark, d):
    return M.keep_first(_rows(spark, d).select("cid", "delivery_no", "pos", "text"), "cid", _ORDER)


def capture_asof(spark, d):
    return M.capture_order(_rows(spark, d), _scans(spark, d)).groupBy("order").agg(F.count("*").alias("comments"), F.countDistinct("home").alias("homes"))


def _no_store(spark):
    return spark.createDataFrame([], "cid string, home string, text string, resolved_on date")


def _dated(folded):
    return folded.withColumn("resolved_on", F.date_format("resolved_on", "yyyy-MM-dd"))


def fold_log(spark, d):
    return _dated(M.fold_captures(_no_store(spark), _rows(spark, d), _scans(spark, d), TODAY))


def fold_twice(spark, d):
    once = M.fold_captures(_no_store(spark), _rows(spark, d).filter("cid IS NOT NULL"), _scans(spark, d), TODAY)
    return _dated(M.fold_captures(once, _rows(spark, d).filter("cid IS NOT NULL"), _scans(spark, d), TODAY))


def append_only_merge(spark, d):
    ids = lambda rows: rows.filter("cid IS NOT NULL").select("cid").distinct()
    old = ids(_early(spark, d)).withColumn("resolved_on", F.lit(None).cast("date"))
    return M.append_only_merge(old, ids(_late(spark, d)), "cid", TODAY).select("cid", F.date_format("resolved_on", "yyyy-MM-dd").alias("resolved_on"))


def union_captured(spark, d):
    w = table(spark, d, "webhook_captures")
    ids = lambda t: M.comment_rows(w.filter(F.col("entity_type") == t)).filter("cid IS NOT NULL").select("cid").distinct()
    return M.union_missing(ids("page"), ids("block"), "cid", TODAY).select("cid", F.date_format("resolved_on", "yyyy-MM-dd").alias("resolved_on"))


def _store(spark, d):
    """What a mirror holds that was last written before EARLIER: the first text of each comment, every fifth (by its number) still without an id."""
    early = M.keep_first(_early(spark, d).filter("cid IS NOT NULL AND text IS NOT NULL"), "cid", _ORDER)
    day = F.when(F.col("resolved"), F.to_date("at"))
    return early.select(F.when(F.col("delivery_no") % 5 != 0, F.col("cid")).alias("cid"), "home", "text", day.alias("resolved_on"))


def fold_store(spark, d):
    """All captures folded into a store that is not empty, with deletions, on homes that the mirror has."""
    closed = _late(spark, d).filter("resolved AND cid IS NOT NULL").select("cid", F.to_date("at").alias("day"))
    homes = table(spark, d, "pages_metadata").select(norm_id("id").alias("home"))
    return _dated(M.fold_captures(_store(spark, d), _rows(spark, d), _scans(spark, d), TODAY, closed, homes))


def open_homes(spark, d):
    return M.open_homes(_store(spark, d))


def _keyed(rows):
    return rows.withColumns({"key": X.text_key("text"), "day": F.substring("created", 1, 10)})


def _bare_bullets(spark, d):
    """Stored bullets whose ids are to be found again; authors that were renamed since (every seventh) are unknown."""
    rows = M.keep_first(_keyed(_rows(spark, d).filter("cid IS NOT NULL AND text IS NOT NULL")), "cid", _ORDER)
    return rows.select("delivery_no", "pos", "home", F.when(F.col("delivery_no") % 7 != 0, F.col("author")).alias("author"), "day", "key")


def _id_sources(spark, d):
    rows = _keyed(_rows(spark, d).filter("cid IS NOT NULL AND text IS NOT NULL")).withColumn("rank", F.when(F.col("at").isNull(), 1).otherwise(0))
    best = M.latest_by(rows.withColumn("_r", -F.col("rank")), ["home", "cid"], [F.col("_r"), -F.col("delivery_no"), -F.col("pos")], ["rank", "author", "day", "key"])
    return best.withColumn("src", F.when(F.col("rank") == 0, "capture").otherwise("backfill"))


def consuming_join(spark, d):
    """Stored bullets with the source entry of the same home, author, day and text, each used once."""
    a = _bare_bullets(spark, d).filter("author IS NOT NULL")
    return M.consuming_join(a, _id_sources(spark, d), ["home", "author", "day", "key"], ["delivery_no", "pos"], ["rank", "cid"], ["cid"]).select("delivery_no", "pos", "cid")


def stamp_ids(spark, d):
    return M.stamp_ids(_bare_bullets(spark, d), _id_sources(spark, d))


def id_tally(spark, d):
    return M.id_tally(stamp_ids(spark, d)).select("src", "bullets", F.round("share", 6).alias("share"))


def child_copies(spark, d):
    """Comments that a parent lists too, anchored on the child's title: every third one here has such a copy beside it, on a page of the spelling turned round."""
    rows = _keyed(_rows(spark, d).filter("text IS NOT NULL")).select("delivery_no", "pos", "home", "anchor", "cid", "author", "day", "key")
    titles = cut(_pages(spark, d, None, ["title"]).select(F.col("page_id").alias("home"), "title"), "titles")
    copies = rows.filter("delivery_no % 3 = 0").join(titles, "home").withColumns({"anchor": F.col("title"), "home": F.reverse("home"), "cid": F.when(F.col("delivery_no") % 2 == 0, F.col("cid"))})
    both = rows.unionByName(copies.select(*rows.columns))
    return M.child_copies(both, titles, ["delivery_no", "pos", "home"])


def _both_writers(spark, d):
    """The comments of the log as a writer with ids put them, mentions as such, and as an older one without ids did, mentions spelled out."""
    rows = M.keep_first(_rows(spark, d).filter("cid IS NOT NULL AND text IS NOT NULL AND author IS NOT NULL"), "cid", _ORDER)
    no = F.col("delivery_no").cast("decimal(20,0)") * F.lit(2**31) + F.col("pos")  # of its own for every comment
    rows = rows.select(no.alias("no"), "cid", "author", F.substring("created", 1, 10).alias("day"), "text", "anchor", "delivery_no", "pos")
    old = rows.filter("delivery_no % 2 = 0").withColumns({"text": F.concat(F.lit("Cleo van Marsh "), F.col("text")), "cid": F.lit(None).cast("string")})
    return rows.withColumn("text", F.concat(F.lit("@Cleo "), F.col("text"))), old


def fuzzy_pairs(spark, d):
    new, old = _both_writers(spark, d)
    return M.fuzzy_pairs(old, new, ["author", "day"]).select(*[F.col(c).cast("decimal(38,0)").cast("string").alias(c) for c in ("legacy_no", "ided_no")])


def reconcile(spark, d):
    """Both writings of the log together: what stays is one bullet a comment."""
    new, old = _both_writers(spark, d)
    both = new.unionByName(old.withColumn("no", F.col("no") + F.expr("cast(1e30 as decimal(31,0))")))
    return M.reconcile(both, ["delivery_no", "pos"], ["author", "day"]).groupBy(F.col("cid").isNotNull().alias("has_id")).agg(F.count("*").alias("bullets"))


def still_live(spark, d):
    return M.still_live(_early(spark, d).select("delivery_no", "pos", "cid", "text"), _late(spark, d)).select("delivery_no", "pos")


def home_assign(spark, d):
    rows = _rows(spark, d).select("cid", "home", "delivery_no", "pos", "at")
    return M.home_of(rows, "cid", "home", F.when(F.col("at").isNull(), 1).otherwise(0), _ORDER)


def thread_resolution(spark, d):
    stored = _early(spark, d).filter("thread IS NOT NULL").groupBy("thread").agg(F.max("resolved").alias("r")).select("thread", (~F.col("r")).alias("open"))
    return M.thread_states(stored, _late(spark, d).filter("thread IS NOT NULL").select("thread"), "thread")


def _bullets(spark, d):
    rows = M.keep_first(_rows(spark, d).filter("cid IS NOT NULL AND thread IS NOT NULL AND text IS NOT NULL"), "cid", _ORDER)
    line = M.bullet(F.col("text"), F.coalesce("author", F.lit("?")), F.substring("created", 1, 10), F.col("cid"), F.lit(None).cast("date"))
    return rows.select("thread", "cid", "delivery_no", "pos", line.alias("line"), "text", "author", "created")


def thread_render(spark, d):
    b = _bullets(spark, d).withColumn("k", F.struct("delivery_no", "pos", "line"))
    return b.groupBy("thread").agg(F.array_join(F.transform(F.sort_array(F.collect_list("k")), lambda x: x["line"]), "\n").alias("body"), F.count("*").alias("bullets"))


def sections_parse(spark, d):
    return M.parse_bullets(thread_render(spark, d), "thread", "body").select("thread", "pos", "who", "day", "cid", X.text_key("text").alias("text"))


def harvest(spark, d):
    """Comments per anchor, those without an anchor or author among the orphans."""
    anchor = F.when(F.col("anchor").isNull() | F.col("author").isNull(), "(orphan)").otherwise(F.col("anchor"))
    return _rows(spark, d).groupBy(anchor.alias("anchor")).agg(F.count("*").alias("comments"), F.countDistinct("cid").alias("ids"), F.min("delivery_no").alias("first_no"))


def anchor_text(spark, d):
    w = table(spark, d, "webhook_captures")
    a = F.coalesce(F.nullif(F.trim("anchor"), F.lit("")), F.nullif(F.trim(F.col("comments")[0]["text"]), F.lit("")), F.concat(F.lit("("), F.col("entity_type"), F.lit(")")), F.lit("(page-level)"))
    return w.select("delivery_no", F.substring(a, 1, 90).alias("anchor"))


def backfill_merge(spark, d):
    """Stored texts first, then captured ones whose text key is not stored yet; the first of each key."""
    w = table(spark, d, "webhook_captures")
    rows = lambda c, p: M.comment_rows(w.filter(c)).filter("text IS NOT NULL").select(X.text_key("text").alias("key"), F.lit(p).alias("rank"), "delivery_no", "pos")
    both = rows("captured_at <> 'backfill'", 0).union(rows("captured_at = 'backfill'", 1))
    return M.keep_first(both, "key", ["rank", "delivery_no", "pos"]).select("key", "rank")


def multi_home(spark, d):
    """Comment texts on more than one page, with the page that had them first."""
    rows = _rows(spark, d).filter("text IS NOT NULL").select(X.text_key("text").alias("key"), "home", "delivery_no")
    several = rows.groupBy("key").agg(F.countDistinct("home").alias("homes"), F.min(F.struct("delivery_no", "home")).getField("home").alias("owner"))
    return several.filter("homes > 1")


def misattribution_repair(spark, d):
    """What happens to each stored copy of a text that several pages hold: the owner keeps it, elsewhere it is dropped."""
    own = multi_home(spark, d)
    rows = _rows(spark, d).filter("text IS NOT NULL").select("delivery_no", "pos", "home", X.text_key("text").alias("key"))
    return rows.join(own, "key").select("delivery_no", "pos", F.when(F.col("home") == F.col("owner"), "keep").otherwise("drop").alias("fate"))


def sticky_date(spark, d):
    """Users in trouble: the day of their first error after the last purchase, kept until the next purchase."""
    e = table(spark, d, "events").select("user_id", "event_type", "ts")
    ok = e.filter("event_type = 'purchase'").groupBy("user_id").agg(F.max("ts").alias("ok"))
    bad = e.filter("event_type = 'error'").join(ok, "user_id", "left").filter("ok IS NULL OR ts > ok")
    return bad.groupBy("user_id").agg(F.date_format(F.min("ts"), "yyyy-MM-dd").alias("missed_on"))


def capped_list(spark, d):
    """The comment ids of each thread, first as a listing of three gives them, then completed by a lookup that knows the pages of the mirror only."""
    rows = _rows(spark, d).filter("thread IS NOT NULL AND cid IS NOT NULL")
    full = rows.groupBy("thread").agg(F.array_sort(F.collect_set("cid")).alias("ids"), F.min("home").alias("home"))  # a thread's own comments
    short = full.select("thread", F.slice("ids", 1, 3).alias("ids"), (F.size("ids") > 3).alias("has_more"))
    pages = table(spark, d, "pages_metadata").filter("NOT coalesce(archived, false)").select(norm_id("id").alias("home")).distinct()
    done = C.completed_lists(short, full.join(pages, "home", "left_semi").select("thread", "ids"), "thread", "ids", 3)
    return done.select("thread", F.size("ids").alias("n"), F.array_join("ids", ",").alias("ids"), "state")


QUERIES = {
    f.__name__: f
    for f in (
        latest_wins, keep_first_dedup, capture_asof, fold_log, fold_twice, fold_store, open_homes, stamp_ids, id_tally, child_copies, reconcile, append_only_merge, union_captured, consuming_join, fuzzy_pairs, still_live, home_assign, thread_resolution,
        thread_render, sections_parse, harvest, anchor_text, backfill_merge, multi_home, misattribution_repair, sticky_date, capped_list,
    )
}

_KEY = "trim(regexp_replace(regexp_replace({}, '\\s*\\(resolved \\d{{4}}-\\d{{2}}-\\d{{2}}\\)|\\s*`c:[0-9a-f]*`', '', 'g'), '\\s+', ' ', 'g'))"
_ID = "lower(replace({}, '-', ''))"
_ROWS = f"""rows AS (SELECT delivery_no, pos, home, seen, anchor, {_ID.format("c.id")} AS cid, {_ID.format("c.discussion_id")} AS thread, c.text AS text, c.author_id AS author, c.rich_text IS NOT NULL AS has_rich,
  coalesce(c.resolved, false) AS resolved, c.created_time AS created FROM (SELECT delivery_no, {_ID.format("page_id")} AS home, TRY_CAST(captured_at AS TIMESTAMPTZ) AS seen, anchor, captured_at, entity_type,
  unnest(comments) AS c, generate_subscripts(comments, 1) - 1 AS pos FROM webhook_captures)),
  early AS (SELECT * FROM rows WHERE seen < TIMESTAMPTZ '{EARLIER}+00'), late AS (SELECT * FROM rows WHERE seen >= TIMESTAMPTZ '{EARLIER}+00'),
  scans AS (SELECT {_ID.format("page_id")} AS home, max(fetched_at) AS scan_at FROM block_trees GROUP BY 1)"""
_FOLD = f"""WITH {_ROWS}, latest AS (SELECT cid, r.* FROM (SELECT cid, arg_max({{'home': home, 'text': text, 'seen': seen}}, row(coalesce(epoch_us(seen), -9000000000000000000), delivery_no, pos)) AS r FROM rows WHERE cid IS NOT NULL GROUP BY 1)),
  folded AS (SELECT cid, l.home, text, CASE WHEN seen > scan_at OR (scan_at IS NULL AND seen IS NOT NULL) THEN NULL ELSE coalesce(strftime(scan_at AT TIME ZONE 'UTC', '%Y-%m-%d'), '{TODAY}') END AS resolved_on FROM latest l LEFT JOIN scans s ON s.home = l.home),
  bare AS (SELECT home, {_KEY.format("text")} AS k, arg_max({{'text': text, 'seen': seen}}, row(coalesce(epoch_us(seen), -9000000000000000000), delivery_no, pos)) AS r FROM rows WHERE cid IS NULL GROUP BY 1, 2)"""
_STORE = f"""{_ROWS}, store AS (SELECT CASE WHEN delivery_no % 5 <> 0 THEN cid END AS cid, home, text, CASE WHEN resolved THEN strftime(seen AT TIME ZONE 'UTC', '%Y-%m-%d') END AS resolved_on
  FROM (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY delivery_no, pos) AS n FROM early WHERE cid IS NOT NULL AND text IS NOT NULL) WHERE n = 1)"""
_STAMP = f"""{_ROWS}, k AS (SELECT *, left(created, 10) AS day, {_KEY.format("text")} AS key FROM rows WHERE cid IS NOT NULL AND text IS NOT NULL),
  bullets AS (SELECT delivery_no, pos, home, CASE WHEN delivery_no % 7 <> 0 THEN author END AS author, day, key FROM (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY delivery_no, pos) AS n FROM k) WHERE n = 1),
  src AS (SELECT home, cid, author, day, key, CASE WHEN seen IS NULL THEN 1 ELSE 0 END AS rank FROM (SELECT *, row_number() OVER (PARTITION BY home, cid ORDER BY seen IS NULL, delivery_no, pos) AS n FROM k) WHERE n = 1),
  named AS (SELECT *, CASE rank WHEN 0 THEN 'capture' ELSE 'backfill' END AS src FROM src),
  one AS (SELECT a.delivery_no, a.pos, b.cid, b.src FROM (SELECT *, row_number() OVER (PARTITION BY home, author, day, key ORDER BY delivery_no, pos) AS n FROM bullets WHERE author IS NOT NULL) a
    JOIN (SELECT *, row_number() OVER (PARTITION BY home, author, day, key ORDER BY rank, cid) AS n FROM named) b USING (home, author, day, key, n)),
  two AS (SELECT a.delivery_no, a.pos, b.cid, b.src FROM (SELECT *, row_number() OVER (PARTITION BY home, day, key ORDER BY delivery_no, pos) AS n FROM bullets WHERE (delivery_no, pos) NOT IN (SELECT (delivery_no, pos) FROM one)) a
    JOIN (SELECT *, row_number() OVER (PARTITION BY home, day, key ORDER BY rank, cid) AS n FROM named WHERE cid NOT IN (SELECT cid FROM one)) b USING (home, day, key, n))"""
_WRITERS = f"""{_ROWS}, firsts AS (SELECT *, CAST(delivery_no AS HUGEINT) * 2147483648 + pos AS no, left(created, 10) AS day, lower(array_to_string(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+'), ' ')) AS w
    FROM (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY delivery_no, pos) AS n FROM rows WHERE cid IS NOT NULL AND text IS NOT NULL AND author IS NOT NULL) WHERE n = 1),
  a AS (SELECT *, row_number() OVER (PARTITION BY author, day, w ORDER BY no) AS r FROM firsts WHERE delivery_no % 2 = 0), b AS (SELECT *, row_number() OVER (PARTITION BY author, day, w ORDER BY no) AS r FROM firsts),
  pairs AS (SELECT a.no AS legacy_no, b.no AS ided_no FROM a JOIN b USING (author, day, w, r))"""
ORACLES = {
    "latest_wins": f"""WITH {_ROWS} SELECT cid, r.* FROM (SELECT cid, arg_max({{'text': text, 'delivery_no': delivery_no}}, row(coalesce(epoch_us(seen), -9000000000000000000), delivery_no, pos)) AS r FROM rows WHERE cid IS NOT NULL GROUP BY 1)""",
    "keep_first_dedup": f"""WITH {_ROWS} SELECT cid, delivery_no, pos, text FROM (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY delivery_no, pos) AS n FROM rows) WHERE cid IS NULL OR n = 1""",
    "capture_asof": f"""WITH {_ROWS} SELECT CASE WHEN seen IS NULL THEN 'no_time' WHEN scan_at IS NULL THEN 'no_scan' WHEN seen > scan_at THEN 'newer' ELSE 'older' END AS "order", count(*) AS comments, count(DISTINCT rows.home) AS homes
      FROM rows LEFT JOIN scans USING (home) GROUP BY 1""",
    "fold_log": f"""{_FOLD} SELECT * FROM folded UNION ALL SELECT NULL, b.home, b.r.text, CASE WHEN b.r.seen > scan_at OR (scan_at IS NULL AND b.r.seen IS NOT NULL) THEN NULL ELSE coalesce(strftime(scan_at AT TIME ZONE 'UTC', '%Y-%m-%d'), '{TODAY}') END
      FROM bare b LEFT JOIN scans s ON s.home = b.home WHERE NOT EXISTS (SELECT 1 FROM folded f WHERE f.home = b.home AND {_KEY.format("f.text")} = b.k)""",
    "fold_twice": f"{_FOLD} SELECT * FROM folded",
    "append_only_merge": f"""WITH {_ROWS}, o AS (SELECT DISTINCT cid FROM early WHERE cid IS NOT NULL), n AS (SELECT DISTINCT cid FROM late WHERE cid IS NOT NULL)
      SELECT coalesce(o.cid, n.cid) AS cid, CASE WHEN n.cid IS NULL THEN '{TODAY}' END AS resolved_on FROM o FULL JOIN n ON o.cid = n.cid""",
    "union_captured": f"""WITH a AS (SELECT DISTINCT entity_type AS t, {_ID.format("unnest(comments).id")} AS cid FROM webhook_captures) SELECT cid, NULL AS resolved_on FROM a WHERE t = 'page' AND cid IS NOT NULL
      UNION ALL SELECT cid, '{TODAY}' FROM a WHERE t = 'block' AND cid IS NOT NULL AND cid NOT IN (SELECT cid FROM a WHERE t = 'page' AND cid IS NOT NULL)""",
    "fold_store": f"""WITH {_STORE}, caps AS (SELECT * FROM rows WHERE home IN (SELECT {_ID.format("id")} FROM pages_metadata)),
      claim AS (SELECT cid, arg_min(home, row(CASE WHEN seen IS NULL THEN 1 ELSE 0 END, delivery_no, pos)) AS home FROM caps WHERE cid IS NOT NULL GROUP BY 1),
      held AS (SELECT claim.cid, coalesce(s.home, claim.home) AS home FROM claim LEFT JOIN store s ON s.cid = claim.cid),
      cap AS (SELECT cid, r.* FROM (SELECT caps.cid, arg_max({{'home': caps.home, 'text': text, 'seen': seen, 'has_rich': has_rich}}, row(coalesce(epoch_us(seen), -9000000000000000000), delivery_no, pos)) AS r
        FROM caps JOIN held ON held.cid = caps.cid AND held.home = caps.home GROUP BY 1)),
      dated AS (SELECT cap.*, scan_at, seen IS NOT NULL AND (scan_at IS NULL OR seen > scan_at) AS newer, coalesce(strftime(scan_at AT TIME ZONE 'UTC', '%Y-%m-%d'), '{TODAY}') AS day FROM cap LEFT JOIN scans USING (home)),
      kept AS (SELECT s.cid, s.home, CASE WHEN s.resolved_on IS NULL AND d.newer AND d.scan_at IS NOT NULL AND d.has_rich AND d.text <> s.text THEN d.text ELSE s.text END AS text, s.resolved_on
        FROM store s LEFT JOIN dated d ON d.cid = s.cid WHERE s.cid IS NOT NULL),
      fresh AS (SELECT *, {_KEY.format("text")} AS k, row_number() OVER (PARTITION BY home, {_KEY.format("text")} ORDER BY cid) AS n FROM dated WHERE cid NOT IN (SELECT cid FROM store WHERE cid IS NOT NULL)),
      bare AS (SELECT *, {_KEY.format("text")} AS k, row_number() OVER (PARTITION BY home, {_KEY.format("text")} ORDER BY resolved_on NULLS FIRST, text) AS n FROM store WHERE cid IS NULL),
      merged AS (SELECT f.cid, coalesce(f.home, b.home) AS home, coalesce(f.text, b.text) AS text, CASE WHEN f.cid IS NULL OR (b.home IS NOT NULL AND NOT f.newer) THEN b.resolved_on WHEN f.newer THEN NULL ELSE f.day END AS resolved_on
        FROM fresh f FULL JOIN bare b ON b.home = f.home AND b.k = f.k AND b.n = f.n),
      two AS (SELECT * FROM kept UNION ALL SELECT * FROM merged),
      extra AS (SELECT NULL AS cid, x.home, x.r.text AS text, CASE WHEN x.r.seen IS NOT NULL AND (scan_at IS NULL OR x.r.seen > scan_at) THEN NULL ELSE coalesce(strftime(scan_at AT TIME ZONE 'UTC', '%Y-%m-%d'), '{TODAY}') END AS resolved_on
        FROM (SELECT home, {_KEY.format("text")} AS k, arg_max({{'text': text, 'seen': seen}}, row(coalesce(epoch_us(seen), -9000000000000000000), delivery_no, pos)) AS r FROM caps WHERE cid IS NULL GROUP BY 1, 2) x LEFT JOIN scans USING (home)
        WHERE NOT EXISTS (SELECT 1 FROM two WHERE two.home = x.home AND {_KEY.format("two.text")} = x.k)),
      gone AS (SELECT cid, strftime(min(seen) AT TIME ZONE 'UTC', '%Y-%m-%d') AS day FROM late WHERE resolved AND cid IS NOT NULL GROUP BY 1)
      SELECT o.cid, home, text, coalesce(resolved_on, gone.day) AS resolved_on FROM (SELECT * FROM two UNION ALL SELECT * FROM extra) o LEFT JOIN gone ON gone.cid = o.cid""",
    "open_homes": f"""WITH {_STORE} SELECT home, count(*) AS open, bool_or(cid IS NULL) AS open_legacy FROM store WHERE resolved_on IS NULL GROUP BY 1""",
    "consuming_join": f"""WITH {_STAMP} SELECT delivery_no, pos, cid FROM one""",
    "stamp_ids": f"""WITH {_STAMP} SELECT b.delivery_no, b.pos, coalesce(one.cid, two.cid) AS cid, coalesce(one.src, two.src, 'legacy') AS src, CASE WHEN one.cid IS NOT NULL THEN 0 WHEN two.cid IS NOT NULL THEN 1 END AS level
      FROM bullets b LEFT JOIN one ON one.delivery_no = b.delivery_no AND one.pos = b.pos LEFT JOIN two ON two.delivery_no = b.delivery_no AND two.pos = b.pos""",
    "id_tally": f"""WITH {_STAMP}, s AS (SELECT coalesce(one.src, two.src, 'legacy') AS src FROM bullets b LEFT JOIN one ON one.delivery_no = b.delivery_no AND one.pos = b.pos LEFT JOIN two ON two.delivery_no = b.delivery_no AND two.pos = b.pos)
      SELECT src, count(*) AS bullets, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM s GROUP BY 1""",
    "child_copies": f"""WITH {_ROWS}, {force_sql("n")}, r AS (SELECT delivery_no, pos, home, anchor, cid, author, left(created, 10) AS day, {_KEY.format("text")} AS key FROM rows WHERE text IS NOT NULL),
      twice AS (SELECT * FROM r UNION ALL SELECT delivery_no, pos, reverse(home), n.title, CASE WHEN delivery_no % 2 = 0 THEN cid END, author, day, key FROM r JOIN n ON n.page_id = r.home WHERE delivery_no % 3 = 0)
      SELECT DISTINCT delivery_no, pos, home FROM twice a WHERE trim(anchor) <> '' AND EXISTS (SELECT 1 FROM n JOIN twice b ON b.home = n.page_id WHERE n.page_id <> a.home AND left(trim(n.title), 90) = left(trim(a.anchor), 90)
        AND (a.cid = b.cid OR ((a.cid IS NULL OR b.cid IS NULL) AND a.author = b.author AND a.day = b.day AND a.key = b.key)))""",
    "fuzzy_pairs": f"""WITH {_WRITERS} SELECT CAST(legacy_no AS VARCHAR) AS legacy_no, CAST(ided_no AS VARCHAR) AS ided_no FROM pairs""",
    "reconcile": f"""WITH {_WRITERS} SELECT true AS has_id, count(*) AS bullets FROM firsts UNION ALL SELECT * FROM (SELECT false, count(*) - (SELECT count(*) FROM pairs) AS n FROM firsts WHERE delivery_no % 2 = 0) WHERE n > 0""",
    "still_live": f"""WITH {_ROWS} SELECT delivery_no, pos FROM early WHERE CASE WHEN cid IS NOT NULL THEN cid IN (SELECT cid FROM late WHERE cid IS NOT NULL) ELSE {_KEY.format("text")} IN (SELECT {_KEY.format("text")} FROM late WHERE text IS NOT NULL) END""",
    "home_assign": f"""WITH {_ROWS} SELECT cid, arg_min(home, row(CASE WHEN seen IS NULL THEN 1 ELSE 0 END, delivery_no, pos)) AS home FROM rows WHERE cid IS NOT NULL GROUP BY 1""",
    "thread_resolution": f"""WITH {_ROWS}, o AS (SELECT thread, NOT bool_or(resolved) AS open FROM early WHERE thread IS NOT NULL GROUP BY 1), n AS (SELECT DISTINCT thread FROM late WHERE thread IS NOT NULL)
      SELECT coalesce(o.thread, n.thread) AS thread, CASE WHEN o.thread IS NULL THEN 'added' WHEN open AND n.thread IS NOT NULL THEN 'kept' WHEN open THEN 'resolved' WHEN n.thread IS NOT NULL THEN 'reopened' ELSE 'closed' END AS state
      FROM o FULL JOIN n ON o.thread = n.thread""",
    "thread_render": f"""WITH {_ROWS} SELECT thread, string_agg(line, chr(10) ORDER BY delivery_no, pos) AS body, count(*) AS bullets FROM (SELECT *, concat('- **', coalesce(author, '?'), '** (', left(created, 10), '): ', replace(text, chr(10), chr(10) || '  '), ' `c:', cid, '`') AS line,
      row_number() OVER (PARTITION BY cid ORDER BY delivery_no, pos) AS n FROM rows WHERE cid IS NOT NULL AND thread IS NOT NULL AND text IS NOT NULL) WHERE n = 1 GROUP BY 1""",
    "sections_parse": f"""WITH {_ROWS} SELECT thread, row_number() OVER (PARTITION BY thread ORDER BY delivery_no, pos) - 1 AS pos, coalesce(author, '?') AS who, left(created, 10) AS day, cid, {_KEY.format("text")} AS text
      FROM (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY delivery_no, pos) AS n FROM rows WHERE cid IS NOT NULL AND thread IS NOT NULL AND text IS NOT NULL) WHERE n = 1""",
    "harvest": f"""WITH {_ROWS} SELECT CASE WHEN anchor IS NULL OR author IS NULL THEN '(orphan)' ELSE anchor END AS anchor, count(*) AS comments, count(DISTINCT cid) AS ids, min(delivery_no) AS first_no FROM rows GROUP BY 1""",
    "anchor_text": """SELECT delivery_no, left(coalesce(nullif(trim(anchor), ''), nullif(trim(comments[1].text), ''), concat('(', entity_type, ')'), '(page-level)'), 90) AS anchor FROM webhook_captures""",
    "backfill_merge": f"""SELECT key, min(rank) AS rank FROM (SELECT {_KEY.format("c.text")} AS key, CASE WHEN captured_at = 'backfill' THEN 1 ELSE 0 END AS rank FROM (SELECT captured_at, unnest(comments) AS c FROM webhook_captures) WHERE c.text IS NOT NULL) GROUP BY 1""",
    "multi_home": f"""WITH {_ROWS} SELECT key, count(DISTINCT home) AS homes, arg_min(home, row(delivery_no, home)) AS owner FROM (SELECT *, {_KEY.format("text")} AS key FROM rows WHERE text IS NOT NULL) GROUP BY 1 HAVING count(DISTINCT home) > 1""",
    "misattribution_repair": f"""WITH {_ROWS}, k AS (SELECT *, {_KEY.format("text")} AS key FROM rows WHERE text IS NOT NULL), o AS (SELECT key, arg_min(home, row(delivery_no, home)) AS owner FROM k GROUP BY 1 HAVING count(DISTINCT home) > 1)
      SELECT delivery_no, pos, CASE WHEN home = owner THEN 'keep' ELSE 'drop' END AS fate FROM k JOIN o USING (key)""",
    "sticky_date": """SELECT user_id, strftime(min(ts), '%Y-%m-%d') AS missed_on FROM events LEFT JOIN (SELECT user_id, max(ts) AS ok FROM events WHERE event_type = 'purchase' GROUP BY 1) USING (user_id)
      WHERE event_type = 'error' AND (ok IS NULL OR ts > ok) GROUP BY 1""",
    "capped_list": f"""WITH {_ROWS}, f AS (SELECT thread, list_sort(list_distinct(list(cid))) AS ids, min(home) AS home FROM rows WHERE thread IS NOT NULL AND cid IS NOT NULL GROUP BY 1),
      s AS (SELECT *, CASE WHEN len(ids) < 3 THEN 'complete' WHEN home IN (SELECT {_ID.format("id")} FROM pages_metadata WHERE NOT coalesce(archived, false) AND id IS NOT NULL) THEN 'refetched' ELSE 'short' END AS state FROM f)
      SELECT thread, CAST(len(CASE state WHEN 'short' THEN ids[1:3] ELSE ids END) AS INT) AS n, array_to_string(CASE state WHEN 'short' THEN ids[1:3] ELSE ids END, ',') AS ids, state FROM s""",
}
