"""Whole phases of a nightly run, put together from the operators, and the run that plays them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.core.tables import table
from driftline.functions import text as X
from driftline.functions.keys import norm_id
from driftline.operators import changes as C
from driftline.operators import comments as M
from driftline.operators import coverage as V
from driftline.plans import comments as PC
from driftline.plans import coverage as PV
from driftline.plans.changes import EARLIER, _pages, force_sql

_DIFF_FIELDS = ["title", "parent_id", "archived", "in_trash"]


def phase_tables(spark, d):
    """Sweep of all tables: what was added, changed and deleted in each; a table whose rows have no time is reported as faulty, and the others go on."""
    kept = ["parent_type", "parent_id", "last_edited_time", *[f for f in _DIFF_FIELDS if f != "parent_id"]]
    rows = lambda at: _pages(spark, d, at, kept).filter("parent_type = 'database_id'")
    diff = C.snapshot_diff(rows(EARLIER), rows(None), "page_id", _DIFF_FIELDS, "last_edited_time")
    home = rows(EARLIER).select("page_id", norm_id("parent_id").alias("was")).join(rows(None).select("page_id", norm_id("parent_id").alias("now"), F.col("last_edited_time").isNull().alias("untimed")), "page_id", "full_outer")
    per = diff.join(home, "page_id").groupBy(F.coalesce("now", "was").alias("db"))
    n = lambda k: F.count_if(F.col("change") == k)
    sums = per.agg(n("added").alias("added"), n("changed").alias("changed"), n("deleted").alias("deleted"), F.coalesce(F.max("untimed"), F.lit(False)).alias("faulty"))
    known = table(spark, d, "databases").select(norm_id("db_id").alias("db")).distinct().withColumn("_k", F.lit(True))
    return sums.join(known, "db", "left").select("db", "added", "changed", "deleted", F.when(F.col("_k").isNull(), "unknown").when(F.col("faulty"), "faulty").otherwise("ok").alias("state"))


def phase_content(spark, d):
    """Pages to be rendered anew, with the first reason: never fetched, edited since the last fetch, or commented since."""
    fetched = table(spark, d, "block_trees").groupBy(norm_id("page_id").alias("page_id")).agg(F.max("fetched_at").alias("at"))
    said = PC._rows(spark, d).filter("at IS NOT NULL").groupBy(F.col("home").alias("page_id")).agg(F.max("at").alias("said"))
    from driftline.functions.keys import instant

    pages = _pages(spark, d, None, ["parent_type", "in_trash", "last_edited_time"]).filter("parent_type <> 'database_id' AND NOT coalesce(in_trash, false)")
    both = pages.select("page_id", instant("last_edited_time").alias("edited")).join(fetched, "page_id", "left").join(said, "page_id", "left")
    why = F.when(F.col("at").isNull(), "new").when(F.col("edited") > F.col("at"), "edited").when(F.col("said") > F.col("at"), "commented")
    return both.select("page_id", why.alias("reason")).filter("reason IS NOT NULL")


def phase_discovery(spark, d):
    """Parents that are named and not mirrored, and what a first look says of each."""
    m = table(spark, d, "pages_metadata")
    named = m.filter("parent_id <> ''").groupBy(norm_id("parent_id").alias("key")).agg(F.count("*").alias("pages"), F.max(F.col("parent_type") == "database_id").alias("as_db"))
    live = table(spark, d, "databases").groupBy(norm_id("db_id").alias("key")).agg(F.max(F.col("deleted_at").isNull()).alias("live"))
    listed = table(spark, d, "blocks").filter("block_id IS NOT NULL").groupBy(norm_id("block_id").alias("key")).agg(F.max(F.col("block_type") == "child_database").alias("view"))
    pages = m.filter("id IS NOT NULL").select(norm_id("id").alias("key")).distinct().withColumn("page", F.lit(True))
    both = named.join(live, "key", "left").join(listed, "key", "left").join(pages, "key", "left")
    verdict = (
        F.when(F.col("live"), "captured").when(~F.col("live"), "deleted").when(F.col("page"), "page").when(F.col("view"), "not_a_db").when(F.col("as_db"), "db404").when(F.col("view").isNotNull(), "block").otherwise("no_access")
    )
    return both.groupBy(verdict.alias("verdict")).agg(F.count("*").alias("parents"), F.sum("pages").alias("pages"))


def phase_renames(spark, d):
    """Pages whose path is another one than before, because they or the page they lie in were renamed, or they moved."""

    def paths(at):
        p = _pages(spark, d, at, ["title", "parent_id"])
        up = p.select(F.col("page_id").alias("parent"), X.file_name("title").alias("folder"))
        own = p.select("page_id", norm_id("parent_id").alias("parent"), X.file_name("title").alias("name"))
        return own.join(up, "parent", "left").select("page_id", "parent", "name", "folder", F.concat_ws("/", "folder", "name").alias("path"))

    a, b = paths(EARLIER).alias("a"), paths(None).alias("b")
    both = a.join(b, F.col("a.page_id") == F.col("b.page_id")).filter(~F.col("a.path").eqNullSafe(F.col("b.path")))
    why = F.when(~F.col("a.parent").eqNullSafe(F.col("b.parent")), "moved").when(F.col("a.name") != F.col("b.name"), "renamed").otherwise("cascade")
    return both.select(F.col("b.page_id").alias("page_id"), why.alias("why"), F.col("b.path").alias("path"))


def phase_comments(spark, d):
    """Full comment sweep: the threads of each page against a complete listing of it."""
    early, late = PC._early(spark, d).filter("thread IS NOT NULL"), PC._late(spark, d).filter("thread IS NOT NULL")
    stored = early.groupBy("thread").agg((~F.max("resolved")).alias("open"))
    home = early.unionByName(late).groupBy("thread").agg(F.min("home").alias("home"))
    return M.thread_states(stored, late.select("thread"), "thread").join(home, "thread").groupBy("home", "state").agg(F.count("*").alias("threads"))


def phase_validate(spark, d):
    """Stored rows against what is there now, both ways: rows that only one side has, by side."""
    side = lambda at: _pages(spark, d, at, _DIFF_FIELDS).select("page_id", F.coalesce("title", F.lit("")).alias("title"), norm_id("parent_id").alias("parent"))
    return C.multiset_diff(side(EARLIER), side(None)).groupBy("side").agg(F.count("*").alias("rows"))


def phase_census(spark, d):
    """All of a coverage census in one table: references, absent and excluded ones and blind spots."""
    lines = PV._lines(spark, d)
    refs = V.references(lines)
    gone = V.absent(refs, PV._present(spark, d))
    left = gone.join(PV._excluded(spark, d), "ref", "left_anti")
    one = lambda df, name: df.groupBy(F.concat(F.lit(f"{name} "), F.col("kind")).alias("what")).agg(F.count("*").alias("lines"), F.countDistinct("ref").alias("ids"))
    blind = V.blind_spots(lines).select(F.concat(F.lit("blind "), F.col("spot")).alias("what"), "lines", F.lit(0).cast("bigint").alias("ids"))
    return one(refs, "referenced").unionByName(one(gone, "absent")).unionByName(one(left, "open")).unionByName(blind)


def bounded_walk(spark, d):
    """The first sixty pages of the closure of gaps, by distance and id: a walk with a budget that leaves out what is there."""
    lines = V.references(PV._lines(spark, d)).filter("kind = 'link_to_page'").select("page", "ref", "kind")
    first = lines.filter(F.col("page").rlike("^[0-3]")).select("ref", "kind")
    pages = table(spark, d, "pages_metadata").select(norm_id("id").alias("ref")).distinct().withColumn("kind", F.lit("page"))
    have = table(spark, d, "block_trees").select(norm_id("page_id").alias("id")).distinct().withColumn("kind", F.lit("page"))
    none = spark.createDataFrame([], "ref string")
    return V.close_gaps(first, lambda items: pages.join(items.select("ref"), "ref", "left_semi"), lambda got: lines.join(got.withColumnRenamed("ref", "page"), "page").select("ref", "kind"), have, none, 60)


PHASES = {f.__name__[6:]: f for f in (phase_tables, phase_content, phase_discovery, phase_renames, phase_comments, phase_validate, phase_census)}


def run_phases(spark: SparkSession, d: str, phases: dict[str, Callable[[SparkSession, str], DataFrame]]) -> DataFrame:
    """phase, rows, error: every phase in turn; one that fails is reported with what it said, and the next begins."""
    done = []
    for name, phase in phases.items():
        try:
            done.append((name, phase(spark, d).count(), None))
        except Exception as e:
            done.append((name, None, f"{type(e).__name__}: {e}".splitlines()[0][:200]))
    return spark.createDataFrame(done, "phase string, rows bigint, error string")


def nightly(spark, d):
    """A run of all phases."""
    return run_phases(spark, d, PHASES)


QUERIES = {f.__name__: f for f in (*(PHASES[k] for k in PHASES), bounded_walk, nightly)}

_ID = "lower(replace({}, '-', ''))"
_NAME = """coalesce(nullif(rtrim(left(regexp_replace(regexp_replace(regexp_replace(trim({0}), '[\\\\/:*?"<>|\\x00-\\x1f]', ' ', 'g'), '^[. ]+|[. ]+$', '', 'g'), ' +', ' ', 'g'), 150)), ''), 'untitled')"""
_CENSUS = f"""WITH {PV._LINES}, {PV._PRESENT}, gone AS (SELECT * FROM refs r WHERE NOT {PV._THERE}), ex AS (SELECT {_ID.format("id")} AS ref FROM pages_metadata WHERE archived AND id IS NOT NULL)
  SELECT 'referenced ' || kind AS what, count(*) AS lines, count(DISTINCT ref) AS ids FROM refs GROUP BY kind UNION ALL SELECT 'absent ' || kind, count(*), count(DISTINCT ref) FROM gone GROUP BY kind
  UNION ALL SELECT 'open ' || kind, count(*), count(DISTINCT ref) FROM gone WHERE ref NOT IN (SELECT ref FROM ex) GROUP BY kind
  UNION ALL SELECT 'blind ' || CASE k WHEN 'child_database' THEN 'idless_db' ELSE 'idless_page' END, count(*), 0 FROM lines WHERE k <> 'link_to_page' AND (way = 3 OR NOT regexp_full_match(id, '[0-9a-f]{{32}}')) AND id IS NOT NULL GROUP BY k"""
ORACLES = {
    "phase_tables": f"""WITH {force_sql("o1", EARLIER)}, {force_sql("n1")}, o AS (SELECT * FROM o1 WHERE parent_type = 'database_id'), n AS (SELECT * FROM n1 WHERE parent_type = 'database_id'),
      j AS (SELECT {_ID.format("coalesce(n.parent_id, o.parent_id)")} AS db, n.page_id IS NOT NULL AND n.last_edited_time IS NULL AS untimed, CASE WHEN n.page_id IS NULL THEN 'deleted' WHEN o.page_id IS NULL THEN 'added'
        WHEN o.title IS DISTINCT FROM n.title OR o.parent_id IS DISTINCT FROM n.parent_id OR o.archived IS DISTINCT FROM n.archived OR o.in_trash IS DISTINCT FROM n.in_trash OR o.last_edited_time <> n.last_edited_time THEN 'changed' ELSE 'same' END AS c
        FROM o FULL JOIN n ON o.page_id = n.page_id)
      SELECT db, count(*) FILTER (c = 'added') AS added, count(*) FILTER (c = 'changed') AS changed, count(*) FILTER (c = 'deleted') AS deleted,
        CASE WHEN db NOT IN (SELECT {_ID.format("db_id")} FROM databases) THEN 'unknown' WHEN bool_or(untimed) THEN 'faulty' ELSE 'ok' END AS state FROM j GROUP BY db""",
    "phase_content": f"""WITH {PC._ROWS}, {force_sql("n")}, s AS (SELECT home, max(seen) AS said FROM rows WHERE seen IS NOT NULL GROUP BY 1)
      SELECT page_id, CASE WHEN scan_at IS NULL THEN 'new' WHEN TRY_CAST(last_edited_time AS TIMESTAMPTZ) > scan_at THEN 'edited' ELSE 'commented' END AS reason FROM n LEFT JOIN scans ON scans.home = n.page_id LEFT JOIN s ON s.home = n.page_id
      WHERE parent_type <> 'database_id' AND NOT coalesce(in_trash, false) AND (scan_at IS NULL OR TRY_CAST(last_edited_time AS TIMESTAMPTZ) > scan_at OR said > scan_at)""",
    "phase_discovery": f"""WITH p AS (SELECT {_ID.format("parent_id")} AS key, count(*) AS pages, bool_or(parent_type = 'database_id') AS as_db FROM pages_metadata WHERE parent_id <> '' GROUP BY 1),
      l AS (SELECT {_ID.format("db_id")} AS key, bool_or(deleted_at IS NULL) AS live FROM databases GROUP BY 1), b AS (SELECT {_ID.format("block_id")} AS key, bool_or(block_type = 'child_database') AS view FROM blocks WHERE block_id IS NOT NULL GROUP BY 1),
      v AS (SELECT pages, CASE WHEN live THEN 'captured' WHEN NOT live THEN 'deleted' WHEN p.key IN (SELECT {_ID.format("id")} FROM pages_metadata WHERE id IS NOT NULL) THEN 'page' WHEN view THEN 'not_a_db' WHEN as_db THEN 'db404' WHEN view IS NOT NULL THEN 'block' ELSE 'no_access' END AS verdict
        FROM p LEFT JOIN l USING (key) LEFT JOIN b USING (key)) SELECT verdict, count(*) AS parents, CAST(sum(pages) AS BIGINT) AS pages FROM v GROUP BY 1""",
    "phase_renames": f"""WITH {force_sql("o", EARLIER)}, {force_sql("n")}, a AS (SELECT o.page_id, {_ID.format("o.parent_id")} AS parent, {_NAME.format("o.title")} AS name, CASE WHEN u.page_id IS NOT NULL THEN {_NAME.format("u.title")} END AS folder FROM o LEFT JOIN o u ON u.page_id = {_ID.format("o.parent_id")}),
      b AS (SELECT n.page_id, {_ID.format("n.parent_id")} AS parent, {_NAME.format("n.title")} AS name, CASE WHEN u.page_id IS NOT NULL THEN {_NAME.format("u.title")} END AS folder FROM n LEFT JOIN n u ON u.page_id = {_ID.format("n.parent_id")})
      SELECT page_id, CASE WHEN a.parent IS DISTINCT FROM b.parent THEN 'moved' WHEN a.name <> b.name THEN 'renamed' ELSE 'cascade' END AS why, concat_ws('/', b.folder, b.name) AS path FROM a JOIN b USING (page_id)
      WHERE concat_ws('/', a.folder, a.name) <> concat_ws('/', b.folder, b.name)""",
    "phase_comments": f"""WITH {PC._ROWS}, o AS (SELECT thread, NOT bool_or(resolved) AS open FROM early WHERE thread IS NOT NULL GROUP BY 1), n AS (SELECT DISTINCT thread FROM late WHERE thread IS NOT NULL),
      h AS (SELECT thread, min(home) AS home FROM (SELECT thread, home FROM early UNION ALL SELECT thread, home FROM late) WHERE thread IS NOT NULL GROUP BY 1),
      s AS (SELECT coalesce(o.thread, n.thread) AS thread, CASE WHEN o.thread IS NULL THEN 'added' WHEN open AND n.thread IS NOT NULL THEN 'kept' WHEN open THEN 'resolved' WHEN n.thread IS NOT NULL THEN 'reopened' ELSE 'closed' END AS state FROM o FULL JOIN n ON o.thread = n.thread)
      SELECT home, state, count(*) AS threads FROM s JOIN h USING (thread) GROUP BY ALL""",
    "phase_validate": f"""WITH {force_sql("o", EARLIER)}, {force_sql("n")}, a AS (SELECT page_id, coalesce(title, '') AS title, {_ID.format("parent_id")} AS parent FROM o), b AS (SELECT page_id, coalesce(title, '') AS title, {_ID.format("parent_id")} AS parent FROM n)
      SELECT * FROM (SELECT 'left' AS side, count(*) AS rows FROM (FROM a EXCEPT ALL FROM b) UNION ALL SELECT 'right', count(*) FROM (FROM b EXCEPT ALL FROM a)) WHERE rows > 0""",
    "phase_census": _CENSUS,
    "bounded_walk": f"""WITH RECURSIVE {PV._LINES}, l AS (SELECT page, ref FROM refs WHERE kind = 'link_to_page'), pg AS (SELECT DISTINCT {_ID.format("id")} AS id FROM pages_metadata), have AS (SELECT DISTINCT {_ID.format("page_id")} AS id FROM block_trees),
      r(ref, round) USING KEY (ref) AS (SELECT DISTINCT ref, 1 FROM l WHERE regexp_matches(page, '^[0-3]') AND ref NOT IN (SELECT id FROM have)
        UNION SELECT l.ref, min(r.round) + 1 FROM r JOIN pg ON pg.id = r.ref JOIN l ON l.page = r.ref WHERE l.ref NOT IN (SELECT id FROM have) AND NOT EXISTS (SELECT 1 FROM recurring.r AS x WHERE x.ref = l.ref) GROUP BY 1)
      SELECT ref, round, ref IN (SELECT id FROM pg) AS got FROM r ORDER BY round, ref LIMIT 60""",
}
ORACLES["nightly"] = " UNION ALL ".join(f"SELECT '{k}' AS phase, (SELECT count(*) FROM ({ORACLES[f'phase_{k}']})) AS rows, NULL AS error" for k in PHASES)
