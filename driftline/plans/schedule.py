"""Queries of queues and trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftline.core.store import work_dir
from driftline.core.tables import table
from driftline.functions.keys import micros, norm_id
from driftline.operators import schedule as S
from driftline.operators import tree as T
from driftline.operators.changes import positions
from driftline.plans.changes import EARLIER, _pages, force_sql
from driftline.streaming import fold


def _population(spark, d):
    scans = table(spark, d, "block_trees").groupBy(norm_id("page_id").alias("page_id")).agg(F.max("fetched_at").alias("last"))
    return _pages(spark, d, None, ["parent_type"]).filter("parent_type <> 'database_id'").select("page_id").join(scans, "page_id", "left")


def audit_share(spark, d):
    return S.oldest_share(_population(spark, d), "last", "page_id", 30).select("page_id", "pos")


def legacy_first(spark, d):
    c = table(spark, d, "webhook_captures").select(norm_id("page_id").alias("page_id"), F.explode("comments").alias("c")).filter("c.id IS NULL")
    pop = _population(spark, d).join(c.select("page_id").distinct().withColumn("legacy", F.lit(True)), "page_id", "left")
    return S.legacy_first(pop, F.col("legacy"), "last", "page_id", 20)


def queue_order(spark, d):
    items = table(spark, d, "blocks").filter("block_type IN ('child_database', 'child_page', 'link_to_page')").select(norm_id("block_id").alias("item"), "block_type").distinct()
    done = table(spark, d, "databases").select(norm_id("db_id").alias("item"))
    rank = F.when(F.col("block_type") == "child_database", 0).when(F.col("block_type") == "child_page", 1).otherwise(2)
    return positions(items.join(done, "item", "left_anti").withColumn("rank", rank), [F.col("rank"), F.col("item"), F.col("block_type")]).select("item", "block_type", "pos")


def top_n_more(spark, d):
    c = table(spark, d, "customer")
    return S.top_and_more(c, "c_nationkey", [F.col("c_acctbal").desc(), F.col("c_custkey")], 10).select("c_nationkey", "c_custkey", "rn", "more")


def batch_split(spark, d):
    b = table(spark, d, "blocks").select("page_id", "block_no")
    return S.group_positions(b, ["page_id"], ["block_no"]).select("block_no", F.floor((F.col("rn") - 1) / 90).alias("batch"))


def slice_sample(spark, d):
    """The first 50 pages to validate: commented ones first; what has a tree already is left out."""
    commented = table(spark, d, "webhook_captures").select(norm_id("page_id").alias("page_id")).distinct().withColumn("has", F.lit(1))
    p = _pages(spark, d, None, ["parent_type"]).select("page_id").join(commented, "page_id", "left")
    done = table(spark, d, "block_trees").select(norm_id("page_id").alias("page_id"))
    return p.join(done, "page_id", "left_anti").orderBy(F.coalesce("has", F.lit(0)).desc(), "page_id").limit(50).select("page_id", F.coalesce("has", F.lit(0)).alias("commented"))


def failure_streak(spark, d):
    e = table(spark, d, "events").select("user_id", "event_type", micros("ts").alias("us"))
    s = S.failures_since_success(e, ["user_id"], "us", F.col("event_type") == "purchase", F.col("event_type") == "error")
    return s.select("user_id", F.col("last_ok").alias("last_ok_us"), "failures")


def strikes(spark, d):
    e = table(spark, d, "events").select("user_id", "event_type", micros("ts").alias("us"))
    buy = e.filter("event_type = 'purchase'").groupBy("user_id").agg(F.min("us").alias("first_buy"))
    bad = e.filter("event_type = 'error'").join(buy, "user_id", "left").filter("first_buy IS NULL OR us < first_buy")
    return bad.groupBy("user_id").agg(F.count("*").alias("strikes")).filter("strikes >= 2")


def throttle(spark, d):
    """Errors that raise an alert when each silences its user for twelve hours, with those held back since the one before."""
    e = table(spark, d, "events").filter("event_type = 'error'").select(F.col("user_id").cast("string").alias("bucket"), micros("ts").alias("at_us"))
    sent = fold.throttled(spark, e, work_dir(spark, "throttle"), 43_200)
    return sent.select(F.col("bucket").cast("bigint").alias("user_id"), "sent_us", "suppressed")


def hourly_alerts(spark, d):
    """One alert a user and hour, and how many that stands for."""
    e = table(spark, d, "events").filter("event_type = 'error'").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    return S.throttle(e, ["user_id"], "ts").select("user_id", micros("sent_at").alias("sent_us"), "suppressed")


def head_of_line(spark, d):
    """What a tick does with each event of a log when errors of large value fail for good and others for now; an event was tried before as often as its value says."""
    e = table(spark, d, "events")
    outcome = F.when((F.col("event_type") == "error") & (F.col("value") >= 50), "permanent").when(F.col("event_type") == "error", "transient").otherwise("ok")
    tries = F.least(F.floor("value"), F.lit(9)).cast("int")
    return S.head_of_line(e.select("event_id", outcome.alias("outcome"), tries.alias("tries")), "event_id", 6).groupBy("outcome", "verdict").agg(F.count("*").alias("events"))


def drain_queue(spark, d):
    """Keys that a drain works off: the batch a crashed run left first, then the live queue, each key once; keys of pages the mirror lacks fail and are dropped."""
    w = table(spark, d, "webhook_captures").select(norm_id("page_id").alias("key"), "delivery_no", "batch_no")
    left = w.filter("batch_no < 100").select("key", F.col("delivery_no").alias("no"))
    live = w.filter("batch_no >= 100").select("key", F.col("delivery_no").alias("no"))
    known = table(spark, d, "pages_metadata").select(norm_id("id").alias("key"))
    return S.drain(left, live, known)


def lifecycle(spark, d):
    """The last event of each database, consumed once: a deletion seeds a strike, a creation a discovery."""
    dbs = table(spark, d, "databases")
    events = dbs.select(norm_id("db_id").alias("id"), F.explode(F.array(F.struct(micros("captured_at").alias("us"), F.lit("created").alias("event")), F.struct(micros("deleted_at").alias("us"), F.lit("deleted").alias("event")))).alias("e"))
    return S.last_events(events.select("id", "e.us", "e.event").filter("us IS NOT NULL"), "id", "us", "event")


def staleness(spark, d):
    e = table(spark, d, "events").select("user_id", "event_type", micros("ts").alias("us"))
    now = e.agg(F.max("us")).first()[0]  # null for an empty log, of which no one is stale
    last = e.filter("event_type = 'view'").groupBy("user_id").agg(F.max("us").alias("last_us"))
    return last.filter(F.lit(now).cast("bigint") - F.col("last_us") >= 6 * 3_600_000_000)


def audit_queue_dedup(spark, d):
    w = table(spark, d, "webhook_captures").select(norm_id("entity_id").alias("entity"), "delivery_no", "entity_type")
    return w.groupBy("entity").agg(F.min("delivery_no").alias("first_no"), F.count("*").alias("asked"))


def run_islands(spark, d):
    return S.islands(table(spark, d, "events").select("user_id", "event_type", micros("ts").alias("us"), "event_id"), "user_id", "event_type", "us", "event_id")


def outcome_islands(spark, d):
    """Runs of equal outcomes of the nightly runs."""
    return S.islands(table(spark, d, "sweep_runs").select(F.lit("nightly").alias("job"), "outcome", F.col("run_no").cast("bigint").alias("no"), "run_no"), "job", "outcome", "no", "run_no")


def _nodes(spark, d, at=None):
    p = _pages(spark, d, at, ["parent_type", "parent_id"])
    pages = p.select(F.col("page_id").alias("id"), F.nullif(norm_id("parent_id"), F.lit("")).alias("parent"))
    owner = table(spark, d, "blocks").filter("block_id IS NOT NULL").groupBy(norm_id("block_id").alias("id")).agg(F.min(norm_id("page_id")).alias("parent"))
    return pages.unionByName(owner.join(pages.select("id"), "id", "left_anti"))


def ancestor_climb(spark, d):
    return T.climb(_nodes(spark, d), table(spark, d, "databases").select(norm_id("db_id").alias("id")), 5)


def retry_unplaced(spark, d):
    """What found no table when only the earlier records were known and finds one now."""
    goal = table(spark, d, "databases").select(norm_id("db_id").alias("id"))
    before = T.climb(_nodes(spark, d, EARLIER), goal, 5).filter("ancestor IS NULL").select("id")
    return before.join(T.climb(_nodes(spark, d), goal, 5).filter("ancestor IS NOT NULL"), "id").select("id", "ancestor")


def _blocks(spark, d):
    b = table(spark, d, "blocks").filter("block_id IS NOT NULL").select("page_id", norm_id("block_id").alias("id"), norm_id("parent_id").alias("parent"), "pos", "block_no")
    return b.groupBy("page_id", "id").agg(F.min(F.struct("block_no", "parent", "pos")).alias("f")).select("page_id", "id", "f.parent", "f.pos")


def tree_order(spark, d):
    """Blocks in depth-first order of their page; any position, also a negative one, keeps its order as text."""
    pos = F.lpad((F.coalesce(F.col("pos"), F.lit(0)).cast("bigint") + F.lit(2**31)).cast("string"), 10, "0")
    return T.tree_paths(_blocks(spark, d), ["page_id"], F.concat_ws(".", pos, F.col("id"))).select("page_id", "id", "level", "path")


def ownership(spark, d):
    """Blocks whose chain of parents ends at the top of their page (owned) or at a block the page lacks (foreign)."""
    owned = tree_order(spark, d).select("page_id", "id", F.lit(True).alias("owned"))
    return _blocks(spark, d).select("page_id", "id").join(owned, ["page_id", "id"], "left").groupBy(F.coalesce("owned", F.lit(False)).alias("owned")).agg(F.count("*").alias("blocks"))


def nesting_depth(spark, d):
    return tree_order(spark, d).groupBy("page_id").agg(F.max("level").alias("depth"), F.count("*").alias("blocks"))


def reference_closure(spark, d):
    p = _pages(spark, d, None, ["parent_type", "parent_id"])
    edges = p.select(norm_id("parent_id").alias("src"), F.col("page_id").alias("dst"))
    b = table(spark, d, "blocks").filter("block_type = 'link_to_page'").select(norm_id("page_id").alias("src"), norm_id(F.get_json_object("payload", "$.page_id")).alias("dst"))
    start = p.filter("parent_type = 'workspace'").select(F.col("page_id").alias("id"))
    return T.reachable(edges.unionByName(b), start)


def tree_overview(spark, d):
    """Counts per kind of parent and parent, the 20 largest of each kind."""
    n = _pages(spark, d, None, ["parent_type", "parent_id"]).groupBy("parent_type", norm_id("parent_id").alias("parent")).agg(F.count("*").alias("pages"))
    return S.top_and_more(n, "parent_type", [F.col("pages").desc(), F.col("parent")], 20).select("parent_type", "parent", "pages", "rn", "more")


QUERIES = {
    f.__name__: f
    for f in (
        audit_share, legacy_first, queue_order, top_n_more, batch_split, slice_sample, failure_streak, strikes, throttle, staleness, hourly_alerts, head_of_line, drain_queue, lifecycle, audit_queue_dedup, run_islands, outcome_islands,
        ancestor_climb, retry_unplaced, tree_order, ownership, nesting_depth, reference_closure, tree_overview,
    )
}

_ID = "lower(replace({}, '-', ''))"
_POP = f"""{force_sql("n")}, scans AS (SELECT {_ID.format("page_id")} AS page_id, max(fetched_at) AS last FROM block_trees GROUP BY 1),
  pop AS (SELECT n.page_id, last FROM n LEFT JOIN scans USING (page_id) WHERE parent_type <> 'database_id')"""


def _nodes_sql(name: str, at: str | None = None) -> str:
    return f"""{force_sql(name + "f", at)}, {name}p AS (SELECT page_id AS id, nullif({_ID.format("parent_id")}, '') AS parent FROM {name}f),
  {name} AS (SELECT * FROM {name}p UNION ALL SELECT {_ID.format("block_id")}, min({_ID.format("page_id")}) FROM blocks WHERE block_id IS NOT NULL AND {_ID.format("block_id")} NOT IN (SELECT id FROM {name}p) GROUP BY 1)"""


def _climb_sql(name: str) -> str:
    return f"""{name}c AS (SELECT id, parent AS node, 1 AS steps FROM {name} UNION ALL SELECT c.id, u.parent, steps + 1 FROM {name}c c JOIN {name} u ON u.id = c.node
  WHERE steps < 5 AND c.node NOT IN (SELECT id FROM goal)), {name}r AS (SELECT a.id, c.node AS ancestor, c.steps FROM {name} a LEFT JOIN {name}c c ON c.id = a.id AND c.node IN (SELECT id FROM goal))"""


_GOAL = f"goal AS (SELECT DISTINCT {_ID.format('db_id')} AS id FROM databases)"
_TREE = f"""b AS (SELECT page_id, id, f.parent, f.pos FROM (SELECT page_id, {_ID.format("block_id")} AS id, arg_min({{'parent': {_ID.format("parent_id")}, 'pos': pos}}, block_no) AS f FROM blocks WHERE block_id IS NOT NULL GROUP BY 1, 2)),
  o AS (SELECT *, concat(lpad(CAST(coalesce(CAST(pos AS BIGINT), 0) + 2147483648 AS VARCHAR), 10, '0'), '.', id) AS k FROM b),
  t AS (SELECT page_id, id, 0 AS level, k AS path FROM o WHERE parent IS NULL UNION ALL SELECT o.page_id, o.id, level + 1, t.path || '/' || o.k FROM t JOIN o ON o.page_id = t.page_id AND o.parent = t.id)"""
ORACLES = {
    "audit_share": f"""WITH {_POP} SELECT page_id, pos FROM (SELECT page_id, row_number() OVER (ORDER BY last NULLS FIRST, page_id) - 1 AS pos, count(*) OVER () AS n FROM pop) WHERE pos < ceil(n / 30.0)""",
    "legacy_first": f"""WITH {_POP}, l AS (SELECT page_id FROM pop WHERE page_id IN (SELECT {_ID.format("page_id")} FROM (SELECT page_id, unnest(comments) AS c FROM webhook_captures) WHERE c.id IS NULL) ORDER BY page_id LIMIT 20)
      SELECT page_id, 0 AS turn FROM l UNION ALL SELECT page_id, 1 FROM (SELECT page_id, row_number() OVER (ORDER BY last NULLS FIRST, page_id) AS r, count(*) OVER () AS n FROM pop WHERE page_id NOT IN (SELECT page_id FROM l)) WHERE r <= ceil(n / 30.0)""",
    "queue_order": f"""SELECT item, block_type, row_number() OVER (ORDER BY CASE block_type WHEN 'child_database' THEN 0 WHEN 'child_page' THEN 1 ELSE 2 END, item, block_type) - 1 AS pos FROM (
      SELECT DISTINCT {_ID.format("block_id")} AS item, block_type FROM blocks WHERE block_type IN ('child_database', 'child_page', 'link_to_page')) WHERE item NOT IN (SELECT {_ID.format("db_id")} FROM databases)""",
    "top_n_more": """SELECT c_nationkey, c_custkey, rn, greatest(n - 10, 0) AS more FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rn, count(*) OVER (PARTITION BY c_nationkey) AS n FROM customer) WHERE rn <= 10""",
    "batch_split": "SELECT block_no, (row_number() OVER (PARTITION BY page_id ORDER BY block_no) - 1) // 90 AS batch FROM blocks",
    "slice_sample": f"""WITH {force_sql("n")} SELECT page_id, CASE WHEN page_id IN (SELECT {_ID.format("page_id")} FROM webhook_captures) THEN 1 ELSE 0 END AS commented FROM n WHERE page_id NOT IN (SELECT {_ID.format("page_id")} FROM block_trees)
      ORDER BY commented DESC, page_id LIMIT 50""",
    "failure_streak": """WITH g AS (SELECT user_id, max(epoch_us(ts)) FILTER (event_type = 'purchase') AS last_ok_us FROM events GROUP BY 1)
      SELECT user_id, last_ok_us, (SELECT count(*) FROM events e WHERE e.user_id = g.user_id AND event_type = 'error' AND (last_ok_us IS NULL OR epoch_us(ts) > last_ok_us)) AS failures FROM g""",
    "strikes": """SELECT user_id, count(*) AS strikes FROM events LEFT JOIN (SELECT user_id, min(ts) AS b FROM events WHERE event_type = 'purchase' GROUP BY 1) USING (user_id) WHERE event_type = 'error' AND (b IS NULL OR ts < b) GROUP BY 1 HAVING count(*) >= 2""",
    "throttle": """WITH RECURSIVE e AS (SELECT user_id, epoch_us(ts) AS us FROM events WHERE event_type = 'error'), nxt AS (SELECT a.user_id, a.us, min(b.us) AS then_us FROM (SELECT DISTINCT user_id, us FROM e) a JOIN e b ON b.user_id = a.user_id AND b.us >= a.us + 43200000000 GROUP BY 1, 2),
      s AS (SELECT user_id, min(us) AS us FROM e GROUP BY 1 UNION ALL SELECT nxt.user_id, then_us FROM s JOIN nxt ON nxt.user_id = s.user_id AND nxt.us = s.us),
      o AS (SELECT user_id, us, lag(us) OVER (PARTITION BY user_id ORDER BY us) AS before FROM s)
      SELECT user_id, us AS sent_us, (SELECT count(*) FROM e WHERE e.user_id = o.user_id AND e.us > o.before AND e.us < o.us) AS suppressed FROM o""",
    "hourly_alerts": "SELECT user_id, epoch_us(min(ts)) AS sent_us, count(*) - 1 AS suppressed FROM events WHERE event_type = 'error' GROUP BY user_id, date_trunc('hour', ts)",
    "head_of_line": """WITH e AS (SELECT event_id, CASE WHEN event_type = 'error' AND value >= 50 THEN 'permanent' WHEN event_type = 'error' THEN 'transient' ELSE 'ok' END AS outcome, least(CAST(floor(value) AS INT), 9) AS tries FROM events),
      h AS (SELECT min(event_id) AS at FROM e WHERE outcome = 'transient' AND tries + 1 < 6)
      SELECT outcome, CASE WHEN event_id > h.at THEN 'waiting' WHEN event_id = h.at THEN 'held' WHEN outcome = 'ok' THEN 'done' WHEN outcome = 'permanent' THEN 'skipped' ELSE 'abandoned' END AS verdict, count(*) AS events FROM e, h GROUP BY ALL""",
    "drain_queue": f"""WITH w AS (SELECT {_ID.format("page_id")} AS key, delivery_no, batch_no FROM webhook_captures), f AS (SELECT key, min(row(CASE WHEN batch_no < 100 THEN 0 ELSE 1 END, delivery_no)) AS o, count(*) AS asked FROM w GROUP BY 1)
      SELECT key, row_number() OVER (ORDER BY o) - 1 AS turn, asked, CASE WHEN key IN (SELECT {_ID.format("id")} FROM pages_metadata) THEN 'done' ELSE 'dropped' END AS outcome FROM f WHERE key IS NOT NULL""",
    "lifecycle": f"""SELECT {_ID.format("db_id")} AS id, CASE WHEN deleted_at IS NOT NULL AND (captured_at IS NULL OR deleted_at >= captured_at) THEN 'deleted' ELSE 'created' END AS event, CASE WHEN deleted_at IS NOT NULL AND (captured_at IS NULL OR deleted_at >= captured_at) THEN 'strike' ELSE 'discovery' END AS seeds
      FROM databases WHERE captured_at IS NOT NULL OR deleted_at IS NOT NULL""",
    "staleness": "SELECT user_id, epoch_us(max(ts)) AS last_us FROM events WHERE event_type = 'view' GROUP BY 1 HAVING (SELECT max(ts) FROM events) - max(ts) >= INTERVAL 6 HOUR",
    "audit_queue_dedup": f"SELECT {_ID.format('entity_id')} AS entity, min(delivery_no) AS first_no, count(*) AS asked FROM webhook_captures GROUP BY 1",
    "run_islands": """SELECT user_id, event_type, island, count(*) AS n FROM (SELECT *, CAST(sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS island FROM (SELECT *, CASE WHEN lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) = event_type THEN 0 ELSE 1 END AS s FROM events)) GROUP BY ALL""",
    "outcome_islands": """SELECT 'nightly' AS job, outcome, island, count(*) AS n FROM (SELECT *, CAST(sum(s) OVER (ORDER BY run_no) AS BIGINT) AS island FROM (SELECT *, CASE WHEN lag(outcome) OVER (ORDER BY run_no) = outcome THEN 0 ELSE 1 END AS s FROM sweep_runs)) GROUP BY ALL""",
    "ancestor_climb": f"WITH RECURSIVE {_GOAL}, {_nodes_sql('n')}, {_climb_sql('n')} SELECT * FROM nr",
    "retry_unplaced": f"""WITH RECURSIVE {_GOAL}, {_nodes_sql("n")}, {_climb_sql("n")}, {_nodes_sql("m", EARLIER)}, {_climb_sql("m")}
      SELECT nr.id, nr.ancestor FROM nr JOIN mr ON mr.id = nr.id WHERE mr.ancestor IS NULL AND nr.ancestor IS NOT NULL""",
    "tree_order": f"WITH RECURSIVE {_TREE} SELECT * FROM t",
    "ownership": f"WITH RECURSIVE {_TREE} SELECT EXISTS (SELECT 1 FROM t WHERE t.page_id = b.page_id AND t.id = b.id) AS owned, count(*) AS blocks FROM b GROUP BY 1",
    "nesting_depth": f"WITH RECURSIVE {_TREE} SELECT page_id, max(level) AS depth, count(*) AS blocks FROM t GROUP BY 1",
    "reference_closure": f"""WITH RECURSIVE {force_sql("n")}, e AS (SELECT {_ID.format("parent_id")} AS src, page_id AS dst FROM n UNION SELECT {_ID.format("page_id")}, {_ID.format("json_extract_string(payload, '$.page_id')")} FROM blocks WHERE block_type = 'link_to_page'),
      r(id, level) USING KEY (id) AS (SELECT page_id, 0 FROM n WHERE parent_type = 'workspace' UNION SELECT e.dst, min(r.level) + 1 FROM r JOIN e ON e.src = r.id
        WHERE e.dst IS NOT NULL AND NOT EXISTS (SELECT 1 FROM recurring.r AS x WHERE x.id = e.dst) GROUP BY 1) SELECT id, level FROM r""",
    "tree_overview": f"""WITH {force_sql("n")}, c AS (SELECT parent_type, {_ID.format("parent_id")} AS parent, count(*) AS pages FROM n GROUP BY ALL)
      SELECT parent_type, parent, pages, rn, greatest(k - 20, 0) AS more FROM (SELECT *, row_number() OVER (PARTITION BY parent_type ORDER BY pages DESC, parent) AS rn, count(*) OVER (PARTITION BY parent_type) AS k FROM c) WHERE rn <= 20""",
}
