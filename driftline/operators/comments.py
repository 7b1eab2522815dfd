"""Comment histories: folding captured comments into an append-only store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.core.scan import SMALL_ROWS
from driftline.core.store import cut
from driftline.functions.keys import instant, norm_id
from driftline.functions.text import text_key
from driftline.operators.schedule import group_positions


def comment_rows(captures: DataFrame) -> DataFrame:
    """One row per comment of a delivery: delivery_no, pos, cid, home, thread, text, author, at (null unless a time), has_rich, resolved, created."""
    rows = captures.select("delivery_no", norm_id("page_id").alias("home"), instant("captured_at").alias("at"), "anchor", F.posexplode("comments").alias("pos", "c"))
    return rows.select(
        "delivery_no", "pos", "home", "at", "anchor", norm_id("c.id").alias("cid"), norm_id("c.discussion_id").alias("thread"), F.col("c.text").alias("text"),
        F.col("c.author_id").alias("author"), F.col("c.rich_text").isNotNull().alias("has_rich"), F.coalesce("c.resolved", F.lit(False)).alias("resolved"), F.col("c.created_time").alias("created"),
    )


def latest_by(rows: DataFrame, keys: list[str], order: list[Column], fields: list[str]) -> DataFrame:
    """The row of the greatest order (a total order within a key); nulls come first.  Map-side combination keeps one row a key and task."""
    rec = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)], F.struct(*fields).alias("v"))
    return rows.groupBy(*keys).agg(F.max(rec).alias("r")).select(*keys, *[F.col(f"r.v.{f}").alias(f) for f in fields])


def keep_first(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Rows without the later ones of a key; rows with a null key are all kept.

    The first position of each key is found by aggregation and joined back, so a hot key is never one task's window.
    """
    first = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*order)).alias("_first"))
    keyed = rows.join(first, key, "inner").filter(F.struct(*order) == F.col("_first")).select(*rows.columns)
    return keyed.unionByName(rows.filter(F.col(key).isNull()))


def capture_order(rows: DataFrame, scans: DataFrame) -> DataFrame:
    """Captures against the last full scan of their home: ``order`` is newer, older, no_scan or no_time.

    A time that cannot be read is older than any scan.
    """
    both = rows.join(scans, "home", "left")
    order = F.when(F.col("at").isNull(), "no_time").when(F.col("scan_at").isNull(), "no_scan").when(F.col("at") > F.col("scan_at"), "newer").otherwise("older")
    return both.withColumn("order", order)


def held_home(captures: DataFrame, stored: DataFrame) -> DataFrame:
    """cid, home: a comment has one home, the one it is stored at, else the first that a live capture names, else that of its first capture."""
    claim = home_of(captures, "cid", "home", F.when(F.col("at").isNull(), 1).otherwise(0), ["delivery_no", "pos"])
    kept = stored.filter("cid IS NOT NULL").groupBy("cid").agg(F.min("home").alias("kept"))
    return claim.join(kept, "cid", "left").select("cid", F.coalesce("kept", "home").alias("held"))


def fold_captures(
    stored: DataFrame, captures: DataFrame, scans: DataFrame, today: str, deletions: DataFrame | None = None, homes: DataFrame | None = None
) -> DataFrame:
    """Fold captured comments into the stored ones: cid, home, text, resolved_on.  Folding twice changes nothing.

    stored: cid, home, text, resolved_on; captures: as ``comment_rows``; scans: home, scan_at; deletions: cid, day;
    homes: home, those the mirror has (captures of others are held back; all are known if absent).
    Captures that name another home than the one that holds a comment are left out; of the rest the latest of
    an id counts.  A new id is appended: open if captured after the home's last scan (or there is none and the
    time is known), else resolved on the scan's day (today without a scan).  A stored open one takes a later
    text only from a capture newer than an existing scan that has rich text.  A stored one without an id takes
    the id of a capture with the same home and text, each one once, and is open again if the capture is newer;
    a capture without an id is appended only if its home holds no such text.  A deletion closes what is open.
    Everything else stays.
    """
    if homes is not None:
        captures = captures.join(homes.select("home").distinct(), "home", "left_semi")
    known = captures.filter("cid IS NOT NULL").join(held_home(captures, stored), "cid").filter("home = held")
    latest = latest_by(known, ["cid"], [F.col("at"), F.col("delivery_no"), F.col("pos")], ["home", "text", "at", "has_rich"])
    caps = capture_order(latest.withColumn("text_key", text_key("text")), scans)
    is_new = F.col("order").isin("newer", "no_scan")
    on_day = F.when(is_new, F.lit(None).cast("date")).otherwise(F.coalesce(F.to_date("scan_at"), F.lit(today).cast("date")))
    with_id, without = stored.filter("cid IS NOT NULL"), stored.filter("cid IS NULL").withColumn("text_key", text_key("text"))
    c = caps.select("cid", F.col("home").alias("c_home"), F.col("text").alias("c_text"), "text_key", "has_rich", "order", on_day.alias("c_day"))
    met = with_id.withColumn("_stored", F.lit(True)).join(c, "cid", "full_outer")
    takes = F.col("resolved_on").isNull() & (F.col("order") == "newer") & F.col("has_rich") & (F.col("c_text") != F.col("text"))
    kept = met.filter("_stored").select("cid", "home", F.when(takes, F.col("c_text")).otherwise(F.col("text")).alias("text"), "resolved_on")
    fresh = met.filter("_stored IS NULL").select("cid", F.col("c_home").alias("home"), F.col("c_text").alias("text"), "text_key", "order", "c_day")
    nth = Window.partitionBy("home", "text_key")
    fresh = fresh.withColumn("n", F.row_number().over(nth.orderBy("cid")))
    bare = without.withColumn("n", F.row_number().over(nth.orderBy(F.col("resolved_on").asc_nulls_first(), "text")))
    b = bare.select("home", "text_key", "n", F.col("text").alias("b_text"), F.col("resolved_on").alias("b_on"), F.lit(True).alias("twin"))
    paired = fresh.join(b, ["home", "text_key", "n"], "full_outer")
    # without a twin the capture is appended, without a capture the stored one stays; an older capture leaves the twin its mark
    day = F.when(F.col("cid").isNull(), F.col("b_on")).when(F.col("twin") & ~is_new, F.col("b_on")).otherwise(F.col("c_day"))
    appended = paired.select("cid", "home", F.coalesce("text", "b_text").alias("text"), day.alias("resolved_on"))
    nameless = captures.filter("cid IS NULL").withColumn("text_key", text_key("text"))
    nameless = capture_order(latest_by(nameless, ["home", "text_key"], [F.col("at"), F.col("delivery_no"), F.col("pos")], ["text", "at"]), scans)
    has = kept.unionByName(appended).select("home", text_key("text").alias("text_key")).distinct()
    extra = nameless.join(has, ["home", "text_key"], "left_anti").select(F.lit(None).cast("string").alias("cid"), "home", "text", on_day.alias("resolved_on"))
    out = kept.unionByName(appended).unionByName(extra)
    if deletions is not None:
        gone = deletions.groupBy("cid").agg(F.min("day").alias("day"))
        out = out.join(gone, "cid", "left").select("cid", "home", "text", F.coalesce("resolved_on", "day").alias("resolved_on"))
    return out


def append_only_merge(old: DataFrame, new: DataFrame, key: str, today: str) -> DataFrame:
    """key, resolved_on: nothing is ever dropped; what vanished gets today once, what is listed again loses its mark."""
    both = old.select(key, "resolved_on", F.lit(True).alias("_old")).join(new.select(key).distinct().withColumn("_new", F.lit(True)), key, "full_outer")
    return both.select(key, F.when(F.col("_new"), F.lit(None).cast("date")).otherwise(F.coalesce("resolved_on", F.lit(today).cast("date"))).alias("resolved_on"))


def union_missing(fresh: DataFrame, captured: DataFrame, key: str, today: str) -> DataFrame:
    """A fresh scan with the captured rows it lacks, those marked as resolved today."""
    lost = captured.join(fresh.select(key), key, "left_anti").withColumn("resolved_on", F.lit(today).cast("date"))
    return fresh.withColumn("resolved_on", F.lit(None).cast("date")).unionByName(lost)


def consuming_join(left: DataFrame, right: DataFrame, keys: list[str], left_order: list[str], right_order: list[str], columns: list[str]) -> DataFrame:
    """Pairs of the n-th left with the n-th right row of a key; each row is used once.  Null keys pair with nothing.

    Rows are numbered within their key by one distributed order (see schedule.group_positions), so a key with
    a third of all rows is no task's alone.
    """
    held = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    both = left.filter(held).select(*keys).distinct().join(right.filter(held).select(*keys).distinct(), keys)  # the others pair with nothing

    def ranked(df: DataFrame, order: list[str]) -> DataFrame:
        return group_positions(df.join(both, keys, "left_semi"), keys, order, "_r")

    return ranked(left, left_order).join(ranked(right, right_order).select(*keys, "_r", *columns), [*keys, "_r"]).drop("_r")


def still_live(old: DataFrame, fresh: DataFrame) -> DataFrame:
    """Stored rows (cid, text) that a fresh listing still has: by id where there is one, else by text."""
    by_id = old.filter("cid IS NOT NULL").join(fresh.filter("cid IS NOT NULL").select("cid"), "cid", "left_semi")
    key = old.filter("cid IS NULL").withColumn("_k", text_key("text"))
    by_text = key.join(fresh.select(text_key("text").alias("_k")), "_k", "left_semi").drop("_k")
    return by_id.unionByName(by_text.select(*by_id.columns))


def home_of(rows: DataFrame, key: str, home: str, priority: Column, order: list[str]) -> DataFrame:
    """One home per key: the one of the least (priority, order)."""
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(priority.alias("p"), *order, home)).getField(home).alias("home"))


def thread_states(stored: DataFrame, live: DataFrame, key: str) -> DataFrame:
    """key, state: absence from a complete listing is an event.  stored: key, open; live: key.

    kept (open and listed), resolved (open, no longer listed), reopened (resolved, listed again), closed, added.
    """
    both = stored.select(key, "open", F.lit(True).alias("_s")).join(live.select(key).distinct().withColumn("_l", F.lit(True)), key, "full_outer")
    listed = F.col("_l").isNotNull()
    state = (
        F.when(F.col("_s").isNull(), "added").when(F.col("open") & listed, "kept").when(F.col("open"), "resolved").when(listed, "reopened").otherwise("closed")
    )
    return both.select(key, state.alias("state"))


def bullet(text: Column, who: Column, day: Column, cid: Column, resolved: Column) -> Column:
    """A stored comment as one Markdown bullet: author, day, text with indented further lines, mark, id."""
    body = F.replace(text, F.lit("\n"), F.lit("\n  "))
    mark = F.when(resolved.isNotNull(), F.concat(F.lit(" (resolved "), F.date_format(resolved, "yyyy-MM-dd"), F.lit(")"))).otherwise("")
    trailer = F.when(cid.isNotNull(), F.concat(F.lit(" `c:"), cid, F.lit("`"))).otherwise("")
    return F.concat(F.lit("- **"), who, F.lit("** ("), day, F.lit("): "), body, mark, trailer)


def parse_bullets(sections: DataFrame, key: str, body: str) -> DataFrame:
    """key, pos, who, day, text, cid of the bullets of a section: a line that begins a bullet starts a record, others continue it."""
    parts = F.split(F.concat(F.lit("\n"), F.col(body)), r"\n- \*\*")
    rows = sections.select(key, F.posexplode(parts).alias("pos", "raw")).filter("pos > 0")
    got = lambda n: F.regexp_extract("raw", r"(?s)^(.*?)\*\* \(([^)]*)\): (.*?)(?: \(resolved [0-9-]{10}\))?(?: `c:([0-9a-f]+)`)?\n*$", n)
    return rows.select(key, (F.col("pos") - 1).alias("pos"), got(1).alias("who"), got(2).alias("day"), F.replace(got(3), F.lit("\n  "), F.lit("\n")).alias("text"), F.nullif(got(4), F.lit("")).alias("cid"))


def staged_join(left: DataFrame, right: DataFrame, levels: list[list[str]], left_order: list[str], right_order: list[str], left_key: list[str], right_key: list[str], columns: list[str]) -> DataFrame:
    """Consuming joins on one key after another: what finds no partner on the first is tried on the next.  Adds ``level`` (from 0).

    left_key, right_key: what names a row of either side, among ``left_order`` and ``columns``.
    """
    out = None
    for k, keys in enumerate(levels):
        got = cut(consuming_join(left, right, keys, left_order, right_order, columns).withColumn("level", F.lit(k)), "staged-join")
        out = got if out is None else out.unionByName(got, allowMissingColumns=True)
        left = left.join(got.select(*left_key), left_key, "left_anti")
        right = right.join(got.select(*right_key), right_key, "left_anti")
    return out


def stamp_ids(bullets: DataFrame, sources: DataFrame) -> DataFrame:
    """Bullets (delivery_no, pos, home, author, day, key) with the id and source they get: by author, day and text of their home, else by day and text; ``legacy`` where no source has one.

    sources: cid, src, rank (the smaller is asked first), home, author, day, key.  A source's id is used once.
    """
    levels = [["home", "author", "day", "key"], ["home", "day", "key"]]
    named = bullets.filter("author IS NOT NULL")
    got = staged_join(named, sources, levels[:1], ["delivery_no", "pos"], ["rank", "cid"], ["delivery_no", "pos"], ["cid"], ["cid", "src"])
    got = got.select("delivery_no", "pos", "cid", "src", "level")
    rest = bullets.join(got.select("delivery_no", "pos"), ["delivery_no", "pos"], "left_anti")
    free = sources.join(got.select("cid"), "cid", "left_anti")
    more = consuming_join(rest, free, levels[1], ["delivery_no", "pos"], ["rank", "cid"], ["cid", "src"]).select("delivery_no", "pos", "cid", "src", F.lit(1).alias("level"))
    stamped = bullets.join(got.unionByName(more), ["delivery_no", "pos"], "left")
    return stamped.select("delivery_no", "pos", "cid", F.coalesce("src", F.lit("legacy")).alias("src"), "level")


def id_tally(stamped: DataFrame) -> DataFrame:
    """src, bullets, share: how many ids came from each source."""
    n = stamped.groupBy("src").agg(F.count("*").alias("bullets"))
    return n.select("src", "bullets", (F.col("bullets") / F.sum("bullets").over(Window.partitionBy(F.lit(0)))).alias("share"))  # one row a source


def open_homes(stored: DataFrame) -> DataFrame:
    """home, open, open_legacy of the homes that hold an open comment, and whether one of them has no id."""
    is_open = F.col("resolved_on").isNull()
    n = stored.groupBy("home").agg(F.count_if(is_open).alias("open"), F.coalesce(F.max(is_open & F.col("cid").isNull()), F.lit(False)).alias("open_legacy"))
    return n.filter("open > 0")


def child_copies(rows: DataFrame, titles: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows (home, anchor, key columns cid, author, day, key) anchored on the title of another page that holds the same comment.

    The same comment has the same id or, where either has none, the same author, day and text.  Gives the distinct
    ``columns`` (all if absent).  Any number of pages may share a title, so rows and pages never meet by title alone:
    what is held is folded to the least and the greatest page of each title and comment, and if another page than
    the row's own holds it, one of these two is another.
    """
    columns = columns or rows.columns
    short = lambda c: F.substring(F.trim(c), 1, 90)
    named = titles.filter("trim(title) <> ''").select(F.col("home").alias("_child"), short("title").alias("_anchor"))
    at = rows.filter("trim(anchor) <> ''").withColumn("_anchor", short("anchor"))
    anchors = cut(named.select("_anchor").distinct(), "child-anchors")
    if anchors.count() <= SMALL_ROWS:  # only saves shuffling rows that no title can match
        at = at.join(F.broadcast(anchors), "_anchor", "left_semi")
    held = rows.select(F.col("home").alias("_child"), "cid", "author", "day", "key").join(named, "_child")
    ends = lambda c, n: [F.min(c).alias(f"_{n}_least"), F.max(c).alias(f"_{n}_most")]
    other = lambda n: (F.col(f"_{n}_least") != F.col("home")) | (F.col(f"_{n}_most") != F.col("home"))
    by_id, by_text = ["_anchor", "cid"], ["_anchor", "author", "day", "key"]
    ids = held.filter("cid IS NOT NULL").groupBy(*by_id).agg(*ends(F.col("_child"), "any"))
    bare = F.when(F.col("cid").isNull(), F.col("_child"))
    texts = held.filter("author IS NOT NULL AND day IS NOT NULL AND key IS NOT NULL").groupBy(*by_text).agg(*ends(F.col("_child"), "any"), *ends(bare, "bare"))
    same_id = at.filter("cid IS NOT NULL").join(ids, by_id).filter(other("any"))
    same_text = at.join(texts, by_text).filter(F.when(F.col("cid").isNull(), other("any")).otherwise(other("bare")))
    return same_id.select(*columns).unionByName(same_text.select(*columns)).distinct()


#: Words of a comment; links, addresses, mentions and the sign an older writer put for any mention stand for a mention.
_TOKENS = r"(\[[^\]]*\]\([^)]*\)|https?://\S+|@\S+|‣|[\p{L}\p{N}]+)"
_MENTION = r"^(\[|https?://|@|‣)"


def _worded(df: DataFrame, block: list[str], side: str) -> DataFrame:
    """Classes of a side: rows of a block that have the same words and anchor.  _head and _tail are the literal words before the first and after the last mention."""
    anchor = F.coalesce(F.lower(F.trim("anchor")), F.lit("")) if "anchor" in df.columns else F.lit("")
    words = F.transform(F.regexp_extract_all("text", F.lit(_TOKENS), F.lit(1)), lambda t: F.concat(F.when(t.rlike(_MENTION), F.lit("\x01")).otherwise(F.lower(t)), F.lit(" ")))
    rows = df.select(*block, "no", anchor.alias("anchor"), F.array_join(words, "").alias("words"), F.size(F.filter(words, lambda w: w != "\x01 ")).alias("literal"))
    rows = rows.filter("literal > 0") if side == "legacy" else rows
    classes = rows.groupBy(*block, "words", "literal", "anchor").agg(F.min("no").alias(f"{side}_class"))
    return rows.join(classes, [*block, "words", "literal", "anchor"])


def _covered(patterns: DataFrame, texts: DataFrame, block: list[str], out: list[str]) -> DataFrame:
    """Classes of texts whose words a pattern (words with mentions) reads as, each mention standing for up to four words.

    Both are brought together by the literal words before the first and after the last mention, so no
    block compares all with all; a text is looked up once for each length of these that its block has.
    """
    p = patterns.filter(F.col("words").contains("\x01"))
    rx = F.concat(F.lit("^\\Q"), F.replace("words", F.lit("\x01 "), F.lit("\\E(?:\\S+ ){0,4}\\Q")), F.lit("\\E$"))
    parts = F.split("words", "\x01 ")
    p = p.select(*block, out[0], rx.alias("_rx"), F.col("literal").alias("_lp"), F.col("anchor").alias("_ap"), parts[0].alias("_head"), F.element_at(parts, -1).alias("_tail"))
    lengths = p.select(F.length("_head").alias("_h"), F.length("_tail").alias("_t"), *block).distinct()
    t = texts.select(*block, out[1], F.col("words").alias("_w"), F.col("literal").alias("_lt"), F.col("anchor").alias("_at")).distinct().join(lengths, block)
    t = t.filter("length(_w) >= _h + _t").select("*", F.expr("left(_w, _h)").alias("_head"), F.expr("right(_w, _t)").alias("_tail")).drop("_h", "_t")
    return t.join(p.distinct(), [*block, "_head", "_tail"]).filter(F.regexp_like("_w", F.col("_rx"))).select(*out, "_lp", "_ap", "_lt", "_at")


def fuzzy_pairs(legacy: DataFrame, ided: DataFrame, block: list[str]) -> DataFrame:
    """Pairs (legacy_no, ided_no) of the same comment as two writers wrote it, one to one.

    legacy, ided: no (unique on its side), text, optionally anchor, and the columns of ``block``.  Two texts are the
    same if their words are, each mention or link of one standing for up to four words of the other.  Legacy
    texts of one or two words need an equal anchor.  Rows of equal words are classes: in rounds, the n-th free row
    of each legacy class takes the n-th free row of its smallest class that has one, of several that want a row
    the smallest gets it, until no row finds another.  So no partner stays free that a free row could take.
    """
    a, b = cut(_worded(legacy, block, "legacy"), "fuzzy-legacy"), cut(_worded(ided, block, "ided"), "fuzzy-ided")
    la = a.select(*block, "legacy_class", "words", "literal", "anchor").distinct()
    lb = b.select(*block, "ided_class", "words", "literal", "anchor").distinct()
    equal = la.alias("a").join(lb.alias("b"), [*block, "words"]).select("legacy_class", "ided_class", F.col("a.literal").alias("_l"), F.col("a.anchor").alias("_x"), F.col("b.anchor").alias("_y"))
    one = _covered(lb, la, block, ["ided_class", "legacy_class"]).select("legacy_class", "ided_class", F.col("_lt").alias("_l"), F.col("_at").alias("_x"), F.col("_ap").alias("_y"))
    two = _covered(la, lb, block, ["legacy_class", "ided_class"]).select("legacy_class", "ided_class", F.col("_lp").alias("_l"), F.col("_ap").alias("_x"), F.col("_at").alias("_y"))
    near = equal.unionByName(one).unionByName(two).filter("_l > 2 OR (_x <> '' AND _x = _y)")
    near = cut(near.select("legacy_class", "ided_class").distinct(), "fuzzy-classes")
    left, right, out = a.select("no", "legacy_class"), b.select("no", "ided_class"), None
    while True:
        # number the free rows of each class that has candidates at all
        have = near.join(right.select("ided_class").distinct(), "ided_class", "left_semi").groupBy("legacy_class").agg(F.min("ided_class").alias("ided_class"))
        l_rows = group_positions(left.join(have, "legacy_class").select("no", "legacy_class", "ided_class"), ["legacy_class"], ["no"])
        r_rows = group_positions(right.join(have.select("ided_class").distinct(), "ided_class", "left_semi"), ["ided_class"], ["no"])
        asked = l_rows.select(F.col("no").alias("legacy_no"), "ided_class", "rn").join(r_rows.select(F.col("no").alias("ided_no"), "ided_class", "rn"), ["ided_class", "rn"])
        got = cut(asked.groupBy("ided_no").agg(F.min("legacy_no").alias("legacy_no")), "fuzzy-round")
        if got.isEmpty():
            return out if out is not None else got.select("legacy_no", "ided_no")
        out = got.select("legacy_no", "ided_no") if out is None else cut(out.unionByName(got.select("legacy_no", "ided_no")), "fuzzy-pairs")
        left = cut(left.join(got.select(F.col("legacy_no").alias("no")), "no", "left_anti"), "fuzzy-left")
        right = cut(right.join(got.select(F.col("ided_no").alias("no")), "no", "left_anti"), "fuzzy-right")


def reconcile(rows: DataFrame, order: list[str], block: list[str]) -> DataFrame:
    """Stored comments (no, cid, text, ...) without repeats of an id (the first stays) and without id-less ones that are the same as an id-bearing one."""
    first = cut(keep_first(rows, "cid", order), "reconcile")
    more = ["anchor"] if "anchor" in rows.columns else []
    pairs = fuzzy_pairs(first.filter("cid IS NULL").select("no", "text", *more, *block), first.filter("cid IS NOT NULL").select("no", "text", *more, *block), block)
    return first.join(pairs.select(F.col("legacy_no").alias("no")), "no", "left_anti")


def thread_homes(rows: DataFrame) -> DataFrame:
    """thread, owner: the home of a thread, that of its first live capture, else of its first."""
    return home_of(rows.filter("thread IS NOT NULL"), "thread", "home", F.when(F.col("at").isNull(), 1).otherwise(0), ["delivery_no", "pos"]).withColumnRenamed("home", "owner")


def repair_homes(rows: DataFrame, owners: DataFrame) -> DataFrame:
    """Rows (cid, thread, home, ...) with ``owner`` and ``fate``: keep at home or without an owner, elsewhere drop if the owner holds the same id, else move there."""
    both = rows.join(owners, "thread", "left")
    held = rows.filter("cid IS NOT NULL").select(F.col("home").alias("owner"), "cid").distinct().withColumn("_held", F.lit(True))
    found = both.join(held, ["owner", "cid"], "left")
    fate = F.when(F.col("owner").isNull() | (F.col("owner") == F.col("home")), "keep").when(F.col("_held"), "drop").otherwise("move")
    return found.withColumn("fate", fate).drop("_held")
