import datetime as dt
import random

from driftline.operators import comments as M

STORED = "cid string, home string, text string, resolved_on date"
CAPS = "delivery_no bigint, pos int, home string, at timestamp, anchor string, cid string, thread string, text string, author string, has_rich boolean, resolved boolean, created string"
SCAN, BEFORE, AFTER, TODAY = dt.datetime(2026, 9, 10), dt.datetime(2026, 9, 5), dt.datetime(2026, 9, 20), "2026-09-24"


def cap(no, cid, text, at, home="h", rich=True):
    return (no, 0, home, at, None, cid, "t", text, "u", rich, False, None)


def fold(spark, stored, caps, scans=(("h", SCAN),), deletions=None):
    s = spark.createDataFrame(stored, STORED)
    c = spark.createDataFrame(caps, CAPS)
    k = spark.createDataFrame(list(scans), "home string, scan_at timestamp")
    d = None if deletions is None else spark.createDataFrame(deletions, "cid string, day date")
    once = M.fold_captures(s, c, k, TODAY, d)
    rows = sorted(map(tuple, once.collect()), key=str)
    twice = sorted(map(tuple, M.fold_captures(spark.createDataFrame(once.collect(), STORED) if rows else s, c, k, TODAY, d).collect()), key=str)
    assert rows == twice, "folding twice changes nothing"
    return rows


def test_new_comments_by_time_of_capture(spark):
    caps = [cap(1, "a", "x", AFTER), cap(2, "b", "y", BEFORE), cap(3, "c", "z", None), cap(4, "d", "w", AFTER, "other"), cap(5, "e", "v", None, "other")]
    day, today = dt.date(2026, 9, 10), dt.date(2026, 9, 24)
    assert fold(spark, [], caps) == sorted([("a", "h", "x", None), ("b", "h", "y", day), ("c", "h", "z", day), ("d", "other", "w", None), ("e", "other", "v", today)], key=str)


def test_stored_comments_are_replaced_only_by_newer_rich_ones(spark):
    done = dt.date(2026, 1, 1)
    stored = [("a", "h", "old", None), ("b", "h", "old", None), ("c", "h", "old", None), ("d", "h", "old", done), ("e", "o", "old", None)]
    caps = [cap(1, "a", "new", AFTER), cap(2, "b", "new", BEFORE), cap(3, "c", "new", AFTER, rich=False), cap(4, "d", "new", AFTER), cap(5, "e", "new", AFTER, "o")]
    got = {r[0]: r[2:] for r in fold(spark, stored, caps)}
    assert got == {"a": ("new", None), "b": ("old", None), "c": ("old", None), "d": ("old", done), "e": ("old", None)}


def test_twins_without_id_and_deletions(spark):
    done = dt.date(2026, 1, 1)
    stored = [(None, "h", "same  text", done), (None, "h", "alone", None)]
    caps = [cap(1, "a", "same text", AFTER), cap(2, None, "alone", AFTER), cap(3, None, "nowhere", AFTER)]
    got = fold(spark, stored, caps, deletions=[("a", dt.date(2026, 9, 1)), ("z", dt.date(2026, 9, 1))])
    # a newer capture opens its twin again; the deletion closes it on its own day
    assert got == sorted([("a", "h", "same text", dt.date(2026, 9, 1)), (None, "h", "alone", None), (None, "h", "nowhere", None)], key=str)
    gone = fold(spark, [("a", "h", "t", None)], [cap(1, "a", "t", AFTER)], deletions=[("a", dt.date(2026, 9, 2)), ("a", dt.date(2026, 9, 1))])
    assert gone == [("a", "h", "t", dt.date(2026, 9, 1))]


def test_latest_capture_counts_whatever_the_order_of_receipt(spark):
    assert fold(spark, [], [cap(9, "a", "first", BEFORE), cap(1, "a", "last", AFTER)]) == [("a", "h", "last", None)]
    assert fold(spark, [], []) == []


def test_append_only_merge(spark):
    old = spark.createDataFrame([("a", None), ("b", dt.date(2026, 1, 1)), ("c", dt.date(2026, 1, 2))], "k string, resolved_on date")
    new = spark.createDataFrame([("c",), ("d",), ("d",)], "k string")
    got = {r.k: r.resolved_on for r in M.append_only_merge(old, new, "k", TODAY).collect()}
    assert got == {"a": dt.date(2026, 9, 24), "b": dt.date(2026, 1, 1), "c": None, "d": None}


def test_keep_first_keeps_all_without_key(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), (None, 3), (None, 3), ("b", 4)], "k string, n int")
    assert sorted((r.k or "", r.n) for r in M.keep_first(df, "k", ["n"]).collect()) == [("", 3), ("", 3), ("a", 1), ("b", 4)]


def test_consuming_join_uses_each_row_once(spark):
    a = spark.createDataFrame([("t", 1), ("t", 2), ("t", 3), ("u", 4)], "k string, n int")
    b = spark.createDataFrame([("t", "x"), ("t", "y"), ("v", "z")], "k string, c string")
    assert sorted((r.n, r.c) for r in M.consuming_join(a, b, ["k"], ["n"], ["c"], ["c"]).collect()) == [(1, "x"), (2, "y")]


def test_fuzzy_pairs_match_mentions_of_up_to_four_words(spark):
    ddl = "who string, no int, text string, anchor string"
    legacy = spark.createDataFrame([("u", 1, "thanks Ann B. Lee for it", None), ("u", 2, "thanks for it", None), ("u", 3, "Thanks, Ann Lee for it", None), ("w", 4, "thanks Ann Lee for it", None), ("u", 9, "hi a b c d e bye", None), ("u", 5, "see [doc](http://x) now please", "A")], ddl)
    ided = spark.createDataFrame([("u", 10, "thanks @Ann for it", None), ("u", 11, "hi @Bo bye", None), ("w", 12, "other @Ann text", None), ("u", 13, "see The Doc now please", "B")], ddl)
    # one partner, so the smallest legacy row gets it; a link of the older text stands for words of the newer
    assert {(r.legacy_no, r.ided_no) for r in M.fuzzy_pairs(legacy, ided, ["who"]).collect()} == {(1, 10), (5, 13)}


def test_fuzzy_pairs_are_one_to_one_and_leave_no_free_partner(spark):
    ddl = "who string, no int, text string, anchor string"
    legacy = spark.createDataFrame([("u", k, "we met Ann Lee today", None) for k in (1, 2, 3)] + [("u", 4, "we met Bo today", None), ("u", 7, "done", "Plan"), ("u", 8, "done", "Other"), ("u", 9, "done", None)], ddl)
    ided = spark.createDataFrame([("u", k, "we met @Ann today", None) for k in (10, 11)] + [("u", 12, "We met @Bo today!", None), ("u", 13, "we met Ann Lee today", None), ("u", 20, "done", " plan "), ("u", 21, "done", None)], ddl)
    got = {(r.legacy_no, r.ided_no) for r in M.fuzzy_pairs(legacy, ided, ["who"]).collect()}
    # row 4 could have had 12, which 3 as the smaller got; 13 is free, but its words are not those of 4
    assert got == {(1, 10), (2, 11), (3, 12), (7, 20)}
    assert M.fuzzy_pairs(legacy.limit(0), ided, ["who"]).count() == 0


def test_fold_truth_table(spark):
    day = lambda d: dt.date(2026, 9, d)
    at = lambda d: dt.datetime(2026, 9, d)
    store = spark.createDataFrame(
        [("same", "h", "old", None), ("edit", "h", "old", None), ("plain", "h", "old", None), ("shut", "h", "old", day(1)), ("late", "h", "old", None), ("noscan", "g", "old", None), ("far", "h", "old", None),
         (None, "h", "twin new", day(2)), (None, "h", "twin old", day(3)), (None, "h", "lone", None), ("del", "h", "x", None), ("del2", "h", "x", day(4)), (None, "h", "spoken", None)],
        "cid string, home string, text string, resolved_on date",
    )
    row = lambda no, cid, home, text, t, rich=True: (no, 0, home, t, None, cid, None, text, "a", rich, False, "2026-09-01")
    caps = spark.createDataFrame(
        [row(1, "same", "h", "old", at(20)), row(2, "edit", "h", "new", at(20)), row(3, "plain", "h", "new", at(20), False), row(4, "shut", "h", "new", at(20)), row(5, "late", "h", "new", at(5)),
         row(6, "noscan", "g", "new", at(20)), row(7, "far", "g", "new", at(20)), row(8, "a1", "h", "fresh", at(20)), row(9, "a2", "h", "fresh", at(5)), row(10, "a3", "h", "fresh", None), row(11, "a4", "g", "fresh", at(1)),
         row(12, "a5", "g", "fresh", None), row(13, "t1", "h", "twin new", at(20)), row(14, "t2", "h", "twin old", at(5)), row(15, None, "h", "spoken", at(20)), row(16, None, "h", "unspoken", at(20)), row(17, "out", "nowhere", "x", at(20)),
         row(18, "two", "g", "x", None), row(19, "two", "h", "x", at(20))],
        "delivery_no bigint, pos int, home string, at timestamp, anchor string, cid string, thread string, text string, author string, has_rich boolean, resolved boolean, created string",
    )
    scans = spark.createDataFrame([("h", at(10))], "home string, scan_at timestamp")
    gone = spark.createDataFrame([("del", day(12)), ("del2", day(12))], "cid string, day date")
    homes = spark.createDataFrame([("h",), ("g",)], "home string")
    out = M.fold_captures(store, caps, scans, "2026-09-24", gone, homes)
    got = {(r.cid, r.home, r.text): r.resolved_on for r in out.collect()}
    assert got == {
        ("same", "h", "old"): None, ("edit", "h", "new"): None, ("plain", "h", "old"): None, ("shut", "h", "old"): day(1), ("late", "h", "old"): None, ("noscan", "g", "old"): None, ("far", "h", "old"): None,
        ("a1", "h", "fresh"): None, ("a2", "h", "fresh"): day(10), ("a3", "h", "fresh"): day(10), ("a4", "g", "fresh"): None, ("a5", "g", "fresh"): day(24), ("t1", "h", "twin new"): None, ("t2", "h", "twin old"): day(3),
        (None, "h", "lone"): None, ("del", "h", "x"): day(12), ("del2", "h", "x"): day(4), (None, "h", "spoken"): None, (None, "h", "unspoken"): None, ("two", "h", "x"): None,
    }
    again = M.fold_captures(out, caps, scans, "2026-09-25", gone, homes)
    assert sorted(map(str, again.collect())) == sorted(map(str, out.collect()))


def test_ids_come_from_sources_once_each(spark):
    b = spark.createDataFrame([(1, 0, "h", "Ann", "d", "k"), (2, 0, "h", None, "d", "k"), (3, 0, "h", "Ann", "d", "k"), (4, 0, "h", "Bo", "e", "z"), (5, 0, "g", "Ann", "d", "k")], "delivery_no bigint, pos int, home string, author string, day string, key string")
    s = spark.createDataFrame([("c1", "capture", 0, "h", "Ann", "d", "k"), ("c2", "backfill", 1, "h", "Ann", "d", "k"), ("c3", "capture", 0, "h", "Cy", "d", "k")], "cid string, src string, rank int, home string, author string, day string, key string")
    got = {r.delivery_no: (r.cid, r.src, r.level) for r in M.stamp_ids(b, s).collect()}
    assert got == {1: ("c1", "capture", 0), 3: ("c2", "backfill", 0), 2: ("c3", "capture", 1), 4: (None, "legacy", None), 5: (None, "legacy", None)}
    assert {r.src: r.bullets for r in M.id_tally(M.stamp_ids(b, s)).collect()} == {"capture": 2, "backfill": 1, "legacy": 2}


def test_threads_and_bullets(spark):
    stored = spark.createDataFrame([("a", True), ("b", True), ("c", False), ("d", False)], "t string, open boolean")
    live = spark.createDataFrame([("a",), ("c",), ("e",)], "t string")
    assert {r.t: r.state for r in M.thread_states(stored, live, "t").collect()} == {"a": "kept", "b": "resolved", "c": "reopened", "d": "closed", "e": "added"}
    F = M.F
    rows = spark.createDataFrame([("s", "one\ntwo", "Ann", "2026-01-01", "ab12", dt.date(2026, 2, 1)), ("s", "x", "Bo", "2026-01-02", None, None)], "k string, text string, who string, day string, cid string, on date")
    body = rows.select("k", M.bullet(F.col("text"), F.col("who"), F.col("day"), F.col("cid"), F.col("on")).alias("l")).groupBy("k").agg(F.array_join(F.sort_array(F.collect_list("l")), "\n").alias("body"))
    got = sorted(map(tuple, M.parse_bullets(body, "k", "body").collect()))
    assert got == [("s", 0, "Ann", "2026-01-01", "one\ntwo", "ab12"), ("s", 1, "Bo", "2026-01-02", "x", None)]


def test_reconcile(spark):
    rows = spark.createDataFrame([(1, "a", "hi @Ann Lee ok", "u"), (2, "a", "hi @Ann Lee ok", "u"), (3, None, "hi Ann Lee ok", "u"), (4, None, "same", "u"), (5, "b", "same", "u"), (8, None, "the same words", "u"), (9, "c", "The same, words", "u"), (6, None, "alone", "u"), (7, None, "alone", "u")], "no int, cid string, text string, who string")
    assert sorted(r.no for r in M.reconcile(rows, ["no"], ["who"]).collect()) == [1, 4, 5, 6, 7, 9]  # a text of one or two words needs an equal anchor


HELD = "no bigint, home string, anchor string, cid string, author string, day string, key string"


def copies(spark, rows, titles, *columns):
    return M.child_copies(spark.createDataFrame(rows, HELD), spark.createDataFrame(titles, "home string, title string"), *columns)


def most_rows(df):
    """The most rows that any step of the plan gave."""
    df.collect()
    todo, most = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        p = todo.pop()
        name, rows = p.getClass().getSimpleName(), p.metrics().get("numOutputRows")
        most = max(most, rows.get().value() if rows.isDefined() else 0)
        inner = p.executedPlan() if name == "AdaptiveSparkPlanExec" else p.plan() if name.endswith("QueryStageExec") else None
        todo += [inner] if inner is not None else [p.children().apply(i) for i in range(p.children().size())]
    return most


def test_child_copies_never_pair_rows_with_all_pages_of_a_title(spark):
    pages = [(f"p{n}", "Notes") for n in range(400)]
    rows = [(n, f"p{n}", "Notes", f"c{n // 2}", "u", "d", f"k{n // 2}") for n in range(300)]
    df = copies(spark, rows, pages)
    assert 300 <= most_rows(df) <= 4 * (300 + 400)  # not 300 * 400
    assert df.count() == 300  # each has its twin on the neighbour's page


def test_child_copies_are_those_of_a_search_over_all_pairs(spark, monkeypatch):
    rnd = random.Random(4)
    some = lambda *v: rnd.choice(v)
    long = "x" * 90
    titles = [(f"p{n}", some("A", " A ", "B", long + "1", long + "2", "", "  ", None)) for n in range(12)]
    anchor = lambda: some("A", "A ", "B", "C", long, long + "3", "", " ", None)
    rows = [(n, some(*[f"p{k}" for k in range(14)], None), anchor(), some(None, *"abcdefgh"), some(None, "u", "v"), some("d", "e", None), some("k", "l", None)) for n in range(150)]
    title = {h: t.strip()[:90] for h, t in titles if t and t.strip()}

    def same(a, b):
        return a[3] == b[3] if a[3] and b[3] else None not in a[4:] and a[4:] == b[4:]

    want = {a for a in rows if a[2] and a[2].strip() and a[1] for b in rows if b[1] != a[1] and title.get(b[1]) == a[2].strip()[:90] and same(a, b)}
    assert 10 < len(want) < 140
    assert sorted(map(tuple, copies(spark, rows, titles).collect())) == sorted(want)
    monkeypatch.setattr(M, "SMALL_ROWS", 0)  # as with very many titles
    assert sorted(map(tuple, copies(spark, rows, titles).collect())) == sorted(want)


def test_child_copies_give_distinct_columns(spark):
    rows = [(1, "h", "A", "a", None, None, None), (1, "h", " A", "a", None, None, None), (2, "p", None, "a", None, None, None)]
    assert copies(spark, rows, [("p", "A")], ["no", "home"]).collect() == [(1, "h")]
