"""References in documents, settled items, closing gaps, alarms, listings and links, on small cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from driftline.functions import text as X
from driftline.operators import comments as M
from driftline.operators import coverage as V
from driftline.operators import quality as Q
from driftline.operators import schedule as S
from driftline.sources import sinks

A, B = "a" * 32, "0123456789abcdef" * 2


@pytest.mark.parametrize(
    ("line", "want"),
    [
        (f"- 🗄️ **T** — database `{A}` (rows in workspace/_databases/)", ("child_database", "db_long", A)),
        (f"    - 🗄️ **T** — database `{A}` (rows in CSV export)  ", ("child_database", "db_long_csv", A)),
        (f"- 🗄️ Tasks `{A}`", ("child_database", "db_short", A)), (f"- 🗄️ `{B}`", ("child_database", "db_short", B)),
        (f"- 📄 **P** — sub-page `{A}`", ("sub_page", "page_long", A)), (f"- 📄 **P** — sub-page `{A}` (have) → `p.md`", ("sub_page", "page_long_status", A)),
        (f"- 📄 P `{A}`", ("sub_page", "page_short", A)), (f"  - 🔗 link to `{A}`", ("link_to_page", "link_to_page", A)),
        (f"- 🔗 link to `{A.upper()}`", None), (f"- 🔗 link to `{A[:31]}`", None), (f"text - 📄 P `{A}`", None), (f"- 📄 P `{A}` and more", None), ("", None), (None, None),
    ],
)
def test_shapes(spark, line, want):
    got = V.references(spark.createDataFrame([(1, line, "x")], "no int, text string, extra string")).collect()
    assert [(r.kind, r.shape, r.ref) for r in got] == ([want] if want else [])


def test_blind_spots_and_absence_by_kind(spark):
    lines = spark.createDataFrame([("- 🗄️ no id",), ("- 📄 no id",), ("<!-- unhandled block type: x -->",), (f"- 📄 P `{A}`",), (None,)], "text string")
    assert {r.spot: r.lines for r in V.blind_spots(lines).collect()} == {"idless_db": 1, "idless_page": 1, "unhandled": 1}
    refs = spark.createDataFrame([(A, "child_database"), (A, "sub_page"), (A, "link_to_page"), (B, "link_to_page"), (B, "child_database")], "ref string, kind string")
    have = spark.createDataFrame([(A, "page"), (B, "table"), (B, "table")], "id string, kind string")
    assert {tuple(r) for r in V.absent(refs, have).collect()} == {(A, "child_database")}


def test_settled_items(spark):
    items = spark.createDataFrame([(k, "sub_page") for k in ("x", "ok", "lost", "bad", "new", "kind")], "ref string, kind string")
    progress = spark.createDataFrame([("ok", "done"), ("lost", "done"), ("bad", "failed"), ("bad", "done"), ("kind", "done"), ("x", "failed")], "ref string, state string")
    have = spark.createDataFrame([("ok", "page"), ("kind", "table")], "id string, kind string")
    got = V.settled(items, progress, have, spark.createDataFrame([("x",)], "ref string"))
    assert {r.ref: r.state for r in got.collect()} == {"x": "excluded", "ok": "settled", "lost": "lost", "bad": "failed", "new": "open", "kind": "lost"}
    due = S.due_slice(items, got.filter("state IN ('settled', 'excluded')"), ["ref", "kind"], [F.col("ref")], 2)
    assert [r.ref for r in due.collect()] == ["bad", "kind"]


def test_gaps_are_closed_until_nothing_is_left(spark):
    edges = {"a": ["b", "c"], "b": ["c", "d"], "c": ["a"], "d": ["gone", "x"], "e": ["f"]}
    refs = spark.createDataFrame([(s, t) for s, ts in edges.items() for t in ts], "page string, ref string").withColumn("kind", F.lit("sub_page"))
    pages = spark.createDataFrame([(p,) for p in "abcdefx"], "ref string")
    capture = lambda items: pages.join(items.select("ref"), "ref", "left_semi").withColumn("kind", F.lit("page"))
    refer = lambda got: refs.join(got.withColumnRenamed("ref", "page"), "page").select("ref", "kind")
    start = spark.createDataFrame([("a", "sub_page"), ("a", "link_to_page"), ("have", "sub_page")], "ref string, kind string")
    have, out = spark.createDataFrame([("have", "page")], "id string, kind string"), spark.createDataFrame([("x",)], "ref string")
    got = {r.ref: (r.round, r.got) for r in V.close_gaps(start, capture, refer, have, out).collect()}
    assert got == {"a": (1, True), "b": (2, True), "c": (2, True), "d": (3, True), "gone": (4, False)}
    assert {r.ref for r in V.close_gaps(start, capture, refer, have, out, budget=2).collect()} == {"a", "b"}
    assert V.close_gaps(start.limit(0), capture, refer, have, out).count() == 0


def test_exclusions_take_all_reasons(spark):
    df = spark.createDataFrame([("a", r, "note") for r in Q.REASONS], "id string, reason string, note string")
    assert Q.checked_exclusions(df).count() == 6 and {"archived", "db404"} <= set(Q.REASONS)


def test_gaps_and_silence(spark, monkeypatch):
    from driftline.core import scan

    h = 3_600_000_000
    rows = [("a", 0), ("a", 5), ("a", h), ("a", 3 * h), ("a", 3 * h + 7), ("a", None), ("b", 9), ("c", None)] + [("hot", 10 * h + k * k) for k in range(60)]
    df = spark.createDataFrame(rows, "k string, us bigint")
    want = {"a": (6, 2 * h, 3 * h + 7), "b": (1, None, 9), "c": (1, None, None), "hot": (60, 59 * 59 - 58 * 58, 10 * h + 59 * 59)}
    for limit in (50_000, 4):
        monkeypatch.setattr(scan, "HOT_ROWS", limit)
        assert {r.k: (r.n, r.max_gap_us, r.last_us) for r in Q.gap_stats(df, "k", "us").collect()} == want
    assert {r.k for r in Q.silent(df, "k", "us", 11 * h, h).collect()} == {"a", "b"}


def test_alarms(spark):
    ddl = "run_no int, started_us bigint, ended_us bigint, outcome string"
    s = 1_000_000
    alarms = lambda rows, now: {r.alarm: r.since_us for r in S.run_alarms(spark.createDataFrame(rows, ddl), now * s, 60, 100, 2).collect()}
    assert alarms([], 0) == {"no success": None, "no start": None}
    assert alarms([(1, 0, 10 * s, "ok")], 50) == {}
    assert alarms([(1, 0, 10 * s, "ok"), (2, 20 * s, 30 * s, "failed"), (3, 40 * s, None, "killed")], 70) == {"no success": 10 * s, "never ended": 40 * s, "failures": 20 * s}
    assert alarms([(1, 0, 10 * s, "ok")], 100) == {"no success": 10 * s, "no start": 0}


def test_relative_paths(spark):
    cases = [("w/a/x.md", "w/a/y.md", "x.md"), ("w/a/x.md", "w/y.md", "a/x.md"), ("w/x.md", "w/a/b/y.md", "../../x.md"), ("d/t/x.md", "w/a/y.md", "../../d/t/x.md"), ("x.md", "y.md", "x.md"), ("x.md", "w/y.md", "../x.md"), ("w/a", "w/a/b", "../a"), (None, "a", None)]
    df = spark.createDataFrame([(t, s) for t, s, _ in cases], "t string, s string")
    assert [r.p for r in df.select(X.relative_path("t", "s").alias("p")).collect()] == [w for *_, w in cases]


def test_lines_are_guarded_and_back(spark):
    texts = ["- a\n\\- b\nplain\n# h\n#no\n1. x\n---\n|t|\n\\\\- c", "", None, "$$\n![x]\n> q"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", X.guard_lines("t").alias("g"), X.unguard_lines(X.guard_lines("t")).alias("u")).collect()
    assert [r.u for r in rows] == texts
    assert rows[0].g == "\\- a\n\\\\- b\nplain\n\\# h\n#no\n\\1. x\n\\---\n\\|t|\n\\\\\\- c"


def test_documents_are_written_only_where_they_differ(spark):
    ddl = "id string, path string, document string"
    a = spark.createDataFrame([("same", "p", "d"), ("text", "p", "d"), ("name", "p", "d"), ("both", "p", "d"), ("gone", "p", "d")], ddl)
    b = spark.createDataFrame([("same", "p", "d"), ("text", "p", "e"), ("name", "q", "d"), ("both", "q", "e"), ("new", "p", "d")], ddl)
    assert {r.id: r.verdict for r in sinks.document_changes(a, b, "id").collect()} == {"same": "keep", "text": "write", "name": "rename", "both": "move", "gone": "remove", "new": "write"}
    one = spark.range(1).select(sinks.with_stamp(F.lit("body"), F.lit("2026-01-01"), "<!-- more -->", F.lit("kept")).alias("d"))
    assert one.first().d == "<!-- generated 2026-01-01 -->\nbody\n\n<!-- more -->\nkept"
    assert one.select(sinks.without_stamp(F.col("d")).alias("d")).first().d.startswith("body\n")


def test_misfiled_comments_go_to_the_home_of_their_thread(spark):
    t = dt.datetime(2026, 1, 1)
    rows = spark.createDataFrame(
        [(1, 0, "a", "t", "late", None), (2, 0, "a", "t", "home", t), (3, 0, "b", "t", "other", t), (4, 0, "a", "t", "other", t), (5, 0, None, "t", "other", t), (6, 0, "z", None, "x", t)],
        "delivery_no bigint, pos int, cid string, thread string, home string, at timestamp",
    )
    got = {r.delivery_no: r.fate for r in M.repair_homes(rows, M.thread_homes(rows)).collect()}
    assert got == {1: "drop", 2: "keep", 3: "move", 4: "drop", 5: "move", 6: "keep"}


def test_clocks_and_pending_sets(spark):
    clock = spark.createDataFrame([("a", 3), ("a", 5), ("dead", 1)], "k string, last int")
    alive = spark.createDataFrame([("a",), ("new",), ("a",)], "k string")
    assert {tuple(r) for r in S.audit_pool(clock, alive, "k", "last").collect()} == {("a", 5), ("new", None)}
    one = lambda *ks: spark.createDataFrame([(k,) for k in ks], "k string")
    assert sorted(r.k for r in S.carried_over(one("a", "b"), one("b", "c"), one("a"), "k").collect()) == ["b", "c"]


def test_runs_of_one_kind_across_buckets(spark, monkeypatch):
    from itertools import groupby

    from driftline.core import scan

    h = 3_600_000_000
    rows = [(k, kind, at, n) for k in "ab" for n, (kind, at) in enumerate([("x", 0), ("x", 5), (None, h), (None, 3 * h), ("x", 3 * h + 1), ("y", 3 * h + 1), ("y", 9 * h), ("y", 9 * h + 2), ("x", 9 * h + 2)])]
    rows += [("hot", "xy"[(i // 7) % 2], 20 * h + i, i) for i in range(50)] + [("a", "x", None, 99), (None, "x", 1, 1)]
    df = spark.createDataFrame(rows, "k string, kind string, us bigint, no int")
    want = set()
    for key in ("a", "b", "hot"):
        mine = sorted(((r[2], r[3], r[1]) for r in rows if r[0] == key and r[2] is not None), key=lambda r: r[:2])
        want |= {(key, kind, i + 1, len(list(g))) for i, (kind, g) in enumerate(groupby(mine, key=lambda r: r[2]))}
    for limit in (50_000, 5):
        monkeypatch.setattr(scan, "HOT_ROWS", limit)
        assert {tuple(r) for r in S.islands(df, "k", "kind", "us", "no").collect()} == want


def test_properties_that_a_document_covers(spark):
    p = spark.createDataFrame([("a", "t", "Blue sky"), ("a", "u", "not there"), ("a", "named", "zzz"), ("a", "e", ""), ("b", "t", "x"), ("b", "n", None), ("c", "t", "--")], "k string, name string, value string")
    d = spark.createDataFrame([("a", "# The SKY is blue\n| named | y |"), ("c", None)], "k string, document string")
    assert {tuple(r) for r in Q.uncovered_properties(p, d, "k").collect()} == {("a", "u", "not there"), ("b", "t", "x")}
    old, probed = spark.createDataFrame([("a",), ("b",), ("c",), ("c",)], "k string"), spark.createDataFrame([("a",), ("c",)], "k string")
    assert [r.k for r in Q.replaced_documents(old, p, d, probed, "k").collect()] == ["c"]
