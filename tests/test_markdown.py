"""Rich text and blocks to Markdown and back: golden lines, random documents, deep and odd ones."""

import json
import random

import pytest

from driftline.operators import markdown as MD
from driftline.operators import richtext as RT

SIGNS = list("ab ab *~`[]()<>\\|!#-1.u/>▸🔥x ")
LEADS = ["[x] ", "▸ ", "- ", "# ", "📝 ", "> ", "🔥 ", "1. ", "$$", "---", "|a|", "\\", "</u>", "<eq>", "```"]


def _t(s, **a):
    return [{"type": "text", "plain_text": s, "annotations": a}]


def random_runs(r, links=True):
    out = []
    for _ in range(r.randint(0, 5)):
        if r.random() < 0.08:
            out.append({"type": "equation", "equation": {"expression": "x_1 < 2"}})
            continue
        text = "".join(r.choice(SIGNS) for _ in range(r.randint(1, 6)))
        if r.random() < 0.15:
            text = r.choice(LEADS) + text
        if r.random() < 0.1:
            text += "\n" + r.choice(["- x", "b", "> q", "1. z", "  "])
        a = {m: True for m in RT.MARKS if r.random() < 0.25}
        if r.random() < 0.1:
            a = {"code": True}
        run = {"type": "text", "plain_text": text, "annotations": a}
        if links and r.random() < 0.15:
            run["href"] = "https://x.example/a(b) c"
        out.append(run)
    return out


def test_random_rich_text_survives():
    for seed in range(1500):
        runs = random_runs(random.Random(seed))
        text = RT.inline(runs)
        back = RT.parse_inline(text)
        assert RT.visible(back) == RT.visible(runs), (seed, text)
        again = RT.inline(back)
        assert RT.inline(RT.parse_inline(again)) == again


@pytest.mark.parametrize(
    ("runs", "want"),
    [
        (_t("bold ", bold=True) + _t("both", bold=True, italic=True) + _t(".", bold=True), "**bold *both*.**"),
        (_t("u", underline=True) + _t(" s", strikethrough=True), "<u>u</u> ~~s~~"),
        (_t("a_b [n] C:\\temp 2 ~ 3 $5 $6"), "a_b [n] C:\\temp 2 ~ 3 $5 $6"),
        (_t("*x* `y`"), "\\*x\\* \\`y\\`"),
        (_t("a`b", code=True), "`` a`b ``"),
        ([{"type": "text", "plain_text": "k]", "href": "https://x/y"}], "[k\\]](https://x/y)"),
        ([{"type": "equation", "equation": {"expression": "x^2"}}], "<eq>x^2</eq>"),
        ([{"type": "mention", "plain_text": "@Plan", "href": "https://x/p"}], "[@Plan](https://x/p)"),
        ([None, {"plain_text": None}, {"plain_text": ""}], ""),
        (None, ""),
    ],
)
def test_spelling(runs, want):
    assert RT.inline(runs) == want


def test_openers_without_partner_are_text():
    for text in ("a ** b", "**a", "a**", "~~x", "<u>x", "x</u>", "`a", "[a](", "[a]", "a * b", "<eq>x"):
        assert RT.plain(RT.parse_inline(text)) == text
    assert [r["annotations"] for r in RT.parse_inline("***a** b*")] == [{"italic": True, "bold": True}, {"italic": True}]
    long = "*a " * 20_000 + "`" * 5000 + "[" * 20_000
    assert RT.plain(RT.parse_inline(long)) == long


def test_long_runs_are_cut():
    assert [len(r["plain_text"]) for r in RT.parse_inline("x" * 5000)] == [1990, 1990, 1020]
    assert [t[0] for t in RT.merge_runs([("a" * 3, "s"), ("b" * 3, "s"), ("c" * 9, "t")], 5)] == ["aaa", "bbb", "ccccc", "cccc"]


@pytest.mark.parametrize(
    ("kind", "payload", "want"),
    [
        ("heading_2", {"rich_text": _t("T")}, "## T"), ("to_do", {"rich_text": _t("x"), "checked": True}, "- [x] x"), ("toggle", {"rich_text": _t("x")}, "- ▸ x"),
        ("callout", {"rich_text": _t("x"), "icon": {"emoji": "🔥"}}, "> 🔥 x"), ("callout", {"rich_text": _t("x")}, ">  x"), ("divider", {}, "---"), ("equation", {"expression": "x"}, "$$\nx\n$$"),
        ("code", {"rich_text": _t("a\nb"), "language": "sql"}, "```sql\na\nb\n```"), ("code", {"rich_text": _t("a"), "language": "plain text", "caption": _t("c")}, "```\na\n```\n- 📝 c"),
        ("image", {"external": {"url": "https://u"}, "caption": _t("c")}, "![c](https://u)"), ("video", {"external": {"url": "https://u"}, "caption": []}, "![video](https://u)"),
        ("pdf", {"type": "file", "file": {"url": "u"}}, "![pdf](ATTACH:ab)"), ("bookmark", {"url": "u"}, "- 🔖 [u](u)"), ("embed", {"url": "u", "caption": _t("c")}, "- 🖼️ [c](u)"),
        ("child_page", {"title": "P"}, "- 📄 **P** — sub-page `ab`"), ("child_database", {"title": "D"}, "- 🗄️ **D** — database `ab` (rows in workspace/_databases/)"),
        ("link_to_page", {"page_id": "a-b"}, "- 🔗 link to `ab`"), ("template", {"rich_text": _t("x")}, "- 🧩 (template: x)"), ("table_of_contents", {}, "- 📑 (table of contents)"),
        ("numbered_list_item", {"rich_text": _t("x")}, "1. x"), ("quote", {"rich_text": _t("x")}, "> x"), ("quote", {"rich_text": []}, "> \\"), ("breadcrumb", {}, ""),
        ("strange", {}, "<!-- unhandled block type: strange -->"), ("strange", {"rich_text": _t("x")}, "x"), ("paragraph", {"rich_text": _t("- no item")}, "\\- no item"),
        ("bulleted_list_item", {"rich_text": _t("[x] no to-do")}, "- \\[x] no to-do"), ("paragraph", {"rich_text": _t("a\nb")}, "a  \nb"), ("bulleted_list_item", {"rich_text": None}, "-"),
        ("table", {"children": [{"type": "table_row", "table_row": {"cells": [_t("a"), _t("b")]}}, {"type": "table_row", "table_row": {"cells": [_t("c|")]}}]}, "| a | b |\n|---|---|\n| c\\| |  |"),
        ("meeting_notes", {"title": _t("Sync"), "status": "in_progress", "calendar_event": {"start_time": "9:00", "end_time": "9:30", "attendees": ["A", "B"]}}, "- 🎙️ **AI meeting notes: Sync** — 9:00 → 9:30 · A, B (in progress)"),
    ],
)
def test_block_types(kind, payload, want):
    assert MD.render({"blocks": [{"id": "a-b", "type": kind, kind: payload}]}) == want


def _p(text, ident, kind="paragraph", **more):
    return {"id": ident, "type": kind, kind: {"rich_text": _t(text), **more}}


def test_boxes_tabs_and_separators():
    columns = {"id": "1", "type": "column_list", "column_list": {"children": [{"id": "2", "type": "column", "column": {"children": [_p("a", "3")]}}, {"id": "4", "type": "column", "column": {"children": [_p("b", "5")]}}]}}
    synced = {"id": "6", "type": "synced_block", "synced_block": {"synced_from": {"block_id": "or-ig"}}}
    rec = {"blocks": [columns, synced, _p("q", "8", "quote"), _p("r", "9", "quote")], "children": {"orig": [_p("c", "7")]}}
    assert MD.render(rec) == "a\n\nb\n\nc\n> q\n\n> r"
    notes = {"id": "n", "type": "meeting_notes", "meeting_notes": {"title": [], "children": {"summary_block_id": "t-1", "notes_block_id": "t2"}}}
    tabs = [{"id": "t1", "type": "paragraph", "paragraph": {"children": [_p("s", "u")]}}, {"id": "t9", "type": "paragraph", "paragraph": {}}]
    assert MD.render({"blocks": [notes], "children": {"n": tabs}}) == "- 🎙️ **AI meeting notes: untitled**\n\n**Summary**\n\ns\n\n**Other tab**"


def test_nesting_and_parsing():
    rec = {"blocks": [_p("a", "1", "bulleted_list_item"), _p("q", "9", "quote")], "children": {"1": [_p("b", "2", "to_do")], "9": [_p("c", "3")], "2": [{"id": "1", "type": "divider", "divider": {}}]}}
    assert MD.render(rec) == "- a\n  - [ ] b\n> q\n>\n> c"
    got = [(b["type"], b["parent"]) for b in MD.parse_blocks("# T\n\n- a\n  - [x] b\n    1. c\n- d\n```py\n# no\n```\n| a | b |\n|---|---|\n| c | d |\n> 🔥 e\n>\n> f\n---\n$$\nx\n$$\nsoft\nwrap\n\n#### four")]
    assert got == [("heading_1", -1), ("bulleted_list_item", -1), ("to_do", 1), ("numbered_list_item", 2), ("bulleted_list_item", -1), ("code", -1), ("table", -1), ("callout", -1), ("paragraph", 7), ("divider", -1), ("equation", -1), ("paragraph", -1), ("heading_3", -1)]
    deep = MD.parse_blocks("- a\n  - b\n    - c\n      - d")
    assert [b["level"] for b in deep] == [0, 1, 2, 3] and [b["refused"] for b in deep] == [None, None, None, "nested deeper than 2"]
    code = MD.parse_blocks("```py\nx\n```\n- 📝 say **it**")
    assert len(code) == 1 and code[0]["extra"]["language"] == "python" and RT.plain(code[0]["extra"]["caption"]) == "say it"
    assert MD.split_icon("🔥 hot") == ("🔥", "hot") and MD.split_icon("plain") == ("", "plain")


def test_any_depth():
    b = {"id": "x", "type": "divider", "divider": {}}
    for k in range(1500):
        b = {"id": str(k), "type": "bulleted_list_item", "bulleted_list_item": {"rich_text": _t("x"), "children": [b]}}
    text = MD.render({"blocks": [b]})
    assert text.count("\n") == 1500 and MD.parse_blocks(text)[-1]["level"] == 1500
    for k in range(300):
        b = {"id": f"q{k}", "type": "quote", "quote": {"rich_text": _t("x"), "children": [b] if k else []}}
    assert MD.parse_blocks(MD.render({"blocks": [b]}))[-1]["level"] == 299


KINDS = ["paragraph", *MD.HEADINGS, *MD.BULLETS, "to_do", "quote", "callout", "code", "divider", "equation", "table", "bookmark", "image"]


def random_block(r, level=0):
    k = r.choice(KINDS)
    p = {"rich_text": random_runs(r)}
    if k == "to_do":
        p["checked"] = r.random() < 0.5
    if k == "callout" and r.random() < 0.7:
        p["icon"] = {"emoji": "🔥"}
    p = {
        "code": {"rich_text": _t("x = 1\n  y ``` z"), "language": "python", "caption": []}, "equation": {"expression": "a\n b"}, "divider": {}, "bookmark": {"url": "https://x.y/z", "caption": []},
        "image": {"external": {"url": "https://x.y/z.png"}, "caption": []}, "table": {"children": [{"type": "table_row", "table_row": {"cells": [random_runs(r), random_runs(r)]}} for _ in range(2)]},
    }.get(k, p)
    if level < 2 and (k in MD._NESTS or k in ("quote", "callout")) and r.random() < 0.4:
        p["children"] = [random_block(r, level + 1) for _ in range(r.randint(1, 3))]
    return {"id": "%032x" % r.getrandbits(100), "type": k, k: p}


def expected(blocks, level=0):
    for b in blocks:
        p = b[b["type"]]
        seen = RT.visible(p.get("rich_text")) if b["type"] != "code" else []
        if b["type"] != "paragraph" or seen:
            yield level, b["type"], seen
        if b["type"] != "table":
            yield from expected(p.get("children", []), level + 1)


def test_random_documents_survive():
    lost = 0
    for seed in range(800):
        r = random.Random(seed)
        rec = {"blocks": [random_block(r) for _ in range(r.randint(1, 4))]}
        blocks = MD.parse_blocks(MD.render(rec))
        got = [(b["level"], b["type"], RT.visible(b["runs"])) for b in blocks if b["type"] != "paragraph" or RT.visible(b["runs"])]
        lost += got != list(expected(rec["blocks"]))
        again = MD.render(MD.to_record(blocks))
        assert MD.render(MD.to_record(MD.parse_blocks(again))) == again, seed
    assert lost <= 1


def test_standins_links_and_trimming():
    i = "a" * 32
    line = lambda s, n=False: (lambda r: r and (r["type"], r["state"]))(MD.standin(s, n))
    assert line(f"- 📄 **T** — sub-page `{i}`") == ("child_page", "kept") and line(f"- 🗄️ **D** — database `{i}` (rows in workspace/_databases/)", True) == ("child_database", "refused")
    assert line(f"- 🗄️ **D** — database `{i}` (rows in workspace/_databases/)") == ("child_database", "kept") and line(f"- 📄 **T** — sub-page `{i}` more") == ("child_page", "refused")
    assert line(f"- 🔗 link to `{i}`", True) == ("link_to_page", "rebuilt") and line("- 🔗 link to `short`") == ("link_to_page", "refused")
    assert line("- 🔖 [x](https://h/p)") == ("bookmark", "rebuilt") and line("- 🔖 [x](ftp)") == ("bookmark", "refused") and line("- plain") is None
    assert line(MD.CONTENTS) == ("table_of_contents", "kept") and line("- 🧩 (template: x)") == ("template", "kept") and line("- 📄 loose") == ("unsupported", "refused")
    assert [b["type"] for b in MD.parse_blocks(f"- 🔗 link to `{i}`\n- a")] == ["link_to_page", "bulleted_list_item"]
    runs = MD.promote_links([{"type": "text", "plain_text": "see https://h/a"}, {"type": "text", "plain_text": f"b and {i}."}, {"type": "text", "plain_text": "x", "href": "u"}])
    assert [r["plain_text"] for r in runs] == ["see ", "https://h/ab", " and ", i, ".", "x"]
    assert MD.trim_payload({"a": ["xyz", ["1", "2", "3"]], "b": 5}, 2, 2) == {"a": ["xy", ["1", "2"]], "b": 5}
    assert MD.table_width({"blocks": [{"table_row": {"cells": [1, 2, 3]}}, {"table_row": None}]}) == 3


def test_over_rows(spark):
    rows = [(1, json.dumps({"blocks": [_p("**", "1"), _p("x", "2", "heading_1")]})), (2, None), (3, "[1]"), (4, "no json"), (5, '{"blocks": null, "children": []}')]
    df = spark.createDataFrame(rows, "tree_no bigint, body string")
    assert {r.tree_no: r.markdown for r in MD.rendered(df).collect()} == {1: "\\*\\*\n# x", 2: None, 3: None, 4: None, 5: ""}
    assert {tuple(r) for r in MD.round_trips(df).collect()} == {(1, 2, 2, 2, True), (2, 0, 0, 0, True), (3, 0, 0, 0, True), (4, 0, 0, 0, True), (5, 0, 0, 0, True)}
    docs = spark.createDataFrame([(7, "# a\n- b"), (8, None), (9, "")], "doc_id bigint, text string")
    assert [(r.doc_id, r.type, r.plain_text, r.level) for r in MD.parsed(docs, "doc_id", "text").orderBy("block_pos").collect()] == [(7, "heading_1", "a", 0), (7, "bulleted_list_item", "b", 0)]
    assert MD.parsed(docs.limit(0), "doc_id", "text").count() == 0
