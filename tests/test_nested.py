import json
import random

from driftline.functions.jsontext import _parse_deep, clean, parse
from driftline.operators import nested as N
from driftline.plans.problems import RUN_PATHS

SCHEMA = "tree_no bigint, body string, page_id string, row_no int"


def brute(rows):
    """Straight from the definition, recursively."""
    out = []
    bare = lambda i: str(i).replace("-", "").lower() if i is not None else ""

    def block(no, b, parent):
        if not isinstance(b, dict):
            return
        for path in RUN_PATHS:
            t, f = path.split(".")
            runs = b.get(t, {}).get(f) if isinstance(b.get(t), dict) else None
            for i, r in enumerate(runs or []):
                if isinstance(r, dict) and r.get("plain_text"):
                    out.append((no, bare(b.get("id")), parent, path, i))
        p = b.get(b.get("type"))
        if isinstance(p, dict):
            for c in p.get("children") or []:
                block(no, c, bare(b.get("id")))

    for no, body, *_ in rows:
        try:
            v = json.loads(body)
        except (ValueError, TypeError):
            continue
        for b in v.get("blocks") or []:
            block(no, b, "")
        for k, bs in (v.get("children") or {}).items():
            for b in bs or []:
                block(no, b, bare(k))
    return sorted(out)


def tree(r, depth=0):
    t = r.choice(["image", "callout", "bulleted_list_item", "paragraph", "divider"])
    run = lambda: r.choice([{"type": "text", "plain_text": "x", "annotations": {"bold": True}}, {"type": "text"}, {"plain_text": ""}, {"plain_text": None}, {"plain_text": "\ud800y"}])
    p = {}
    for f in ("caption", "rich_text"):
        if r.random() < 0.7:
            p[f] = r.choice([None, [], [run() for _ in range(r.randint(1, 3))]])
    if r.random() < 0.4 and depth < 5:
        p["children"] = r.choice([None, [], [tree(r, depth + 1) for _ in range(2)]])
    if r.random() < 0.3:
        p["icon"] = {"type": "emoji", "emoji": "🔥"}
    i = "%032x" % r.getrandbits(128)
    return {"id": r.choice([i, f"{i[:8]}-{i[8:]}", None]) if depth else i, "type": t, "has_children": r.random() < 0.5, t: p}


def case(seed, n=40):
    r = random.Random(seed)
    rows = []
    for k in range(n):
        v = {"name": "x", "blocks": r.choice([None, [], [tree(r) for _ in range(3)]])}
        if r.random() < 0.6:
            v["children"] = r.choice([None, {}, {"%032x" % 5: [tree(r)], "%032x" % 6: None, "%032x" % 7: []}])
        rows.append((k, json.dumps(v), "p", 1))
    return [*rows, (n, None, "p", 1), (n + 1, "", "p", 1), (n + 2, '{"blocks": [', "p", 1), (n + 3, "[1, 2]", "p", 1), (n + 4, '{"blocks": [], "x": NaN}', "p", 1), rows[0]]


def test_runs_equal_brute_force(spark):
    for seed in range(3):
        rows = [r for r in case(seed) if r[1] not in ("[1, 2]",)]
        got = sorted(map(tuple, N.text_runs(spark.createDataFrame(rows, SCHEMA), RUN_PATHS).collect()))
        assert got == brute(rows)


def test_every_row_knows_its_parent(spark):
    df = spark.createDataFrame(case(7), SCHEMA)
    plan = N.analysed_plan(df)
    assert {"tree", "block", "rich_text", "caption"} <= plan.tables and "callout" in plan.inlined
    rows = N.shred(df.filter("tree_no > 0"), plan).collect()
    at = {(r.tree_no, r.row_no): r for r in rows}
    assert len(at) == len(rows)
    for r in rows:
        assert r.parent_row is None if r.table_name == "tree" else at[r.tree_no, r.parent_row].table_name == r.parent_table
    blocks = N.flat_table(N.shred(df, plan), "block", ["type", "callout.icon"]).columns
    assert "callout_icon" in blocks


def test_plan_rules():
    p = N.plan_tables([("tree", "a", False), ("a", "b", True), ("a", "c", False), ("d", "c", False), ("tree", "d", False), ("d", "e", False), ("e", "d", False)])
    assert p.tables == {"tree", "b", "c", "d"} and p.inlined == {"a", "e"}


def test_deep_and_empty(spark):
    body = '{"blocks": [' + '{"id": "1", "type": "callout", "callout": {"children": [' * 9000 + '{"id": "2", "type": "image", "image": {"caption": [{"plain_text": "z"}]}}' + "]}}" * 9000 + "]}"
    got = N.text_runs(spark.createDataFrame([(1, body, "p", 1)], SCHEMA), RUN_PATHS).collect()
    assert [(r.block_id, r.parent_id, r.field_path) for r in got] == [("2", "1", "image.caption")]
    assert N.text_runs(spark.createDataFrame([], SCHEMA), RUN_PATHS).count() == 0


def test_deep_parser_agrees_with_the_library():
    r = random.Random(2)

    def value(d=0):
        k = r.randint(0, 7 if d < 4 else 5)
        return [None, True, False, r.randint(-9, 9), r.random(), "a\"b\\é\n"][k] if k < 6 else [value(d + 1) for _ in range(r.randint(0, 3))] if k == 6 else {str(i): value(d + 1) for i in range(r.randint(0, 3))}

    for _ in range(200):
        s = json.dumps(value(), indent=r.choice([None, 1]))
        assert _parse_deep(s) == json.loads(s)
    assert parse("[1,]") == (False, None) and parse("NaN") == (False, None) and parse(None) == (False, None)
    assert clean("a\ud83dz").encode()


def test_long_and_odd_field_names_are_elements_of_their_own(spark):
    long = ["a" * 41, "a" * 40 + "b", "my-field", "my field"]
    body = {"blocks": [{"id": "1", "type": "x", "x": {n: [{"v": n}] for n in long}}]}
    df = spark.createDataFrame([(1, json.dumps(body), "p", 1)], SCHEMA)
    plan = N.analysed_plan(df)
    assert set(long) <= plan.tables and not plan.maps
    assert {r.table_name: r["columns"]["v"] for r in N.shred(df, plan, set(long)).collect()} == {n: n for n in long}


def test_many_keys_chosen_by_the_data_are_a_map(spark, monkeypatch):
    monkeypatch.setattr(N, "MAP_KEYS", 10)
    bodies = [{"blocks": [], "users": {f"user_{3 * k + i}": {"name": [{"n": k}], "tags": {f"t{k}": {"z": 1}}} for i in range(3)}} for k in range(8)]
    df = spark.createDataFrame([(k, json.dumps(b), "p", 1) for k, b in enumerate(bodies)], SCHEMA)
    plan = N.analysed_plan(df)
    assert plan.maps == {"users"} and "users.*" in plan.inlined | plan.tables and not any(t.startswith("user_") for t in plan.tables | plan.inlined)
    rows = N.shred(df, plan).collect()
    assert sum(r.table_name == "name" for r in rows) == 24
    assert [tuple(r) for r in N.links(N.shred(df, plan)).filter("without_parent > 0").collect()] == []
    deep = N._Graph(frozenset())
    deep.take({f"k{i}": {"x": {"y": 1}} for i in range(100)})
    assert deep.maps == {"tree"} and len(deep.below["tree"]) < 40
