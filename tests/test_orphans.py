import datetime as dt
import random

from driftline.core import scan
from driftline.operators import orphans

PAGES = "delivery_no bigint, swept_at timestamp, id string, last_edited_time string, archived boolean, in_trash boolean, key string, bucket int"
DBS = "db_id string, captured_at timestamp, deleted_at timestamp, rec int"
BLOCKS = "block_no bigint, block_id string, block_type string, payload string, listed_at timestamp, bucket int"
T0 = dt.datetime(2026, 1, 1)


def at(minutes):
    return None if minutes is None else T0 + dt.timedelta(minutes=minutes)


def iso(minutes):
    return None if minutes is None else (T0 + dt.timedelta(minutes=minutes)).strftime("%Y-%m-%dT%H:%M:00.000Z")


def brute(pages, dbs, blocks):
    norm = lambda i: None if i is None else i.replace("-", "").lower()
    out = set()
    for no, block_id, kind, payload, t, _ in blocks:
        import json

        try:
            p = json.loads(payload) if payload else {}
        except ValueError:
            p = {}
        refs = []
        if kind == "child_database" and block_id is not None:
            refs.append((block_id, "databases", True))
        if kind == "link_to_page":
            refs += [(p[f], table, False) for f, table in (("page_id", "pages_metadata"), ("database_id", "databases")) if p.get(f) is not None]
        for ref, table, needs_db in refs:
            k = norm(ref)
            there = False
            if t is not None:
                there = any(norm(i) == k and c is not None and c <= t and (x is None or x > t) for i, c, x, _ in dbs)
                if not needs_db:
                    seen = [(r[3] or "", r[1], r[0], r[4], r[5]) for r in pages if r[1] is not None and norm(r[2]) == k and r[1] <= t]
                    if seen:
                        best = max(seen, key=lambda r: r[:3])
                        there |= not (best[3] or best[4])
            if not there:
                out.add((no, table, None if t is None else t.strftime("%Y-%m")))
    return out


def run(spark, pages, dbs, blocks):
    d = orphans.workspace_deltas(spark.createDataFrame(blocks, BLOCKS), spark.createDataFrame(pages, PAGES), spark.createDataFrame(dbs, DBS))
    return {tuple(r) for r in orphans.orphan_references(d).collect()}, d


def random_case(seed, n=60):
    r = random.Random(seed)
    ids = ["%032x" % k for k in range(6)]
    spell = lambda i: r.choice([i, i.upper(), f"{i[:8]}-{i[8:]}"])
    time = lambda: at(r.choice([None, *range(0, 4000, 7)]))
    pages = [(k, time(), r.choice([None, spell(r.choice(ids))]), iso(r.choice([None, 0, 60, 120, 500])), r.choice([None, True, False, False]), r.choice([None, False, False, True]), "x", 1) for k in range(n)]
    dbs = [(spell(i), time(), time(), 1) for i in ids[3:]] + [(None, at(0), None, 1)]
    blocks = []
    for k in range(n):
        kind = r.choice(["child_database", "link_to_page", "link_to_page", "paragraph"])
        ref = spell(r.choice(ids))
        payload = r.choice(['{"page_id": "%s"}' % ref, '{"database_id": "%s"}' % ref, '{"page_id": null}', None, "not json", '{"comment_id": "x"}'])
        blocks.append((k, r.choice([None, ref]), kind, payload, time(), 1))
    return pages, dbs, blocks


def test_equals_brute_force(spark):
    for seed in range(3):
        case = random_case(seed)
        got, _ = run(spark, *case)
        assert got == brute(*case)


def test_hot_key_is_cut_and_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr(scan, "HOT_ROWS", 5)
    pages, dbs, blocks = random_case(9, 120)
    hot = "%032x" % 1
    pages += [(1000 + k, at(60) + dt.timedelta(seconds=k), hot, iso(k % 3), k % 2 == 0, False, "x", 1) for k in range(60)]
    blocks += [(1000 + k, None, "link_to_page", '{"page_id": "%s"}' % hot, at(60) + dt.timedelta(seconds=k), 1) for k in range(60)]
    got, _ = run(spark, pages, dbs, blocks)
    assert got == brute(pages, dbs, blocks)


def test_empty_tables(spark):
    got, d = run(spark, [], [], [])
    assert got == set() and orphans.orphan_keys(orphans.fold_deltas(d)).count() == 0


def test_folding_in_parts_equals_folding_at_once(spark):
    _, d = run(spark, *random_case(4))
    whole = orphans.fold_deltas(d)
    early, late = d.filter("coalesce(at_us, 0) % 2 = 0"), d.filter("coalesce(at_us, 0) % 2 <> 0")
    parts = orphans.fold_deltas(late, orphans.fold_deltas(early))
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))


def test_a_hot_instant_and_hot_seconds(spark, monkeypatch):
    monkeypatch.setattr(scan, "HOT_ROWS", 4)
    pages, dbs, blocks = random_case(11, 40)
    hot = "%032x" % 2
    one = lambda k, us: at(90) + dt.timedelta(microseconds=us * (k % 3))
    for us in (0, 1, 250_000):
        more = [(5000 + k, one(k, us), hot, iso(k % 4), k % 2 == 0, False, "x", 1) for k in range(30)]
        refs = [(5000 + k, None, "link_to_page", '{"page_id": "%s"}' % hot, one(k, us), 1) for k in range(30)]
        got, _ = run(spark, pages + more, dbs, blocks + refs)
        assert got == brute(pages + more, dbs, blocks + refs)


def current(pages, dbs, blocks):
    """Orphans when everything is known: latest listings against what exists at the end."""
    end = dt.datetime(2100, 1, 1)
    last = {}
    for b in blocks:
        if b[2] in ("child_database", "link_to_page"):
            k = ("#", b[0]) if b[1] is None else b[1].replace("-", "").lower()
            rank = (b[4] is not None, b[4] or T0, b[0])
            if k not in last or rank > last[k][0]:
                last[k] = (rank, b)
    out = {}
    import json

    for no, target, _ in brute(pages, dbs, [(*b[:4], end, 1) for _, b in last.values()]):
        b = next(x for x in blocks if x[0] == no)
        ref = b[1] if b[2] == "child_database" else json.loads(b[3])["page_id" if target == "pages_metadata" else "database_id"]
        k = (ref.replace("-", "").lower(), target)
        out[k] = out.get(k, 0) + 1
    return out


def test_kept_counts_withdraw_what_is_listed_again(spark, tmp_path):
    pages, dbs, blocks = random_case(6, 200)
    b = spark.createDataFrame([(*x, "p") for x in blocks], BLOCKS + ", page_id string")
    p, d = spark.createDataFrame(pages, PAGES), spark.createDataFrame(dbs, DBS)
    for stops in ([], ["2026-01-02 00:00:00"], ["2026-01-01 12:00:00", "2026-01-02 06:00:00"]):
        root = f"file://{tmp_path}/{len(stops)}"
        got = {(r.key, r.target_table): r.refs for r in orphans.current_orphans(b, p, d, root, stops).collect()}
        assert got == current(pages, dbs, blocks)
        again = {(r.key, r.target_table): r.refs for r in orphans.current_orphans(b, p, d, root, stops).collect()}
        assert again == got  # batches that were taken change nothing
