import random
import uuid

import numpy as np
import pandas as pd

from driftline.core.store import work_dir
from driftline.operators import messages as M

SCHEMA = "delivery_no bigint, entity_id string, captured_at string, comments array<struct<id:string,text:string>>, digest string, prefix int"


def identity(row):
    import datetime as dt

    _, e, c, cs, *_ = row
    t = c
    if c and c[0].isdigit():
        t = dt.datetime.fromisoformat(c.replace("Z", "+00:00")).timestamp()
    return (e and e.replace("-", "").lower(), t, frozenset(x[0].replace("-", "").lower() for x in cs or [] if x and x[0] is not None))


def surplus(rows):
    first, out = {}, set()
    for r in sorted(rows, key=lambda r: r[0]):
        k = identity(r)
        if k in first:
            out.add((first[k], r[0]))
        else:
            first[k] = r[0]
    return out


def case(seed, n=200):
    r = random.Random(seed)
    ids = [uuid.UUID(int=r.getrandbits(128)).hex for _ in range(12)]
    times = ["2026-01-05T10:00:00.5+00:00", "2026-01-05T12:00:00.500000+02:00", "2026-01-05T10:00:00.500Z", "backfill", None, "garbled", "2026-01-06T10:00:00Z"]
    comments = lambda: r.choice([None, [], [(None, "x")], [(i, "t") for i in r.sample(ids, 2)], [(ids[0], "a"), (ids[1].upper(), "b")], [(ids[1], "b"), (ids[0], "c"), (None, "d")]])
    rows = [(k, r.choice([None, "E1", "e-1", "e2"]), r.choice(times), comments(), "x", 1) for k in range(n)]
    return rows + [(n + k, "hot", "backfill", [(ids[0], "a")], "x", 1) for k in range(n)]


def test_equals_brute_force_with_a_hot_message(spark):
    for seed, rounds in ((1, 4), (2, 1), (3, 7)):
        rows = case(seed)
        got = [tuple(r) for r in M.surplus_copies(spark.createDataFrame(rows, SCHEMA), work_dir(spark, "m"), rounds).collect()]
        assert len(got) == len(set(got)) and set(got) == surplus(rows)


def test_kept_is_one_of_each_and_keeps_columns(spark):
    rows = case(4)
    kept = M.kept_messages(spark.createDataFrame(rows + [rows[0]], SCHEMA), work_dir(spark, "k"))
    assert kept.columns[0] == "delivery_no" and set(kept.columns) == {"delivery_no", "entity_id", "captured_at", "comments", "digest", "prefix"}
    got = [r.delivery_no for r in kept.collect()]
    assert len(got) == len(set(got)) and set(got) == {r[0] for r in rows} - {c for _, c in surplus(rows)}


def test_empty_and_repeated_batch(spark):
    assert M.surplus_copies(spark.createDataFrame([], SCHEMA), work_dir(spark, "e")).count() == 0
    keyed = spark.createDataFrame(case(5), SCHEMA).select("delivery_no", M.message_digest().alias("digest"))
    index = M.MessageIndex(spark, work_dir(spark, "r"))
    once = sorted(map(tuple, index.absorb(0, keyed).collect()))
    assert sorted(map(tuple, index.absorb(0, keyed).collect())) == once
    # every delivery of a later batch that brings nothing new is surplus
    assert index.absorb(1, keyed).filter("first_no <> copy_no").count() == len(once)


def entries(n, step=1):
    out = np.zeros(n, dtype=M.ENTRY)
    out["hi"], out["lo"], out["no"] = np.arange(n, dtype=np.uint64) << np.uint64(58), np.arange(n) * step, np.arange(n)
    return out


def test_binary_search_of_sorted_arrays_with_equal_halves():
    ids = [bytes(8) + bytes([0] * 7 + [k]) for k in range(0, 20, 2)]
    none = pd.DataFrame({"entries": []})
    took = M._take(pd.DataFrame({"prefix": [0] * 10, "digest": ids, "delivery_no": range(10), "n": 1}), none)
    assert len(took) == 1 and took["digest"].iloc[0] is None
    kept, hit = M._search(pd.Series([bytes(8) + bytes([0] * 7 + [k]) for k in range(20)]), took["entries"])
    assert [int(v) if h else None for v, h in zip(kept, hit, strict=True)] == [k // 2 if k % 2 == 0 else None for k in range(20)]
    both = M._merge(4)(pd.concat([took, took]))
    assert len(np.frombuffer(both["entries"][0], dtype=M.ENTRY)) == 10


def test_a_merge_splits_arrays_to_longer_prefixes():
    run = pd.DataFrame({"prefix": [0], "entries": [entries(8).tobytes()]})
    split = M._merge(6)(run)
    assert list(split["prefix"]) == list(range(8)) and [len(b) for b in split["entries"]] == [24] * 8
    assert M.bits_for(10) == M.MIN_BITS and M.bits_for(10**10) == 16 and M.bits_for(10**13) == 26


def test_the_index_grows_its_prefix_and_removes_what_it_replaced(spark, monkeypatch):
    monkeypatch.setattr(M, "PREFIX_ENTRIES", 4)
    rows = [(k, f"e{k % 70}", "backfill", [(f"{k % 70}", "a")], "x", 1) for k in range(200)]
    keyed = spark.createDataFrame(rows, SCHEMA).select("delivery_no", M.message_digest().alias("digest"))
    index, got = M.MessageIndex(spark, work_dir(spark, "g"), merge_at=2), set()
    for k in range(5):
        got |= {tuple(r) for r in index.absorb(k, keyed.filter(f"delivery_no >= {40 * k} and delivery_no < {40 * k + 40}")).collect()}
    assert got == {(k % 70, k) for k in range(70, 200)}
    state = index._manifest()
    assert state["bits"] > M.MIN_BITS and state["entries"] == 70
    assert sorted(M.ControlFiles(spark, f"{index.root}/runs").names()) == sorted(r[5:] for r in state["runs"])


def test_a_hot_message_beyond_the_row_limit_and_rounds_by_batch(spark, monkeypatch):
    from driftline.core import scan

    monkeypatch.setattr(scan, "HOT_ROWS", 10)
    rows = [(*r, r[0] // 17) for r in case(8)]
    df = spark.createDataFrame(rows, SCHEMA + ", batch_no int")
    got = [tuple(r) for r in M.surplus_copies(df, work_dir(spark, "h"), 5).collect()]
    assert len(got) == len(set(got)) and set(got) == surplus([r[:6] for r in rows])


def test_the_loser_of_a_race_takes_the_winners_result(spark):
    keyed = spark.createDataFrame(case(5), SCHEMA).select("delivery_no", M.message_digest().alias("digest"))
    index = M.MessageIndex(spark, work_dir(spark, "race"))
    first = {tuple(r) for r in index.absorb(0, keyed).collect()}
    index._commit(0, keyed.limit(3), "b000000000.json", "loser")
    assert {tuple(r) for r in index.absorb(0, keyed).collect()} == first
    assert not any("loser" in n for n in M.ControlFiles(spark, f"{index.root}/runs").names())
