import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from driftline.core.store import work_dir
from driftline.operators.ledger import DONE, LEASED, PENDING, Busy, Ledger, StaleToken, process_increments, replay_runs, run_spans, span_of
from driftline.plans.problems import tracked_fields

T0 = dt.datetime(2026, 1, 1)
PAGES = "delivery_no bigint, swept_at timestamp, id string, title string, parent_id string, last_edited_time string, archived boolean, in_trash boolean, place int, run_no int"
RUNS = "run_no int, started_at timestamp, ended_at timestamp, outcome string"


def test_lease_expires_and_stale_writer_is_refused(spark):
    for led in (Ledger(), Ledger(spark, work_dir(spark, "led"))):
        led.enqueue([1, 2])
        t1, got = led.lease(7, 100, 10)
        assert got == [1, 2] and led.lease(8, 105, 10)[1] == []
        t2, again = led.lease(8, 110, 10)
        assert again == [1, 2] and t2 > t1
        with pytest.raises(StaleToken):
            led.complete(t1, [1])
        led.complete(t2, [1])
        led.complete(t2, [1])  # telling it twice changes nothing
        assert [led.items()[i].state for i in (1, 2)] == [DONE, LEASED]
        led.release(t2)
        assert led.items()[2].state == PENDING
        led.enqueue([1, 2, 3])
        assert led.items()[1].state == DONE and led.items()[3].state == PENDING


def test_create_is_won_once(spark):
    led = Ledger(spark, work_dir(spark, "race"))
    assert led.files.create("x", "a") and not led.files.create("x", "b") and led.files.read("x") == "a"


def test_failed_and_killed_runs_leave_their_items_to_the_next(spark):
    runs = [(1, 10, 11, "ok"), (2, 20, 21, "failed"), (3, 30, None, "killed"), (4, 40, 41, "ok"), (5, 50, None, "killed")]
    owner = replay_runs(Ledger(), runs)
    assert owner == {0: 1, 1: 4, 2: 4, 3: 4}
    assert run_spans(owner, [r[1] for r in runs]) == [(10, 1), (40, 4)]


def test_span_of_equals_counting(spark):
    r = random.Random(1)
    for bounds in ([5], sorted(r.sample(range(1000), 40)), [1, 1, 1, 9], [0, 10**15]):
        xs = [-1, *bounds, *[b + 1 for b in bounds], bounds[-1] + 5, *(r.randint(-5, 1005) for _ in range(50))]
        got = spark.createDataFrame([(x,) for x in xs], "x bigint").select("x", span_of(F.col("x"), bounds).alias("n")).collect()
        assert all(g.n == sum(b < g.x for b in bounds) for g in got)


def brute(pages, runs):
    seen, out, before = [r for r in pages if r[1] is not None and r[2] is not None], set(), {}
    for no, start, _, outcome in sorted(runs, key=lambda r: r[1]):
        if outcome != "ok":
            continue
        now = {}
        for r in seen:
            if r[1] <= start:
                k = r[2].replace("-", "").lower()
                rank = (r[5] is not None, r[5] or "", r[1], r[0])
                if k not in now or rank > now[k][0]:
                    now[k] = (rank, (r[5], r[3], (r[4] or None) and r[4].replace("-", ""), bool(r[6]), bool(r[7])))
        out |= {(no, k) for k, v in now.items() if k not in before or before[k][1] != v[1]}
        before = now
    return out


def case(seed, n=150):
    r = random.Random(seed)
    ids = ["%032x" % k for k in range(8)]
    when = lambda: T0 + dt.timedelta(minutes=r.randint(0, 10_000))
    pages = [
        (k, r.choice([when(), when(), None]), r.choice([*ids, None, ids[0], ids[0], ids[0].upper()]), r.choice(["a", "b", None]), r.choice(["p", "q", "p-"]).replace("-", ""),
         r.choice([None, "2026-01-01T00:00:00.000Z", "2026-01-02T00:00:00.000Z"]), r.choice([None, False, True]), r.choice([False, False, True]), 1, 1)
        for k in range(n)
    ]
    runs = [(k, T0 + dt.timedelta(minutes=1000 * k), T0 if k % 3 else None, r.choice(["ok", "ok", "failed", "killed"])) for k in range(1, 9)]
    return pages, runs


def test_equals_brute_force(spark):
    for seed in range(3):
        pages, runs = case(seed)
        out = process_increments(spark.createDataFrame(pages, PAGES), spark.createDataFrame(runs, RUNS), work_dir(spark, "inc"), tracked_fields())
        rows = [tuple(r) for r in out.collect()]
        assert len(rows) == len(set(rows)) and set(rows) == brute(pages, runs)


def test_a_crash_before_completion_is_repeated_without_doubling(spark):
    pages, runs = case(5)
    p, s, root = spark.createDataFrame(pages, PAGES), spark.createDataFrame(runs, RUNS), work_dir(spark, "crash")
    process_increments(p, s, root, tracked_fields(), ttl_s=0)
    # the first call's completion is lost: its items are leased and the lease has run out
    led = Ledger(spark, f"{root}/ledger")

    def forget(token, items):
        for x in items.values():
            x.state, x.expires = LEASED, 0
        return token, None

    led._change(forget)
    rows = [tuple(r) for r in process_increments(p, s, root, tracked_fields()).collect()]
    assert len(rows) == len(set(rows)) and set(rows) == brute(pages, runs)


def test_an_expired_writer_changes_nothing(spark, monkeypatch):
    from driftline.operators import ledger as L

    pages, runs = case(6)
    p, s, root = spark.createDataFrame(pages, PAGES), spark.createDataFrame(runs, RUNS), work_dir(spark, "stale")
    whole, slow = brute(pages, runs), L.changed_pages

    def overtaken(records, spans, tracked):
        # while this writer works its lease runs out, and another does everything
        monkeypatch.setattr(L, "changed_pages", slow)
        rows = [tuple(r) for r in process_increments(p, s, root, tracked, worker=2).collect()]
        assert set(rows) == whole
        return slow(records.limit(0), spans, tracked)

    monkeypatch.setattr(L, "changed_pages", overtaken)
    with pytest.raises(StaleToken):
        process_increments(p, s, root, tracked_fields(), ttl_s=0, worker=1)
    rows = [tuple(r) for r in process_increments(p, s, root, tracked_fields()).collect()]
    assert len(rows) == len(whole) and set(rows) == whole


def test_a_busy_lease_raises_and_a_failed_writer_gives_its_lease_up(spark, monkeypatch):
    from driftline.operators import ledger as L

    pages, runs = case(7)
    p, s, root = spark.createDataFrame(pages, PAGES), spark.createDataFrame(runs, RUNS), work_dir(spark, "busy")
    led = Ledger(spark, f"{root}/ledger")
    led.enqueue([r[0] for r in runs])
    token, _ = led.lease(9, 2**40, 10)
    with pytest.raises(Busy):
        process_increments(p, s, root, tracked_fields())
    led.release(token)
    good = L.changed_pages
    monkeypatch.setattr(L, "changed_pages", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        process_increments(p, s, root, tracked_fields())
    monkeypatch.setattr(L, "changed_pages", good)
    # what a crashed writer left under its token is never read, and goes
    spark.createDataFrame([("left", 1)], "page_id string, run_no int").write.partitionBy("run_no").parquet(f"{root}/out/token=1")
    assert {tuple(r) for r in process_increments(p, s, root, tracked_fields()).collect()} == brute(pages, runs)
    assert "token=1" not in L.ControlFiles(spark, f"{root}/out").names()


def test_control_files_of_other_stores(spark):
    files = Ledger(spark, work_dir(spark, "other")).files
    files._local = False
    assert files.create("x", "a") and not files.create("x", "b") and files.read("x") == "a"
    files._renames = True
    assert files.create("y", "é") and files.read("y") == "é" and files.names() == ["x", "y"]


def test_no_rows_and_no_successful_run(spark):
    p, s = spark.createDataFrame([], PAGES), spark.createDataFrame([(1, T0, None, "killed"), (None, T0, None, "ok")], RUNS)
    assert process_increments(p, s, work_dir(spark, "none"), tracked_fields()).count() == 0
    ok = spark.createDataFrame([(1, T0, None, "ok")], RUNS)
    assert process_increments(p, ok, work_dir(spark, "none"), tracked_fields()).count() == 0
