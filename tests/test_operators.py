import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from driftline.core.store import work_dir
from driftline.functions import cells
from driftline.functions import text as X
from driftline.operators import changes as C
from driftline.operators import quality as Q
from driftline.operators import schedule as S
from driftline.operators import tree as T
from driftline.sources import files, paged, sinks
from driftline.streaming import fold


def test_first_snapshot_adds_nothing(spark):
    new = spark.createDataFrame([("a", "1"), ("b", None)], "k string, v string")
    assert {r.change for r in C.snapshot_diff(new.limit(0), new, "k", ["v"]).collect()} == {"changed"}
    old = spark.createDataFrame([("a", ""), ("c", "x"), ("b", None)], "k string, v string")
    assert {r.k: r.change for r in C.snapshot_diff(old, new, "k", ["v"]).collect()} == {"a": "changed", "b": "same", "c": "deleted"}


def test_positions_number_every_row_once(spark):
    r = random.Random(1)
    vals = [r.randint(0, 50) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(vals)), "i int, v int").repartition(7)
    rows = sorted(C.positions(df, [F.col("v"), F.col("i")]).collect(), key=lambda x: x.pos)
    assert [x.pos for x in rows] == list(range(500)) and [(x.v, x.i) for x in rows] == sorted((v, i) for i, v in enumerate(vals))
    assert C.positions(df.limit(0), [F.col("v")]).count() == 0


def test_column_resolution():
    got = C.resolve_columns(["a", "b", "c"], ["a", "x"], ["a", "c", "y"])
    assert got == [("a", 0, "kept"), ("c", 1, "schema only"), ("y", 2, "added"), ("x", 3, "added"), ("b", -1, "dropped")]
    with pytest.raises(ValueError):
        C.union_sources([])


def test_spread_and_floor_boundaries(spark):
    rows = [(f"k{n}", f"h{i}") for n in (26, 30, 31, 62) for i in range(n)] * 2
    sp = Q.spread(spark.createDataFrame(rows, "key string, home string"), "key", "home")
    assert {r.key for r in Q.spread_breaches(sp, "key").collect()} == {"k31", "k62"}
    base = spark.createDataFrame([("k31", 31), ("k62", 61)], "key string, allowed int")
    assert {r.key for r in Q.spread_breaches(sp, "key", 30, base).collect()} == {"k62"}
    make = lambda d: spark.createDataFrame([(k,) for k, n in d.items() for _ in range(n)], "t string")
    before, after = make({"at": 100, "under": 100, "small": 19, "gone": 50, "same": 20}), make({"at": 60, "under": 59, "small": 1, "new": 9, "same": 20})
    assert {r.t for r in Q.row_floor(before, after, "t").collect()} == {"under"}


def test_exclusions_are_refused_as_a_whole(spark):
    ok = spark.createDataFrame([("a", "no_access", None), ("b", "deliberate", "why")], "id string, reason string, note string")
    assert Q.checked_exclusions(ok).count() == 2
    for bad in (("c", "because", "x"), ("d", "deliberate", " "), ("e", None, None)):
        with pytest.raises(Exception, match="refused"):
            Q.checked_exclusions(spark.createDataFrame([bad], "id string, reason string, note string")).collect()


def test_run_floor_never_falls_on_a_bad_run(spark):
    now = spark.createDataFrame([("a", 90), ("b", 89), ("d", 5)], "k string, n int")
    floors = spark.createDataFrame([("a", 100), ("b", 100), ("c", 7)], "k string, floor int")
    got = {r.k: (r.verdict, r.next_floor) for r in Q.run_floor(now, floors, "k").collect()}
    assert got == {"a": ("ok", 90), "b": ("inconclusive", 100), "c": ("inconclusive", 7), "d": ("ok", 5)}


def test_group_positions_with_null_keys(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), (None, 5), (None, 4), ("b", 1)], "k string, v int")
    got = {(r.k, r.v): r.rn for r in S.group_positions(df, ["k"], ["v"]).collect()}
    assert got == {("a", 1): 1, ("a", 3): 2, (None, 4): 1, (None, 5): 2, ("b", 1): 1}


def test_audit_share_takes_never_seen_first(spark):
    pop = spark.createDataFrame([(f"p{i:02d}", None if i > 58 else i) for i in range(61)], "id string, last int")
    assert {r.id for r in S.oldest_share(pop, "last", "id", 30).collect()} == {"p59", "p60", "p00"}


def test_climb_walk_and_reach_survive_cycles(spark):
    nodes = spark.createDataFrame([("a", "b"), ("b", "db"), ("x", "y"), ("y", "x"), ("n", None), ("d6", "d5"), ("d5", "d4"), ("d4", "d3"), ("d3", "d2"), ("d2", "d1"), ("d1", "db")], "id string, parent string")
    got = {r.id: (r.ancestor, r.steps) for r in T.climb(nodes, spark.createDataFrame([("db",)], "id string"), 5).collect()}
    assert got["a"] == ("db", 2) and got["x"] == (None, None) and got["n"] == (None, None) and got["d5"] == ("db", 5) and got["d6"] == (None, None)
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("z", "q"), (None, "a")], "src string, dst string")
    assert {r.id: r.level for r in T.reachable(edges, spark.createDataFrame([("a",)], "id string")).collect()} == {"a": 0, "b": 1, "c": 2}


def test_reach_has_no_last_level(spark):
    chain = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(20)] + [("n20", "n3")], "src string, dst string")
    got = {r.id: r.level for r in T.reachable(chain, spark.createDataFrame([("n0",)], "id string")).collect()}
    assert got == {f"n{i}": i for i in range(21)}


def test_cells(spark):
    want = {
        '{"type":"number","number":5.0}': "5.0", '{"type":"number","number":null}': "", '{"type":"title","title":[{"plain_text":"a"},{"plain_text":"b"}]}': "ab", '{"type":"rich_text","rich_text":"odd"}': "",
        '{"type":"select","select":null}': "", '{"type":"status","status":{"name":"Done"}}': "Done", '{"type":"multi_select","multi_select":[{"name":"x"},{"name":"y"}]}': "x, y",
        '{"type":"date","date":{"start":"2026-01-01","end":"2026-01-02"}}': "2026-01-01 → 2026-01-02", '{"type":"date","date":null}': "", '{"type":"people","people":[{"id":"1","name":""},{"id":"2","name":"B"}]}': "1, B",
        '{"type":"files","files":[{"name":"","external":{"url":"u"}},{"name":"n"}]}': "u, n", '{"type":"checkbox","checkbox":true}': "true", '{"type":"relation","relation":[{"id":"a"},{"id":"b"}]}': "a, b",
        '{"type":"unique_id","unique_id":{"prefix":null,"number":7}}': "7", '{"type":"unique_id","unique_id":{"prefix":"P","number":7}}': "P-7", '{"type":"verification","verification":{"state":"ok"}}': "ok", '{"type":"button","button":{}}': "{}",
        '{"type":"formula","formula":{"type":"boolean","boolean":true}}': "True", '{"type":"formula","formula":{"type":"string","string":null}}': "None", '{"type":"rollup","rollup":{"type":"number","number":2.5}}': "2.5",
        '{"type":"rollup","rollup":{"type":"array","array":[{"type":"title","title":[{"plain_text":"a"}]},{"type":"select","select":null},{"type":"number","number":3}]}}': "a | 3", '{"type":"rollup","rollup":{"type":"incomplete"}}': "",
        "not json": "not json", '{"type":"created_by","created_by":{"id":"1","name":"A"}}': "A",
    }
    df = spark.createDataFrame([(k,) for k in [*want, None]], "p string").select("p", cells.full_cell("p").alias("c"))
    got = {r.p: r.c for r in df.collect()}
    assert {k: got[k] for k in want} == want and got[None] == ""


def test_scalars(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(X.file_name(F.lit(" ..a/b:c. "))) == "a b c" and one(X.file_name(F.lit("..."))) == "untitled" and one(X.slug(F.lit("--Héllo  World--"))) == "h-llo-world"
    assert one(X.dashed(F.lit("0" * 32))) == "00000000-0000-0000-0000-000000000000" and one(X.dashed(F.lit("short"))) == "short"
    assert one(X.time_span(F.lit("2026-01-01T09:00"), F.lit("2026-01-01T10:00"))) == "2026-01-01T09:00 → 10:00" and one(X.time_span(F.lit("2026-01-01"), F.lit(None).cast("string"))) == "2026-01-01"
    assert one(X.strip_credentials(F.lit("https://h/p?a=1&X-Amz-Sig=2&token=3&b=4#f"))) == "https://h/p?a=1&b=4#f" and one(X.strip_credentials(F.lit("https://h/p?sig=1"))) == "https://h/p"
    assert one(X.unescape_md(X.escape_md(F.lit("a*b_[c]\\")))) == "a*b_[c]\\" and one(X.text_key(F.lit(" a  b (resolved 2026-01-01) `c:ab12`"))) == "a b"
    assert one(X.endpoint_class(F.lit("/v1/blocks/x/children"))) == "block_children" and one(X.endpoint_class(F.lit("/nowhere"))) == "other"


def test_files(spark):
    path = work_dir(spark, "csv")
    rows = spark.createDataFrame([("1", 'a "q", b\r\nc'), ("2", ""), ("3", " pad ")], "_row_id string, v string")
    sinks.write_table_csv(rows, path, [F.col("_row_id")])
    assert sorted((r._row_id, r.v) for r in files.read_table_csv(spark, path, ["_row_id", "v"]).collect()) == [("1", 'a "q", b\r\nc'), ("2", ""), ("3", " pad ")]
    log = work_dir(spark, "log")
    spark.createDataFrame([('{"id":"a","line_no":1,"v":"x"}',), ("broken",), ('{"id":"b","line_no":2,"v":"y"}',), ('{"id":"a","line_no":3,"v":"z"}',)], "value string").write.text(log)
    assert sorted(map(tuple, files.read_jsonl(spark, log, "id string, line_no bigint, v string", "id").collect())) == [("a", 3, "z", 1), ("b", 2, "y", 2)]
    assert files.read_state(spark, work_dir(spark, "absent")).count() == 0
    state = work_dir(spark, "state")
    spark.createDataFrame([('{"a": "1"}',)], "value string").write.text(state)
    assert [tuple(r) for r in files.read_state(spark, state).collect()] == [("a", "1")]
    conf = spark.createDataFrame([(0, 1, "A=1"), (0, 2, "export A='2'"), (1, 1, 'B="x y"'), (0, 3, "# C=1"), (0, 9, "B=low")], "priority int, line_no int, text string")
    assert {r.key: r.value for r in files.config_rows(conf).collect()} == {"A": "2", "B": "x y"}
    doc = spark.createDataFrame([("k", "head\n\n## One `ab`\n- x\n\n## Two\nbody\n")], "k string, t string")
    assert [tuple(r)[1:] for r in files.document_sections(doc, "k", "t").orderBy("section_no").collect()] == [(0, None, None, "head\n"), (1, "One", "ab", "- x"), (2, "Two", None, "body")]
    reg = spark.createDataFrame([("a\n<!-- r -->\nin\n<!-- /r -->\nz",), ("a\n## R\nrest",), ("none",)], "t string")
    assert [r[0] for r in reg.select(files.document_region("t", "r", "## R")).collect()] == ["in", "rest", None]


def test_versions_and_upsert(spark):
    t = sinks.VersionedTable(spark, work_dir(spark, "t"))
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert t.read("k string, v int").count() == 0 and t.write(df, only_if_changed=True) == 1 and t.write(df.orderBy(F.desc("k")), only_if_changed=True) == 1
    up = sinks.upsert(df, spark.createDataFrame([("b", 9), ("c", None)], "k string, v int"), "k")
    assert t.write(up, only_if_changed=True) == 2 and sorted(map(tuple, t.read().collect())) == [("a", 1), ("b", 9), ("c", None)]
    assert t.write(df, version=2) == 2 and t.read().count() == 3


def test_capped_scan_is_complete_or_refuses():
    def server(times, cap):
        rows = sorted(enumerate(times), key=lambda r: (r[1] is None, r[1] or 0, r[0]))
        return lambda since: [r for r in rows if since is None or (r[1] is not None and r[1] >= since)][:cap]

    scan = lambda times, cap=8: [r[0] for r in paged.complete_scan(server(times, cap), cap, lambda r: r[0], lambda r: r[1])]
    for times in ([], [1] * 5, list(range(12)), [1, 2, 3, 4, 5, 6, 7, 7, 7, 8, 9, 10], list(range(8))):
        assert sorted(scan(times)) == list(range(len(times)))
    with pytest.raises(paged.Truncated):
        scan([5] * 9)
    with pytest.raises(paged.Truncated):
        scan([1] * 4 + [None] * 9)
    waits, left = [], [paged.Busy(3), paged.Busy(), paged.Busy()]

    def call():
        if left:
            raise left.pop(0)
        return "ok"

    assert paged.paced(call, wait=waits.append) == "ok" and waits[0] == 3 and len(waits) == 3
    assert list(paged.pages(lambda c: ([1, 2], "x") if c is None else ([3], None))) == [1, 2, 3]


def test_streamed_fold_equals_one_batch_and_survives_a_rerun(spark):
    root = work_dir(spark, "s")
    rows = [json.dumps({"key": f"k{i % 5}", "at_us": i * 7 % 13, "serial": i, "value": str(i), "deleted": i == 17}) for i in range(40)]
    bad = ["broken", '{"at_us": 1}', "[]"]
    spark.createDataFrame([(x,) for x in rows[:20] + bad], "value string").repartition(3).write.text(f"{root}/log")
    fold.fold_stream(spark, f"{root}/log", root, 1)
    spark.createDataFrame([(x,) for x in rows[20:] + rows[:5]], "value string").write.mode("append").text(f"{root}/log")
    got = sorted(map(tuple, fold.fold_stream(spark, f"{root}/log", root, 1).collect()))
    batch = spark.createDataFrame([(x,) for x in rows], "value string").select(F.from_json("value", fold.STATE).alias("e")).select("e.*")
    assert got == sorted(map(tuple, fold.fold_batch(spark.createDataFrame([], fold.STATE), batch).collect()))
    assert sorted(r.value for r in spark.read.option("recursiveFileLookup", True).text(f"{root}/dead").collect()) == sorted(bad)
    assert sorted(map(tuple, fold.fold_stream(spark, f"{root}/log", root, 1).collect())) == got


def test_streamed_throttle_and_queue(spark):
    root = work_dir(spark, "th")
    hour = 3_600_000_000
    at = [0, 1, hour - 1, hour, hour + 5, 3 * hour]
    spark.createDataFrame([("b", x) for x in at] + [("c", 5)], "bucket string, at_us bigint").coalesce(1).write.json(f"{root}/in")
    stream = spark.readStream.schema("bucket string, at_us bigint").json(f"{root}/in")
    q = fold.rolling_throttle(stream).writeStream.format("memory").queryName("throttled").outputMode("append").option("checkpointLocation", f"{root}/cp").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("throttled").collect())) == [("b", 0, 0), ("b", hour, 2), ("b", 3 * hour, 1), ("c", 5, 0)]
    stamped = stream.withColumn("ts", F.timestamp_micros("at_us"))
    q = fold.queue(stamped, "bucket", "ts").writeStream.format("memory").queryName("queued").outputMode("append").option("checkpointLocation", f"{root}/cq").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.bucket for r in spark.table("queued").collect()) == ["b", "c"]
    tries = fold.Attempts(spark, work_dir(spark, "tries"), 2)
    assert [tries.failed("x") for _ in range(3)] == [False, False, True]
    tries.succeeded("x")
    assert tries.failed("x") is False
    fold.route(spark.createDataFrame([("comment.new", dt.date(2026, 1, 1)), ("page.x", None)], "type string, d date"), [("comments", "type like 'comment.%'")], root + "/q", 0)
    assert {r.queue for r in spark.read.parquet(root + "/q/batch=0").collect()} == {"comments", "unrouted"}


def test_paged_restart_and_batches():
    calls = []

    def query(cursor):
        calls.append(cursor)
        if cursor == "x" and calls.count("x") == 1:
            raise paged.StaleCursor
        return ([1, 2], "x") if cursor is None else ([3], None)

    assert list(paged.sweep(query)) == [1, 2, 1, 2, 3]
    assert list(paged.in_batches(iter(range(5)), lambda ids: {i: i * 2 for i in ids if i != 3}, 2)) == [(0, 0), (1, 2), (2, 4), (3, None), (4, 8)]


def test_ids_and_signatures(spark):
    import hashlib
    import hmac

    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(X.parse_ids(F.lit(f" {'A' * 32}, {'b' * 8}-{'b' * 24}\n"))) == ["a" * 32, "b" * 32]
    with pytest.raises(Exception, match="no valid id"):
        one(X.parse_ids(F.lit("abc")))
    for secret in ("s", "k" * 100):
        good = "sha256=" + hmac.new(secret.encode(), "bödy".encode(), hashlib.sha256).hexdigest()
        assert one(X.signature_matches(F.lit("bödy"), F.lit(good), secret)) is True
        assert one(X.signature_matches(F.lit("body"), F.lit(good), secret)) is False and one(X.signature_matches(F.lit("x"), F.lit(None).cast("string"), secret)) is False


def test_corpus_lines_metadata_sinks_and_index(spark):
    import os

    root = work_dir(spark, "corpus")
    plain = root.removeprefix("file://")
    for name, text in (("a/x.md", "one\ntwo"), ("b.partial/y.md", "no"), ("z.txt", "no")):
        os.makedirs(os.path.dirname(f"{plain}/{name}"), exist_ok=True)
        with open(f"{plain}/{name}", "w") as f:
            f.write(text)
    assert sorted((r.line_no, r.text) for r in files.corpus_lines(spark, root).collect()) == [(1, "one"), (2, "two")]
    meta = spark.createDataFrame([("b", "page"), ("a", "row"), ("c", "page")], "id string, kind string")
    sinks.write_metadata(meta, root + "/meta", [F.col("id")], F.col("kind") == "page", ["id"])
    assert [(r.line_no, r.id) for r in spark.read.json(root + "/meta/meta_jsonl").orderBy("line_no").collect()] == [(0, "a"), (1, "b"), (2, "c")]
    assert sorted(r.id for r in spark.read.csv(root + "/meta/content_tsv", sep="\t", header=True).collect()) == ["b", "c"]
    i = "a" * 32
    paths = spark.createDataFrame([(f"t {i}.csv",), (f"w/p {i}.md",), (f"_schema {i}.md",), (f"x.partial/{i}",), (f"folder {i}",), ("none.md",)], "path string")
    assert sorted(r.kind for r in files.artifact_index(paths).collect()) == ["document", "folder", "table"]
    got = S.failures_since_success(spark.createDataFrame([("j", 1, "ok"), ("j", 2, "bad"), ("j", 3, "bad"), ("k", 1, "bad"), ("m", 5, "ok")], "k string, t int, o string"), ["k"], "t", F.col("o") == "ok", F.col("o") == "bad")
    assert {r.k: (r.last_ok, r.failures) for r in got.collect()} == {"j": (1, 2), "k": (None, 1), "m": (5, 0)}
