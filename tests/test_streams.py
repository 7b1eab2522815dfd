"""Growing logs, keyed folds in buckets, cool-downs, lines that hold others up."""

import json
import os

from pyspark.sql import functions as F

from driftline.core.store import ControlFiles, work_dir
from driftline.operators import schedule as S
from driftline.sources import paged, tail
from driftline.streaming import fold


def write(path, lines, end="\n", mode="a"):
    with open(path, mode) as f:
        f.write("".join(f"{x}\n" for x in lines[:-1]) + (lines[-1] + end if lines else ""))


def event(key, at, value, serial=0, deleted=None):
    return json.dumps({"key": key, "at_us": at, "serial": serial, "value": value, "deleted": deleted})


def test_every_split_reads_every_line_once(tmp_path):
    path = str(tmp_path / "log")
    lines = [f"line {k} " + "ä" * (k % 40) for k in range(200)] + [""]
    write(path, lines)
    size = os.path.getsize(path)
    assert tail.whole_lines(path) == size and tail.whole_lines(str(tmp_path / "none")) == 0
    for split in (1, 7, 64, 1000, 10**6):
        reader = tail.TailReader({"path": path, "split": split})
        got = [v for p in reader.partitions({"turn": 0, "at": 0}, reader.latestOffset()) for b in reader.read(p) for v in b.column("value").to_pylist()]
        assert got == lines
    write(path, ["no end yet"], end="")
    assert tail.whole_lines(path) == size
    one = str(tmp_path / "one")
    write(one, ["x" * 200_000], end="")
    assert tail.whole_lines(one) == 0


def test_lines_appended_later_are_folded_and_a_partial_one_waits(spark, tmp_path):
    path, root = str(tmp_path / "log"), work_dir(spark, "tail")
    read = lambda: {r.key: (r.value, r.deleted) for r in fold.fold_stream(spark, path, root, tail=True).collect()}
    write(path, [event("a", 1, "x"), "no json", event("b", 1, "y"), event("c", 5, "z")[:20]], end="")
    assert read() == {"a": ("x", False), "b": ("y", False)}
    write(path, [event("c", 5, "z")[20:], event("a", 3, "x3"), event("a", 2, "x2"), event("b", 9, None, deleted=True)])
    assert read() == {"a": ("x3", False), "b": ("y", True), "c": ("z", False)}
    assert read() == {"a": ("x3", False), "b": ("y", True), "c": ("z", False)}
    dead = [r.value for r in spark.read.text(f"{root}/dead").collect()]
    assert dead == ["no json"]
    # put aside when read to its end, not before; what comes after is read from the new file
    size = os.path.getsize(path)
    assert not tail.rotate(path, size - 1, 10) and not tail.rotate(path, size, 10**9) and tail.rotate(path, size, 10)
    assert [os.path.basename(p) for p in tail.segments(path)] == ["log.000001"]
    write(path, [event("d", 1, "new")])
    assert read()["d"] == ("new", False)
    # rotated although it was behind: the rest is read where it lies now
    write(path, [event("e", 1, "behind")])
    os.rename(path, path + ".000002")
    write(path, [event("f", 1, "after")])
    got = read()
    assert got["e"] == ("behind", False) and got["f"] == ("after", False)
    for k in range(5):
        write(path, [event("g", k, str(k))], mode="w")
        assert tail.rotate(path, os.path.getsize(path), 1)
    assert len(tail.segments(path)) == tail.SEGMENTS


def test_offset_beyond_the_end_reads_nothing(tmp_path):
    path = str(tmp_path / "log")
    write(path, ["a", "b"])
    reader = tail.TailReader({"path": path})
    assert reader.partitions({"turn": 0, "at": 999}, reader.latestOffset()) == []


def test_state_is_rewritten_by_bucket(spark):
    root = work_dir(spark, "state")
    state = fold.BucketedState(spark, root, 8)
    df = lambda rows: spark.createDataFrame(rows, fold.STATE)
    state.fold(df([(f"k{i}", 1, 1, "a", False) for i in range(50)]), 0)
    first = state._versions()[-1]["map"]
    state.fold(df([("k7", 2, 1, "b", False)]), 1)
    second = state._versions()[-1]["map"]
    assert sum(first[b] != second[b] for b in first) == 1
    state.fold(df([("k7", 3, 1, "again", False)]), 1)  # a batch number that was taken
    rows = {r.key: r.value for r in state.read().collect()}
    assert len(rows) == 50 and rows["k7"] == "b" and rows["k8"] == "a"
    for n in range(2, 6):
        state.fold(df([(f"k{i}", n, 1, str(n), False) for i in range(50)]), n)
    folders = [x for x in ControlFiles(spark, root).names() if x.startswith("batch=")]
    assert len(folders) <= 2 and {r.value for r in state.read().collect()} == {"5"}
    state.fold(df([]), 6)
    assert state.read().count() == 50


def test_cool_down_counts_from_the_last_sent(spark):
    h = 3_600_000_000
    rows = [("a", 0), ("a", h - 1), ("a", h), ("a", h + 1), ("a", 2 * h + 5), ("b", 7), ("a", None), ("b", 7)]
    got = fold.throttled(spark, spark.createDataFrame(rows, "bucket string, at_us bigint"), work_dir(spark, "t"), slice_rows=3)
    assert {tuple(r) for r in got.collect()} == {("a", 0, 0), ("a", h, 1), ("a", 2 * h + 5, 1), ("b", 7, 0)}
    assert fold.throttled(spark, spark.createDataFrame([], "bucket string, at_us bigint"), work_dir(spark, "t")).count() == 0


def test_head_of_line(spark):
    rows = [(1, "ok", 0), (2, "permanent", 0), (3, "transient", 5), (4, "transient", 2), (5, "ok", 0), (6, "permanent", 0)]
    ddl = "no int, outcome string, tries int"
    got = {r.no: r.verdict for r in S.head_of_line(spark.createDataFrame(rows, ddl), "no", 6).collect()}
    assert got == {1: "done", 2: "skipped", 3: "abandoned", 4: "held", 5: "waiting", 6: "waiting"}
    assert {r.verdict for r in S.head_of_line(spark.createDataFrame(rows[:3], ddl), "no", 6).collect()} == {"done", "skipped", "abandoned"}


def test_drain_takes_leftovers_first_and_each_key_once(spark):
    ddl = "key string, no int"
    left, live = spark.createDataFrame([("b", 9), ("x", 8)], ddl), spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), (None, 4)], ddl)
    got = {r.key: (r.turn, r.asked, r.outcome) for r in S.drain(left, live, spark.createDataFrame([("a",), ("b",)], "key string")).collect()}
    assert got == {"x": (0, 1, "dropped"), "b": (1, 2, "done"), "a": (2, 2, "done")}


def test_last_event_of_each(spark):
    e = spark.createDataFrame([("a", 1, "created"), ("a", 2, "deleted"), ("b", 5, "created"), ("c", 3, "deleted"), ("c", 3, "created")], "id string, us int, event string")
    assert {r.id: r.seeds for r in S.last_events(e, "id", "us", "event").collect()} == {"a": "strike", "b": "discovery", "c": "strike"}


def test_paged_source_over_several_files(spark, tmp_path):
    spark.dataSource.register(paged.PagedSource)
    df = spark.range(5000).select("id", F.timestamp_micros(F.col("id") % 700 * 1_000_000).cast("timestamp_ntz").alias("ts"), F.lit("x").alias("v"))
    df = df.unionByName(spark.createDataFrame([(9999, None, "no time")], "id bigint, ts timestamp_ntz, v string"))
    df.repartition(5).write.option("parquet.block.size", 4096).parquet(f"{tmp_path}/t.parquet")
    got = spark.read.format("paged").schema("id bigint, v string").options(path=f"{tmp_path}/t.parquet", key="id", at="ts", cap="100", windowRows="600").load()
    assert got.rdd.getNumPartitions() > 3
    assert sorted(r.id for r in got.collect()) == list(range(5000))


def test_paged_source_of_an_empty_table(spark, tmp_path):
    spark.dataSource.register(paged.PagedSource)
    spark.createDataFrame([], "id bigint, ts timestamp_ntz").write.parquet(f"{tmp_path}/e.parquet")
    assert spark.read.format("paged").schema("id bigint").options(path=f"{tmp_path}/e.parquet", key="id", at="ts").load().count() == 0
