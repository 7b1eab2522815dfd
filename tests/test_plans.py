"""Registered queries over small tables made here."""

import datetime as dt

from driftline.operators import markdown as MD
from driftline.plans import files, schedule


def tables(spark, folder, **made):
    for name, (rows, ddl) in made.items():
        spark.createDataFrame(rows, ddl).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_table_render_reads_a_null_as_live(spark, tmp_path):
    d = tables(spark, tmp_path, pages_metadata=([("page_id", True), ("page_id", None), ("page_id", False), ("workspace", None)], "parent_type string, archived boolean"))
    assert files.table_render(spark, d).first().markdown.split("\n")[2:] == ["| page_id | 1 | 2 |", "| workspace | 0 | 1 |"]


def test_link_rewrite_takes_every_kind_of_target(spark, tmp_path):
    t = dt.datetime(2025, 1, 1)
    payloads = ['{"page_id": "p1"}', '{"database_id": "D-1"}', '{"page_id": "d1"}', '{"database_id": "p1"}', '{"comment_id": "c-1"}', '{"database_id": "d2"}', '{"page_id": null}', '{"page_id": "", "database_id": "d9"}']
    d = tables(
        spark, tmp_path,
        pages_metadata=([("P-1", "Plan", "2025-01-01T00:00:00Z", t, 1)], "id string, title string, last_edited_time string, swept_at timestamp, delivery_no bigint"),
        databases=([("d1", "Tasks", None), ("d2", "Old", t)], "db_id string, title string, deleted_at timestamp"),
        blocks=([(i, "link_to_page", p) for i, p in enumerate(payloads)], "block_no bigint, block_type string, payload string"),
    )
    got = {r.block_no: r.link for r in files.link_rewrite(spark, d).collect()}
    tasks, plan = "workspace/_databases/Tasks d1", "workspace/Plan p1.md"
    assert got == {0: plan, 1: tasks, 2: tasks, 3: plan, 4: "c1", 5: "d2", 7: "d9"}


def test_blocks_nested_twenty_levels_deep_are_owned(spark, tmp_path):
    rows = [("p", f"b{i}", f"b{i - 1}" if i else None, 0, i) for i in range(20)] + [("p", "x", "y", 0, 20), ("p", "y", "x", 0, 21), ("p", "z", "gone", 0, 22)]
    d = tables(spark, tmp_path, blocks=(rows, "page_id string, block_id string, parent_id string, pos int, block_no bigint"))
    assert {r.id: r.level for r in schedule.tree_order(spark, d).collect()} == {f"b{i}": i for i in range(20)}
    assert {r.owned: r.blocks for r in schedule.ownership(spark, d).collect()} == {True: 20, False: 3}
    assert [tuple(r) for r in schedule.nesting_depth(spark, d).collect()] == [("p", 19, 20)]


def test_a_marked_run_with_a_blank_at_its_edge_keeps_its_marks():
    runs = [{"plain_text": "hello ", "annotations": {"bold": True}}, {"plain_text": "world", "href": "https://x.org"}]
    assert MD.inline(runs) == "**hello** [world](https://x.org)"
    assert MD.visible(MD.parse_inline(MD.inline(runs))) == MD.visible(runs) != MD.visible([{"plain_text": "hello world"}])
