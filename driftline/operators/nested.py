"""Deeply nested records to flat tables, by shared inlining.

First the schema graph of all records is taken: which element occurs in which, and whether repeatedly
(``schema_graph``).  Then ``plan_tables`` decides: an element that is repeated, that occurs in several
parents or that contains itself gets a table of its own; every other element is a singleton of one
parent and becomes columns of the table it sits in.  ``shred`` cuts each record accordingly, and every
row names the row it belongs to.

Elements are known by field name, of any length and spelling.  The entries of ``blocks`` and of any
``children`` are the element ``block``, whether listed in an array or in a map from a parent's id.  An
element with more than MAP_KEYS distinct fields that hold objects is a map with keys chosen by the data:
its entries are one element, named after it with ``.*``.  So the schema graph has at most MAP_KEYS fields
an element, whatever the records hold.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.core.store import cut
from driftline.functions.jsontext import clean, parse

ROOT, BLOCK = "tree", "block"
_OF_BLOCKS = ("blocks", "children")
#: Distinct fields holding objects that an element may have before it counts as a map.
MAP_KEYS = 1000


def element(parent: str, name: str, maps: frozenset[str] | set[str] = frozenset()) -> str:
    """The element that a field of an element holds."""
    if name in _OF_BLOCKS:
        return BLOCK
    return f"{parent}.*" if parent in maps else name


@dataclass(frozen=True)
class Plan:
    """Elements with a table of their own; all others are columns of their only parent.  ``maps``: elements whose keys are data."""

    tables: frozenset[str] = field(default_factory=frozenset)
    inlined: frozenset[str] = field(default_factory=frozenset)
    maps: frozenset[str] = field(default_factory=frozenset)


class _Graph:
    """Edges (parent element, child element, repeated) of the records of a task."""

    def __init__(self, maps: frozenset[str]):
        self.maps = set(maps)
        self.below: dict[str, dict[tuple[str, bool], None]] = {}

    def _add(self, parent: str, child: str, repeated: bool) -> None:
        fields = self.below.setdefault(parent, {})
        fields[child, repeated] = None
        # the twofold leaves room for fields that occur once and repeated
        if len(fields) > 2 * MAP_KEYS and parent not in self.maps:
            self.maps.add(parent)

    def take(self, value) -> None:
        todo = [(ROOT, value)]
        while todo:
            name, obj = todo.pop()
            if not isinstance(obj, dict):
                continue
            for k, v in obj.items():
                kind = element(name, k, self.maps)
                if isinstance(v, dict):
                    if k == "children":
                        for blocks in v.values():
                            if isinstance(blocks, list):
                                self._add(name, BLOCK, True)
                                todo.extend((BLOCK, b) for b in blocks)
                    else:
                        self._add(name, kind, False)
                        todo.append((kind, v))
                elif isinstance(v, list) and any(isinstance(x, dict) for x in v):
                    self._add(name, kind, True)
                    todo.extend((kind, x) for x in v)

    def edges(self) -> list[tuple[str, str, bool]]:
        return sorted((p, c, many) for p, fields in self.below.items() for c, many in fields)


def schema_graph(records: DataFrame, body: str = "body", maps: frozenset[str] = frozenset()) -> DataFrame:
    """The distinct edges of the schema graph over all records: parent, child, repeated.

    Each task sends every edge once, so what is shuffled grows with the number of tasks and of element
    names, not with the records.  Bodies that are no JSON have no edges.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = _Graph(maps)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                ok, value = parse(text)
                if ok:
                    graph.take(value)
        rows = graph.edges()
        safe = lambda i: pa.array([clean(r[i]) for r in rows], pa.string())
        yield pa.RecordBatch.from_arrays([safe(0), safe(1), pa.array([r[2] for r in rows], pa.bool_())], ["parent", "child", "repeated"])

    return records.select(F.col(body).cast("string")).mapInArrow(task, "parent string, child string, repeated boolean").distinct()


def map_elements(edges: DataFrame) -> frozenset[str]:
    """Elements with more than MAP_KEYS distinct fields that hold objects; counted before anything is collected."""
    wide = edges.groupBy("parent").agg(F.count_distinct("child").alias("n")).filter(F.col("n") > MAP_KEYS)
    return frozenset(r.parent for r in wide.select("parent").toLocalIterator())


def plan_tables(edges: list[tuple[str, str, bool]], maps: frozenset[str] = frozenset()) -> Plan:
    """Shared inlining over the schema graph."""
    below: dict[str, set[str]] = {}
    above: dict[str, set[str]] = {}
    repeated = {c for _, c, many in edges if many}
    for p, c, _ in edges:
        below.setdefault(p, set()).add(c)
        above.setdefault(c, set()).add(p)
    recursive = set()
    for start in below:
        seen: set[str] = set()
        todo = list(below[start])
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo.extend(below.get(x, ()))
        if start in seen:
            recursive.add(start)
    shared = {c for c, ps in above.items() if len(ps) > 1}
    # of elements that only contain each other in a cycle, those entered from outside or repeated break it
    entry = {c for c in recursive if c in repeated or c in shared}
    loops = recursive if not entry else entry
    tables = {ROOT} | repeated | shared | loops
    return Plan(frozenset(tables), frozenset(set(above) - tables), maps)


SHREDDED = pa.schema(
    [
        ("tree_no", pa.int64()),
        ("table_name", pa.string()),
        ("row_no", pa.int32()),
        ("parent_table", pa.string()),
        ("parent_row", pa.int32()),
        ("block_id", pa.string()),
        ("parent_id", pa.string()),
        ("field_path", pa.string()),
        ("pos", pa.int32()),
        ("columns", pa.map_(pa.string(), pa.string())),
    ]
)
SHREDDED_DDL = (
    "tree_no bigint, table_name string, row_no int, parent_table string, parent_row int, block_id string, "
    "parent_id string, field_path string, pos int, columns map<string,string>"
)


def _bare(value) -> str:
    return str(value).replace("-", "").lower() if value is not None else ""


def _text(value) -> str | None:
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False)


def shred_record(value, plan: Plan, wanted: frozenset[str] | None = None) -> list[tuple]:
    """The rows of one record.  Row numbers are given in order of the walk, the same on every run."""
    rows: list[tuple] = []
    count = 0
    # element, object, table and row it belongs to, block and parent ids, path from the block, position
    todo = [(ROOT, value, None, None, "", "", "", 0)]
    while todo:
        name, obj, p_table, p_row, block_id, parent_id, path, pos = todo.pop()
        count += 1
        row_no, later = count, []
        cols: dict[str, str | None] = {}
        if not isinstance(obj, dict):
            cols["value"] = _text(obj)
        else:
            if name == BLOCK:
                block_id, path = _bare(obj.get("id")), ""
            inner = [("", path, obj, name)]
            while inner:
                prefix, at, d, own = inner.pop()
                for k, v in d.items():
                    kind, here = element(own, k, plan.maps), f"{at}.{k}" if at else k
                    if kind == BLOCK and isinstance(v, (list, dict)):
                        # children of this block, or blocks listed under a parent's id
                        listed = v.items() if isinstance(v, dict) else [(block_id if name != ROOT else "", v)]
                        for under, blocks in listed:
                            if isinstance(blocks, list):
                                later += [(BLOCK, b, name, row_no, "", _bare(under), "", i) for i, b in enumerate(blocks) if isinstance(b, dict)]
                    elif isinstance(v, dict):
                        if kind in plan.tables or kind not in plan.inlined:
                            later.append((kind, v, name, row_no, block_id, parent_id, here, 0))
                        else:
                            inner.append((f"{prefix}{k}.", here, v, kind))
                    elif isinstance(v, list) and any(isinstance(x, dict) for x in v):
                        later += [(kind, x, name, row_no, block_id, parent_id, here, i) for i, x in enumerate(v)]
                    else:
                        cols[prefix + k] = _text(v)
        if wanted is None or name in wanted:
            rows.append((name, row_no, p_table, p_row, block_id, parent_id, path, pos, cols))
        todo.extend(reversed(later))
    return rows


def shred(records: DataFrame, plan: Plan, tables: set[str] | None = None, key: str = "tree_no", body: str = "body") -> DataFrame:
    """All rows of all tables of the plan, or of ``tables`` only; ``columns`` holds the inlined values as text.

    (tree_no, row_no) is the key of a row, (tree_no, parent_row) the row of ``parent_table`` it belongs to.
    ``block_id`` and ``parent_id`` are the ids of the enclosing block and of the block or listing above
    it ('' at top level), ``field_path`` the path from the block, ``pos`` the index in its array.  Bodies
    that are no JSON give no rows; the same body fetched twice gives its rows for each fetch.
    """
    wanted = frozenset(tables) if tables is not None else None

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for no, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ok, value = parse(text)
                if ok:
                    held.extend((no, *row) for row in shred_record(value, plan, wanted))
                if len(held) > 5000:
                    yield _batch(held)
                    held = []
        if held:
            yield _batch(held)

    return records.select(F.col(key).cast("bigint"), F.col(body).cast("string")).mapInArrow(task, SHREDDED_DDL)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    safe: Callable = lambda x: clean(x) if isinstance(x, str) else x
    for i in (1, 3, 5, 6, 7):
        columns[i] = [safe(x) for x in columns[i]]
    columns[9] = [[(clean(k), safe(v)) for k, v in d.items()] for d in columns[9]]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t.type) for c, t in zip(columns, SHREDDED, strict=True)], schema=SHREDDED)


def flat_table(shredded: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """One table of a shredded frame with chosen columns (absent ones are null)."""
    keys = ["tree_no", "row_no", "parent_table", "parent_row", "block_id", "parent_id", "field_path", "pos"]
    return shredded.filter(F.col("table_name") == name).select(*keys, *[F.col("columns")[c].alias(c.replace(".", "_")) for c in columns])


def analysed_plan(records: DataFrame, body: str = "body") -> Plan:
    """The plan for these records.

    The graph is taken again as long as it shows new maps, usually never; what is collected at last has at
    most MAP_KEYS fields an element.
    """
    maps: frozenset[str] = frozenset()
    while True:
        edges = cut(schema_graph(records, body, maps), "schema-graph")
        more = map_elements(edges) - maps
        if not more:
            return plan_tables([(r.parent, r.child, r.repeated) for r in edges.collect()], maps)
        maps |= more


def text_runs(records: DataFrame, paths: list[str]) -> DataFrame:
    """Non-empty text runs under the given paths of a block: tree_no, block_id, parent_id, field_path, run_pos."""
    plan = analysed_plan(records)
    tables = {element(p.rpartition(".")[0].rpartition(".")[2], p.rpartition(".")[2], plan.maps) for p in paths}
    runs = shred(records, plan, tables)
    text = F.col("columns")["plain_text"]
    return runs.filter(F.col("field_path").isin(paths) & text.isNotNull() & (text != "")).select(
        "tree_no", "block_id", "parent_id", "field_path", F.col("pos").alias("run_pos")
    )


def links(shredded: DataFrame) -> DataFrame:
    """table_name, parent_table, rows, without_parent: how every table hangs below its parents; no row may lack its parent row."""
    rows = shredded.select("tree_no", "table_name", "row_no", "parent_table", "parent_row")
    above = rows.select("tree_no", F.col("table_name").alias("parent_table"), F.col("row_no").alias("parent_row"), F.lit(True).alias("_there"))
    both = rows.filter("parent_table IS NOT NULL").join(above.distinct(), ["tree_no", "parent_table", "parent_row"], "left")
    return both.groupBy("table_name", "parent_table").agg(F.count("*").alias("rows"), F.count_if(F.col("_there").isNull()).alias("without_parent"))
