"""Processing only new or changed records: a ledger of work items with leases and fencing tokens.

A work item is a span of arrival times.  It is ``pending``, ``leased`` or ``done``.  A worker leases
all pending items, does them in one Spark job, writes the result to ``out/token=T/run_no=N``, and marks the
items done with its token T: only then is the folder published, for readers take the folders of tokens
that have done items.  A lease that runs out returns its items to ``pending``; a worker whose token is no
longer the current one of an item is refused, and what it wrote stays unpublished.  The path is fixed by
item and token, so a write that is repeated under a token replaces its own rows and no one else's.

The ledger itself is control data, bounded by the number of runs: one JSON document per version,
version N+1 is created only if no one else created it, so every transition is a compare-and-swap.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.core.store import ControlFiles
from driftline.functions.keys import micros, norm_id
from driftline.operators.versions import precedence

PENDING, LEASED, DONE = "pending", "leased", "done"


class StaleToken(Exception):
    """The writer's lease is not the current one of the item."""


class Busy(Exception):
    """Items are leased by another worker, so the result is not whole yet."""


@dataclass
class Item:
    item: int
    state: str = PENDING
    token: int = 0
    worker: int | None = None
    expires: int | None = None


class Ledger:
    """Work items at a path of the shared folder, or in memory if there is none.  Times are integers of any one clock."""

    def __init__(self, spark: SparkSession | None = None, root: str | None = None):
        self.files = ControlFiles(spark, root) if root else None
        self._memory: tuple[int, dict[int, Item]] = (0, {})

    def _load(self) -> tuple[int, int, dict[int, Item]]:
        if self.files is None:
            return 0, *self._memory
        while True:
            names = [n for n in self.files.names() if n.startswith("v")]
            if not names:
                return 0, 0, {}
            try:
                doc = json.loads(self.files.read(names[-1]))
            except Exception:
                if self.files.exists(names[-1]):
                    raise
                continue  # a later version was written and this one removed since the listing
            return int(names[-1][1:-5]), doc["token"], {int(k): Item(**v) for k, v in doc["items"].items()}

    def _change(self, step: Callable[[int, dict[int, Item]], tuple[int, object]]) -> object:
        while True:
            version, token, items = self._load()
            token, result = step(token, items)
            if self.files is None:
                self._memory = (token, items)
                return result
            doc = json.dumps({"token": token, "items": {k: asdict(v) for k, v in items.items()}})
            if self.files.create(f"v{version + 1:09d}.json", doc):
                if version > 1:
                    self.files.delete(f"v{version - 1:09d}.json")
                return result

    def items(self) -> dict[int, Item]:
        return self._load()[2]

    def enqueue(self, new: list[int]) -> None:
        """Add items as pending; known ones stay as they are."""

        def step(token, items):
            for i in new:
                items.setdefault(i, Item(i))
            return token, None

        self._change(step)

    def lease(self, worker: int, now: int, ttl: int, only: set[int] | None = None) -> tuple[int, list[int]]:
        """All pending items (expired leases count as pending), under a new fencing token."""

        def step(token, items):
            token += 1
            got = []
            for x in items.values():
                if x.state == LEASED and x.expires is not None and x.expires <= now:
                    x.state, x.worker, x.expires = PENDING, None, None
                if x.state == PENDING and (only is None or x.item in only):
                    x.state, x.token, x.worker, x.expires = LEASED, token, worker, now + ttl
                    got.append(x.item)
            return token, (token, sorted(got))

        return self._change(step)

    def complete(self, token: int, done: list[int]) -> None:
        """Mark items done.  Refused as a whole if any of them is no longer leased under this token."""

        def step(current, items):
            for i in done:
                if items[i].state == DONE and items[i].token == token:
                    continue
                if items[i].state != LEASED or items[i].token != token:
                    raise StaleToken(f"item {i} is {items[i].state} under token {items[i].token}, not {token}")
                items[i].state, items[i].expires = DONE, None
            return current, None

        self._change(step)

    def release(self, token: int) -> None:
        """Give up a lease at once, as a worker does that fails in an orderly way."""

        def step(current, items):
            for x in items.values():
                if x.state == LEASED and x.token == token:
                    x.state, x.worker, x.expires = PENDING, None, None
            return current, None

        self._change(step)


def replay_runs(ledger: Ledger, runs: list[tuple[int, int, int | None, str]]) -> dict[int, int]:
    """Play run attempts (run_no, start, end, outcome) through the ledger in order of start.

    Item k is what arrived after the start of attempt k-1 and up to the start of attempt k.  Every
    attempt leases what is pending; one with outcome ``ok`` completes it, a failed one gives its lease
    up at its end, a killed one never says anything and its lease has run out when the next begins.
    Returns the attempt that completed each item; items no attempt completed are absent.
    """
    owner: dict[int, int] = {}
    runs = sorted(runs, key=lambda r: (r[1], r[0]))
    ledger.enqueue(list(range(len(runs))))
    for k, (run_no, start, end, outcome) in enumerate(runs):
        # a killed run holds its lease until the next attempt begins
        until = runs[k + 1][1] if k + 1 < len(runs) else start + 1
        token, got = ledger.lease(run_no, start, max(0, until - start), only=set(range(k + 1)))
        if outcome == "ok":
            ledger.complete(token, got)
            owner.update(dict.fromkeys(got, run_no))
        elif outcome == "failed" and end is not None:
            ledger.release(token)
    return owner


def run_spans(owner: dict[int, int], starts: list[int]) -> list[tuple[int, int]]:
    """(upper arrival bound, run that processed the records up to it), ascending; items in one run are one span."""
    spans: list[tuple[int, int]] = []
    for k, at in enumerate(starts):
        run = owner.get(k)
        if run is None:
            continue
        if spans and spans[-1][1] == run:
            spans[-1] = (at, run)
        else:
            spans.append((at, run))
    return spans


def span_of(at: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds lie below ``at``: the index of the span that ``at`` falls into.

    The bounds are spread over a literal table of equal steps, so a row looks at the few bounds of its step only.
    """
    low, high = bounds[0], bounds[-1]
    width = (high - low) // (4 * len(bounds)) + 1
    steps: list[list[int]] = [[] for _ in range((high - low) // width + 1)]
    for b in bounds:
        steps[(b - low) // width].append(b)
    base, n = [], 0
    for s in steps:
        base.append(n)
        n += len(s)
    at_step = F.floor((at - F.lit(low)) / F.lit(width)).cast("int") + 1
    inner = F.array(*[F.array(*[F.lit(b).cast("bigint") for b in s]) for s in steps])
    below = F.aggregate(F.element_at(inner, at_step), F.lit(0), lambda k, b: k + (b < at).cast("int"))
    inside = F.element_at(F.lit(base), at_step) + below
    return F.when(at <= low, 0).when(at > high, len(bounds)).otherwise(inside)


def changed_pages(records: DataFrame, spans: list[tuple[int, int]], tracked: list) -> DataFrame:
    """Per run of ``spans`` the pages whose record in force differs from the one at the run before.

    records: id, swept_at, last_edited_time, delivery_no and what ``tracked`` reads.  Each record
    belongs to exactly one span; the greatest record of each (page, span) is found with map-side
    combination, so a hot page costs a task no more than one row per run, and the window over a page
    is bounded by the number of runs.  Records without id or arrival, or later than the last run, are
    in no span.  Output: run_no, page_id.
    """
    spark = records.sparkSession
    if not spans:
        return spark.createDataFrame([], "run_no int, page_id string")
    runs = F.lit([r for _, r in spans])
    place = span_of(micros("swept_at"), [b for b, _ in spans])
    rows = records.filter("swept_at IS NOT NULL AND id IS NOT NULL").select(
        norm_id("id").alias("page_id"),
        place.alias("place"),
        F.struct(*precedence(), F.struct(*tracked).alias("content")).alias("rec"),
    )
    best = rows.filter(F.col("place") < len(spans)).groupBy("page_id", "place").agg(F.max("rec").alias("rec"))
    by_run = Window.partitionBy("page_id").orderBy("place")
    force = best.select("page_id", "place", F.max("rec").over(by_run.rowsBetween(Window.unboundedPreceding, 0)).alias("now"))
    state = lambda c: F.struct(F.col(f"{c}.edit_us"), F.col(f"{c}.content"))
    steps = force.select("page_id", "place", "now", F.lag("now").over(by_run).alias("before"))
    return steps.filter(F.col("before").isNull() | ~state("now").eqNullSafe(state("before"))).select(
        F.element_at(runs, F.col("place") + 1).cast("int").alias("run_no"), "page_id"
    )


def process_increments(records: DataFrame, sweep_runs: DataFrame, root: str, tracked: list, ttl_s: int = 6 * 3600, worker: int = 0) -> DataFrame:
    """Everything each successful run had to process, published through the ledger at ``root``.

    Runs are control data (one row per nightly attempt).  The history of attempts decides which run
    owns which span; then this call leases the runs that are not published yet, writes them below
    ``root/out/token=T`` and marks them done with that token.  After a crash a later call with the same root
    takes over what was not done.  Raises Busy if another worker holds runs that are still to be done, and
    StaleToken if this worker's own lease ran out while it wrote.
    """
    spark = records.sparkSession
    runs = [
        (r.run_no, r.s, r.e, r.outcome)
        for r in sweep_runs.filter("started_at IS NOT NULL AND run_no IS NOT NULL")
        .select("run_no", micros("started_at").alias("s"), micros("ended_at").alias("e"), "outcome")
        .toLocalIterator()
    ]
    runs.sort(key=lambda r: (r[1], r[0]))
    owner = replay_runs(Ledger(), runs)
    spans = run_spans(owner, [r[1] for r in runs])
    ledger, out = Ledger(spark, f"{root}/ledger"), ControlFiles(spark, f"{root}/out")
    wanted = {run for _, run in spans}
    ledger.enqueue(sorted(wanted))
    token, leased = ledger.lease(worker, int(time.time()), ttl_s, only=wanted)
    if leased:
        try:
            found = changed_pages(records, spans, tracked)
            if len(leased) < len(spans):
                found = found.filter(F.col("run_no").isin(leased))
            found.hint("rebalance", "run_no").write.mode("overwrite").partitionBy("run_no").parquet(f"{out.root}/token={token}")
        except Exception:
            ledger.release(token)
            raise
        ledger.complete(token, leased)
    return published(spark, ledger, out, wanted)


def published(spark: SparkSession, ledger: Ledger, out: ControlFiles, wanted: set[int]) -> DataFrame:
    """run_no, page_id of all ``wanted`` runs, from the folders of their tokens; leftovers of refused and crashed writers are removed."""
    items = ledger.items()
    open_ = sorted(r for r in wanted if items[r].state != DONE)
    if open_:
        raise Busy(f"{len(open_)} runs are not done, the first is {open_[0]} under token {items[open_[0]].token}")
    tokens = {items[r].token for r in wanted}
    alive = {x.token for x in items.values() if x.state in (LEASED, DONE)}
    folders = {n: int(n[6:]) for n in out.names() if n.startswith("token=")}
    for name, token in folders.items():
        if token not in alive:
            out.delete(name)
    paths = [f"{out.root}/{n}" for n, t in folders.items() if t in tokens]
    if not paths:
        return spark.createDataFrame([], "run_no int, page_id string")
    # each folder alone: partition columns are found from where reading begins
    parts = [spark.read.schema("page_id string, run_no int").parquet(p).select("run_no", "page_id") for p in paths]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.filter(F.col("run_no").isin(sorted(wanted))) if len(items) > len(wanted) else rows
