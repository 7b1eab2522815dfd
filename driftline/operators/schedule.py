"""Work queues: order, shares, caps, streaks, throttling."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.core.scan import bucket_folds, time_buckets
from driftline.core.store import cut
from driftline.operators.changes import positions


def group_positions(df: DataFrame, keys: list[str], order: list[str], name: str = "rn") -> DataFrame:
    """Rows numbered from 1 within their key, whatever the size of the key.

    All rows are numbered in one distributed order that keeps keys together; a key's first number is
    subtracted.  No task sorts more than its range.
    """
    at = positions(df, [F.col(c).asc_nulls_first() for c in [*keys, *order]], "_at")
    first = at.groupBy(*keys).agg(F.min("_at").alias("_first"))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    joined = at.alias("a").join(first.alias("b"), same)
    return joined.select(*[F.col(f"a.{c}") for c in df.columns], (F.col("_at") - F.col("_first") + 1).alias(name))


def oldest_share(population: DataFrame, last: str, key: str, days: int = 30) -> DataFrame:
    """The part of a population that is due today: the ceil(n / days) longest not seen, never seen ones first, ties by key."""
    n = population.count()
    share = min(n, math.ceil(n / float(days)))
    return positions(population, [F.col(last).asc_nulls_first(), F.col(key)]).filter(F.col("pos") < share)


def legacy_first(population: DataFrame, legacy: Column, last: str, key: str, legacy_n: int, days: int = 30) -> DataFrame:
    """Up to ``legacy_n`` legacy keys by key, then the oldest share of the rest: key and ``turn``."""
    first = population.filter(legacy).orderBy(key).limit(legacy_n).select(key, F.lit(0).alias("turn"))
    rest = population.join(first.select(key), key, "left_anti")
    return first.unionByName(oldest_share(rest, last, key, days).select(key, F.lit(1).alias("turn")))


def top_and_more(df: DataFrame, key: str, order: list[Column], k: int) -> DataFrame:
    """The first k rows of each key with ``rn``, and how many more the key has.

    Spark keeps only k rows a key and task before the shuffle, so a hot key is no more than k rows a task.
    """
    w = Window.partitionBy(key).orderBy(*order)
    top = df.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= k)
    n = df.groupBy(key).agg(F.count("*").alias("_n"))
    return top.join(n, key).withColumn("more", F.greatest(F.col("_n") - k, F.lit(0))).drop("_n")


def failures_since_success(attempts: DataFrame, key: list[str], at: str, ok: Column, bad: Column) -> DataFrame:
    """Per key how many failures came after its last success, and when that was (null: never)."""
    last = F.max(F.when(ok, F.col(at)))
    good = attempts.groupBy(*key).agg(last.alias("last_ok"))
    joined = attempts.filter(bad).join(good, key, "right")
    return joined.groupBy(*key, "last_ok").agg(F.count_if(F.col(at).isNotNull() & (F.col("last_ok").isNull() | (F.col(at) > F.col("last_ok")))).alias("failures"))


def throttle(alerts: DataFrame, bucket: list[str], at: str, every: str = "1 hour") -> DataFrame:
    """One alert a bucket and window, with the number of those held back."""
    w = alerts.groupBy(*bucket, F.window(at, every).alias("w")).agg(F.min(at).alias("sent_at"), (F.count("*") - 1).alias("suppressed"))
    return w.select(*bucket, "sent_at", "suppressed")


def islands(events: DataFrame, key: str, kind: str, at: str, tie: str) -> DataFrame:
    """Runs of consecutive events of one kind, in order of the number ``at`` (microseconds), then ``tie``: key, kind, island (from 1), n.

    A key is cut into buckets of ``at`` (see core.scan): what a bucket inherits is the last event and the number
    of runs before it, so no task sorts all events of a key.  Events without a key or ``at`` are left out.
    """
    rows, _, refined = time_buckets(events.filter(F.col(at).isNotNull()).select(key, kind, at, tie), key, at)
    last = bucket_folds(rows, key, {"last": F.max(F.struct(at, tie, kind))}, {"last": F.max}, refined).select(key, "bucket", F.col("before_last").alias("_before"))
    inside = Window.partitionBy(key, "bucket").orderBy(at, tie)
    both = rows.join(last, [key, "bucket"])
    # a run begins where the event before is of another kind, or there is none
    before = F.coalesce(F.lag(F.struct(F.col(kind).alias("k"))).over(inside), F.when(F.col("_before").isNotNull(), F.struct(F.col(f"_before.{kind}").alias("k"))))
    marked = cut(both.select(key, "bucket", kind, at, tie, F.when(before.isNull() | ~before["k"].eqNullSafe(F.col(kind)), 1).otherwise(0).alias("_s")), "islands")
    runs = bucket_folds(marked, key, {"runs": F.sum("_s")}, {"runs": F.sum}, refined).select(key, "bucket", F.coalesce("before_runs", F.lit(0)).alias("_past"))
    running = F.sum("_s").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    numbered = marked.join(runs, [key, "bucket"]).withColumn("island", F.col("_past") + running)
    return numbered.groupBy(key, kind, "island").agg(F.count("*").alias("n"))


def head_of_line(events: DataFrame, order: str, limit: int) -> DataFrame:
    """Events of a log (order unique; outcome ok, permanent or transient; tries before this one) with the ``verdict`` of this tick.

    A transient failure that was tried fewer than ``limit`` times holds the line: it stays where it is (``held``) and
    everything behind it waits.  Before it, ok is done, a permanent failure is skipped, and a transient one that has been tried often enough is abandoned.
    """
    holds = (F.col("outcome") == "transient") & (F.col("tries") + 1 < limit)
    at = events.filter(holds).agg(F.min(order)).first()[0]
    ends = F.when(F.col("outcome") == "ok", "done").when(F.col("outcome") == "permanent", "skipped").otherwise("abandoned")
    if at is None:
        return events.withColumn("verdict", ends)
    return events.withColumn("verdict", F.when(F.col(order) > F.lit(at), "waiting").when(F.col(order) == F.lit(at), "held").otherwise(ends))


def drain(left: DataFrame, live: DataFrame, readable: DataFrame) -> DataFrame:
    """key, turn, asked, outcome: each key of a queue once, those that a crashed drain left over (key, no) first, in order of first request.

    Keys that cannot be read (absent from ``readable``) are dropped; requests without a key ask for nothing.
    """
    both = left.select("key", "no", F.lit(0).alias("rank")).unionByName(live.select("key", "no", F.lit(1).alias("rank"))).filter("key IS NOT NULL")
    first = both.groupBy("key").agg(F.min(F.struct("rank", "no")).alias("_first"), F.count("*").alias("asked"))
    at = positions(first.select("key", "asked", F.col("_first.rank").alias("rank"), F.col("_first.no").alias("no")), [F.col("rank"), F.col("no"), F.col("key")], "turn")
    found = at.join(readable.select("key").distinct().withColumn("_there", F.lit(True)), "key", "left")
    return found.select("key", "turn", "asked", F.when(F.col("_there"), "done").otherwise("dropped").alias("outcome"))


def last_events(events: DataFrame, key: str, at: str, event: str) -> DataFrame:
    """key, event, seeds: the latest event of each key (of several at one time the last by name) and what it seeds."""
    last = events.groupBy(key).agg(F.max(F.struct(at, event)).getField(event).alias(event))
    return last.withColumn("seeds", F.when(F.col(event) == "deleted", "strike").otherwise("discovery"))


def due_slice(items: DataFrame, settled: DataFrame, key: list[str], order: list[Column], n: int) -> DataFrame:
    """The next ``n`` items in ``order`` that are not settled, for a run with a budget; the next run takes up where this one's settled items end."""
    return items.join(settled.select(*key), key, "left_anti").orderBy(*order).limit(n)


def audit_pool(clock: DataFrame, alive: DataFrame, key: str, last: str) -> DataFrame:
    """A rescan clock (key, last) for the keys that are alive: dead ones go, new ones were never seen."""
    return alive.select(key).distinct().join(clock.groupBy(key).agg(F.max(last).alias(last)), key, "left")


def carried_over(pending: DataFrame, found: DataFrame, settled: DataFrame, key: str) -> DataFrame:
    """What is pending after a run: what was pending or was found, without what is settled."""
    return pending.select(key).union(found.select(key)).distinct().join(settled.select(key), key, "left_anti")


def run_alarms(runs: DataFrame, now_us: int, ok_s: int, nightly_s: int, streak: int) -> DataFrame:
    """alarm, since_us of a job whose runs (run_no, started_us, ended_us, outcome) are known: no success for ``ok_s``, no start for
    ``nightly_s``, a last run that never ended, and ``streak`` failures in a row.  A history without runs raises the first two."""
    ok = F.col("outcome") == "ok"
    last = runs.agg(F.max(F.when(ok, F.col("ended_us"))).alias("ok_us"), F.max("started_us").alias("start_us"), F.max(F.struct("started_us", "run_no", "ended_us")).alias("last"), F.max(F.when(ok, F.col("run_no"))).alias("ok_no")).first()
    since = runs if last.ok_no is None else runs.filter(F.col("run_no") > last.ok_no)
    failed = since.agg(F.count("*").alias("n"), F.min("started_us").alias("first_us")).first()
    late = lambda us, s: us is None or now_us - us >= s * 1_000_000
    raised = [
        ("no success", last.ok_us, late(last.ok_us, ok_s)), ("no start", last.start_us, late(last.start_us, nightly_s)),
        ("never ended", last.last.started_us if last.last else None, bool(last.last) and last.last.ended_us is None), ("failures", failed.first_us, failed.n >= streak),
    ]
    return runs.sparkSession.createDataFrame([(name, at) for name, at, on in raised if on], "alarm string, since_us bigint")
