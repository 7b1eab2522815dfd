"""Change logs as streams: keyed folds, dead letters, throttling."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from driftline.core.store import ControlFiles
from driftline.sources.tail import TailSource

STATE = "key string, at_us bigint, serial bigint, value string, deleted boolean"
#: Buckets that a state table is kept in; a batch rewrites those it touches.
BUCKETS = 64


def fold_batch(state: DataFrame, batch: DataFrame) -> DataFrame:
    """Latest value per key by (at_us, serial); a tombstone is final and unordered.  Folding a batch twice changes nothing."""
    # a tombstone brings no value of its own; a deleted key of the state keeps the last one it had
    old = state.withColumn("live", F.col("at_us").isNotNull())
    new = batch.select("key", "at_us", "serial", "value", F.coalesce("deleted", F.lit(False)).alias("deleted"))
    both = old.unionByName(new.withColumn("live", ~F.col("deleted")))
    rec = F.struct(F.col("at_us"), F.col("serial"), F.col("value"))
    folded = both.groupBy("key").agg(F.max(F.when(F.col("live"), rec)).alias("r"), F.max("deleted").alias("deleted"))
    return folded.select("key", F.col("r.at_us").alias("at_us"), F.col("r.serial").alias("serial"), F.col("r.value").alias("value"), "deleted")


class BucketedState:
    """A keyed state in hash buckets, each in the folder of the batch that last rewrote it.

    A version is a map from bucket to folder.  It counts once its control file is created; folders that
    neither the last version nor the one before it names are removed.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.files = ControlFiles(spark, f"{self.root}/versions")

    def _versions(self) -> list[dict]:
        return [json.loads(self.files.read(n)) for n in self.files.names()[-2:]]

    def read(self, version: dict | None = None, only: list[int] | None = None) -> DataFrame:
        """The state, or the buckets ``only`` of it."""
        version = version if version is not None else next(iter(self._versions()[-1:]), None)
        paths = sorted({f"{self.root}/{folder}/bucket={b}" for b, folder in (version or {"map": {}})["map"].items() if only is None or int(b) in only})
        return self.spark.read.schema(STATE).parquet(*paths) if paths else self.spark.createDataFrame([], STATE)

    def fold(self, batch: DataFrame, batch_id: int) -> None:
        """Fold one batch in; a batch that was folded before is left out."""
        past = self._versions()
        last = past[-1] if past else {"batch": -1, "map": {}}
        if last["batch"] >= batch_id:
            return
        place = F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("int")
        touched = sorted(r.bucket for r in batch.select(place.alias("bucket")).distinct().collect())  # BUCKETS at most
        folder = f"batch={batch_id}-{uuid.uuid4().hex[:8]}"
        new = fold_batch(self.read(last, touched), batch).withColumn("bucket", place)
        if touched:
            new.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.root}/{folder}")
        version = {"batch": batch_id, "map": {**last["map"], **{str(b): folder for b in touched}}}
        store = ControlFiles(self.spark, self.root)
        if not self.files.create(f"{batch_id:012d}", json.dumps(version)):
            store.delete(folder)
            return
        named = {f for v in (last, version) for f in v["map"].values()}
        for name in store.names():
            if name.startswith("batch=") and name not in named:
                store.delete(name)
        for name in self.files.names()[:-2]:
            self.files.delete(name)


def fold_stream(spark: SparkSession, log: str, root: str, per_trigger: int = 4, archive: str | None = None, tail: bool = False) -> DataFrame:
    """Fold a log of JSON lines (key, at_us, serial, value, deleted) up to now and return the state.

    ``log`` is a folder of files, or with ``tail`` one file that grows (see sources.tail).  The stream's checkpoint
    holds how far the log is read, the state's version is the batch number: a batch that is run again after a
    crash finds its version written and leaves it.  A batch rewrites the buckets of the state that its keys fall
    into.  Lines that are no JSON, or name no key, go to ``root/dead`` and never hold up the rest.  With ``archive``
    log files are moved there once a later batch has committed what they held, which rotates the log without losing a line.
    """
    state = BucketedState(spark, f"{root}/state")

    def step(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select("value", F.from_json("value", STATE, {"mode": "PERMISSIVE"}).alias("e"))
        good = F.coalesce(F.col("e.key").isNotNull(), F.lit(False))
        rows.filter(~good).select("value").write.mode("overwrite").text(f"{root}/dead/batch={batch_id}")
        state.fold(rows.filter(good).select("e.*"), batch_id)

    if tail:
        spark.dataSource.register(TailSource)
        stream = spark.readStream.format("tail").option("path", log).load()
    else:
        source = spark.readStream.option("maxFilesPerTrigger", per_trigger)
        if archive is not None:
            source = source.option("cleanSource", "archive").option("sourceArchiveDir", archive)
        stream = source.text(log)
    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return state.read()


def queue(events: DataFrame, key: str, at: str, within: str = "1 day") -> DataFrame:
    """Streaming work queue with one pending item a key: repeats within the watermark are dropped."""
    return events.withWatermark(at, within).dropDuplicatesWithinWatermark([key])


def rolling_throttle(alerts: DataFrame, cool_s: int = 3600) -> DataFrame:
    """Streaming alerts (bucket, at_us) with a cool-down from the last one sent: bucket, sent_us, suppressed before it.

    The state of a bucket is two numbers.  Alerts of a bucket within a micro-batch are put in order of time, so
    what a task holds is bounded by the trigger; batches must come in order of time.  Alerts without a time are left out.
    """

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, held = state.get if state.exists else (None, 0)
        out = []
        times = np.sort(np.concatenate([part["at_us"].dropna().to_numpy(np.int64) for part in parts] or [np.zeros(0, np.int64)]))
        i = 0
        while i < len(times):
            # all alerts of a cool-down are stepped over at once
            free = 0 if last is None else int(np.searchsorted(times, last + cool_s * 1_000_000))
            held += max(0, free - i)
            i = max(i, free)
            if i < len(times):
                last = int(times[i])
                out.append((key[0], last, held))
                held, i = 0, i + 1
        state.update((last, held))
        yield pd.DataFrame(out, columns=["bucket", "sent_us", "suppressed"])

    return alerts.groupBy("bucket").applyInPandasWithState(
        step, "bucket string, sent_us bigint, suppressed bigint", "last bigint, held bigint", "append", GroupStateTimeout.NoTimeout
    )


def throttled(spark: SparkSession, alerts: DataFrame, root: str, cool_s: int = 3600, slice_rows: int = 50_000_000) -> DataFrame:
    """The alerts (bucket string, at_us) that are sent when each silences its bucket for ``cool_s``: bucket, sent_us, suppressed before it.

    The alerts are written to a log slice of time by slice of time, and each slice is one micro-batch of ``rolling_throttle``.
    """
    log, out = f"{root}/alerts", f"{root}/sent"
    timed = alerts.filter("at_us IS NOT NULL").select("bucket", "at_us")
    low, high, n = timed.agg(F.min("at_us"), F.max("at_us"), F.count("*")).first()
    if low is None:
        return spark.createDataFrame([], "bucket string, sent_us bigint, suppressed bigint")
    slices = max(2, -(-n // slice_rows))
    step = (high - low) // slices + 1
    for k in range(slices):
        part = timed.filter((F.col("at_us") >= low + k * step) & (F.col("at_us") < low + (k + 1) * step))
        part.write.mode("append").parquet(log)
        stream = rolling_throttle(spark.readStream.schema("bucket string, at_us bigint").parquet(log), cool_s)
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
    return spark.read.schema("bucket string, sent_us bigint, suppressed bigint").parquet(out)


def route(batch: DataFrame, rules: list[tuple[str, str]], root: str, batch_id: int) -> None:
    """Events of a micro-batch into one folder a queue: the first rule (name, SQL condition) that holds; repeated batches replace their own folders."""
    out = F.lit("unrouted")
    for name, condition in reversed(rules):
        out = F.when(F.expr(condition), name).otherwise(out)
    batch.withColumn("queue", out).write.mode("overwrite").partitionBy("queue").parquet(f"{root}/batch={batch_id}")


class Attempts:
    """Bounded retries of items in a control file: after ``limit`` failures an item is abandoned; success clears it."""

    def __init__(self, spark: SparkSession, root: str, limit: int = 5):
        self.files, self.limit = ControlFiles(spark, root), limit

    def failed(self, item: str) -> bool:
        """Count a failure; True if the item is now abandoned."""
        n = 1
        while not self.files.create(f"{item}.{n}", ""):
            n += 1
        return n > self.limit

    def succeeded(self, item: str) -> None:
        for name in self.files.names():
            if name.rpartition(".")[0] == item:
                self.files.delete(name)
