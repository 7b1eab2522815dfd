"""References to records that do not exist.

Everything is a stream of signed deltas per key: a reference counts +1, and -1 when a later listing of
its block withdraws it; a record that comes into being counts +1 for its kind, one that goes -1.
``OrphanCounts`` keeps the counts per key between runs and takes what changed; keys with a positive
reference count and an existence count of zero are the current orphans (``orphan_keys``).  The counts of a
key as they stood at each reference's own instant say whether it was an orphan then
(``orphan_references``): the counts a bucket of time inherits are folded first, those within it run on.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.core.scan import bucket_folds, time_buckets
from driftline.core.store import ControlFiles, cut
from driftline.functions.keys import micros, norm_id
from driftline.operators.versions import precedence, presence_flips

DELTA_COLUMNS = ["key", "at_us", "ref_delta", "db_delta", "page_delta", "ref_no", "target_table", "needs_database"]
EXISTENCE = ["db_delta", "page_delta"]


def _delta(df: DataFrame, **columns: Column) -> DataFrame:
    empty = {
        "ref_delta": F.lit(0),
        "db_delta": F.lit(0),
        "page_delta": F.lit(0),
        "ref_no": F.lit(None).cast("bigint"),
        "target_table": F.lit(None).cast("string"),
        "needs_database": F.lit(None).cast("boolean"),
    }
    return df.select(*[(columns.get(c, empty.get(c))).alias(c) for c in DELTA_COLUMNS])


def database_deltas(databases: DataFrame) -> DataFrame:
    """+1 at ``captured_at``, -1 at ``deleted_at``.  A span that ends before it begins, or has no beginning, never existed."""
    lived = databases.filter("db_id IS NOT NULL AND captured_at IS NOT NULL AND (deleted_at IS NULL OR deleted_at > captured_at)")
    spans = lived.select(
        norm_id("db_id").alias("key"),
        F.explode(
            F.array(
                F.struct(micros("captured_at").alias("at_us"), F.lit(1).alias("delta")),
                F.struct(micros("deleted_at").alias("at_us"), F.lit(-1).alias("delta")),
            )
        ).alias("e"),
    ).filter("e.at_us IS NOT NULL")
    return _delta(spans, key=F.col("key"), at_us=F.col("e.at_us"), db_delta=F.col("e.delta"))


def _present() -> Column:
    return ~(F.coalesce(F.col("archived"), F.lit(False)) | F.coalesce(F.col("in_trash"), F.lit(False)))


def page_deltas(pages: DataFrame) -> DataFrame:
    """+1 / -1 whenever the record in force of a page becomes present or stops being so."""
    flips = presence_flips(pages.select("id", "swept_at", "last_edited_time", "delivery_no", "archived", "in_trash"), _present())
    return _delta(flips, key=F.col("key"), at_us=F.col("at_us"), page_delta=F.col("delta"))


def reference_deltas(blocks: DataFrame) -> DataFrame:
    """+1 per reference of a block listing: the id of a ``child_database``, or the ``page_id`` and ``database_id`` of a ``link_to_page``.

    Payloads that are null, not JSON or name nothing give no reference.
    """
    links = blocks.filter("block_type IN ('child_database', 'link_to_page')").select(
        "block_no",
        "listed_at",
        "block_type",
        "block_id",
        F.when(F.col("block_type") == "link_to_page", F.get_json_object("payload", "$.page_id")).alias("page_ref"),
        F.when(F.col("block_type") == "link_to_page", F.get_json_object("payload", "$.database_id")).alias("database_ref"),
    )
    child = F.col("block_type") == "child_database"
    refs = links.select(
        "block_no",
        "listed_at",
        F.explode(
            F.array(
                F.struct(F.when(child, F.col("block_id")).alias("ref"), F.lit("databases").alias("target"), F.lit(True).alias("db")),
                F.struct(F.col("page_ref").alias("ref"), F.lit("pages_metadata").alias("target"), F.lit(False).alias("db")),
                F.struct(F.col("database_ref").alias("ref"), F.lit("databases").alias("target"), F.lit(False).alias("db")),
            )
        ).alias("r"),
    ).filter("r.ref IS NOT NULL")
    return _delta(
        refs,
        key=norm_id("r.ref"),
        at_us=micros("listed_at"),
        ref_delta=F.lit(1),
        ref_no=F.col("block_no"),
        target_table=F.col("r.target"),
        needs_database=F.col("r.db"),
    )


def workspace_deltas(blocks: DataFrame, pages: DataFrame, databases: DataFrame) -> DataFrame:
    """All deltas of a workspace, written once because both levels of the scan read them."""
    return cut(reference_deltas(blocks).unionByName(page_deltas(pages)).unionByName(database_deltas(databases)), "deltas")


def orphan_references(deltas: DataFrame) -> DataFrame:
    """References whose key did not exist at their own instant: ref_no, target_table, period (YYYY-MM).

    Existence deltas of an instant count before its references.  A reference without a time precedes
    everything, so it is an orphan without a period.  A key with a third of all references is cut
    into buckets of time (see core.scan); the references of a hot instant all meet the same counts, which are joined to them.
    """
    wanted = F.col("ref_no").isNotNull() & (F.col("ref_delta") > 0)
    missing = (F.col("databases") <= 0) & (F.col("needs_database") | (F.col("pages") <= 0))
    untimed = deltas.filter(wanted & F.col("at_us").isNull()).select("ref_no", "target_table", F.lit(None).cast("string").alias("period"))
    rows = deltas.filter("at_us IS NOT NULL").select("key", "at_us", *[F.col(c).cast("bigint") for c in EXISTENCE], "ref_no", "ref_delta", "target_table", "needs_database")
    rows, hot, refined = time_buckets(rows, "key", "at_us")
    counts = bucket_folds(rows, "key", {c: F.sum(c) for c in EXISTENCE}, {c: F.sum for c in EXISTENCE}, refined)
    own = rows.select("key", "bucket", "at_us", *EXISTENCE, "ref_no", "ref_delta", "target_table", "needs_database", F.when(F.col("ref_no").isNull(), 1).otherwise(2).alias("rank"))
    carry = counts.filter("before_db_delta <> 0 OR before_page_delta <> 0")
    carry = carry.select("key", "bucket", F.lit(None).cast("bigint").alias("at_us"), *[F.col(f"before_{c}").alias(c) for c in EXISTENCE], F.lit(0).alias("rank"))
    at_once = None
    if hot is not None:
        own = own.join(hot, ["key", "bucket"], "left")
        total = lambda c: F.coalesce(F.col(f"before_{c}"), F.lit(0)) + F.col(c)
        here = counts.join(hot, ["key", "bucket"], "left_semi").select("key", "bucket", total("db_delta").alias("databases"), total("page_delta").alias("pages"))
        at_once = own.filter(F.col("_hot") & wanted).join(here, ["key", "bucket"]).select("ref_no", "target_table", "needs_database", "at_us", "databases", "pages")
        own = own.filter("_hot IS NULL").drop("_hot")
        carry = carry.join(hot, ["key", "bucket"], "left_anti")
    running = Window.partitionBy("key", "bucket").orderBy(F.col("at_us").asc_nulls_first(), "rank").rowsBetween(Window.unboundedPreceding, 0)
    state = own.unionByName(carry, allowMissingColumns=True).select(
        "ref_no", "target_table", "needs_database", "at_us", "ref_delta",
        F.sum("db_delta").over(running).alias("databases"),
        F.sum("page_delta").over(running).alias("pages"),
    ).filter(wanted).drop("ref_delta")
    if at_once is not None:
        state = state.unionByName(at_once)
    return state.filter(missing).select("ref_no", "target_table", F.date_format(F.timestamp_micros("at_us"), "yyyy-MM").alias("period")).unionByName(untimed)


def fold_deltas(deltas: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Signed counts per key and referenced table: key, target_table, refs, databases, pages.

    ``state`` is an earlier result: folding new deltas into it equals folding all deltas at once.
    References of a key are counted per referenced table, its existence once (target_table null).
    """
    new = deltas.groupBy("key", "target_table", "needs_database").agg(
        F.sum("ref_delta").cast("bigint").alias("refs"),
        F.sum("db_delta").cast("bigint").alias("databases"),
        F.sum("page_delta").cast("bigint").alias("pages"),
    )
    both = new if state is None else new.unionByName(state)
    return (
        both.groupBy("key", "target_table", "needs_database")
        .agg(*[F.sum(c).alias(c) for c in ("refs", "databases", "pages")])
        .filter("refs <> 0 OR databases <> 0 OR pages <> 0")
    )


def orphan_keys(state: DataFrame) -> DataFrame:
    """Keys with positive references and zero existence now: key, target_table, refs."""
    exists = state.groupBy("key").agg(F.sum("databases").alias("d"), F.sum("pages").alias("p"))
    refs = state.filter("refs > 0").select("key", "target_table", "needs_database", "refs")
    gone = (F.coalesce("d", F.lit(0)) <= 0) & (F.col("needs_database") | (F.coalesce("p", F.lit(0)) <= 0))
    return refs.join(exists, "key", "left").filter(gone).groupBy("key", "target_table").agg(F.sum("refs").alias("refs"))


REFS_DDL = "page string, block string, listed_us bigint, block_no bigint, refs array<struct<key:string,target_table:string,needs_database:boolean>>"
PAGES_DDL = "key string, edit_us bigint, arrival_us bigint, serial bigint, present int"
COUNTS_DDL = "key string, target_table string, needs_database boolean, refs bigint, databases bigint, pages bigint"


class OrphanCounts:
    """Signed counts per key kept between runs at a path of the shared folder, with the listing in force of
    every block and the record in force of every page, which say what a new one withdraws.

    ``apply`` takes blocks, page records and database events that are new since the last run.  A version is
    written beside the last one and becomes the state when its control file is created; a batch that
    fails before leaves the state as it was, and a batch number that was taken before changes nothing.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = ControlFiles(spark, f"{self.root}/versions")

    def _state(self) -> dict | None:
        names = self.files.names()
        return json.loads(self.files.read(names[-1])) if names else None

    def _read(self, name: str, ddl: str) -> DataFrame:
        state = self._state()
        return self.spark.read.schema(ddl).parquet(f"{state['path']}/{name}") if state else self.spark.createDataFrame([], ddl)

    def counts(self) -> DataFrame:
        """key, target_table, needs_database, refs, databases, pages."""
        return self._read("counts", COUNTS_DDL)

    def apply(self, batch_no: int, blocks: DataFrame, pages: DataFrame, database_events: DataFrame) -> None:
        """Fold one batch: listings of blocks, page records, and deltas as ``database_deltas`` gives them."""
        state = self._state()
        if state and state["batch"] >= batch_no:
            return
        path = f"{self.root}/state/batch={batch_no}-{uuid.uuid4().hex[:8]}"
        # of a block's listings, in the batch or before it, the latest is in force
        refs = reference_deltas(blocks).groupBy("ref_no").agg(F.collect_set(F.struct("key", "target_table", "needs_database")).alias("refs"))  # at most two a block
        block = F.coalesce(norm_id("block_id"), F.concat(F.lit("#"), F.col("block_no").cast("string")))
        kinds = blocks.filter("block_no IS NOT NULL AND block_type IN ('child_database', 'link_to_page')")
        listed = kinds.select(F.coalesce(norm_id("page_id"), F.lit("")).alias("page"), block.alias("block"), F.coalesce(micros("listed_at"), F.lit(-(2**63))).alias("listed_us"), "block_no")
        listed = listed.join(refs, listed["block_no"] == refs["ref_no"], "left").drop("ref_no").withColumn("refs", F.coalesce("refs", F.array().cast("array<struct<key:string,target_table:string,needs_database:boolean>>")))
        self._fold(listed, "refs", REFS_DDL, ["page", "block"], ["listed_us", "block_no", "refs"], path)
        known = pages.filter("swept_at IS NOT NULL AND id IS NOT NULL").select(norm_id("id").alias("key"), *precedence(), _present().cast("int").alias("present"))
        self._fold(known, "pages", PAGES_DDL, ["key"], ["edit_us", "arrival_us", "serial", "present"], path)
        new_refs = self.spark.read.parquet(f"{path}/refs-changes")
        one = lambda rows, sign: rows.select(F.explode("refs").alias("r"), F.lit(sign).alias("refs")).select("r.*", "refs")
        deltas = one(new_refs.select("refs"), 1).unionByName(one(new_refs.select(F.col("old.refs").alias("refs")), -1))
        moved = self.spark.read.parquet(f"{path}/pages-changes").select("key", (F.col("present") - F.coalesce(F.col("old.present"), F.lit(0))).alias("pages")).filter("pages <> 0")
        events = database_events.select("key", F.col("db_delta").alias("databases"))
        every = deltas.unionByName(moved, allowMissingColumns=True).unionByName(events, allowMissingColumns=True).na.fill(0, ["refs", "pages", "databases"])
        names = ("refs", "databases", "pages")
        total = every.select("key", "target_table", "needs_database", *[F.col(c).cast("bigint") for c in names]).unionByName(self.counts())
        total = total.groupBy("key", "target_table", "needs_database").agg(*[F.sum(c).alias(c) for c in names]).filter("refs <> 0 OR databases <> 0 OR pages <> 0")
        total.write.mode("overwrite").parquet(f"{path}/counts")
        if not self.files.create(f"b{batch_no:09d}.json", json.dumps({"batch": batch_no, "path": path})):
            ControlFiles(self.spark, self.root).delete(path[len(self.root) + 1 :])  # another run took this batch; its version stands
            return
        store = ControlFiles(self.spark, self.root)
        for name in ("refs-changes", "pages-changes"):
            store.delete(f"{path[len(self.root) + 1:]}/{name}")
        if state:
            store.delete(state["path"][len(self.root) + 1 :])

    def _fold(self, rows: DataFrame, name: str, ddl: str, key: list[str], record: list[str], path: str) -> None:
        """Write the greatest record of each key over the state and ``rows``, and those that are new, with the ``old`` one they replace."""
        best = rows.groupBy(*key).agg(F.max(F.struct(*record)).alias("new"))
        old = self._read(name, ddl).select(*key, F.struct(*record).alias("old"))
        both = best.join(old, key, "full_outer").withColumn("won", F.col("new").isNotNull() & (F.col("old").isNull() | (F.col("new") > F.col("old"))))
        both = cut(both, f"{name}-fold")
        both.select(*key, *[F.when(F.col("won"), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in record]).write.mode("overwrite").parquet(f"{path}/{name}")
        both.filter("won").select(*key, *[F.col(f"new.{c}").alias(c) for c in record], "old").write.mode("overwrite").parquet(f"{path}/{name}-changes")


def current_orphans(blocks: DataFrame, pages: DataFrame, databases: DataFrame, root: str, stops: list[str]) -> DataFrame:
    """key, target_table, refs: orphans when all is known, from counts kept at ``root`` over the batches that the instants ``stops`` part.

    Rows without a time of their own belong to the first batch.
    """
    counts, bounds = OrphanCounts(blocks.sparkSession, root), [None, *stops, None]
    events = database_deltas(databases)
    for k in range(len(bounds) - 1):
        low, high = (F.lit(x).cast("timestamp") if x else None for x in bounds[k : k + 2])

        def part(df: DataFrame, at: Column, low=low, high=high) -> DataFrame:
            if high is not None:
                df = df.filter(F.coalesce(at < high, F.lit(True)) if low is None else at < high)
            return df if low is None else df.filter(at >= low)

        counts.apply(k, part(blocks, F.col("listed_at")), part(pages, F.col("swept_at")), part(events, F.timestamp_micros("at_us")))
    return orphan_keys(counts.counts())


def orphan_report(deltas: DataFrame) -> DataFrame:
    """Orphan references per referenced table and month of listing."""
    found = orphan_references(deltas)
    return found.groupBy("target_table", "period").agg(F.count("*").alias("orphans"))
