"""Messages delivered more than once: a persisted index of sorted identifiers by hash prefix.

The index is a list of immutable runs.  A run holds, per hash prefix, one sorted array of entries
(16-byte identifier digest, 8-byte number of the copy that was kept).  Of every incoming batch the
identifiers are first made unique (map-side combination: a message with a third of all deliveries
becomes one row), then each prefix's arrays are binary-searched, and identifiers found nowhere become
a new run.  When there are ``merge_at`` runs they are merged into one.  Prefixes get longer as the index
grows, so an array stays at about PREFIX_ENTRIES entries; a merge splits the arrays.

A manifest names the current runs.  Every batch writes under a name of its own and counts once its
manifest is created: one that fails before leaves no trace, one that loses a race takes the winner's
result, one that is repeated takes its stored result.  Runs that a merge replaced are removed.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.core import scan
from driftline.core.store import ControlFiles, cut
from driftline.functions.keys import instant, norm_id

#: entry of an index array: digest as two big-endian halves (their order is the order of the bytes), kept copy
ENTRY = np.dtype([("hi", ">u8"), ("lo", ">u8"), ("no", ">i8")])
RUN_SCHEMA = "prefix bigint, entries binary"
#: An array is about this long (24 bytes an entry); a prefix has at least MIN_BITS and at most 32 bits.
PREFIX_ENTRIES, MIN_BITS = 1 << 18, 4
#: Deliveries a round takes at most, unless that gives fewer than MIN_ROUNDS.
ROUND_ROWS, MIN_ROUNDS = 1_000_000_000, 4


def message_digest(entity: str = "entity_id", captured: str = "captured_at", comments: str = "comments") -> Column:
    """16 bytes that equal messages share: entity, capture instant (or the literal), set of non-null comment ids.

    A null entity and a null capture time are values of their own, a null list of comments has the empty
    set; times that cannot be read are compared as text.  Lengths are part of what is hashed, so no two contents run together.
    """
    when = F.coalesce(F.unix_micros(instant(captured)).cast("string"), F.concat(F.lit("="), F.col(captured)), F.lit("null"))
    ids = F.array_sort(F.array_distinct(F.filter(F.transform(F.col(comments), lambda c: norm_id(c["id"])), lambda i: i.isNotNull())))
    parts = [F.coalesce(norm_id(entity), F.lit("\x00")), when, F.coalesce(F.array_join(ids, "\x01"), F.lit(""))]
    framed = F.concat(*[F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts])
    return F.unhex(F.md5(framed.cast("binary")))


def prefix_of(digest: str, bits: int) -> Column:
    """The first ``bits`` bits of a digest as a number."""
    return F.shiftrightunsigned(F.conv(F.hex(F.substring(digest, 1, 4)), 16, 10).cast("bigint"), 32 - bits)


def bits_for(entries: int) -> int:
    """Bits of the prefix for so many identifiers in all."""
    return min(32, max(MIN_BITS, math.ceil(math.log2(max(1, entries) / PREFIX_ENTRIES))))


def _halves(digests: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"".join(digests), dtype=[("hi", ">u8"), ("lo", ">u8")])
    return raw["hi"].astype(np.uint64), raw["lo"].astype(np.uint64)


def _search(digests: pd.Series, blobs: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Binary search of digests in sorted arrays: the number kept for each, and whether it was found."""
    hi, lo = _halves(digests)
    kept, hit = np.zeros(len(hi), dtype=np.int64), np.zeros(len(hi), dtype=bool)
    for blob in blobs:
        run = np.frombuffer(blob, dtype=ENTRY)
        his, los = run["hi"].astype(np.uint64), run["lo"].astype(np.uint64)
        at = np.searchsorted(his, hi)
        while True:
            inside = at < len(run)
            same = np.zeros(len(hi), dtype=bool)
            same[inside] = his[at[inside]] == hi[inside]
            found = same.copy()
            found[same] = los[at[same]] == lo[same]
            kept[found], hit[found] = run["no"][at[found]], True
            # digests sharing their first half are next to each other; step over them
            if not (same & ~found).any():
                break
            at = np.where(same & ~found, at + 1, len(run))
    return kept, hit


TAKEN = "prefix bigint, digest binary, first_no bigint, n bigint, entries binary"


def _take(batch: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    """One prefix of a batch against the index: a row per identifier with surplus copies, and one row with the sorted array of the novel ones."""
    if not len(batch):
        return pd.DataFrame({"prefix": [], "digest": [], "first_no": [], "n": [], "entries": []})
    kept, hit = _search(batch["digest"], index["entries"])
    no, n = batch["delivery_no"].to_numpy(np.int64), batch["n"].to_numpy(np.int64)
    several = hit | (n > 1)
    new = np.empty(int((~hit).sum()), dtype=ENTRY)
    hi, lo = _halves(batch["digest"])
    new["hi"], new["lo"], new["no"] = hi[~hit], lo[~hit], no[~hit]
    new = new[np.lexsort((new["lo"], new["hi"]))]
    prefix = int(batch["prefix"].iloc[0])
    first = [int(x) for x in np.where(hit, kept, no)[several]]
    rows = {"prefix": [prefix] * len(first), "digest": list(batch["digest"][several]), "first_no": first, "n": [int(x) for x in n[several]], "entries": [None] * len(first)}
    if len(new):
        for column, value in zip(rows, (prefix, None, None, None, new.tobytes()), strict=True):
            rows[column].append(value)
    return pd.DataFrame(rows).astype({"first_no": "Int64", "n": "Int64"})


def _merge(bits: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Several sorted arrays of a prefix into one for each longer prefix of ``bits`` bits; of an identifier in two of them the smaller number stays."""

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        # joining arrays brings them to the machine's byte order; the result goes back to the stored one
        all_ = np.concatenate([np.frombuffer(b, dtype=ENTRY) for b in group["entries"]])
        all_ = all_[np.lexsort((all_["no"], all_["lo"], all_["hi"]))]
        first = np.ones(len(all_), dtype=bool)
        first[1:] = (all_["hi"][1:] != all_["hi"][:-1]) | (all_["lo"][1:] != all_["lo"][:-1])
        all_ = all_[first].astype(ENTRY)
        prefix = all_["hi"].astype(np.uint64) >> np.uint64(64 - bits)
        starts = np.nonzero(np.concatenate([[True], prefix[1:] != prefix[:-1]]))[0]
        ends = [*starts[1:], len(all_)]
        return pd.DataFrame({"prefix": prefix[starts].astype(np.int64), "entries": [all_[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]})

    return merge


class MessageIndex:
    """Identifiers of all messages kept so far, at a path of the shared folder."""

    def __init__(self, spark: SparkSession, root: str, merge_at: int = 4):
        self.spark, self.root, self.merge_at = spark, root.rstrip("/"), merge_at
        self.files = ControlFiles(spark, f"{self.root}/manifest")

    def _manifest(self) -> dict:
        names = self.files.names()
        return json.loads(self.files.read(names[-1])) if names else {"batch": -1, "runs": [], "bits": MIN_BITS, "entries": 0}

    def _runs(self, runs: list[str]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], RUN_SCHEMA)
        return self.spark.read.schema(RUN_SCHEMA).parquet(*[f"{self.root}/{r}" for r in runs]).filter("entries IS NOT NULL")

    def _merged(self, runs: list[str], bits: int, name: str) -> list[str]:
        """The runs as one, with prefixes of ``bits`` bits."""
        self._runs(runs).groupBy("prefix").applyInPandas(_merge(bits), RUN_SCHEMA).write.mode("overwrite").parquet(f"{self.root}/{name}")
        return [name]

    def absorb(self, batch_no: int, keyed: DataFrame) -> DataFrame:
        """Take one batch of (digest, delivery_no): surplus copies as (first_no, copy_no), each against the copy that is kept.

        Batches come in the order of their numbers; one that was taken before gives its stored result.
        """
        done, own = f"b{batch_no:09d}.json", f"{batch_no}-{uuid.uuid4().hex[:8]}"
        if not self.files.exists(done):
            self._commit(batch_no, keyed, done, own)
        doc = json.loads(self.files.read(done))
        return self.spark.read.schema("first_no bigint, copy_no bigint").parquet(f"{self.root}/{doc['surplus']}")

    def _commit(self, batch_no: int, keyed: DataFrame, done: str, own: str) -> None:
        state, store = self._manifest(), ControlFiles(self.spark, self.root)
        runs, bits = state["runs"], max(state["bits"], bits_for(state["entries"] + keyed.count()))
        if runs and (bits > state["bits"] or len(runs) >= self.merge_at):
            runs = self._merged(runs, bits, f"runs/merged={own}")
        unique = keyed.groupBy("digest").agg(F.min("delivery_no").alias("delivery_no"), F.count("*").alias("n")).withColumn("prefix", prefix_of("digest", bits))
        if runs:
            taken = unique.groupBy("prefix").cogroup(self._runs(runs).groupBy("prefix")).applyInPandas(_take, TAKEN)
        else:
            nothing = pd.DataFrame({"entries": []})
            taken = unique.groupBy("prefix").applyInPandas(lambda batch: _take(batch, nothing), TAKEN)
        run, surplus = f"runs/batch={own}", f"surplus/batch={own}"
        taken.write.mode("overwrite").parquet(f"{self.root}/{run}")
        taken = self.spark.read.schema(TAKEN).parquet(f"{self.root}/{run}")
        novel = taken.filter("entries IS NOT NULL").agg(F.sum(F.length("entries"))).first()[0] or 0
        self._surplus(keyed, taken.filter("digest IS NOT NULL")).write.mode("overwrite").parquet(f"{self.root}/{surplus}")
        kept = [*runs, run] if novel else runs
        doc = {"batch": batch_no, "runs": kept, "bits": bits, "entries": state["entries"] + novel // ENTRY.itemsize, "surplus": surplus}
        won = self.files.create(done, json.dumps(doc))
        # the loser's files go, or those that no manifest needs any more
        gone = {*state["runs"], run} - set(kept) if won else {run, surplus, *runs} - set(state["runs"])
        for path in gone:
            store.delete(path)

    def _surplus(self, keyed: DataFrame, wanted: DataFrame) -> DataFrame:
        """Deliveries that are not the kept copy.  Each identifier is on the lookup side once.

        A message with very many deliveries would be one task of a join by identifier; those with more than
        HOT_ROWS are looked up apart, by a list sent to every task where it is small.
        """
        wanted = wanted.select("digest", "n", "first_no")
        hot = wanted.filter(F.col("n") > scan.HOT_ROWS).drop("n")
        both = keyed.join(wanted.filter(F.col("n") <= scan.HOT_ROWS).drop("n"), "digest")
        if not hot.isEmpty():
            both = both.unionByName(keyed.join(scan.small(hot), "digest"))
        return both.filter("delivery_no <> first_no").select("first_no", F.col("delivery_no").alias("copy_no"))


def _rounds(keyed: DataFrame, rounds: int | None) -> list[int]:
    """First delivery numbers of the rounds: consecutive batches together, about equally many rows each, ROUND_ROWS at most."""
    n, low, with_batch = keyed.agg(F.count("*"), F.min("delivery_no"), F.count("batch_no")).first()
    if not n:
        return []
    k = rounds or max(MIN_ROUNDS, math.ceil(n / ROUND_ROWS))
    by = "batch_no" if with_batch else "delivery_no"
    cuts = sorted(set(keyed.agg(F.percentile_approx(by, [i / k for i in range(1, k)], 10_000)).first()[0] or [])) if k > 1 else []
    starts = keyed.agg(*[F.min(F.when(F.col(by) >= c, F.col("delivery_no"))) for c in cuts]).first() if cuts else []
    return sorted({low, *(x for x in starts if x is not None)})


def surplus_copies(captures: DataFrame, root: str, rounds: int | None = None) -> DataFrame:
    """Surplus copies of all deliveries, taken in rounds of consecutive batches (``batch_no`` where there is one).

    Deliveries are numbered in order of receipt, so the copy an index keeps is the one with the smallest
    number.  Deliveries without a number cannot be named and give no row.
    """
    spark = captures.sparkSession
    batch = F.col("batch_no") if "batch_no" in captures.columns else F.lit(None)
    rows = captures.filter("delivery_no IS NOT NULL").select("delivery_no", batch.cast("bigint").alias("batch_no"), message_digest().alias("digest"))
    keyed = cut(rows, "deliveries")
    starts = _rounds(keyed, rounds)
    if not starts:
        return spark.createDataFrame([], "first_no bigint, copy_no bigint")
    index, out = MessageIndex(spark, root), None
    for k, a in enumerate(starts):
        mine = keyed.filter(F.col("delivery_no") >= a)
        if k + 1 < len(starts):
            mine = mine.filter(F.col("delivery_no") < starts[k + 1])
        part = index.absorb(k, mine.select("digest", "delivery_no"))
        out = part if out is None else out.unionByName(part)
    return out


def kept_messages(captures: DataFrame, root: str, rounds: int | None = None) -> DataFrame:
    """The deliveries without their surplus copies: exactly one of each message, all columns as they are.

    A row that repeats a number is the same delivery again; rows without a number cannot be told apart and all stay.
    """
    gone = surplus_copies(captures, root, rounds).select(F.col("copy_no").alias("delivery_no"))
    kept = captures.filter("delivery_no IS NOT NULL").join(gone, "delivery_no", "left_anti").dropDuplicates(["delivery_no"])
    return kept.unionByName(captures.filter("delivery_no IS NULL").select(*kept.columns))
