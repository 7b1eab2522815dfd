"""Prefix scans in time: running aggregates that never put one key's rows into one task.

A plain window over a key sorts all rows of the key in one task.  Here a key is cut into buckets of
time: hours, an hour with more than HOT_ROWS rows into its seconds, such a second into its
microseconds.  The first level folds each bucket (with map-side combination), a window over the buckets
of a key gives what each bucket inherits, and the second level runs within (key, bucket), led by one
row that carries the inherited state.  What is still hot at one instant has one state for all its rows,
so it needs no order and is folded or joined instead of sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.core.store import cut

#: A bucket with more rows than this is cut further.  Fixed: it does not grow with the data.
HOT_ROWS = 50_000
#: Widths of buckets in microseconds, coarse to fine.
HOUR_US, SECOND_US = 3_600_000_000, 1_000_000
WIDTHS = (HOUR_US, SECOND_US, 1)
#: Buckets of a key are themselves cut into spans of this many microseconds where hours had to be refined.
SPAN_US = 30 * 24 * HOUR_US
#: Lists of at most so many rows (tens of bytes each) are sent to every task; longer ones are joined.
SMALL_ROWS = 100_000


def floor_to(at: Column | str, width: int) -> Column:
    """The beginning of the interval of this width that a time in microseconds falls into."""
    at = F.col(at) if isinstance(at, str) else at
    return at - F.pmod(at, F.lit(width).cast("bigint"))


def small(df: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if it was counted to be small, else left to the planner."""
    return F.broadcast(df) if df.count() <= SMALL_ROWS else df


def hot_buckets(df: DataFrame, key: str) -> DataFrame | None:
    """key, bucket of the buckets with more than HOT_ROWS rows, or None if there are none."""
    hot = df.groupBy(key, "bucket").agg(F.count("*").alias("_n")).filter(F.col("_n") > HOT_ROWS)
    hot = cut(hot.select(key, "bucket", F.lit(True).alias("_hot")), "hot-buckets")
    return None if hot.isEmpty() else small(hot)


def time_buckets(df: DataFrame, key: str, at: str) -> tuple[DataFrame, DataFrame | None, bool]:
    """``df`` with ``bucket`` (its beginning), the instants (key, bucket) that are hot all the same or None, and whether any hour was cut.

    Buckets of a key never overlap: a bucket is either whole or replaced by finer ones.
    """
    out = df.withColumn("bucket", floor_to(at, WIDTHS[0]))
    for n, width in enumerate(WIDTHS[1:]):
        hot = hot_buckets(out.select(key, "bucket"), key)
        if hot is None:
            return out, None, n > 0
        marked = out.join(hot, [key, "bucket"], "left")
        out = marked.withColumn("bucket", F.when(F.col("_hot"), floor_to(at, width)).otherwise(F.col("bucket"))).drop("_hot")
    return out, hot_buckets(out.select(key, "bucket"), key), True


def bucket_folds(df: DataFrame, key: str, folds: dict[str, Column], merge: dict[str, callable], refined: bool) -> DataFrame:
    """key, bucket, ``x`` (the fold of the bucket) and ``before_x`` (of all earlier buckets of the key; null for the first).

    folds: aggregate per bucket by name; merge: how folded values of several buckets combine.  Where hours
    were cut a key may have very many buckets, so the window over them is itself cut into spans.
    """
    totals = df.groupBy(key, "bucket").agg(*[c.alias(n) for n, c in folds.items()])
    upto = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    if not refined:
        earlier = upto(Window.partitionBy(key).orderBy("bucket"))
        return totals.select("*", *[merge[n](F.col(n)).over(earlier).alias(f"before_{n}") for n in folds])
    totals = cut(totals.withColumn("_span", floor_to("bucket", SPAN_US)), "bucket-folds")
    spans = totals.groupBy(key, "_span").agg(*[merge[n](F.col(n)).alias(n) for n in folds])
    earlier = upto(Window.partitionBy(key).orderBy("_span"))
    spans = spans.select(key, "_span", *[merge[n](F.col(n)).over(earlier).alias(f"_s_{n}") for n in folds])
    inside = upto(Window.partitionBy(key, "_span").orderBy("bucket"))
    rows = totals.select("*", *[merge[n](F.col(n)).over(inside).alias(f"_i_{n}") for n in folds]).join(spans, [key, "_span"])
    both = {n: (F.when(F.col(f"_s_{n}").isNull(), F.col(f"_i_{n}")).when(F.col(f"_i_{n}").isNull(), F.col(f"_s_{n}"))
                .otherwise(merge_two(merge[n], f"_s_{n}", f"_i_{n}"))) for n in folds}
    return rows.select(key, "bucket", *folds, *[c.alias(f"before_{n}") for n, c in both.items()])


def merge_two(merge: callable, a: str, b: str) -> Column:
    """Two folded values combined: sums are added, of maxima the greater stands."""
    return F.col(a) + F.col(b) if merge is F.sum else F.greatest(a, b) if merge is F.max else F.least(a, b)
