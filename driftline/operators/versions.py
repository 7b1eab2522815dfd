"""Which record of a page is in force, and when that changes.

The record in force at an instant is, among the page's records that had arrived by then, the one with
the greatest (edit instant, arrival, delivery number); a null edit time is the earliest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.core.scan import bucket_folds, time_buckets
from driftline.functions.keys import instant, micros, norm_id

#: An edit instant that is unknown counts as earlier than any other.
NO_EDIT = -(2**63)


def precedence(edit: str = "last_edited_time", arrival: str = "swept_at", serial: str = "delivery_no") -> list[Column]:
    """The order of records of a page, as leading fields of a struct that ``max`` compares."""
    return [
        F.coalesce(micros(instant(edit)), F.lit(NO_EDIT)).alias("edit_us"),
        micros(arrival).alias("arrival_us"),
        F.col(serial).alias("serial"),
    ]


def presence_flips(records: DataFrame, present: Column) -> DataFrame:
    """Instants at which a page appears (+1) or disappears (-1), from its records in any order.

    Input columns: id, swept_at, last_edited_time, delivery_no and what ``present`` reads.  Records
    without an arrival or an id never come into force.  Repeated records flip nothing.
    Output: key, at_us, delta.  Pages are cut into buckets of arrival (see core.scan); of very many records
    of a page at one instant only the greatest can be in force, so those are folded into one.
    """
    rows = records.filter("swept_at IS NOT NULL AND id IS NOT NULL").select(
        norm_id("id").alias("key"), micros("swept_at").alias("at_us"), F.struct(*precedence(), present.cast("int").alias("present")).alias("rec")
    )
    rows, hot, refined = time_buckets(rows, "key", "at_us")
    if hot is not None:
        marked = rows.join(hot, ["key", "bucket"], "left")
        one = marked.filter("_hot").groupBy("key", "bucket").agg(F.max("at_us").alias("at_us"), F.max("rec").alias("rec"))
        rows = marked.filter("_hot IS NULL").drop("_hot").unionByName(one)
    rows = rows.select("key", "bucket", "rec")
    carry = bucket_folds(rows, "key", {"rec": F.max("rec")}, {"rec": F.max}, refined).filter("before_rec IS NOT NULL")
    both = rows.withColumn("own", F.lit(1)).unionByName(carry.select("key", "bucket", F.col("before_rec").alias("rec"), F.lit(0).alias("own")))
    # the inherited record leads its bucket
    order = [F.col("own"), F.col("rec.arrival_us"), F.col("rec.serial")]
    within = Window.partitionBy("key", "bucket").orderBy(*order)
    running = both.select(
        "key", "bucket", "own", "rec", F.max("rec").over(within.rowsBetween(Window.unboundedPreceding, 0)).getField("present").alias("now")
    )
    before = F.coalesce(F.lag("now").over(within), F.lit(0))
    return (
        running.select("key", "own", F.col("rec.arrival_us").alias("at_us"), (F.col("now") - before).alias("delta"))
        .filter("own = 1 AND delta <> 0")
        .select("key", "at_us", "delta")
    )
