"""Writing tables, documents and logs so that a run that did not finish is never seen."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.core.store import ControlFiles
from driftline.operators.changes import positions


def write_table_csv(df: DataFrame, path: str, order: list[Column]) -> None:
    """A CSV table in a total order.  The rows are range-partitioned, so the part files in order of name are the order of the table."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").csv(path, header=True, quote='"', escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def content_digest(df: DataFrame) -> str:
    """Digest of a table as a multiset of rows, for writing only what changed: sums of row hashes, whatever the order."""
    row = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\x00null")) for c in df.columns], *[F.col(c).isNull() for c in df.columns])
    r = df.agg(F.count("*").alias("n"), F.sum(row.cast("decimal(38,0)")).alias("a"), F.bit_xor(row).alias("b")).first()
    return hashlib.sha256(f"{df.columns}|{r.n}|{r.a}|{r.b}".encode()).hexdigest()


class VersionedTable:
    """A table whose versions are immutable folders; a manifest created last makes a version visible."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = ControlFiles(spark, f"{self.root}/_versions")

    def version(self) -> int:
        names = self.files.names()
        return int(names[-1]) if names else 0

    def read(self, schema: str | None = None, version: int | None = None) -> DataFrame:
        v = self.version() if version is None else version
        if not v:
            return self.spark.createDataFrame([], schema)
        r = self.spark.read if schema is None else self.spark.read.schema(schema)
        return r.parquet(f"{self.root}/v={v:09d}")

    def write(self, df: DataFrame, version: int | None = None, only_if_changed: bool = False) -> int:
        """Write the next version (or the one a batch number names: writing it twice is writing it once)."""
        if version is not None and version <= self.version():
            return self.version()
        v = self.version() + 1 if version is None else version
        digest = content_digest(df) if only_if_changed else ""
        if only_if_changed and self.version() and self.files.read(f"{self.version():09d}") == digest:
            return self.version()
        df.write.mode("overwrite").parquet(f"{self.root}/v={v:09d}")
        self.files.create(f"{v:09d}", digest)
        return v


def upsert(table: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Rows of ``changes`` replace those of the same key, others are added; keys are unique on both sides."""
    rest = [c for c in table.columns if c != key]
    a = table.select(key, F.struct(*rest).alias("_a"))
    b = changes.select(key, F.struct(*rest).alias("_b"))
    return a.join(b, key, "full_outer").select(key, F.coalesce("_b", "_a").alias("r")).select(key, *[F.col(f"r.{c}").alias(c) for c in rest])


def row_documents(rows: DataFrame, key: str, title: str, columns: list[str], body: Column | None = None) -> DataFrame:
    """key, document: title, a table of the non-empty cells in column order, and the enrichment carried over as it is."""
    cells = [
        F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", F.concat(F.lit(f"| {c} | "), F.replace(F.replace(F.col(c).cast("string"), F.lit("\n"), F.lit(" ")), F.lit("|"), F.lit("\\|")), F.lit(" |")))
        for c in columns
    ]
    table = F.array_join(F.array_compact(F.array(*cells)), "\n")
    parts = [F.concat(F.lit("# "), F.coalesce(F.nullif(F.trim(title), F.lit("")), F.lit("untitled"))), F.lit("| property | value |\n|---|---|"), table]
    return rows.select(key, F.concat_ws("\n", *[F.nullif(p, F.lit("")) for p in parts], *([body] if body is not None else [])).alias("document"))


def write_metadata(meta: DataFrame, path: str, order: list[Column], content: Column, fields: list[str]) -> None:
    """Two sinks of one table: all rows as JSON lines in order, the content rows as a tab-separated projection."""
    at = positions(meta, order, "line_no")
    at.repartitionByRange("line_no").sortWithinPartitions("line_no").write.mode("overwrite").json(f"{path}/meta_jsonl")
    at.filter(content).select("line_no", *fields).repartitionByRange("line_no").sortWithinPartitions("line_no").drop("line_no").write.mode("overwrite").csv(f"{path}/content_tsv", sep="\t", header=True)


def append_log(df: DataFrame, path: str) -> None:
    """Append rows to a log of JSON lines."""
    df.write.mode("append").json(path)


def document_changes(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """key, verdict of documents (key, path, document) against those of the last run: write, rename (another path, the same text),
    move (another path and text), remove, or keep.  Only the verdicts but the last touch a file."""
    a = before.select(key, F.struct("path", "document").alias("_a"))
    b = after.select(key, F.struct("path", "document").alias("_b"))
    same_path, same_text = F.col("_a.path").eqNullSafe(F.col("_b.path")), F.col("_a.document").eqNullSafe(F.col("_b.document"))
    verdict = F.when(F.col("_a").isNull(), "write").when(F.col("_b").isNull(), "remove").when(same_path & same_text, "keep").when(same_path, "write").when(same_text, "rename").otherwise("move")
    return a.join(b, key, "full_outer").select(key, verdict.alias("verdict"))


def with_stamp(document: Column, stamp: Column, marker: str, enrichment: Column) -> Column:
    """A document with its stamp line, the marker, and below it the enrichment carried over as it is."""
    return F.concat(F.lit("<!-- generated "), stamp, F.lit(" -->\n"), document, F.lit(f"\n\n{marker}\n"), F.coalesce(enrichment, F.lit("")))


def without_stamp(document: Column) -> Column:
    """The document that a stamp line does not change: what two runs are compared by."""
    return F.regexp_replace(document, r"^<!-- generated [^>]* -->\n", "")


def schema_document(columns: DataFrame, table: str, pos: str, name: str) -> DataFrame:
    """table, document: a section with a pipe table of each table's columns in order."""
    line = F.concat(F.lit("| "), (F.col(pos) + 1).cast("string"), F.lit(" | "), F.replace(F.col(name), F.lit("|"), F.lit("\\|")), F.lit(" |"))
    rows = columns.groupBy(table).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(pos, line.alias("line")))), lambda x: x["line"]), "\n").alias("body"))  # a table's columns
    return rows.select(table, F.concat(F.lit("## "), F.col(table), F.lit("\n\n| # | column |\n|---|---|\n"), "body").alias("document"))
