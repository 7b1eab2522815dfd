"""Reading the mirror's files: CSV tables, JSON lines, state maps, documents, event logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_table_csv(spark: SparkSession, path: str, columns: list[str], key: str = "_row_id") -> DataFrame:
    """A CSV table as strings: embedded line breaks honoured, empty cells are '', of a repeated key the last row of its file counts."""
    schema = StructType([StructField(c, StringType()) for c in columns])
    raw = spark.read.schema(schema).csv(path, header=True, multiLine=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    rows = raw.na.fill("").withColumn("_pos", F.monotonically_increasing_id())
    last = rows.groupBy(key).agg(F.max(F.struct("_pos", *columns)).alias("r"))
    return last.select(*[F.col(f"r.{c}").alias(c) for c in columns], F.col("r._pos").alias("_pos"))


def read_jsonl(spark: SparkSession, path: str, schema: str, key: str, line_no: str = "line_no") -> DataFrame:
    """JSON lines that carry their line number: bad lines are skipped, the last value of a key counts, its first line is its position."""
    rows = spark.read.schema(schema).json(path, mode="DROPMALFORMED").filter(F.col(key).isNotNull())
    names = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max(F.struct(line_no, *[n for n in names if n != line_no])).alias("r"), F.min(line_no).alias("first_line")).select(
        key, *[F.col(f"r.{n}").alias(n) for n in names], "first_line"
    )


def read_state(spark: SparkSession, path: str, default_when_corrupt: bool = True) -> DataFrame:
    """A JSON map of state as (key, value) rows; a missing file is an empty state, a corrupt one too unless told otherwise."""
    from pyspark.errors import AnalysisException

    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException:
        return spark.createDataFrame([], "key string, value string")
    parsed = text.select(F.from_json("value", "map<string,string>").alias("m"), "value")
    if not default_when_corrupt:
        parsed = parsed.withColumn("m", F.when(F.col("m").isNull(), F.raise_error(F.lit("corrupt state")).cast("map<string,string>")).otherwise(F.col("m")))
    return parsed.filter("m IS NOT NULL").select(F.explode("m").alias("key", "value"))


def artifact_index(paths: DataFrame, path: str = "path") -> DataFrame:
    """id, kind, path of the files whose name ends in an id: tables (.csv), documents (.md), folders.  ``_schema`` files and partial folders are none."""
    found = paths.filter(~F.col(path).rlike(r"(^|/)_schema|\.partial(/|$)|\.tmp(/|$)"))
    ident = F.regexp_extract(path, r"([0-9a-f]{32})(?:\.md|\.csv)?$", 1)
    kind = F.when(F.col(path).endswith(".csv"), "table").when(F.col(path).endswith(".md"), "document").otherwise("folder")
    return found.select(ident.alias("id"), kind.alias("kind"), F.col(path).alias("path")).filter("id <> ''")


def corpus_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line_no (from 1), text of every line of the documents below a folder; partial folders are skipped."""
    docs = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.md").select(F.col("_metadata.file_path").alias("file"), "value")
    docs = docs.filter(~F.col("file").rlike(r"\.partial"))
    return docs.select("file", F.posexplode(F.split("value", "\n")).alias("n", "text")).select("file", (F.col("n") + 1).alias("line_no"), "text")


def document_sections(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, section_no, title, section_id, body: level-2 headings of a document with an optional back-quoted id; ``head`` is section 0."""
    parts = docs.select(key, F.posexplode(F.split(F.concat(F.lit("\n"), F.col(text)), r"\n## ")).alias("section_no", "raw"))
    first = F.substring_index("raw", "\n", 1)
    return parts.select(
        key, "section_no",
        F.when(F.col("section_no") > 0, F.trim(F.regexp_replace(first, r"\s*`[^`]*`\s*$", ""))).alias("title"),
        F.when(F.col("section_no") > 0, F.nullif(F.regexp_extract(first, r"`([^`]*)`\s*$", 1), F.lit(""))).alias("section_id"),
        F.when(F.col("section_no") == 0, F.expr("substring(raw, 2)")).otherwise(F.regexp_replace(F.expr("substring(raw, length(substring_index(raw, '\n', 1)) + 2)"), r"\n+$", "")).alias("body"),
    )


def document_region(text: str, name: str, heading: str):
    """The delimited region of a document, else what follows its heading, else null."""
    c = F.col(text)
    inside = F.regexp_extract(c, rf"(?s)<!-- {name} -->\n(.*?)\n?<!-- /{name} -->", 1)
    after = F.regexp_extract(c, rf"(?s)(?:^|\n){heading}\n(.*)$", 1)
    return F.when(c.contains(f"<!-- {name} -->"), inside).when(c.rlike(rf"(?:^|\n){heading}\n"), after)


def read_events(lines: DataFrame, must_contain: str, schema: str, value: str = "value") -> DataFrame:
    """Events of a log: a substring test before any JSON is parsed, then the lines that parse."""
    hit = lines.filter(F.col(value).contains(must_contain))
    return hit.select(F.from_json(value, schema).alias("e")).filter("e IS NOT NULL").select("e.*")


def config_rows(assignments: DataFrame) -> DataFrame:
    """Last assignment of each key wins: rows (priority, line_no, text) of KEY=value files; quotes, ``export`` and comments are understood."""
    rows = assignments.select("priority", "line_no", F.regexp_extract("text", r"^\s*(?:export\s+)?([A-Za-z_]\w*)\s*=\s*(.*?)\s*$", 1).alias("k"), F.regexp_extract("text", r"^\s*(?:export\s+)?[A-Za-z_]\w*\s*=\s*(.*?)\s*$", 1).alias("v"))
    rows = rows.filter("k <> ''").withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("priority"), F.desc("line_no"))))
    return rows.filter("rn = 1").select(F.col("k").alias("key"), F.regexp_replace("v", r"""^(["'])(.*)\1$""", "$2").alias("value"))
