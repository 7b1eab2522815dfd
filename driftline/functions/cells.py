"""Typed properties (JSON ``{type, <type>: value}``) as flat cell texts, by built-in expressions.

Only formula and rollup objects, whose cells are the textual form of a nested value, go through an
Arrow UDF, and only in rows that hold one.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_TEXTS, _NAMED = "array<struct<plain_text:string>>", "array<struct<name:string>>"
_PERSON = "struct<name:string,id:string>"
#: All that a cell may need of a property, whatever its type: one reading of its JSON text.
PARTS = (
    f"type string, title {_TEXTS}, rich_text {_TEXTS}, number string, select struct<name:string>, status struct<name:string>, multi_select {_NAMED}, date struct<start:string,end:string>, "
    f"people array<{_PERSON}>, files array<struct<name:string,external:struct<url:string>,file:struct<url:string>>>, checkbox string, url string, email string, phone_number string, "
    f"created_time string, last_edited_time string, relation array<struct<id:string>>, created_by {_PERSON}, last_edited_by {_PERSON}, unique_id struct<prefix:string,number:string>, "
    "verification struct<state:string>, button string"
)


def parts_of(prop: str) -> str:
    """SQL text of the parts of a property's column; all null where it is not JSON, a part null where it has another shape."""
    return f"from_json({prop}, '{PARTS}')"


def _form(v) -> str:
    """The textual form of a value: None, True, numbers as they print, objects with single quotes."""
    return str(v)


@F.pandas_udf(StringType())
def nested_cell(raw: pd.Series) -> pd.Series:
    """Cells of formula and rollup properties; malformed JSON comes back as it is."""

    def one(text):
        if text is None:
            return None
        try:
            p = json.loads(text)
        except ValueError:
            return text
        if not isinstance(p, dict):
            return text
        kind = p.get("type")
        v = p.get(kind)
        if not isinstance(v, dict):
            return "" if v is None else _form(v)
        inner = v.get(v.get("type"))
        if kind == "rollup" and v.get("type") == "array":
            parts = []
            for x in inner if isinstance(inner, list) else []:
                t = x.get("type") if isinstance(x, dict) else None
                y = x.get(t) if t else x
                if isinstance(y, list):
                    y = "".join(r.get("plain_text", r.get("name", "")) for r in y if isinstance(r, dict))
                elif isinstance(y, dict):
                    y = y.get("name", y.get("start", ""))
                parts.append("" if y is None else _form(y))
            return " | ".join(x for x in parts if x)
        if kind == "rollup" and v.get("type") not in ("number", "date"):
            return ""
        return _form(inner)

    return raw.map(one, na_action="ignore")


_PLAIN_KINDS = ("number", "url", "email", "phone_number", "created_time", "last_edited_time", "button")


def _cell_text(p: str, v: str) -> str:
    """SQL text of a cell, from the columns of a property's JSON text and of its parts.  Text, as it is read much faster than a tree of columns is built."""
    joined = lambda xs, one, by: f"coalesce(array_join(transform({v}.{xs}, x -> {one}), '{by}'), '')"
    named = lambda x: f"coalesce(nullif({x}.name, ''), {x}.id)"
    cases = {
        **{k: joined(k, "coalesce(x.plain_text, '')", "") for k in ("title", "rich_text")},
        **{k: f"coalesce({v}.{k}, '')" for k in _PLAIN_KINDS},
        **{k: f"coalesce({v}.{k}.name, '')" for k in ("select", "status")},
        **{k: f"coalesce({named(f'{v}.{k}')}, '')" for k in ("created_by", "last_edited_by")},
        "multi_select": joined("multi_select", "x.name", ", "),
        "date": f"concat_ws(' → ', {v}.date.start, {v}.date.end)",
        "people": joined("people", named("x"), ", "),
        "files": joined("files", "coalesce(nullif(x.name, ''), x.external.url, x.file.url)", ", "),
        "checkbox": f"if({v}.checkbox <=> 'true', 'true', 'false')",
        "relation": joined("relation", "x.id", ", "),
        "unique_id": f"if({v}.unique_id.number IS NULL, '', concat_ws('-', nullif({v}.unique_id.prefix, ''), {v}.unique_id.number))",
        "verification": f"coalesce({v}.verification.state, '')",
    }
    other = rf"""coalesce(regexp_extract({p}, r'"type"\s*:\s*"[^"]*"\s*,\s*"[^"]*"\s*:\s*(.*)\}}\s*$', 1), '')"""
    when = " ".join(f"WHEN '{k}' THEN {text}" for k, text in cases.items())
    return f"CASE WHEN {v}.type IS NULL THEN coalesce({p}, '') ELSE CASE {v}.type {when} ELSE {other} END END"


def cell(prop: str, parts: str | None = None) -> Column:
    """The cell text of a property's column; empty for null values, the raw text for what cannot be read.

    ``parts`` is the column of the property's parts where a projection before this one has read them already.
    """
    return F.expr(_cell_text(prop, parts or parts_of(prop)))


def full_cell(prop: str, parts: str | None = None) -> Column:
    """As ``cell``, with formulas and rollups."""
    nested = F.coalesce(F.expr(f"{parts or parts_of(prop)}.type IN ('formula', 'rollup')"), F.lit(False))
    return F.when(nested, nested_cell(F.when(nested, F.col(prop)))).otherwise(cell(prop, parts))


def flatten_cells(rows: DataFrame, keep: list[str], props: dict[str, Column], nested: set[str] = frozenset()) -> DataFrame:
    """``keep`` and one cell per property.  Every property is parsed once, in a projection of its own.

    Properties that may be formulas or rollups are named in ``nested``.
    """
    first = rows.select(*keep, *[c.alias(f"_p_{k}") for k, c in props.items()])
    read = first.select("*", *[F.expr(parts_of(f"_p_{k}")).alias(f"_v_{k}") for k in props])
    return read.select(*keep, *[(full_cell if k in nested else cell)(f"_p_{k}", f"_v_{k}").alias(k) for k in props])
