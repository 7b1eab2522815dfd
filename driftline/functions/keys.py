"""Column functions that bring ids and instants of any spelling to one form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm_id(c: Column | str) -> Column:
    """Id without dashes in small letters; null stays null."""
    return F.lower(F.regexp_replace(_col(c), "-", ""))


def instant(c: Column | str) -> Column:
    """Timestamp named by an ISO string in any offset spelling; null where it names none."""
    text = F.regexp_replace(F.trim(_col(c)), r"([+-]\d{2})(\d{2})$", "$1:$2")
    text = F.when(text.rlike(r"^\d{4}-\d{2}"), text)
    return text.try_cast("timestamp")


def micros(c: Column | str) -> Column:
    """Microseconds of a timestamp since 1970 as bigint."""
    return F.unix_micros(_col(c).cast("timestamp"))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
