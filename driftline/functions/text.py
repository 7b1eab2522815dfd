"""String functions over columns: ids, names, cells, Markdown escapes, time spans, URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from driftline.functions.keys import _col


def dashed(c: Column | str) -> Column:
    """Id in 8-4-4-4-12 groups; what is not 32 characters long passes unchanged."""
    bare = F.regexp_replace(_col(c), "-", "")
    grouped = F.regexp_replace(bare, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.when(F.length(bare) == 32, grouped).otherwise(_col(c))


def is_id(c: Column | str) -> Column:
    """32 small hexadecimal digits."""
    return _col(c).rlike("^[0-9a-f]{32}$")


def file_name(c: Column | str, cap: int = 150) -> Column:
    """A title as a file name: characters no file system takes become spaces, no dots at the ends, ``untitled`` if nothing is left."""
    bare = F.regexp_replace(F.trim(_col(c)), r'[\\/:*?"<>|\x00-\x1f]', " ")
    cut = F.rtrim(F.left(F.regexp_replace(F.regexp_replace(bare, r"^[. ]+|[. ]+$", ""), " +", " "), F.lit(cap)))
    return F.coalesce(F.nullif(cut, F.lit("")), F.lit("untitled"))


def slug(c: Column | str, cap: int = 50) -> Column:
    """Small letters and digits, anything else one dash."""
    dashes = F.regexp_replace(F.lower(_col(c)), "[^a-z0-9]+", "-")
    return F.left(F.regexp_replace(dashes, "^-+|-+$", ""), F.lit(cap))


def md_cell(c: Column | str) -> Column:
    """Text as a cell of a pipe table."""
    return F.replace(F.replace(F.replace(_col(c), F.lit("\r"), F.lit("")), F.lit("\n"), F.lit(" ")), F.lit("|"), F.lit("\\|"))


def escape_md(c: Column | str) -> Column:
    """Backslash before every character that Markdown may read as an inline mark."""
    return F.regexp_replace(_col(c), r"([\\`*~<\[\]])", r"\\$1")


def unescape_md(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), r"\\([\\`*~<\[\]])", "$1")


# fixed values: what begins a block at the start of a line
_MARKER = r"(?:#{1,6}(?: |$)|-(?: |$)|\d+\.(?: |$)|>(?: |$)|\||\$\$|!\[|---\s*$)"


def starts_block(c: Column | str) -> Column:
    """Whether a line begins a block of its own rather than going on with a paragraph."""
    return _col(c).rlike(rf"^\s*(?:{_MARKER}|```|<!--|<details)")


def guard_lines(c: Column | str) -> Column:
    """Text whose lines begin no block: those that would get a backslash, also before backslashes of their own."""
    return F.regexp_replace(_col(c), rf"(?m)^(\\*{_MARKER})", r"\\$1")


def unguard_lines(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), rf"(?m)^\\(?=\\*{_MARKER})", "")


def relative_path(target: Column | str, source: Column | str) -> Column:
    """The path of ``target`` as seen from the folder of the file ``source``: up to where both part, and down from there."""
    t, s = F.split(_col(target), "/"), F.split(_col(source), "/")
    up = F.slice(s, F.lit(1), F.size(s) - 1)  # the folder
    n = F.least(F.size(up), F.size(t) - 1)
    # folders that both begin with: those before the first that differs
    same = F.aggregate(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), F.lit(0), lambda k, i: F.when((k == i) & (i < n) & (F.get(t, i) == F.get(up, i)), k + 1).otherwise(k))
    return F.concat(F.repeat(F.lit("../"), F.size(up) - same), F.array_join(F.slice(t, same + 1, F.size(t)), "/"))


def mask_stamps(c: Column | str) -> Column:
    """Dates and times replaced by a mark, so texts that differ only in stamps compare equal."""
    return F.regexp_replace(_col(c), r"\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}:?\d{2})?)?", "<stamp>")


def time_span(start: Column | str, end: Column | str) -> Column:
    """``start → end`` of ISO texts; on the same day only the end's time is repeated; without an end just the start."""
    s, e = _col(start), _col(end)
    same = (F.substring(s, 1, 10) == F.substring(e, 1, 10)) & (F.length(e) > 11)
    return F.when(e.isNull(), s).when(same, F.concat(s, F.lit(" → "), F.substring(e, 12, 100))).otherwise(F.concat(s, F.lit(" → "), e))


def plain_text(runs: Column | str) -> Column:
    """The plain texts of an array of runs joined; null for a null array."""
    return F.array_join(F.transform(_col(runs), lambda r: F.coalesce(r["plain_text"], F.lit(""))), "")


# fixed values: query parameters that carry credentials
CREDENTIALS = ("signature", "sig", "policy", "key-pair-id", "token", "file_token")


def strip_credentials(url: Column | str) -> Column:
    """URL without query parameters that grant access (those above and ``x-amz*``); the others keep their order."""
    u = _col(url)
    base, query = F.substring_index(u, "?", 1), F.when(u.contains("?"), F.regexp_extract(u, r"\?([^#]*)", 1))
    name = lambda p: F.lower(F.substring_index(p, "=", 1))
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: ~(name(p).isin(*CREDENTIALS) | name(p).startswith("x-amz"))), "&")
    fragment = F.regexp_extract(u, r"(#.*)$", 1)
    return F.when(query.isNull(), u).otherwise(F.concat(base, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")), fragment))


def text_key(c: Column | str) -> Column:
    """What makes two stored comments the same text: without the resolved mark and the id trailer, spaces collapsed."""
    bare = F.regexp_replace(_col(c), r"\s*\(resolved \d{4}-\d{2}-\d{2}\)|\s*`c:[0-9a-f]*`", "")
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def comment_mark(c: Column | str) -> Column:
    """The id in a line's comment trailer; null where there is none."""
    return F.nullif(F.regexp_extract(_col(c), r"`c:([0-9a-f]+)`", 1), F.lit(""))


# fixed values: endpoint families, the first that matches counts
ENDPOINTS = (
    ("block_children", r"^/v1/blocks/[^/]+/children$"),
    ("block", r"^/v1/blocks/"),
    ("source_query", r"^/v1/(?:databases|data_sources)/[^/]+/query$"),
    ("source", r"^/v1/(?:databases|data_sources)/"),
    ("property", r"^/v1/pages/[^/]+/properties/"),
    ("page", r"^/v1/pages/"),
    ("comments", r"^/v1/comments"),
    ("users", r"^/v1/users"),
    ("search", r"^/v1/search"),
    ("internal", r"^/api/"),
)


def endpoint_class(path: Column | str) -> Column:
    """Family of a request path; ``other`` where none matches."""
    out = F.lit("other")
    for name, pattern in reversed(ENDPOINTS):
        out = F.when(_col(path).rlike(pattern), name).otherwise(out)
    return out


def parse_ids(c: Column | str) -> Column:
    """Ids of a list separated by commas or blanks, dashes removed; one that is no id fails the query."""
    parts = F.filter(F.split(F.trim(_col(c)), r"[,\s]+"), lambda p: p != "")
    bare = F.transform(parts, lambda p: F.lower(F.replace(p, F.lit("-"), F.lit(""))))
    bad = F.filter(bare, lambda p: ~p.rlike("^[0-9a-f]{32}$"))
    return F.when(F.size(bad) > 0, F.raise_error(F.concat(F.lit("no valid id: "), bad[0])).cast("array<string>")).otherwise(bare)


def signature_matches(body: Column | str, signature: Column | str, secret: str) -> Column:
    """Whether ``sha256=...`` is the keyed digest of a body, from two nested built-in digests of padded keys."""
    import hashlib

    key = secret.encode("utf-8")
    key = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\x00")
    inner, outer = (F.unhex(F.lit(bytes(b ^ pad for b in key).hex())) for pad in (0x36, 0x5C))
    digest = F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, _col(body).cast("binary")), 256))), 256)
    return F.coalesce(_col(signature) == F.concat(F.lit("sha256="), digest), F.lit(False))
