"""Block trees to Markdown and back.

``render`` writes the blocks of a page in tree order, ``parse_blocks`` reads lines into blocks, and
``to_record`` makes a block tree of them again.  Both directions keep a stack of their own, so blocks may
nest to any depth.  The line of a block that is itself written or read is in ``operators.richtext``.
The Spark side maps both over rows, so one record's blocks are all that is ever held.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.functions.jsontext import clean, parse
from driftline.operators.richtext import MARKS, escape, inline, link, merge_runs, normal, parse_inline, plain, visible  # noqa: F401

# fixed values: the lines and signs that stand for blocks
BULLETS = {"bulleted_list_item": "- ", "numbered_list_item": "1. ", "toggle": "- ▸ "}
HEADINGS = {"heading_1": "# ", "heading_2": "## ", "heading_3": "### "}
SUB_PAGE, SUB_TABLE, LINK_TO = "- 📄 **{title}** — sub-page `{id}`", "- 🗄️ **{title}** — database `{id}` (rows in workspace/_databases/)", "- 🔗 link to `{id}`"
URL_SIGNS = {"bookmark": "🔖", "embed": "🖼️", "link_preview": "👁️"}
CONTENTS, TEMPLATE, CAPTION, MEETING = "- 📑 (table of contents)", "- 🧩 (template: {text})", "- 📝", "- 🎙️ **AI meeting notes: {title}**"
TABS = {"summary_block_id": "Summary", "notes_block_id": "Notes", "transcript_block_id": "Transcript"}
UNHANDLED = "<!-- unhandled block type: {type} -->"
MEDIA = ("image", "file", "pdf", "video", "audio")
LANGUAGES = {"py": "python", "js": "javascript", "sh": "bash", "": "plain text"}

#: Blocks whose children stand deeper than themselves, and those that have no line of their own.
_NESTS = {*BULLETS, *HEADINGS, "to_do"}
_BARE_BOX = ("column_list", "column", "synced_block")
#: Levels below the top that a push can rebuild.
MAX_NESTING = 2
_MARKER = r"(?:#{1,6}(?: |$)|-(?: |$)|\d+\.(?: |$)|>(?: |$)|\||\$\$|!\[|---\s*$)"
_STARTS = re.compile(rf"\s*(?:{_MARKER}|```|<!--|<details)")
_LEADS = re.compile(rf"\\*{_MARKER}")
_LED = re.compile(rf"\\(?=\\*{_MARKER})")
_INNER = re.compile(r"\[[ xX]\](?: |$)|▸(?: |$)|📝(?: |$)")


def starts_block(line: str) -> bool:
    """Whether a line begins a block, rather than going on with the text above."""
    return bool(_STARTS.match(line))


def split_icon(text: str) -> tuple[str, str]:
    """(icon, rest): a leading symbol character and its joiners are a callout's icon."""
    i = 0
    while i < len(text) and (unicodedata.category(text[i]) in ("So", "Sk") or (i and text[i] in "\ufe0f\u200d")):
        i += 1
    return text[:i], text[i:].lstrip(" ") if i else text


def _guard(line: str) -> str:
    """A line of text that would begin a block, with a backslash before it."""
    return "\\" + line if _LEADS.match(line) else line


def _unguard(line: str) -> str:
    return line[1:] if _LED.match(line) else line


def _looks_inner(text: str) -> bool:
    icon, _ = split_icon(text)
    return bool(_INNER.match(text)) or text.startswith(" ") or bool(icon and (text[len(icon) :].startswith(" ") or text == icon))


def _guard_inner(text: str) -> str:
    """Text of an item that would be read as another kind of item, with a backslash before it."""
    return "\\" + text if _looks_inner(text) or (text.startswith("\\") and _looks_inner(text.lstrip("\\"))) else text


def _unguard_inner(text: str) -> str:
    return text[1:] if text.startswith("\\") and _looks_inner(text.lstrip("\\")) else text


def _bare(i) -> str:
    return str(i or "").replace("-", "")


def _broken(text: str) -> list[str]:
    """The lines of a text, without blanks around them; all but the last end in the two blanks of a hard break."""
    lines = [x.lstrip() for x in text.split("\n")]
    return [x.rstrip() + "  " for x in lines[:-1]] + [lines[-1].rstrip()]


def pipe_table(rows: list[list[str]]) -> list[str]:
    """A pipe table with a separator below its first row; ragged rows are padded, bars and line breaks in cells are escaped."""
    if not rows:
        return []
    width = max(len(r) for r in rows)
    cell = lambda c: c.replace("|", "\\|").replace("\n", " ")
    line = lambda r: "| " + " | ".join([*(cell(c) for c in r), *[""] * (width - len(r))]) + " |"
    return [line(rows[0]), "|" + "---|" * width, *(line(r) for r in rows[1:])]


def _span_of(*places: dict) -> str:
    """Start and end of the first of some records that has any."""
    for x in places:
        if isinstance(x, dict) and (x.get("start_time") or x.get("end_time")):
            return " → ".join(str(t) for t in (x.get("start_time"), x.get("end_time")) if t)
    return ""


def _text_lines(kind: str, p: dict, lead: str) -> list[str]:
    """An item of one line, its further lines behind hard breaks."""
    text = inline(p.get("rich_text"))
    first, *more = _broken(text) if text.strip() else [""]
    if first.strip():
        first = _guard(first) if kind in HEADINGS else _guard_inner(first)
    return [(lead + first) if first or more else lead.rstrip(), *(_guard(x) for x in more)]


def _own_lines(b: dict, kind: str, p: dict) -> list[str]:
    """The lines of one block without its children."""
    title = p.get("title") if isinstance(p.get("title"), str) else plain(p.get("title"))
    if kind == "paragraph":
        text = inline(p.get("rich_text"))
        return [_guard(x) for x in _broken(text)] if text else [""]
    if kind in HEADINGS:
        return _text_lines(kind, p, HEADINGS[kind])
    if kind in BULLETS:
        return _text_lines(kind, p, BULLETS[kind])
    if kind == "to_do":
        return _text_lines(kind, p, f"- [{'x' if p.get('checked') else ' '}] ")
    if kind in ("quote", "callout"):
        icon = ((p.get("icon") or {}).get("emoji") or "") if kind == "callout" and isinstance(p.get("icon"), dict) else ""
        first, *more = _broken(inline(p.get("rich_text")))
        # an empty first line of a quote is a backslash: a blank there says callout without an icon
        first = (f"{icon} " if kind == "callout" else "") + (_guard_inner(_guard(first)) if first.strip() else first if kind == "callout" else "\\" + first)
        return ["> " + first, *("> " + _guard(x) for x in more)]
    if kind == "code":
        body = plain(p.get("rich_text"))
        fence = "```"
        while fence in body:
            fence += "`"
        language = p.get("language") or ""
        caption = inline(p.get("caption")).strip()
        return [fence + ("" if language == "plain text" else language), *body.split("\n"), fence, *([f"{CAPTION} {caption}".replace("\n", " ")] if caption else [])]
    if kind == "divider":
        return ["---"]
    if kind == "equation":
        return ["$$", *(p.get("expression") or "").split("\n"), "$$"]
    if kind in MEDIA:
        caption = (inline(p.get("caption")) or kind).replace("\n", " ")
        hosted = isinstance(p.get("file"), dict)
        url = f"ATTACH:{_bare(b.get('id'))}" if hosted else ((p.get("external") or {}).get("url") or "")
        return [f"![{caption}]({url})"]
    if kind in URL_SIGNS:
        url = p.get("url") or ""
        return [f"- {URL_SIGNS[kind]} [{(inline(p.get('caption')) or url)}]({url})".replace("\n", " ")]
    if kind in ("child_page", "child_database"):
        return [(SUB_PAGE if kind == "child_page" else SUB_TABLE).format(title=title or "untitled", id=_bare(b.get("id")))]
    if kind == "link_to_page":
        return [LINK_TO.format(id=_bare(p.get("page_id") or p.get("database_id") or p.get("comment_id")))]
    if kind == "template":
        return [TEMPLATE.format(text=inline(p.get("rich_text"))).replace("\n", " ")]
    if kind == "table_of_contents":
        return [CONTENTS]
    if kind in ("meeting_notes", "transcription"):
        event = p.get("calendar_event") if isinstance(p.get("calendar_event"), dict) else {}
        when, who, status = _span_of(event, p.get("recording")), event.get("attendees") or [], p.get("status")
        head = MEETING.format(title=title.strip() or "untitled") + (f" — {when}" if when else "") + (" · " + ", ".join(map(str, who)) if who else "")
        return [head + (f" ({status.replace('_', ' ')})" if isinstance(status, str) and status != "notes_ready" else "")]
    if kind in _BARE_BOX or kind in ("breadcrumb", "_tab"):
        return []
    text = inline(p.get("rich_text"))
    return text.split("\n") if text else [UNHANDLED.format(type=kind)]


class _Level:
    """Blocks that are being written: where to, how deep, and what to do at their end."""

    __slots__ = ("blocks", "lines", "indent", "ident", "behind")

    def __init__(self, blocks, lines, indent, ident="", behind=None):
        self.blocks, self.lines, self.indent, self.ident, self.behind = iter(blocks), lines, indent, ident, behind


def render(record: dict) -> str:
    """Markdown of a record with ``blocks`` and optionally ``children`` (map from a parent's id).

    Children of items and headings are indented by two blanks; those of quotes and callouts go on behind a bare
    ``>``; boxes have no line of their own.  A block within itself is left out.
    """
    top = record.get("children")
    listed = {_bare(k).lower(): v for k, v in top.items()} if isinstance(top, dict) else {}

    def kids(b: dict, kind: str, p: dict) -> list[dict]:
        ident = b.get("id")
        if kind == "synced_block" and isinstance(p.get("synced_from"), dict):
            ident = p["synced_from"].get("block_id") or ident
        own = p.get("children")
        got = own if isinstance(own, list) else listed.get(_bare(ident).lower())
        return [x for x in got or [] if isinstance(x, dict)]

    out: list[str] = []
    open_: set[str] = set()
    levels = [_Level(record.get("blocks") or [], out, int(record.get("indent") or 0))]
    while levels:
        at = levels[-1]
        b = next(at.blocks, None)
        if b is None:
            levels.pop()
            open_.discard(at.ident)
            if at.behind is not None:
                lines, prefix = at.behind
                lines.append(prefix + ">")
                lines.extend(f"{prefix}> {x}" if x.strip() else prefix + ">" for x in at.lines)
            continue
        if not isinstance(b, dict):
            continue
        kind = b.get("type") if isinstance(b.get("type"), str) else "unsupported"
        p = b.get(kind) if isinstance(b.get(kind), dict) else {}
        ident, lines, prefix = _bare(b.get("id")).lower(), at.lines, "  " * at.indent
        if ident and ident in open_:
            continue
        last = lines[-1] if lines else ""
        if kind == "table":
            rows = [[inline(c) if isinstance(c, list) else "" for c in ((k.get("table_row") or {}).get("cells") or [])] for k in kids(b, kind, p)]
            if rows and last.lstrip().startswith("|"):
                lines.append("")
            lines.extend(prefix + x for x in pipe_table(rows))
            continue
        if kind == "_tab":
            if last.strip():
                lines.append("")
            lines.append(f"{prefix}**{p['label']}**")
        elif kind == "paragraph" and last.strip() and not starts_block(last):
            lines.append("")  # else it would be read as more of the text above
        elif kind in ("quote", "callout") and last.lstrip().startswith(">"):
            lines.append("")
        lines.extend((prefix + x) if x else x for x in _own_lines(b, kind, p))
        below = kids(b, kind, p)
        if not below:
            continue
        if kind in ("meeting_notes", "transcription"):
            names = {_bare(v): k for k, v in p["children"].items() if v} if isinstance(p.get("children"), dict) else {}
            below = [{"type": "_tab", "id": x.get("id"), "_tab": {"label": TABS.get(names.get(_bare(x.get("id"))), "Other tab"), "children": kids(x, x.get("type"), x.get(x.get("type")) or {})}} for x in below]
        if ident:
            open_.add(ident)
        if kind in ("quote", "callout"):
            levels.append(_Level(below, [], 0, ident, (lines, prefix)))
        else:
            levels.append(_Level(below, lines, at.indent + (kind in _NESTS), ident))
    return "\n".join(out)


_ITEM = re.compile(r"- \[([ xX])\](?: (.*))?$|- (▸)(?: (.*))?$|-(?: (.*))?$|\d+\.(?: (.*))?$", re.S)
_HEAD = re.compile(r"(#{1,6})(?: (.*))?$", re.S)
_MEDIA_LINE = re.compile(r"!\[(.+)\]\((https?://[^)]+|ATTACH:[0-9a-f]{32})\)$")
_CELLS = re.compile(r"(?<!\\)\|")
_RULE = re.compile(r"\s*:?-{3,}:?\s*")
_ANY_STANDIN = re.compile(r"- [📄🗄🔗🔖🖼👁📑🧩🎙]\ufe0f?(?: |$)")
_STANDIN = re.compile(r"^- (?:📄 \*\*(?P<page>.*)\*\* — sub-page|🗄️ \*\*(?P<table>.*)\*\* — database|🔗 link to) `(?P<id>[^`]*)`(?P<rest>.*)$|^- (?:🔖|🖼️|👁️) \[(?P<label>.*)\]\((?P<url>[^)]*)\)$")


def standin(line: str, nested: bool = False) -> dict | None:
    """What a line that stands for something outside the document is to become; None for other lines.

    ``rebuilt``: a block can be made (links, bookmarks).  ``kept``: the target is a document of its own, which is
    not made anew from a line.  ``refused``, with a reason: no valid id, text behind it, no URL, a
    sub-document inside another block, where it cannot be moved to, or a sign without what belongs to it.
    """
    m = _STANDIN.match(line)
    if not m:
        if line == CONTENTS:
            return {"type": "table_of_contents", "state": "kept", "reason": ""}
        if re.fullmatch(re.escape(TEMPLATE).replace(r"\{text\}", ".*"), line):
            return {"type": "template", "state": "kept", "reason": ""}
        if line.startswith(MEETING.partition("{")[0]):
            return {"type": "meeting_notes", "state": "kept", "reason": ""}
        return {"type": "unsupported", "state": "refused", "reason": "incomplete"} if _ANY_STANDIN.match(line) else None
    if m["url"] is not None:
        kind = {"🔖": "bookmark", "👁": "link_preview"}.get(line[2], "embed")
        ok = re.match(r"https?://", m["url"])
        return {"type": kind, "state": "rebuilt" if ok else "refused", "reason": "" if ok else "no URL", "url": m["url"], "label": m["label"]}
    kind = "child_page" if m["page"] is not None else "child_database" if m["table"] is not None else "link_to_page"
    rest = m["rest"].strip()
    if kind == "child_database" and SUB_TABLE.endswith(rest or "\0"):
        rest = ""
    reason = ""
    if not re.fullmatch(r"[0-9a-f]{32}", m["id"]):
        reason = "no valid id"
    elif rest:
        reason = "text behind it"
    elif nested and kind != "link_to_page":
        reason = "inside another block"
    state = "refused" if reason else "rebuilt" if kind == "link_to_page" else "kept"
    return {"type": kind, "state": state, "reason": reason, "id": m["id"], "title": m["page"] or m["table"] or ""}


class _Lines:
    """Lines that are being read: a document, or the inside of a quote."""

    __slots__ = ("lines", "first", "i", "above", "owner", "level", "soft")

    def __init__(self, lines: list[str], first: int, owner: int, level: int, soft: bool):
        self.lines, self.first, self.i, self.owner, self.level, self.soft = lines, first, 0, owner, level, soft
        self.above: list[tuple[int, int, int]] = []  # indent, block, level


def _indent(line: str) -> int:
    return len(line) - len(line.lstrip(" "))


def _goes_on(d: _Lines, ind: int, hard: bool) -> bool:
    """Whether the next line belongs to the text of the line at i."""
    if d.i + 1 >= len(d.lines):
        return False
    now, nxt = d.lines[d.i], d.lines[d.i + 1]
    return bool(nxt.strip()) and not starts_block(nxt) and _indent(nxt) <= ind and (now.endswith("  ") if hard else True)


def _wrapped(d: _Lines, text: str, ind: int, hard: bool) -> str:
    """``text`` with the lines that go on from it: after two blanks a line break, else one blank between."""
    while _goes_on(d, ind, hard):
        gap = "\n" if d.lines[d.i].endswith("  ") else " "
        d.i += 1
        text = text.rstrip(" ") + gap + _unguard(d.lines[d.i].strip())
    return text.rstrip(" ")


def parse_blocks(text: str) -> list[dict]:
    """Blocks of Markdown lines: line_no, indent, parent (index of the enclosing block or -1), level, type, runs, extra, refused.

    The parent is the last block with a smaller indent, or the quote whose inside it is.  A fence or equation
    without an end goes on to the end.  ``refused`` says why a block cannot be rebuilt from its line; null where it can.
    """
    out: list[dict] = []
    todo = [_Lines(text.split("\n"), 1, -1, 0, True)]
    while todo:
        d = todo[-1]
        if d.i >= len(d.lines):
            todo.pop()
            continue
        raw = d.lines[d.i].rstrip()
        t = raw.strip()
        if not t:
            d.i += 1
            continue
        ind, start = _indent(raw), d.i
        while d.above and d.above[-1][0] >= ind:
            d.above.pop()
        parent, level = (d.above[-1][1], d.above[-1][2] + 1) if d.above else (d.owner, d.level)
        kind, runs, extra, refused, inside = _one(d, t, ind, bool(d.above) or d.owner >= 0)
        d.i += 1
        if refused is None and level > MAX_NESTING:
            refused = f"nested deeper than {MAX_NESTING}"
        if kind == "caption":
            out[-1]["extra"]["caption"] = runs
            continue
        out.append({"line_no": d.first + start, "indent": ind // 2, "parent": parent, "level": level, "type": kind, "runs": runs, "extra": extra, "refused": refused})
        d.above.append((ind, len(out) - 1, level))
        if inside is not None:
            todo.append(_Lines(inside[1], inside[0], len(out) - 1, level + 1, False))
    return out


def _until(d: _Lines, ind: int, ends) -> list[str]:
    """The lines up to one that ends them; stands on that line after."""
    body = []
    d.i += 1
    while d.i < len(d.lines) and not ends(d.lines[d.i].strip()):
        line = d.lines[d.i]
        body.append(line[min(ind, _indent(line)) :])
        d.i += 1
    return body


def _one(d: _Lines, t: str, ind: int, nested: bool) -> tuple[str, list[dict], dict, str | None, tuple[int, list[str]] | None]:
    """Read the block that begins at line i, and stand on its last line: type, runs, extra, refused, (line number, lines) of a quote's inside."""
    m = _HEAD.match(t)
    if m:
        body = _wrapped(d, _unguard(m[2] or "") + ("  " if d.lines[d.i].endswith("  ") else ""), ind, True)
        return f"heading_{min(3, len(m[1]))}", parse_inline(body), {}, None, None
    if t.startswith("<!--"):
        of = re.fullmatch(re.escape(UNHANDLED).replace(r"\{type\}", r"(\w+)"), t)
        return "unsupported", [], {"of": of[1]} if of else {"comment": t}, "a comment of the mirror" if of else "a comment", None
    if t.startswith("```"):
        fence = re.match(r"`+", t)[0]
        language = t[len(fence) :].strip()
        body = _until(d, ind, lambda x: x.startswith(fence) and not x.strip("`"))
        return "code", [], {"language": LANGUAGES.get(language.lower(), language), "text": "\n".join(body)}, None, None
    if t == "$$":
        return "equation", [], {"expression": "\n".join(x.rstrip() for x in _until(d, ind, lambda x: x == "$$"))}, None, None
    if t == "---":
        return "divider", [], {}, None, None
    if t.startswith("|") and t.endswith("|") and len(t) > 1:
        rows = []
        while d.i < len(d.lines) and d.lines[d.i].strip().startswith("|"):
            cells = _CELLS.split(d.lines[d.i].strip())[1:]
            cells = cells[:-1] if cells and not cells[-1].strip() else cells
            if not cells or not all(_RULE.fullmatch(c) for c in cells):
                rows.append([parse_inline(c.strip().replace("\\|", "|")) for c in cells])
            d.i += 1
        d.i -= 1
        return "table", [], {"cells": rows}, None if rows else "a table without rows", None
    if t == ">" or t.startswith("> "):
        return _quote(d, ind)
    m = _MEDIA_LINE.match(t)
    if m:
        hosted = m[2].startswith("ATTACH:")
        caption = [] if m[1] in MEDIA else parse_inline(m[1])
        return (m[1] if m[1] in MEDIA else "image"), caption, {"url": m[2]}, "a file of the page" if hosted else None, None
    out_of_here = standin(t, nested)
    if out_of_here:
        kind, reason = out_of_here.pop("type"), out_of_here.get("reason") or None
        return kind, [], out_of_here, reason, None
    m = _ITEM.match(t)
    if m:
        before = d.lines[d.i - 1].strip() if d.i else ""
        if t.startswith(CAPTION + " ") and before.startswith("```") and not before.strip("`"):
            return "caption", parse_inline(t[len(CAPTION) + 1 :]), {}, None, None
        if m[1]:
            kind, body, extra = "to_do", m[2], {"checked": m[1] != " "}
        elif m[3]:
            kind, body, extra = "toggle", m[4], {}
        elif t[0] == "-":
            kind, body, extra = "bulleted_list_item", m[5], {}
        else:
            kind, body, extra = "numbered_list_item", m[6], {}
        body = _wrapped(d, _unguard_inner((body or "") + ("  " if d.lines[d.i].endswith("  ") else "")), ind, True)
        return kind, parse_inline(body), extra, None, None
    body = _wrapped(d, _unguard(t), ind, not d.soft)
    return "paragraph", parse_inline(body), {}, None, None


def _quote(d: _Lines, ind: int) -> tuple[str, list[dict], dict, None, tuple[int, list[str]] | None]:
    """All lines of a region of ``>``: the text of a quote or callout, then its inside."""
    first = d.i
    inner: list[str] = []
    while d.i < len(d.lines):
        line = d.lines[d.i]
        rest = line[_indent(line) :]
        if _indent(line) != ind or not (rest.rstrip() == ">" or rest.startswith("> ")):
            break
        inner.append(rest[2:] if rest.startswith("> ") else "")
        d.i += 1
    d.i -= 1
    head, extra = inner[0], {}
    icon, rest = split_icon(head)
    kind = "quote"
    if (icon and (head[len(icon) :].startswith(" ") or head.rstrip() == icon)) or head.startswith(" "):
        kind, head = "callout", (head[len(icon) + 1 :] if icon else head[1:])
        extra = {"icon": icon} if icon else {}
    k = 1
    if kind == "quote" and starts_block(head):
        text, k = "", 0
    elif kind == "quote" and head.rstrip(" ") == "\\":
        text = " " * (len(head) - 1)
    else:
        text = _unguard(_unguard_inner(head))
    while k and k < len(inner) and inner[k - 1].endswith("  ") and inner[k].strip() and not starts_block(inner[k]) and not _indent(inner[k]):
        text = text.rstrip(" ") + "\n" + _unguard(inner[k])
        k += 1
    return kind, parse_inline(text.rstrip(" ")), extra, None, (d.first + first + k, inner[k:]) if k < len(inner) else None


def to_record(blocks: list[dict]) -> dict:
    """Parsed blocks as a record again, children inside their parents; what stands for a block outside keeps its id or URL."""
    made: list[dict] = []
    top: list[dict] = []
    for n, b in enumerate(blocks):
        kind, x = b["type"], b["extra"]
        p: dict = {"rich_text": b["runs"]}
        one = {"id": f"{n + 1:032x}", "type": kind, kind: p}
        if kind == "to_do":
            p["checked"] = x["checked"]
        elif kind == "callout" and x.get("icon"):
            p["icon"] = {"emoji": x["icon"]}
        elif kind == "code":
            p.update(rich_text=[{"type": "text", "plain_text": x["text"]}], language=x["language"], caption=x.get("caption", []))
        elif kind == "equation":
            p["expression"] = x["expression"]
        elif kind == "table":
            p["children"] = [{"type": "table_row", "table_row": {"cells": row}} for row in x["cells"]]
        elif kind in MEDIA:
            p["caption"] = b["runs"]
            if x["url"].startswith("ATTACH:"):
                one["id"], p["file"] = x["url"][7:], {"url": ""}
            else:
                p["external"] = {"url": x["url"]}
        elif kind in URL_SIGNS:
            p.update(url=x.get("url"), caption=[] if x.get("label") == x.get("url") else parse_inline(x.get("label") or ""))
        elif kind in ("child_page", "child_database"):
            one["id"], p["title"] = x.get("id"), x.get("title")
        elif kind == "link_to_page":
            p["page_id"] = x.get("id")
        made.append(one)
        if b["parent"] < 0:
            top.append(one)
        else:
            made[b["parent"]][made[b["parent"]]["type"]].setdefault("children", []).append(one)
    return {"blocks": top}


def shape(record: dict) -> list[tuple]:
    """(level, type, visible text) of the blocks that a document can hold, in order: what must survive a round trip."""
    return [(b["level"], b["type"], visible(b["runs"])) for b in parse_blocks(render(record))]


_PROMOTE = re.compile(r"https?://[^\s)>\]]+|(?<![0-9a-f])[0-9a-f]{32}(?![0-9a-f])")


def promote_links(items: list[dict]) -> list[dict]:
    """Neighbouring plain runs joined, and the URLs and ids inside the joined text made links and mentions."""
    out: list[dict] = []
    for plain, group in groupby(items, key=lambda r: r.get("type", "text") == "text" and not r.get("href") and not any((r.get("annotations") or {}).values())):
        if not plain:
            out.extend(group)
            continue
        text, at = "".join(r.get("plain_text") or "" for r in group), 0
        for m in _PROMOTE.finditer(text):
            if m.start() > at:
                out.append({"type": "text", "plain_text": text[at : m.start()]})
            url = m[0].startswith("http")
            out.append({"type": "text", "plain_text": m[0], "href": m[0]} if url else {"type": "mention", "plain_text": m[0], "mention": {"page": {"id": m[0]}}})
            at = m.end()
        if at < len(text):
            out.append({"type": "text", "plain_text": text[at:]})
    return out


def trim_payload(value, text_cap: int, list_cap: int):
    """A payload with its texts and lists cut to a size, at any depth; for fixtures and messages, never for stored data."""
    if isinstance(value, str):
        return value[:text_cap]
    if isinstance(value, list):
        return [trim_payload(v, text_cap, list_cap) for v in value[:list_cap]]
    if isinstance(value, dict):
        return {k: trim_payload(v, text_cap, list_cap) for k, v in value.items()}
    return value


def table_width(record: dict) -> int:
    """Cells of the widest table row of a record."""
    width, todo = 0, [record]
    while todo:
        x = todo.pop()
        if isinstance(x, dict):
            cells = (x.get("table_row") or {}).get("cells") if isinstance(x.get("table_row"), dict) else None
            width = max(width, len(cells) if isinstance(cells, list) else 0)
            todo.extend(x.values())
        elif isinstance(x, list):
            todo.extend(x)
    return width


def rendered(trees: DataFrame, key: str = "tree_no", body: str = "body") -> DataFrame:
    """key, markdown of each record; null where the body is no JSON object."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                ok, value = parse(text)
                out.append(clean(render(value)) if ok and isinstance(value, dict) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["key", "markdown"])

    return trees.select(F.col(key).cast("bigint").alias("key"), F.col(body).cast("string")).mapInArrow(task, "key bigint, markdown string").withColumnRenamed("key", key)


def parsed(texts: DataFrame, key: str, body: str) -> DataFrame:
    """key, block_pos, line_no, indent, parent_pos, level, type, plain_text, detail (JSON), refused of every block of every text."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (k, n, b["line_no"], b["indent"], b["parent"], b["level"], b["type"], "".join(r["plain_text"] for r in b["runs"]), json.dumps(b["extra"], ensure_ascii=False), b["refused"])
                for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                for n, b in enumerate(parse_blocks(text or ""))
            ]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 10
            types = [pa.int64(), *[pa.int32()] * 5, *[pa.string()] * 4]
            names = ["key", "block_pos", "line_no", "indent", "parent_pos", "level", "type", "plain_text", "detail", "refused"]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names)

    ddl = "key bigint, block_pos int, line_no int, indent int, parent_pos int, level int, type string, plain_text string, detail string, refused string"
    return texts.select(F.col(key).cast("bigint").alias("key"), F.col(body).cast("string")).mapInArrow(task, ddl).withColumnRenamed("key", key)


def round_trips(trees: DataFrame, body: str = "body", key: str = "tree_no") -> DataFrame:
    """key, runs, kept, blocks, stable of each record.

    runs: its rich texts, kept: those that read back with all visible characters, marks, code, links and equations;
    blocks: those of its document, stable: whether the document, read and written again, is read as the same blocks
    and written the same from then on.  Bodies that are no JSON object have no blocks and are stable.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[], [], [], []]
            for text in batch.column(1).to_pylist():
                ok, value = parse(text)
                a = b = 0
                todo = [value] if ok else []
                while todo:
                    x = todo.pop()
                    if isinstance(x, dict):
                        for k, v in x.items():
                            if k in ("rich_text", "caption") and isinstance(v, list):
                                a += 1
                                b += visible(parse_inline(inline(v))) == visible(v)
                            else:
                                todo.append(v)
                    elif isinstance(x, list):
                        todo.extend(x)
                blocks, same = [], True
                if ok and isinstance(value, dict):
                    blocks = parse_blocks(render(value))
                    again = render(to_record(blocks))
                    back = parse_blocks(again)
                    look = lambda bs: [(x["level"], x["type"], visible(x["runs"])) for x in bs]
                    same = look(back) == look(blocks) and render(to_record(back)) == again
                for col, v in zip(cols, (a, b, len(blocks), same), strict=True):
                    col.append(v)
            types = [pa.int32(), pa.int32(), pa.int32(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], ["key", "runs", "kept", "blocks", "stable"])

    ddl = "key bigint, runs int, kept int, blocks int, stable boolean"
    return trees.select(F.col(key).cast("bigint").alias("key"), F.col(body).cast("string")).mapInArrow(task, ddl).withColumnRenamed("key", key)
