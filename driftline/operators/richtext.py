"""Rich text to a line of Markdown and back.

Rich text is a list of runs (plain_text, href, annotations, equation).  ``inline`` proposes spellings of
the runs, from the most readable to one of tags alone, and takes the first that ``parse_inline`` reads
back as the same characters with the same marks, code, link and equation.  ``parse_inline`` cuts a
text into pieces, matches openers and closers of marks on a stack, and gives every piece the marks that
are open around it; openers and closers without a partner are text.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from itertools import groupby

# fixed values: how marks are written, outermost first; their spelling as tags; equations; what a backslash escapes
MARKS = {"underline": ("<u>", "</u>"), "strikethrough": ("~~", "~~"), "italic": ("*", "*"), "bold": ("**", "**")}
TAGS = {"underline": ("<u>", "</u>"), "strikethrough": ("<s>", "</s>"), "italic": ("<i>", "</i>"), "bold": ("<b>", "</b>")}
EQUATION = ("<eq>", "</eq>")
ESCAPABLE = "\\*`~<[]"
#: Longest text of one run.
RUN_CAP = 1990

_MARK_OF = {"u": "underline", "s": "strikethrough", "i": "italic", "b": "bold"}
_MUST = re.compile(r"\\(?=[\\*`~<\[\]\n]|\s*\Z)|[*`]|~(?=~)|(?<=~)~|<(?=/?(?:[bius]|eq)>)|\[(?=[^\]\n]*\]\()")
_ALL = re.compile(r"[\\*`~<\[\]]")
_PIECE = re.compile(r"[^\\*`~<\[]+")
_TAG = re.compile(r"<(/?)([bius])>")


def escape(text: str, everything: bool = False) -> str:
    """Text that reads back as itself: what would be misread is escaped, or all that can be."""
    return (_ALL if everything else _MUST).sub(lambda m: "\\" + m[0], text)


def link(label: str, href: str | None) -> str:
    """A Markdown link; the label is written already."""
    if not href:
        return label
    return f"[{label}]({href.replace('\\', '%5C').replace('(', '%28').replace(')', '%29').replace(' ', '%20')})"


def normal(runs: list[dict] | None) -> list[tuple]:
    """Runs as (text, marks, code, href, equation), neighbours of equal style merged, empty ones dropped."""
    flat = []
    for r in runs or []:
        if not isinstance(r, dict):
            continue
        a = r.get("annotations") if isinstance(r.get("annotations"), dict) else {}
        eq = r.get("type") == "equation"
        text = ((r.get("equation") or {}).get("expression") if eq else r.get("plain_text")) or ""
        href = r.get("href") or None
        style = (frozenset() if eq else frozenset(m for m in MARKS if a.get(m)), bool(a.get("code")) and not eq, None if eq else href, eq)
        if text:
            flat.append((text, *style))
    return [("".join(x[0] for x in g), *style) for style, g in groupby(flat, key=lambda x: x[1:])]


def merge_runs(runs: list[tuple], cap: int = RUN_CAP) -> list[tuple]:
    """Neighbouring runs of one style folded while together they are no longer than ``cap``; longer runs are split at it."""
    out: list[tuple] = []
    for text, *style in runs:
        while text:
            if out and list(out[-1][1:]) == style and len(out[-1][0]) < cap:
                room = cap - len(out[-1][0])
                if len(text) <= room:
                    out[-1] = (out[-1][0] + text, *style)
                    break
            out.append((text[:cap], *style))
            text = text[cap:]
    return out


def plain(runs: list[dict] | None) -> str:
    """The text of the runs without any style."""
    return "".join(r[0] for r in normal(runs))


def visible(runs: list[dict] | None) -> list[tuple]:
    """The characters of rich text that are no blanks, each with its marks, code, link and equation."""
    return [(ch, *rest) for t, *rest in normal(runs) for ch in t if not ch.isspace()]


def _leaf(text: str, code: bool, eq: bool, everything: bool) -> str:
    if eq:
        return EQUATION[0] + text + EQUATION[1]
    if not code:
        return escape(text, everything)
    core = text.strip()
    if not core:
        return text
    lead, tail = text[: len(text) - len(text.lstrip())], text[len(text.rstrip()) :]
    longest = max((len(x) for x in re.findall(r"`+", core)), default=0)
    fence = "`" * (longest + 1)
    return f"{lead}{fence} {core} {fence}{tail}" if longest else f"{lead}`{core}`{tail}"


def _spell(runs: list[tuple], marks: dict[str, tuple[str, str]], everything: bool) -> str:
    """Greedy nesting: of what the first run has, that which reaches furthest over the next runs is opened first."""
    out, i = [], 0
    while i < len(runs):
        text, own, code, href, eq = runs[i]
        best, reach = None, i
        for m in (*marks, "href"):
            has = (lambda r, h=href: h is not None and r[3] == h) if m == "href" else (lambda r, m=m: m in r[1])
            j = i
            while j < len(runs) and has(runs[j]):
                j += 1
            if j > reach:
                best, reach = m, j
        if best is None:
            out.append(_leaf(text, code, eq, everything))
            i += 1
            continue
        if best == "href":
            inner = _spell([(t, m, c, None, e) for t, m, c, _, e in runs[i:reach]], marks, everything)
            inner = _label(inner)
        else:
            inner = _spell([(t, m - {best}, c, h, e) for t, m, c, h, e in runs[i:reach]], marks, everything)
        core = inner.strip()
        lead, tail = inner[: len(inner) - len(inner.lstrip())], inner[len(inner.rstrip()) :]
        a, b = ("", "") if best == "href" else marks[best]
        written = (link(core, href) if best == "href" else f"{a}{core}{b}") if core else ""
        out.append(f"{lead}{written}{tail}" if core else inner)
        i = reach
    return "".join(out)


def _label(text: str) -> str:
    """A written label whose closing brackets are escaped, outside code and escapes."""
    opaque = _opaque(text)
    return "".join("\\]" if c == "]" and i not in opaque else c for i, c in enumerate(text))


def inline(runs: list[dict] | None) -> str:
    """Markdown of rich text that reads back as the same runs; blanks at the edge of a marked run lose their marks only."""
    want = normal(runs)
    if all(not m and not c and not h and not e for _, m, c, h, e in want):
        text = "".join(r[0] for r in want)
        short = escape(text)
        return short if short == text or plain(parse_inline(short)) == text else escape(text, True)
    seen, whole, near = visible(runs), "".join(r[0] for r in want), None
    for table, everything in ((MARKS, False), (MARKS, True), (TAGS, False), (TAGS, True)):
        names = list(table)
        for k in range(len(names)):
            text = _spell(want, {n: table[n] for n in names[k:] + names[:k]}, everything)
            back = parse_inline(text)
            if visible(back) == seen:
                if plain(back) == whole:
                    return text
                near = near or text
    return near or _spell(want, TAGS, True)


def _ticks(s: str) -> tuple[dict[int, list[int]], dict[int, int]]:
    """Backtick runs: places by length, and length by place."""
    by_length: dict[int, list[int]] = {}
    at: dict[int, int] = {}
    for m in re.finditer(r"`+", s):
        by_length.setdefault(len(m[0]), []).append(m.start())
        at[m.start()] = len(m[0])
    return by_length, at


def _code_end(ticks: tuple[dict[int, list[int]], dict[int, int]], i: int, n: int) -> int:
    places = ticks[0].get(n, [])
    k = bisect_left(places, i)
    return places[k] if k < len(places) else -1


def _opaque(s: str) -> set[int]:
    """Places inside code spans and behind escaping backslashes."""
    out: set[int] = set()
    ticks, i = _ticks(s), 0
    while i < len(s):
        if s[i] == "\\" and i + 1 < len(s) and s[i + 1] in ESCAPABLE:
            out.add(i + 1)
            i += 2
        elif s[i] == "`":
            n = len(s) - i - len(s[i:].lstrip("`")) if i not in ticks[1] else ticks[1][i]
            end = _code_end(ticks, i + n, n)
            if end >= 0:
                out.update(range(i, end + n))
            i = end + n if end >= 0 else i + n
        else:
            i += 1
    return out


def _edge(c: str) -> int:
    """0 for blanks and ends, 1 for punctuation and symbols, 2 for other characters."""
    return 0 if not c or c.isspace() else 1 if unicodedata.category(c)[0] in "PS" else 2


class _Reader:
    """Pieces of a text: text itself, and openers and closers of marks."""

    def __init__(self, href: str | None):
        self.href = href
        self.pieces: list[tuple] = []  # ("text", run) or ("mark", literal)
        self.opens: dict[int, list[str]] = {}
        self.closes: dict[int, list[str]] = {}
        self.left: dict[int, str] = {}
        self.stack: list[list] = []  # [kind, piece, count]

    def text(self, s: str, **style) -> None:
        if s:
            self.pieces.append(("text", s, style))

    def mark(self, kind: str, literal: str, can_open: bool, can_close: bool) -> None:
        at, n = len(self.pieces), len(literal) if kind == "*" else 1
        self.pieces.append(("mark", "", {}))
        while can_close and n:
            k = next((k for k in range(len(self.stack) - 1, -1, -1) if self.stack[k][0] == kind), None)
            if k is None:
                break
            del self.stack[k + 1 :]  # what was opened inside and not closed is text
            opener = self.stack[k]
            used = 2 if kind == "*" and min(n, opener[2]) >= 2 else 1
            name = ("bold" if used == 2 else "italic") if kind == "*" else kind
            self.opens.setdefault(opener[1], []).append(name)
            self.closes.setdefault(at, []).append(name)
            opener[2] -= used
            n -= used
            self.left[opener[1]] = "*" * opener[2] if kind == "*" else ""
            if not opener[2]:
                del self.stack[k]
        if n and can_open:
            self.stack.append([kind, at, n])
        self.left[at] = "*" * n if kind == "*" else (literal if n else "")

    def runs(self) -> list[dict]:
        out: list[dict] = []
        active: dict[str, int] = {}

        def add(s: str, style: dict) -> None:
            marks = {m: True for m in MARKS if active.get(m)} | ({"code": True} if style.get("code") else {})
            run = {"type": "equation", "plain_text": s, "annotations": {}, "equation": {"expression": s}} if style.get("eq") else {"type": "text", "plain_text": s, "annotations": marks}
            href = style.get("href") or self.href
            if href and not style.get("eq"):
                run["href"] = href
            out.append(run)

        for i, (kind, s, style) in enumerate(self.pieces):
            if kind == "mark":
                for m in self.closes.get(i, ()):
                    active[m] -= 1
                if self.left.get(i):
                    add(self.left[i], {})
                for m in self.opens.get(i, ()):
                    active[m] = active.get(m, 0) + 1
            elif kind == "link":
                for r in style["runs"]:
                    r["annotations"] = {m: True for m in MARKS if active.get(m)} | r["annotations"] if r["type"] == "text" else {}
                    out.append(r)
            else:
                add(s, style)
        return out


def _read(s: str, href: str | None) -> list[dict]:
    r, ticks, i = _Reader(href), _ticks(s), 0
    opaque = closers = None
    plain_: list[str] = []

    def flush() -> None:
        r.text("".join(plain_))
        plain_.clear()

    while i < len(s):
        m = _PIECE.match(s, i)
        if m:
            plain_.append(m[0])
            i = m.end()
            continue
        c = s[i]
        if c == "\\":
            escaped = i + 1 < len(s) and s[i + 1] in ESCAPABLE
            plain_.append(s[i + 1] if escaped else c)
            i += 2 if escaped else 1
        elif c == "`":
            n = len(re.compile(r"`+").match(s, i)[0])
            end = _code_end(ticks, i + n, n)
            if end < 0:
                plain_.append("`" * n)
                i += n
                continue
            body = s[i + n : end]
            if n > 1 and len(body) > 2 and body[0] == body[-1] == " ":
                body = body[1:-1]
            flush()
            r.text(body, code=True)
            i = end + n
        elif c == "*":
            n = len(re.compile(r"\*+").match(s, i)[0])
            before, after = _edge(s[i - 1 : i] if i else ""), _edge(s[i + n : i + n + 1])
            flush()
            r.mark("*", "*" * n, after > 0 and (after == 2 or before < 2), before > 0 and (before == 2 or after < 2))
            i += n
        elif c == "~" and s.startswith("~~", i):
            before, after = _edge(s[i - 1 : i] if i else ""), _edge(s[i + 2 : i + 3])
            flush()
            r.mark("strikethrough", "~~", after > 0, before > 0)
            i += 2
        elif c == "<" and s.startswith(EQUATION[0], i) and (end := s.find(EQUATION[1], i)) > i:
            flush()
            r.text(s[i + len(EQUATION[0]) : end], eq=True)
            i = end + len(EQUATION[1])
        elif c == "<" and (m := _TAG.match(s, i)):
            flush()
            r.mark(_MARK_OF[m[2]], m[0], not m[1], bool(m[1]))
            i = m.end()
        elif c == "[" and href is None:
            if closers is None:
                opaque = _opaque(s)
                closers = [k for k, x in enumerate(s) if x == "]" and k not in opaque]
            k = bisect_left(closers, i)
            close = closers[k] if k < len(closers) else -1
            end = s.find(")", close + 2) if close > 0 and s.startswith("](", close) else -1
            if end > close + 2:
                flush()
                target = s[close + 2 : end].replace("%20", " ").replace("%28", "(").replace("%29", ")").replace("%5C", "\\")
                r.pieces.append(("link", "", {"runs": _read(s[i + 1 : close], target)}))
                i = end + 1
            else:
                plain_.append(c)
                i += 1
        else:
            plain_.append(c)
            i += 1
    flush()
    return r.runs()


def parse_inline(text: str) -> list[dict]:
    """Runs of Markdown text: escapes, code spans, marks, links, equations; neighbours of one style are one run of up to RUN_CAP characters."""
    out = []
    for t, marks, code, href, eq in merge_runs(normal(_read(text, None))):
        run = {"type": "equation" if eq else "text", "plain_text": t, "annotations": {**{m: True for m in MARKS if m in marks}, **({"code": True} if code else {})}}
        if href:
            run["href"] = href
        if eq:
            run["equation"] = {"expression": t}
        out.append(run)
    return out
