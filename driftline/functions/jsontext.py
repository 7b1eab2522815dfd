"""Strict JSON reading in Python workers: any depth, no non-standard constants, text that Arrow accepts."""

from __future__ import annotations

import json
import re
from json.decoder import scanstring

_SPACE = re.compile(r"[ \t\n\r]*")
_ATOM = re.compile(r"-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null")
_WORDS = {"true": True, "false": False, "null": None}


def _refuse(name: str):
    raise ValueError(f"{name} is no JSON")


def parse(text: str | None):
    """(True, value), or (False, None) where the text is null or not valid JSON."""
    if text is None:
        return False, None
    try:
        return True, json.loads(text, parse_constant=_refuse)
    except RecursionError:
        try:
            return True, _parse_deep(text)
        except (ValueError, IndexError):
            return False, None
    except ValueError:
        return False, None


def _parse_deep(s: str):
    """The same with an explicit stack, for nesting beyond what the C scanner recurses into."""
    stack: list = []
    at = _SPACE.match(s, 0).end()
    while True:
        # a value begins at ``at``
        c = s[at]
        if c in "{[":
            box: dict | list = {} if c == "{" else []
            at = _SPACE.match(s, at + 1).end()
            if s[at] == ("}" if c == "{" else "]"):
                at, value = at + 1, box
            else:
                key = None
                if c == "{":
                    key, at = _key(s, at)
                stack.append((box, key))
                continue
        elif c == '"':
            value, at = scanstring(s, at + 1, True)
        else:
            m = _ATOM.match(s, at)
            if not m:
                raise ValueError(at)
            w, at = m[0], m.end()
            value = _WORDS[w] if w in _WORDS else (int(w) if re.fullmatch(r"-?\d+", w) else float(w))
        # a value ended: put it into its box, and close boxes that end here
        while True:
            at = _SPACE.match(s, at).end()
            if not stack:
                if at != len(s):
                    raise ValueError(at)
                return value
            box, key = stack.pop()
            if isinstance(box, dict):
                box[key] = value
            else:
                box.append(value)
            c = s[at]
            if c == ",":
                at = _SPACE.match(s, at + 1).end()
                if isinstance(box, dict):
                    key, at = _key(s, at)
                stack.append((box, key))
                break
            if c != ("}" if isinstance(box, dict) else "]"):
                raise ValueError(at)
            at, value = at + 1, box


def _key(s: str, at: int) -> tuple[str, int]:
    if s[at] != '"':
        raise ValueError(at)
    key, at = scanstring(s, at + 1, True)
    at = _SPACE.match(s, at).end()
    if s[at] != ":":
        raise ValueError(at)
    return key, _SPACE.match(s, at + 1).end()


def clean(text: str) -> str:
    """The text with surrogates that have no partner replaced, which UTF-8 cannot hold."""
    try:
        text.encode("utf-8")
        return text
    except UnicodeEncodeError:
        return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
