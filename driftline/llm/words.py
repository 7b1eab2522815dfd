"""Words of a text in a form that ignores case, accents, punctuation, markup and spacing."""

from __future__ import annotations

import re
import unicodedata

_WORD = re.compile(r"[^\W_]+")
_MARK = re.compile(r"[̀-ͯ]")


def fold(text: str) -> str:
    """Small letters without accents; ß is ss.  Typed-out umlauts (ae, oe, ue) equal the bare vowel."""
    t = text.lower()
    if not t.isascii():
        t = _MARK.sub("", unicodedata.normalize("NFKD", t)).replace("ß", "ss").replace("ø", "o").replace("æ", "a").replace("ł", "l")
    return t.replace("ae", "a").replace("oe", "o").replace("ue", "u")


def words(text: str | None) -> list[str]:
    """The folded words of a text; none for null and for texts without letters or digits."""
    return _WORD.findall(fold(text)) if text else []
