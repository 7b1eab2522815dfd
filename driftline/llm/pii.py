"""Personal information in free text: found in a normalised text, replaced in the source text.

A chain of transducers undoes disguises: look-alike letters, full-width and invisible characters, digits
spelled as words, ``(at)`` and ``[dot]``.  Every normalised character keeps the span of source
characters it stands for, so what a detector finds maps back to source offsets.

Kinds: email, phone, id_number, address, name.  Names come from a directory of known name parts, from
forms of address and from mentions; a name inside an e-mail or street address is part of that.

Edge cases: a null text has no findings and stays null, an empty one stays empty; texts are taken
whole, whatever their length; of overlapping findings the earlier kind of the list email, id_number,
phone, address, name stands.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.core.store import cut

KINDS = ("email", "id_number", "phone", "address", "name")

# fixed values: Cyrillic and Greek letters that look like Latin ones
LOOKALIKE = dict(
    zip(
        "авеёкмнорстухіјѕԁһАВЕЁКМНОРСТУХІЈЅαβεικνορτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
        "abeekmhopctyxijsdhABEEKMHOPCTYXIJSaβeiknoptuxABEZHIKMNOPTYX".replace("β", "b"),
        strict=True,
    )
)
# fixed values: digits as words in English, German, French and Spanish
SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
DASHES = "‐‑‒−﹣"
SPACES = "      　"
INVISIBLE = "­​‌‍⁠﻿"


class Mapped:
    """A text with the source span of each character; identity while ``spans`` is None."""

    __slots__ = ("text", "starts", "ends")

    def __init__(self, text: str, starts: list[int] | None = None, ends: list[int] | None = None):
        self.text, self.starts, self.ends = text, starts, ends

    def source(self, a: int, b: int) -> tuple[int, int]:
        return (a, b) if self.starts is None else (self.starts[a], self.ends[b - 1])

    def replaced(self, edits: list[tuple[int, int, str]]) -> Mapped:
        """Replace spans (ascending, disjoint) of this text; each new character stands for its whole span."""
        if not edits:
            return self
        starts = self.starts if self.starts is not None else range(len(self.text))
        ends = self.ends if self.ends is not None else range(1, len(self.text) + 1)
        out: list[str] = []
        s: list[int] = []
        e: list[int] = []
        at = 0
        for a, b, new in edits:
            out.append(self.text[at:a])
            s.extend(starts[at:a])
            e.extend(ends[at:a])
            out.append(new)
            s.extend([starts[a]] * len(new))
            e.extend([ends[b - 1]] * len(new))
            at = b
        out.append(self.text[at:])
        s.extend(starts[at:])
        e.extend(ends[at:])
        return Mapped("".join(out), s, e)


_ODD = re.compile(f"[{DASHES}{SPACES}{INVISIBLE}！-～\U0001d400-\U0001d7ff’]")
_CHUNK = re.compile(r"\S+")
_LOOK = re.compile(f"[{''.join(LOOKALIKE)}]")
_LATIN = re.compile(r"[A-Za-z@0-9]")
_AT = re.compile(r"\s{0,3}[(\[{<]\s?(?:at|ät|arobase|arroba)\s?[)\]}>]\s{0,3}|(?<=[\w]) {1,2}@ {1,2}(?=[\w-]+(?:\.| dot |\s?[(\[{]))", re.I)
_DOT = re.compile(r"\s{0,3}[(\[{<]\s?(?:dot|punkt|point|punto)\s?[)\]}>]\s{0,3}", re.I)
_BARE = re.compile(r"(?<=[\w]) (at) (?=[\w-]+(?: dot [\w-]+)+(?![\w-]| dot | ?@))", re.I)
#: An address whose parts are joined by points or by the word: all of it, on both sides of the @.
_CHAIN = re.compile(r"(?<![\w.+-])[\w+-]+(?:(?:\.| dot )[\w+-]+)*@[\w-]+(?:(?:\.| dot )[A-Za-z][\w-]*)+", re.I)
_BARE_DOT = re.compile(r" dot ", re.I)
_SPELLED = re.compile(r"\b(?:(?:" + "|".join(sorted(SPELLED, key=len, reverse=True)) + r"|\d)(?:[ ,.-]{1,2}|\b)){6,}", re.I)
_WORD_DIGIT = re.compile(r"\w+")


def _characters(m: Mapped) -> Mapped:
    edits = []
    for x in _ODD.finditer(m.text):
        c = x[0]
        new = "" if c in INVISIBLE else "-" if c in DASHES else " " if c in SPACES else "'" if c == "’" else unicodedata.normalize("NFKC", c)
        edits.append((x.start(), x.end(), new))
    return m.replaced(edits)


def _lookalikes(m: Mapped) -> Mapped:
    """Only in chunks that mix them with Latin letters, digits or @: words of another script stay."""
    if m.text.isascii() or not _LOOK.search(m.text):
        return m
    edits = []
    for chunk in _CHUNK.finditer(m.text):
        if _LATIN.search(chunk[0]):
            edits += [(chunk.start() + x.start(), chunk.start() + x.end(), LOOKALIKE[x[0]]) for x in _LOOK.finditer(chunk[0])]
    return m.replaced(edits)


def _separators(m: Mapped) -> Mapped:
    low = m.text.lower()
    if "@" not in low and "at" not in low and "ät" not in low and "arr" not in low and "arob" not in low:
        return m
    m = m.replaced([(x.start(), x.end(), "@") for x in _AT.finditer(m.text)])
    m = m.replaced([(x.start(), x.end(), "@") for x in _BARE.finditer(m.text)])
    if "@" in m.text:
        m = m.replaced([(x.start(), x.end(), ".") for x in _DOT.finditer(m.text)])
        if " dot " in m.text.lower():
            m = m.replaced([(c.start() + x.start(), c.start() + x.end(), ".") for c in _CHAIN.finditer(m.text) for x in _BARE_DOT.finditer(c[0])])
    return m


def _spelled(m: Mapped) -> tuple[Mapped, list[tuple[int, int]]]:
    """Digits that are spelled as words as digits, and where they stand in the new text."""
    edits, spans, shift = [], [], 0
    for run in _SPELLED.finditer(m.text):
        words = list(_WORD_DIGIT.finditer(run[0]))
        if sum(not w[0].isdigit() for w in words) < 4:
            continue
        end = run.start() + words[-1].end()
        digits = "".join(SPELLED.get(w[0].lower(), w[0]) for w in words)
        edits.append((run.start(), end, digits))
        spans.append((run.start() + shift, run.start() + shift + len(digits)))
        shift += len(digits) - (end - run.start())
    return m.replaced(edits), spans


def normalise(text: str) -> Mapped:
    """The text with disguises undone, and where each character comes from."""
    return _normalise(text)[0]


def _normalise(text: str) -> tuple[Mapped, list[tuple[int, int]]]:
    m = Mapped(text)
    if not text.isascii():
        m = _lookalikes(_characters(m))
    return _spelled(_separators(m))


_EMAIL = re.compile(r"(?<![\w.+-])[\w.+-]+@(?:[\w-]+\.)+[^\W\d_]{2,24}(?![\w-])")
_L, _R = r"(?<![\w.,:/+-])", r"(?!\w|[-./:,]\d)"
_ID = re.compile(
    _L
    + r"(?:\d{3}-\d{2}-\d{4}|\d{3} \d{2} \d{4}(?! \d)|\d{8}-\d{4}|\d{8}-?[A-Z]|[XYZ]-?\d{7}-?[A-Z]|[A-Z]{1,2}\d{7,9}"
    + r"|[A-Z]{2} ?\d{2} ?\d{2} ?\d{2}(?: ?[A-Z])?|[A-Z]{2}-\d{3}-\d{4}|\d{2} \d{3} \d{3} \d{3}|[1-9] \d{2} \d{2} \d{2} \d{3} \d{3}(?: \d{2})?)"
    + _R
)
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
#: Further groups of digits behind an identity number that are part of it.
_TAIL = re.compile(r"(?:[ -]\d{4,6})+(?: \d{2,3})?(?!\w)")
_ID_WORD = re.compile(
    r"(?:ssn|social security(?: (?:no|number))?|tax (?:no|id|number)|steuer-?id|passport(?: (?:no|number))?|reisepass|personalausweis|dni|nie|nino"
    r"|national (?:id|insurance)(?: (?:no|number))?|driver'?s? licen[cs]e|sécurité sociale)\b[.:# ]{0,3}(?=[A-Z0-9 -]{6,})([A-Z]{0,3}[- ]?\d(?:[ -]?\d){4,14}(?:-?[A-Z])?)(?!\w)",
    re.I,
)
_PHONE = re.compile(
    _L.replace(".,:/+-", ".,:/-")
    + r"(?:\+\d{1,3} ?(?:\(0\))?(?:[ .-]?\d{1,5}){2,5}|\+\d{8,15}"
    + r"|(?:1[ .-])?(?:\(\d{3}\) ?|\d{3}[-. ])\d{3}[-. ]\d{4}"
    + r"|\(0\d{2,4}\) ?\d{3,8}(?:[ -]\d{2,6})?|0\d{2} \d{4} \d{4}|0\d{2,4}[/-]\d{3,8}(?:[ -]\d{2,6})?|0\d{3,4} \d{3} ?\d{3,4}"
    + r"|0[1-9](?:[ .]\d{2}){4}|00\d{4,7} \d{4,8}|00\d{9,13}|0[1-9]\d{8,9}|1[2-9]\d{9}|[2-9]\d{2}[2-9]\d{6})"
    + r"(?!\w|[-./:]\d)(?: ?(?:ext\.?|x|Durchwahl|poste) ?\d{1,5}\b)?"
)
_UP = r"[^\W\d_a-zà-öø-ÿ][\w'’-]*\.?"
# fixed values: first words of place names of two words
_PLACE = r"(?:(?:Port|Nether|Upper|Lower|Great|Little|New|Old|North|South|East|West|Saint|St\.?|San|Santa|Los|Las|El|La|Le|Les|Bad|Mount|Fort|Lake|Cape) )?" + _UP
_ADDRESS = re.compile(
    # number, name, kind of street
    r"(?<![\w.,:/+-])\d{1,5} ?[A-Za-z]? (?:" + _UP + r" ){1,4}(?:(?i:street|st\.|road|rd\.?|avenue|ave\.?|lane|drive|dr\.|row|court|ct|crescent|boulevard|blvd\.?|terrace|place|square|way|hill|close|walk|gardens|mews|parade|quay))(?!\w)"
    r"(?:,? (?:Apt|Flat|Unit|Suite|apt|APT)\.? ?\w{1,6})?(?:,[ \n]| ?\n)?(?:(?<=[,\n ])" + _PLACE + r"(?: \d{4,6})?)?"
    # number, kind of street, name
    r"|(?<![\w.,:/+-])\d{1,4}(?: ?(?:bis|ter|quater))?,? (?i:rue|avenue|av\.|impasse|chemin|boulevard|bd|place|allée|quai|route|cours|passage|sentier|square|via|viale|piazza) (?:(?:de la|de l'|des|du|de|d'|la|le|les|l'|della|del|di) ?)*" + _UP + r"(?: " + _UP + r"){0,3}(?:, \d{5} " + _PLACE + r")?"
    # kind of street, name, number
    r"|(?<!\w)(?i:calle|c/|avda\.|avenida|camino|plaza|paseo|ronda|travesía|carretera|rua|largo|praça) (?:(?:de las|de los|de la|del|de|das|dos|da|do|la|el) )?" + _UP + r"(?: " + _UP + r"){0,3},? (?:n\.?º ?)?\d{1,4}[a-z]?(?:, \d{1,2}\.?º ?(?:[A-Z]\b)?)?(?:, \d{4,5} " + _UP + r")?"
    r"|(?<!\w)(?:" + _UP + r" )?[^\W\d_]*(?i:straße|strasse|str\.|weg|allee|gasse|platz|ring|damm|ufer|steig|chaussee|graben|markt|laan|straat|gatan|vägen|gracht) \d{1,4} ?[a-z]?\b(?:, \d{4,5} " + _UP + r")?"
    r"|(?<!\w)(?i:am|an der|im|auf dem|zum|zur|in der|hinter dem|beim) " + _UP + r" \d{1,4}[a-z]?\b(?:, \d{4,5} " + _UP + r")?"
    r"|(?<!\w)(?:ul\.|ulica|al\.) (?:" + _UP + r" ?){1,3} \d{1,4}[a-z]?\b"
)
# fixed values: words after "am" that begin a date, not a street
_DATE_WORD = re.compile(
    r"(?i)^(?:am|im|zum) (?:montag|dienstag|mittwoch|donnerstag|freitag|samstag|sonntag|januar|februar|märz|april|mai|juni|juli|august|september|oktober|november|dezember|jahr|jahre)\b"
)
_NAME_WORD = re.compile(r"[^\W\d_]+(?:['-][^\W\d_]+)*")
_TITLE = r"(?:Mr|Ms|Mrs|Miss|Mx|Dr|Prof|Frau|Herr|Hr|Fr|Mme|Mlle|Sr|Sra|Sig|Sig\.ra)\.?"
_CAP = r"[A-ZÀ-ÖØ-Þ][\w]+(?:['-][A-ZÀ-ÖØ-Þ]?[\w]+)*"
_TITLED = re.compile(r"(?<!\w)" + _TITLE + r" (?:[A-Z]\. ?)?(" + _CAP + r")(?: " + _CAP + r")?")
_MENTION = re.compile(r"(?<![\w.])@(" + _CAP + r") (" + _CAP + r")")
_AROUND = re.compile(r"(?:" + _TITLE + r" )?(?:@)?(?:[A-Z]\. ?){0,2}$")
_LINK = re.compile(r"(?:https?://|www\.)\S+")


def _is_iban(text: str) -> bool:
    """Whether the check digits fit."""
    bare = text.replace(" ", "")
    return 15 <= len(bare) <= 34 and int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1


class _Spans:
    """Disjoint spans, kept in order, so that a look at one is a binary search."""

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def free(self, a: int, b: int) -> bool:
        """Whether the span meets none of them."""
        k = bisect_left(self.ends, a + 1)
        return k == len(self.ends) or self.starts[k] >= b

    def add(self, a: int, b: int) -> None:
        k = bisect_left(self.starts, a)
        self.starts.insert(k, a)
        self.ends.insert(k, b)


class Detector:
    """Finds personal information, given the parts of known names (in small letters).

    Parts of two letters (Li, Bo) are also words, so they count only where they are written with a capital
    letter; a single letter is an initial, which belongs to a name beside it.
    """

    def __init__(self, name_parts: Iterable[str]):
        self.parts = frozenset(p.lower() for p in name_parts if len(p.strip(".")) > 1)
        self._seen: dict[str, list[tuple[str, int, int]]] = {}

    def find(self, text: str | None) -> list[tuple[str, int, int]]:
        """(kind, start, end) in source offsets, ascending and disjoint."""
        if not text:
            return []
        if len(text) > 2000:
            return self._find(text)
        known = self._seen.get(text)
        if known is None:
            if len(self._seen) > 20_000:
                self._seen.clear()
            known = self._seen[text] = self._find(text)
        return known

    def _find(self, text: str) -> list[tuple[str, int, int]]:
        m, spelled = _normalise(text)
        t, found, taken = m.text, [], _Spans()

        def take(kind: str, a: int, b: int) -> None:
            if b > a and taken.free(a, b):
                taken.add(a, b)
                found.append((kind, a, b))

        if "http" in t or "www." in t:
            for x in _LINK.finditer(t):
                taken.add(x.start(), x.end())
        if "@" in t:
            for x in _EMAIL.finditer(t):
                take("email", x.start(), x.end())
        if any(c.isdigit() for c in t):
            for x in _IBAN.finditer(t):
                if _is_iban(x[0]):
                    take("id_number", x.start(), x.end())
            for x in _ID.finditer(t):
                more = _TAIL.match(t, x.end())
                take("id_number", x.start(), more.end() if more else x.end())
            for x in _ID_WORD.finditer(t):
                take("id_number", x.start(1), x.end(1))
            for x in _ADDRESS.finditer(t):
                if not _DATE_WORD.match(x[0]):
                    take("address", x.start(), self._address_end(t, x.start(), x.end()))
            for x in _PHONE.finditer(t):
                if 8 <= sum(c.isdigit() for c in x[0].split("ext")[0]) <= 15:
                    take("phone", x.start(), x.end())
            for a, b in spelled:  # a number that someone spelled out is one that was to be hidden
                if 7 <= b - a <= 15:
                    take("phone", a, b)
        self._names(t, taken, take)
        return sorted(((k, *m.source(a, b)) for k, a, b in found), key=lambda f: f[1])

    def _address_end(self, t: str, a: int, b: int) -> int:
        """Without names of persons that follow the address in the text."""
        for x in reversed(list(_NAME_WORD.finditer(t, a, b))):
            if x.end() < b and t[x.end() : b].strip(" ,.\n"):
                break
            if x[0].lower() not in self.parts:
                break
            b = a + len(t[a : x.start()].rstrip(" ,\n"))
        return b

    def _names(self, t: str, taken: _Spans, take) -> None:
        words = [(x.start(), x.end()) for x in _NAME_WORD.finditer(t) if x[0].lower() in self.parts and (len(x[0]) > 2 or x[0][0].isupper())]
        for x in _TITLED.finditer(t):
            words.append((x.start(1), x.end(1) if x[1].lower() in self.parts else x.end()))
        for x in _MENTION.finditer(t):
            words.append((x.start(1), x.end()))
        words = sorted(w for w in words if taken.free(*w))
        spans: list[list[int]] = []
        for a, b in words:
            # parts of one name are next to each other, or joined by a comma or middle initials
            if spans and a <= spans[-1][1]:
                spans[-1][1] = max(b, spans[-1][1])
            elif spans and re.fullmatch(r",? (?:[A-Z]\. ?){0,2}", t[spans[-1][1] : a]):
                spans[-1][1] = b
            else:
                spans.append([a, b])
        for a, b in spans:
            lead = _AROUND.search(t, max(0, a - 20), a)
            # a title or initial that ends another finding stays there
            take("name", lead.start() if lead and lead.start() < a and taken.free(lead.start(), b) else a, b)

    def redact(self, text: str | None) -> str | None:
        """The text with each finding replaced by a placeholder of its kind, such as ``[PHONE]``."""
        if text is None:
            return None
        out, at = [], 0
        for kind, a, b in self.find(text):
            if a < at:
                continue
            out += [text[at:a], f"[{kind.upper()}]"]
            at = b
        return "".join([*out, text[at:]])


#: A directory of at most so many name parts goes to every task; the words of the texts are joined with a longer one.
MAX_NAME_PARTS = 500_000


def name_parts(people: DataFrame) -> DataFrame:
    """part: the distinct name parts of the persons of a directory, in small letters, written.  Bots and nulls have none."""
    parts = people.filter("kind = 'person' AND full_name IS NOT NULL").select(F.explode(F.split(F.lower("full_name"), r"[\s,]+")).alias("part"))
    return cut(parts.select(F.regexp_replace("part", r"^\.+|\.+$", "").alias("part")).filter("length(part) > 1").distinct(), "name-parts")


def _texts(captures: DataFrame) -> DataFrame:
    """delivery_no with all its texts, the anchor first."""
    return captures.select("delivery_no", F.concat(F.array("anchor"), F.coalesce(F.transform("comments", lambda c: c["text"]), F.array().cast("array<string>"))).alias("texts"))


def _with_parts(captures: DataFrame, parts: DataFrame) -> tuple[DataFrame, list[str]]:
    """delivery_no, texts, parts: the texts with the name parts that occur in them, or with none and the whole directory beside it.

    A directory beyond MAX_NAME_PARTS is joined to the words of the texts: nothing of it is sent around as a whole.
    """
    texts = _texts(captures)
    if parts.count() <= MAX_NAME_PARTS:
        return texts.withColumn("parts", F.array().cast("array<string>")), [r.part for r in parts.collect()]
    texts = cut(texts.withColumn("row", F.monotonically_increasing_id()), "pii-texts")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, words = [], []
            for row, each in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for w in {x[0].lower() for t in each if t for x in _NAME_WORD.finditer(normalise(t).text)}:
                    rows.append(row)
                    words.append(w)
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(words, pa.string())], ["row", "part"])

    known = texts.select("row", "texts").mapInArrow(task, "row bigint, part string").join(parts, "part").groupBy("row").agg(F.collect_set("part").alias("parts"))
    both = texts.join(known, "row", "left")
    return both.select("delivery_no", "texts", F.coalesce("parts", F.array().cast("array<string>")).alias("parts")), []


def _detected(captures: DataFrame, parts: DataFrame, one: Callable[[Detector, str | None], Iterable[str | None]], column: str) -> DataFrame:
    """delivery_no, comment_pos (-1 for the anchor) and what ``one`` gives for each text."""
    rows, directory = _with_parts(captures, parts)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = Detector(directory)
        for batch in batches:
            nos, poss, out = [], [], []
            for no, texts, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                detector = Detector(own) if own else shared
                for i, text in enumerate(texts):
                    for x in one(detector, text):
                        nos.append(no)
                        poss.append(i - 1)
                        out.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(nos, pa.int64()), pa.array(poss, pa.int32()), pa.array(out, pa.string())], ["delivery_no", "comment_pos", column])

    return rows.mapInArrow(task, f"delivery_no bigint, comment_pos int, {column} string")


def pii_in_captures(captures: DataFrame, parts: DataFrame) -> DataFrame:
    """delivery_no, comment_pos (-1 for the anchor), pii_kind: one row per text and kind found in it.

    One pass without a shuffle: every text is looked at where it is read (see _with_parts for very long directories).
    """
    return _detected(captures, parts, lambda detector, text: sorted({f[0] for f in detector.find(text)}), "pii_kind")


def redacted_captures(captures: DataFrame, parts: DataFrame) -> DataFrame:
    """delivery_no, comment_pos, text with placeholders; texts that are null stay null."""
    return _detected(captures, parts, lambda detector, text: [detector.redact(text)], "text")
