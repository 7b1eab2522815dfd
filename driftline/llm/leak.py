"""Evaluation texts leaking into training text.

A passage is ``window`` or more consecutive words of an item of which at most one word in ten is
altered; its first and its last word are unaltered or misspelled.  Every window of ``window`` words of
every item and every document gets a 64-bit SimHash of its words.  The fingerprint is cut into four
blocks of 16 bits: two fingerprints within RADIUS bits of each other agree in one block up to
SUB_RADIUS bits, so looking up each block's neighbours in the items' block tables finds every pair
within the radius.  Each candidate is then verified word by word: the weighted shingle similarity
along the common diagonal (a shared word weighs 1, an altered one -9) must not be negative over at
least ``window`` words.

A passage has a window with at most ALTERED altered words, so at least window - ALTERED of its words are in
the items' vocabulary and SEED of them in a row are those of an item.  A document window without either
cannot be a candidate and is not fingerprinted; that drops no passage.  Words of no item weigh nothing in
the fingerprint.  The windows have the size of the least passage, 15 words, as items leak in part.

One pass over the documents looks for PASS_WORDS words of items.  More items take two steps: one scan of
the corpus a SCAN_WORDS words of items keeps the documents that share SEED words in a row with any item, and
the passes run over those alone.

Edge cases: null, empty and very short documents or items have no passage; documents are read whole;
a document with copies of a passage gives one row per item; equal documents give a row each.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterable, Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.core.store import cut
from driftline.llm.words import words

BITS, BLOCKS, SUB_RADIUS = 64, 4, 3
#: Fingerprints within this many bits are found for certain: more would leave each block over SUB_RADIUS.
RADIUS = BLOCKS * (SUB_RADIUS + 1) - 1
#: Words of items held by one pass (about 100 bytes a word in a worker), and by one scan for suspects (8 bytes a word).
PASS_WORDS, SCAN_WORDS = 1_000_000, 16_000_000
#: No passage has more altered words than this in each of its windows: of L // 10 altered words, one of L // window disjoint windows has at most two.
ALTERED = 2
#: Unaltered words in a row that a window of 15 words with ALTERED altered ones has: 13 words in three stretches.
SEED = 5
_MASKS = np.array([sum(1 << b for b in bits) for k in range(SUB_RADIUS + 1) for bits in combinations(range(16), k)], dtype=np.int32)


def _near(a: str, b: str) -> bool:
    """The same word misspelled: one letter left out, put in, replaced, or two neighbours swapped; words of 4 letters or more."""
    if min(len(a), len(b)) < 4 or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    ra, rb = a[i:], b[i:]
    return ra[1:] == rb[1:] or ra[1:] == rb or ra == rb[1:] or (len(ra) > 1 and len(rb) > 1 and ra[0] == rb[1] and ra[1] == rb[0] and ra[2:] == rb[2:])


def _joined(blocks: np.ndarray) -> np.ndarray:
    """The blocks of each fingerprint as one 64-bit number."""
    out = np.zeros(len(blocks), np.uint64)
    for b in range(BLOCKS):
        out = (out << np.uint64(16)) | blocks[:, b].astype(np.uint64)
    return out


def _grams(codes: np.ndarray) -> np.ndarray:
    """A 64-bit number for every SEED neighbouring words."""
    n = max(0, len(codes) - SEED + 1)
    out = np.zeros(n, np.uint64)
    for k in range(SEED):
        out = out * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + n].astype(np.uint64) + np.uint64(1)
    return out


def _among(grams: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which of the numbers are in the sorted table."""
    at = np.searchsorted(table, grams)
    out = at < len(table)
    out[out] = table[at[out]] == grams[out]
    return out


class ItemIndex:
    """Fingerprints of all windows of a set of items, by block."""

    def __init__(self, items: list[tuple[int, str | None]], window: int = 15):
        self.window = window
        self.ids, self.words = [], []
        for item_id, text in items:
            w = words(text)
            if len(w) >= window:
                self.ids.append(item_id)
                self.words.append(w)
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for ws in self.words for w in ws}))}
        signs = [np.unpackbits(np.frombuffer(hashlib.blake2b(w.encode(), digest_size=8).digest(), np.uint8)) for w in self.vocabulary]
        # the last row is for words of no item
        self.signs = np.vstack([*(s.astype(np.int32) * 2 - 1 for s in signs), np.zeros(BITS, np.int32)]) if signs else np.zeros((1, BITS), np.int32)
        codes = [self.codes(w) for w in self.words]
        self.owner = np.concatenate([np.full(len(c) - window + 1, i) for i, c in enumerate(codes)]) if codes else np.zeros(0, int)
        self.place = np.concatenate([np.arange(len(c) - window + 1) for c in codes]) if codes else np.zeros(0, int)
        self.texts = np.vstack([np.lib.stride_tricks.sliding_window_view(c, window) for c in codes]) if codes else np.zeros((0, window), np.int64)
        self.seeds = np.unique(np.concatenate([_grams(c) for c in codes])) if codes else np.zeros(0, np.uint64)
        blocks = np.vstack([self.fingerprints(c) for c in codes]) if codes else np.zeros((0, BLOCKS), np.uint16)
        self.prints = _joined(blocks)
        self.tables = []
        self._near: dict[tuple[int, int], np.ndarray] = {}
        for b in range(BLOCKS):
            # the windows in order of the block's value, and where each value begins
            order = np.argsort(blocks[:, b], kind="stable").astype(np.int32)
            self.tables.append((order, np.concatenate([[0], np.cumsum(np.bincount(blocks[:, b], minlength=1 << 16))])))

    def codes(self, ws: list[str]) -> np.ndarray:
        return np.fromiter(map(self.vocabulary.get, ws, repeat(len(self.vocabulary))), np.int64, len(ws))

    def fingerprints(self, codes: np.ndarray, places: np.ndarray | None = None) -> np.ndarray:
        """The four blocks of the SimHash of the windows at these places, or of all."""
        if places is None:
            places = np.arange(len(codes) - self.window + 1)
        bits = np.zeros((len(places), BITS), np.int32)
        for k in range(self.window):
            bits += self.signs[codes[places + k]]
        return np.packbits(bits > 0, axis=1).view(">u2").astype(np.uint16)

    def candidates(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the fingerprint, index of the item window) for all pairs within RADIUS bits."""
        prints, left, right = _joined(blocks), [], []
        for b in range(BLOCKS):
            values, which = np.unique(blocks[:, b], return_inverse=True)
            lists = [self._neighbours(b, v) for v in values.tolist()]
            n = np.array([len(x) for x in lists])[which]
            mine = np.repeat(np.arange(len(blocks)), n)
            hits = np.concatenate([lists[k] for k in which.tolist()])
            close = np.bitwise_count(prints[mine] ^ self.prints[hits]) <= RADIUS
            left.append(mine[close])
            right.append(hits[close])
        return np.concatenate(left), np.concatenate(right)

    def _neighbours(self, b: int, value: int) -> np.ndarray:
        """The item windows whose block b is within SUB_RADIUS bits of a value; copies of a passage ask for the same values again."""
        got = self._near.get((b, value))
        if got is None:
            if len(self._near) > 50_000:
                self._near.clear()
            entries, starts = self.tables[b]
            near = _MASKS ^ np.int32(value)
            n = starts[near + 1] - starts[near]
            first = np.cumsum(n) - n
            got = self._near[b, value] = entries[np.repeat(starts[near] - first, n) + np.arange(n.sum())]
        return got

    def _holds(self, ws: list[str], item: list[str], shift: int) -> bool:
        """Whether the document words hold a passage of the item on this diagonal (document place - item place)."""
        a, b = max(0, shift), min(len(ws), len(item) + shift)
        score = low_at = 0
        firsts: list[tuple[int, int]] = []  # (score before, place) of possible beginnings, scores falling
        for p in range(a, b):
            same = ws[p] == item[p - shift]
            edge = same or _near(ws[p], item[p - shift])
            if edge and (not firsts or score < firsts[-1][0]):
                firsts.append((score, p))
            score += 1 if same else -9
            if edge:
                # the earliest beginning from which the passage up to here is not altered too much
                low_at = next((at for before, at in firsts if score >= before), None)
                if low_at is not None and p - low_at + 1 >= self.window:
                    return True
        return False

    def leaked(self, text: str | None) -> list[int]:
        """Items of which the text holds a passage."""
        ws = words(text)
        if len(ws) < self.window or not self.ids:
            return []
        codes = self.codes(ws)
        known = np.concatenate([[0], np.cumsum(codes < len(self.vocabulary))])
        here = known[self.window :] - known[: -self.window] >= self.window - ALTERED
        if not here.any():
            return []
        seeds = np.concatenate([[0], np.cumsum(_among(_grams(codes), self.seeds))])
        inner = self.window - SEED + 1
        places = np.nonzero(here & (seeds[inner:] > seeds[:-inner]))[0]
        if not len(places):
            return []
        near, hit = [], []
        for k in range(0, len(places), 64):
            some = places[k : k + 64]
            a, h = self.candidates(self.fingerprints(codes, some))
            equal = (codes[some[a][:, None] + np.arange(self.window)] == self.texts[h]).sum(axis=1) >= self.window - ALTERED
            near.append(some[a[equal]])
            hit.append(h[equal])
        near, hit = np.concatenate(near), np.concatenate(hit)
        found: set[int] = set()
        tried: set[tuple[int, int]] = set()
        for i, shift in zip(self.owner[hit].tolist(), (near - self.place[hit]).tolist(), strict=True):
            if i in found or (i, shift) in tried:
                continue
            tried.add((i, shift))
            if self._holds(ws, self.words[i], shift):
                found.add(i)
        return [self.ids[i] for i in sorted(found)]


_indexes: dict[tuple, ItemIndex] = {}


def _index(items: list[tuple[int, str | None]], window: int) -> ItemIndex:
    """The index of these items; a worker process keeps the one it built last for its next task."""
    key = (window, *items)
    if key not in _indexes:
        _indexes.clear()
        _indexes[key] = ItemIndex(items, window)
    return _indexes[key]


def _groups(items: Iterable[tuple[int, str | None]], size: int) -> Iterator[list[tuple[int, str | None]]]:
    """Consecutive items of about ``size`` words together."""
    part, n = [], 0
    for item in items:
        k = len(item[1] or "") // 4
        if part and n + k > size:
            yield part
            part, n = [], 0
        part.append(item)
        n += k
    if part:
        yield part


def _seed_codes(ws: list[str]) -> np.ndarray:
    return np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in ws), np.uint64, len(ws))


def suspects(documents: DataFrame, items: list[tuple[int, str | None]]) -> DataFrame:
    """doc_id, text of the documents that share SEED words in a row with any of the items, written: all that can hold a passage of them."""
    table = np.unique(np.concatenate([np.zeros(0, np.uint64), *(_grams(_seed_codes(words(text))) for _, text in items)]))
    shared = documents.sparkSession.sparkContext.broadcast(table)  # 8 bytes a word of at most SCAN_WORDS

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [bool(_among(_grams(_seed_codes(words(t))), shared.value).any()) for t in batch.column(1).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return cut(documents.mapInArrow(task, "doc_id bigint, text string"), "suspects")


def leaked_items(documents: DataFrame, items: Iterable[tuple[int, str | None]], window: int = 15) -> DataFrame:
    """doc_id, item_id of all documents that hold a passage of an item.

    One scan of the corpus without a shuffle for up to SCAN_WORDS words of items; beyond PASS_WORDS the passes run
    over the suspects of that scan.
    """
    spark, out = documents.sparkSession, None
    rows = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    for group in _groups(items, SCAN_WORDS):
        parts = list(_groups(group, PASS_WORDS))
        where = rows if len(parts) == 1 else suspects(rows, group)
        for part in parts:
            one = where.mapInArrow(_finder(part, window), "doc_id bigint, item_id bigint")
            out = one if out is None else out.unionByName(one)
    return out if out is not None else spark.createDataFrame([], "doc_id bigint, item_id bigint")


def _finder(part: list[tuple[int, str | None]], window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(part, window)
        for batch in batches:
            docs, found = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for item_id in index.leaked(text):
                    docs.append(doc_id)
                    found.append(item_id)
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(found, pa.int64())], ["doc_id", "item_id"])

    return task
