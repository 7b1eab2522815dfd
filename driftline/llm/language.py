"""Missing or wrong language labels: a language with a confidence for documents and for their lines.

Every language has a codeword of BITS bits, far from all others.  One binary classifier a bit, logistic
over hashed character n-grams of words, predicts whether a text's language has that bit set.  Decoding
takes the codeword with the least loss, each bit's loss weighted by how reliable its classifier was for
that language on held-out rows; the distance to the next codeword gives the confidence and flags what is
ambiguous.  A document's lines are decoded together: changing the language between lines costs SWITCH,
so a lone short line does not, a passage does.

The classifiers are fitted on a bounded sample of labelled rows (of about PER_LABEL documents a language the
LINES_PER_LABEL lines of the smallest hashes, so the same on every run); labels are partly wrong, so rows the
first fit disagrees with are left out of the second.  A fitted model is kept in the shared folder for
other queries over the same files.  Everything else covers all rows: one pass without a shuffle.

Edge cases: a null, blank or wordless document has no language (null, confidence 0) and gives no found
row unless its label is missing, which it cannot correct; texts are taken whole.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.core.store import ControlFiles, base_dir

# fixed values: two-letter code, three-letter codes and English name of the languages told apart
LANGUAGES = {
    "de": ("deu", "ger", "german"), "en": ("eng", "english"), "es": ("spa", "spanish"), "fr": ("fra", "fre", "french"), "it": ("ita", "italian"),
    "nl": ("nld", "dut", "dutch"), "pl": ("pol", "polish"), "pt": ("por", "portuguese"), "ru": ("rus", "russian"), "sv": ("swe", "swedish"),
}
CODES = sorted(LANGUAGES)
BITS = 15
FEATURES = 1 << 12
#: Feature counts of a text are brought to this sum.
SCALE = 12.0
PER_LABEL = 500
LINES_PER_LABEL = 2000
MAX_LINE = 1000
SWITCH = 0.9
#: What a line of fewer than four words weighs beside longer ones, so that a run of them can still be a segment.
SHORT = 0.5
#: Least advantage of several languages over the best single one, in units of decoding loss, for a document to count as mixed.
MIXED = 0.5
_WORD = re.compile(r"[^\W\d_]{1,40}")
_NOISY = re.compile(r"[`/@(0-9]")
_NOISE = re.compile(r"`[^`]*`|https?://\S+|\S+@\S+|\[\[?[^\]]*\]\(([^)]*)\)|[0-9a-f]{8,}")


def label_code(label: Column) -> Column:
    """Two-letter code named by a label in any spelling; null where it names none of the languages."""
    bare = F.lower(F.regexp_replace(F.trim(label), r"[-_].*$", ""))
    names = F.create_map(*[F.lit(x) for code, others in LANGUAGES.items() for name in (code, *others) for x in (name, code)])
    return names[bare]


def codewords() -> np.ndarray:
    """Codeword of each language as a row of -1 and 1: the best of seeded random matrices by least distance of rows, then of columns."""
    rng, best, score = np.random.default_rng(20), None, (-1, -1)
    for _ in range(3000):
        m = np.where(rng.random((len(CODES), BITS)) < 0.5, -1, 1)
        rows = min((m[i] != m[j]).sum() for i in range(len(m)) for j in range(i))
        ones = (m > 0).sum(axis=0)
        if rows < score[0] or ones.min() < 3 or ones.max() > len(m) - 3:
            continue
        cols = min(min((m[:, i] != m[:, j]).sum(), (m[:, i] == m[:, j]).sum()) for i in range(BITS) for j in range(i))
        if cols >= 1 and (rows, cols) > score:
            best, score = m, (rows, cols)
    return best


def line_words(line: str) -> list[str]:
    """The words that tell the language of a line: small letters, without code, links and ids."""
    line = line.lower()
    if _NOISY.search(line):
        line = _NOISE.sub(" ", line)
    return _WORD.findall(line)


@lru_cache(maxsize=20_000)
def word_features(word: str) -> np.ndarray:
    """Hashed n-grams (1 to 4 letters, with marks of the word's ends) and the word itself.

    Accents are kept and also left out, since they are not always typed.
    """
    forms = {word}
    bare = unicodedata.normalize("NFKD", word)
    if bare != word:
        forms.add("".join(c for c in bare if not unicodedata.combining(c)))
    out = []
    for form in sorted(forms):
        w = f"<{form}>"
        grams = [w] + [w[i : i + n] for n in (1, 2, 3, 4) for i in range(len(w) - n + 1)]
        out += [zlib.crc32(g.encode("utf-8")) % FEATURES for g in grams]
    return np.array(out)


@dataclass
class Model:
    """Weights of the bit classifiers, codewords and the weight of each bit for each language."""

    weights: np.ndarray  # FEATURES x BITS
    bias: np.ndarray  # BITS
    code: np.ndarray  # languages x BITS
    trust: np.ndarray  # languages x BITS, rows sum to 1

    def loss(self, margins: np.ndarray) -> np.ndarray:
        """Weighted loss of each language for rows of bit margins."""
        z = -self.code[None, :, :] * margins[:, None, :]
        return (np.logaddexp(0, z) * self.trust[None, :, :]).sum(axis=2)


def _counts(features: list[np.ndarray]) -> np.ndarray:
    """Feature counts of texts, a byte each (what is beyond 255 says nothing more)."""
    x = np.zeros((len(features), FEATURES), np.uint8)
    for row, idx in zip(x, features, strict=True):
        row += np.minimum(np.bincount(idx, minlength=FEATURES), 255).astype(np.uint8)
    return x


def _vectors(counts: np.ndarray) -> np.ndarray:
    x = counts.astype(np.float32)
    x *= SCALE / np.maximum(1, x.sum(axis=1, keepdims=True))
    return x


def _fit(counts: np.ndarray, y: np.ndarray, code: np.ndarray, epochs: int = 8, size: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Logistic classifiers of all bits at once, in small batches; each language weighs the same."""
    rng = np.random.default_rng(8)
    weight = len(y) / (len(np.unique(y)) * np.maximum(1, np.bincount(y, minlength=len(code))))
    w, b = np.zeros((FEATURES, BITS), np.float32), np.zeros(BITS, np.float32)
    m, v, t = np.zeros_like(w), np.zeros_like(w), 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for k in range(0, len(order), size):
            rows = order[k : k + size]
            x = _vectors(counts[rows])
            g = (1 / (1 + np.exp(-(x @ w + b))) - (code[y[rows]] > 0)) * (weight[y[rows]][:, None] / len(rows))
            g = g.astype(np.float32)
            gw = x.T @ g + 2e-5 * w
            t += 1
            m, v = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw * gw
            w -= 0.03 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)
            b -= 0.3 * g.sum(axis=0)
    return w, b


def _margins(counts: np.ndarray, w: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.vstack([_vectors(counts[k : k + 1000]) @ w + b for k in range(0, len(counts), 1000)])


def train(rows: list[tuple[str, str]]) -> Model:
    """Fit on (text, language) rows; their labels may be partly wrong."""
    code, lines, y, per = codewords(), [], [], {}
    for text, lang in rows:
        k = CODES.index(lang)
        for line in text.splitlines():
            ws = line_words(line)
            if len(ws) >= 4 and per.get(k, 0) < LINES_PER_LABEL:
                per[k] = per.get(k, 0) + 1
                lines.append(ws)
                y.append(k)
    if not lines:
        raise ValueError("no labelled text to learn from")
    x, y = _counts([np.concatenate([word_features(w) for w in ws]) for ws in lines]), np.array(y)
    held = np.arange(len(y)) % 5 == 0
    keep = ~held
    even = np.full((len(code), BITS), 1 / BITS)
    for _ in range(2):
        own = np.nonzero(keep)[0]
        w, b = _fit(x[own], y[own], code)
        margins = _margins(x, w, b)
        guess = Model(w, b, code, even).loss(margins).argmin(axis=1)
        keep = ~held & (guess == y)
    # how often each bit is right for each language, on held-out rows whose label the model shares
    right = np.full((len(code), BITS), 0.5)
    for k in range(len(code)):
        own = held & (y == k) & (guess == k)
        if own.any():
            right[k] = ((margins[own] > 0) == (code[k] > 0)).mean(axis=0)
    trust = np.clip(right, 0.05, None)
    return Model(w, b, code, (trust / trust.sum(axis=1, keepdims=True)).astype(np.float32))


def training_rows(documents: DataFrame, per_label: int = PER_LABEL, lines_per_label: int = LINES_PER_LABEL) -> list[tuple[str, str]]:
    """(line, language): lines of about ``per_label`` labelled documents a language, the same on every run.

    The number of documents of a label sets its share of the hash range; of their lines of 12 to MAX_LINE
    characters and four words the ``lines_per_label`` of the smallest hashes are taken, each language for itself.
    A task sends no more than that many lines a language.
    """
    labelled = documents.select("doc_id", "text", label_code(F.col("lang")).alias("code")).filter("code IS NOT NULL AND text IS NOT NULL")
    counts = {r.code: r.n for r in labelled.groupBy("code").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    share = F.create_map(*[x for c, n in counts.items() for x in (F.lit(c), F.lit(min(1.0, per_label / n)))])
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(8)), F.lit(1_000_003)) / F.lit(1_000_003.0)
    picked = labelled.filter(place < share[F.col("code")])
    lines = picked.select("doc_id", "code", F.posexplode(F.split("text", r"\r?\n")).alias("line_no", "line"))
    lines = lines.filter(F.length(F.trim("line")).between(12, MAX_LINE) & (F.regexp_count("line", F.lit(r"\pL+")) >= 4))
    by_hash = Window.partitionBy("code").orderBy(F.xxhash64("doc_id", "line_no", F.lit(9)), "doc_id", "line_no", "line")
    rows = lines.withColumn("_n", F.row_number().over(by_hash)).filter(F.col("_n") <= lines_per_label).select("code", "_n", "line").collect()
    return [(r.line, r.code) for r in sorted(rows, key=lambda r: (r.code, r._n))]


def trained(documents: DataFrame) -> Model:
    """The model of these documents; fitted once for the files they are read from, and kept in the shared folder."""
    spark = documents.sparkSession
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    seen = []
    for name in sorted(documents.inputFiles()):
        path = fs_path(name)
        status = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path)
        seen.append((name, status.getLen(), status.getModificationTime()))
    if not seen:  # rows that come from no file
        return train(training_rows(documents))
    key = hashlib.sha256(repr((seen, PER_LABEL, LINES_PER_LABEL, FEATURES, BITS)).encode()).hexdigest()[:32]
    files = ControlFiles(spark, f"{base_dir(spark)}/driftline/{spark.sparkContext.applicationId}/language-models")
    if not files.exists(key):
        model = train(training_rows(documents))
        parts = {n: [str(a.dtype), list(a.shape), base64.b64encode(np.ascontiguousarray(a).tobytes()).decode()] for n, a in vars(model).items()}
        files.create(key, json.dumps(parts))
    parts = json.loads(files.read(key))
    return Model(**{n: np.frombuffer(base64.b64decode(raw), dtype=kind).reshape(shape) for n, (kind, shape, raw) in parts.items()})


class Decoder:
    """Languages of documents and their lines."""

    def __init__(self, model: Model):
        self.model = model
        self._rows: dict[str, int] = {}
        self._table = np.zeros((1024, BITS + 1), np.float32)  # weights of a word's features, and their number

    def _word(self, w: str) -> int:
        k = self._rows.get(w)
        if k is None:
            k = self._rows[w] = len(self._rows)
            if k >= len(self._table):
                self._table = np.vstack([self._table, np.zeros_like(self._table)])
            features = word_features(w)
            self._table[k, :BITS] = self.model.weights[features].sum(axis=0)
            self._table[k, BITS] = len(features)
        return k

    def lines(self, text: str) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Non-blank lines, their number of words, and their losses per language (0 for a line without words)."""
        lines = [x for x in text.splitlines() if x.strip()]
        words = [line_words(x) for x in lines]
        n = np.array([len(w) for w in words], np.int64)
        margins = np.zeros((len(lines), BITS), np.float32)
        some = np.nonzero(n)[0]
        if len(some):
            idx = np.array([self._word(w) for ws in words for w in ws])
            starts = np.concatenate([[0], np.cumsum(n[some])[:-1]])
            total = np.add.reduceat(self._table[idx], starts, axis=0)
            margins[some] = total[:, :BITS] * (SCALE / total[:, BITS:]) + self.model.bias
        loss = self.model.loss(margins)
        loss[n == 0] = 0
        return lines, n, loss

    def document(self, text: str | None) -> tuple[int, float, list[tuple[int, float]]]:
        """(language, confidence, lines): the index of the language or -1; per non-blank line (language, confidence), empty unless mixed."""
        if not text or not text.strip():
            return -1, 0.0, []
        if len(self._rows) > 200_000:
            self._rows.clear()
        lines, n, loss = self.lines(text)
        if not n.sum():
            return -1, 0.0, []
        # a line says more the longer it is, but not without limit; a few words say little beside whole sentences
        weight = np.minimum(n, 12) / 4.0
        if (n >= 4).any():
            weight[n < 4] *= SHORT
        cost = loss * weight[:, None]
        total = cost.sum(axis=0)
        best = int(total.argmin())
        # where every line that says anything says the same, there is nothing to choose
        path, changed = self._path(cost) if (cost.argmin(axis=1)[weight > 0] != best).any() else ([best], 0.0)
        if len(set(path)) > 1 and total[best] - changed >= MIXED:
            chars: dict[int, int] = {}
            for x, k in zip(lines, path, strict=True):
                chars[k] = chars.get(k, 0) + len(x)
            main = max(chars, key=lambda k: (chars[k], -k))
            own = np.array(path) == main
            sure = [(k, self._sure(loss[i] * np.minimum(n[i], 12) / 4.0, k)) for i, k in enumerate(path)]
            return main, self._sure(cost[own].sum(axis=0) * min(1.0, 12 / max(1.0, weight[own].sum())), main), sure
        return best, self._sure(total * min(1.0, 12 / max(1.0, weight.sum())), best), []

    @staticmethod
    def _sure(cost: np.ndarray, k: int) -> float:
        """Confidence in k from its distance to the other codewords: a half each for two that are equally near."""
        p = np.exp(-(cost - cost.min()) * 2)
        return float(p[k] / p.sum())

    @staticmethod
    def _path(cost: np.ndarray) -> tuple[list[int], float]:
        """The cheapest language per line when a change costs SWITCH, and its cost."""
        state, back = cost[0].copy(), []
        for row in cost[1:]:
            k = int(state.argmin())
            jump = state[k] + SWITCH < state
            back.append(np.where(jump, k, np.arange(len(state))))
            state = np.where(jump, state[k] + SWITCH, state) + row
        k = int(state.argmin())
        path = [k]
        for b in reversed(back):
            k = int(b[k])
            path.append(k)
        path.reverse()
        return path, float(state.min())


def detected_languages(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, label (code or null), seg_no, lang, confidence, ambiguous: seg_no -1 for each document, and each non-blank line of a mixed one."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(model)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text, label in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lang, sure, lines = decoder.document(text)
                out.append((doc_id, label, -1, CODES[lang] if lang >= 0 else None, sure))
                out += [(doc_id, label, i, CODES[k], c) for i, (k, c) in enumerate(lines)]
            cols = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.float64())],
                ["doc_id", "label", "seg_no", "lang", "confidence"],
            )

    rows = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), label_code(F.col("lang")).alias("label"))
    found = rows.mapInArrow(task, "doc_id bigint, label string, seg_no int, lang string, confidence double")
    return found.withColumn("ambiguous", F.col("confidence") < 0.7)


def label_corrections(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, seg_no, lang: documents whose label is missing or wrong (seg_no -1), and every line of mixed documents."""
    found = detected_languages(documents, model).filter("lang IS NOT NULL")
    return found.filter("seg_no >= 0 OR label IS NULL OR label <> lang").select("doc_id", "seg_no", "lang")
