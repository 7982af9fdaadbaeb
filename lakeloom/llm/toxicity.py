"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding maps every character to one character, so places stay: lower case, accents off,
look-alike letters of other scripts to Latin, digits and signs written for letters to those
letters, and l, 1, | and ! to i. Entries are whole words or word stems; they match only at the
start of a word (what stands before is no letter), whole words also only at its end.

The lexicon is learned from labelled rows: words and stems whose documents are toxic far more often
than others get their smoothed log-odds as weight. Phrases of a hit and the word before or after
it that occur in clean documents only are exceptions: a hit inside one doesn't count. The score is
a logistic function of the summed weights, as they are and by length (weights per root of the
word count), fitted on the same rows.

Learning reads a bounded sample: at most ``Fit.rows`` labelled rows, smallest hash first; a
document's label, language, source and id never enter its score. Scoring reads whole texts.

Defined results: null and empty texts match nothing and get the lowest score. Rows are scored one by
one: repeated rows get equal scores, a null id is carried. Without usable labels of both kinds the
lexicon is empty and every score is 0. Extra columns aren't read.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import stored, words


@dataclass(frozen=True)
class Fit:
    """Bounds and settings of learning."""

    rows: int = 20_000
    stems: tuple[int, ...] = (4, 5, 6, 7, 8)
    min_docs: int = 4
    min_share: float = 0.01
    min_odds: float = 2.5
    terms: int = 2_000
    exceptions: int = 500


#: Letters of other scripts that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "е": "e", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p",
    "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "i",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ℓ": "i", "ƒ": "f", "ß": "s",
}
#: Digits and signs written for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i", "l": "i"}


class _Fold(dict):
    """Character code → folded character, worked out when first seen."""

    def __missing__(self, code: int) -> str:
        c = chr(code).lower()[:1]
        c = HOMOGLYPHS.get(c, c)
        c = unicodedata.normalize("NFKD", c)[:1].lower()[:1] or c
        c = SUBSTITUTES.get(HOMOGLYPHS.get(c, c), HOMOGLYPHS.get(c, c))
        self[code] = c
        return c


_FOLD = _Fold()
_ASCII = bytes(ord(_FOLD[i]) for i in range(128)) + bytes(range(128, 256))


def fold(text: str) -> str:
    """The folded text; it has as many characters as the text."""
    return text.encode("ascii").translate(_ASCII).decode("ascii") if text.isascii() else text.translate(_FOLD)


@dataclass
class Lexicon:
    """Entries with weights, exception phrases, and the coefficients of the score."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    coefficients: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def __post_init__(self):
        self.machine = None

    def __getstate__(self):
        return self.__dict__ | {"machine": None}

    def matcher(self):
        import ahocorasick

        if self.machine is None:
            a = ahocorasick.Automaton()
            entries: dict[str, list] = {}
            for kind, terms in (("word", self.words), ("stem", self.stems)):
                for t, w in terms.items():
                    entries.setdefault(t, []).append((kind, len(t), w))
            for t in self.exceptions:
                entries.setdefault(t, []).append(("except", len(t), 0.0))
            for t, e in entries.items():
                a.add_word(t, e)
            if entries:
                a.make_automaton()
            self.machine = a
        return self.machine

    def hits(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) of the counted matches in a text: one a word, the heaviest."""
        a = self.matcher()
        if not len(a):
            return []
        # a word's ends are those of the text as it stands: a sign after a word isn't a letter of it
        letters = letters_of(text)
        n, found, free = len(letters), {}, []
        for last, entries in a.iter(letters):
            for kind, size, weight in entries:
                lo, hi = last - size + 1, last + 1
                if lo and text[lo - 1].isalpha():
                    continue
                if kind != "stem" and hi < n and text[hi].isalpha():
                    continue
                if kind == "except":
                    free.append((lo, hi))
                elif lo not in found or weight > found[lo][2]:
                    found[lo] = (lo, hi, weight)
        return [h for h in found.values() if not any(lo <= h[0] and h[1] <= hi for lo, hi in free)]

    def features(self, text: str | None) -> tuple[float, float]:
        """Summed weights, and summed weights per root of the word count; as logarithms."""
        if not text:
            return 0.0, 0.0
        total = sum(w for _, _, w in self.hits(text))
        return (math.log1p(total), math.log1p(total / math.sqrt(1 + text.count(" ") + text.count("\n")))) if total else (0.0, 0.0)

    def score(self, text: str | None) -> float:
        """0 to 1; higher: toxic likelier."""
        b, c1, c2 = self.coefficients
        if not (self.words or self.stems):
            return 0.0
        x1, x2 = self.features(text)
        return 1 / (1 + math.exp(-(b + c1 * x1 + c2 * x2)))


_SPACED = str.maketrans({c: " " for c in map(chr, range(128)) if not c.isalpha()})


def letters_of(text: str) -> str:
    """The folded text with each ASCII character that is no letter as a space."""
    return fold(text).translate(_SPACED)


def learning_rows(docs: DataFrame, labels: DataFrame, fit: Fit, key: str = "doc_id", text: str = "text",
                  label: str = "toxic") -> DataFrame:
    """``(text, toxic)`` of a bounded sample of labelled rows outside the held-out third.

    Copies would count one document's words many times over, so of the rows that share three minimum hashes of their
    3-word runs one is taken.
    """
    rows = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key)))
    rows = rows.groupBy(F.col(key).alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("toxic"))
    sample = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit.rows)
    # at most fit.rows rows of 12 bytes: a proven bound
    x = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(sample), "doc_id")
    x = x.withColumn("w", words(F.col("text")))
    runs = F.sequence(F.lit(0), F.greatest(F.size("w") - 3, F.lit(0)))
    least = [F.array_min(F.transform(runs, lambda i, k=k: F.xxhash64(F.lit(k), F.slice("w", i + 1, 3)))).alias(f"m{k}") for k in range(3)]
    return stored(x.select("text", "toxic", *least).dropDuplicates(["m0", "m1", "m2"]).select("text", "toxic"), "toxicity-rows")


def held_out(key: Column) -> Column:
    """Whether the checksum of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _terms(text: str, fit: Fit) -> set[tuple[str, str]]:
    out = set()
    for w in set(letters_of(text).split()):
        out.add(("word", w))
        out |= {("stem", w[:k]) for k in fit.stems if len(w) > k}
    return out


def learn(docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), **columns) -> Lexicon:
    """Learn entries, exceptions and coefficients."""
    rows = learning_rows(docs, labels, fit, **columns)
    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    pos, neg = sum(n for t, n in totals.items() if t > 0), sum(n for t, n in totals.items() if t <= 0)
    lex = Lexicon()
    if not pos or not neg:
        return lex

    def counts(pick) -> DataFrame:
        """Documents of each kind that have a (kind, term) which ``pick`` finds; summed in tasks first."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found: tuple[Counter, Counter] = Counter(), Counter()
                for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    if text:
                        found[int(toxic > 0)].update(pick(text))
                keys = list(found[0].keys() | found[1].keys())
                yield pa.record_batch([pa.array([k for k, _ in keys], pa.string()), pa.array([t for _, t in keys], pa.string()),
                                       pa.array([found[1][k] for k in keys], pa.int64()), pa.array([found[0][k] for k in keys], pa.int64())],
                                      ["kind", "term", "pos", "neg"])

        x = rows.mapInArrow(run, "kind string, term string, pos bigint, neg bigint")
        return x.groupBy("kind", "term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))

    odds = F.log((F.col("pos") + 0.5) / (pos + 1.0)) - F.log((F.col("neg") + 0.5) / (neg + 1.0))
    found = counts(lambda t: _terms(t, fit)).withColumn("odds", odds)
    found = found.where((F.col("pos") >= max(fit.min_docs, fit.min_share * pos)) & (F.col("odds") >= fit.min_odds))
    found = found.orderBy(F.desc(F.col("odds") * F.sqrt("pos")), "kind", "term").limit(fit.terms).collect()
    lex.words, lex.stems = _chosen([(r["kind"], r["term"], r["pos"], r["odds"]) for r in found])

    around = counts(lambda t: _phrases(lex, t))
    clean = around.where((F.col("pos") == 0) & (F.col("neg") >= fit.min_docs)).orderBy(F.desc("neg"), "term").limit(fit.exceptions)
    lex.exceptions = [r["term"] for r in clean.collect()]
    lex.machine = None
    lex.coefficients = _logistic(rows, lex)
    return lex


def _chosen(found: list[tuple[str, str, int, float]]) -> tuple[dict[str, float], dict[str, float]]:
    """Of entries that start alike and cover nearly the same documents, the longest; then no entry under a kept stem."""
    stems = {t: (n, w) for kind, t, n, w in found if kind == "stem"}
    words = {t: (n, w) for kind, t, n, w in found if kind == "word"}
    for t, (n, _) in sorted(stems.items(), key=lambda x: len(x[0])):
        longer = [m for u, (m, _) in [*stems.items(), *words.items()] if len(u) > len(t) and u.startswith(t)]
        if any(m >= 0.9 * n for m in longer):
            del stems[t]
    kept: dict[str, float] = {}
    for t, (_, w) in sorted(stems.items(), key=lambda x: len(x[0])):
        if not any(t.startswith(u) for u in kept):
            kept[t] = w
    return {t: w for t, (_, w) in words.items() if not any(t.startswith(u) for u in kept)}, kept


def _phrases(lex: Lexicon, text: str) -> set[tuple[str, str]]:
    """The two-word phrases around each hit."""
    letters, out = letters_of(text), set()
    for lo, _, _ in lex.hits(text):
        hi = letters.find(" ", lo)
        word = letters[lo:] if hi < 0 else letters[lo:hi]
        before, after = letters[max(0, lo - 64):lo].split(), [] if hi < 0 else letters[hi:hi + 64].split()
        out |= {("phrase", f"{x} {word}") for x in before[-1:]} | {("phrase", f"{word} {x}") for x in after[:1]}
    return out


def _logistic(rows: DataFrame, lex: Lexicon, ridge: float = 1e-2) -> tuple[float, float, float]:
    """Coefficients of the score by Newton's method on sums that Spark takes over the learning rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [lex.features(t) for t in b.column(0).to_pylist()]
            yield pa.record_batch([pa.array([round(v[0], 6) for v in x], pa.float64()), pa.array([round(v[1], 6) for v in x], pa.float64()),
                                   pa.array([int(t > 0) for t in b.column(1).to_pylist()], pa.int64())], ["x1", "x2", "y"])

    # at most Fit.rows rows of three numbers, equal ones counted together
    got = rows.mapInArrow(run, "x1 double, x2 double, y bigint").groupBy("x1", "x2", "y").agg(F.count(F.lit(1)).alias("n")).collect()
    x = np.array([[1.0, r["x1"], r["x2"]] for r in got])
    y, n = np.array([r["y"] for r in got], float), np.array([r["n"] for r in got], float)
    order = np.lexsort((y, x[:, 2], x[:, 1]))
    x, y, n = x[order], y[order], n[order]
    beta = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (n * (y - p)) - ridge * n.sum() * np.array([0, 1e-2, 1e-2]) * beta
        hess = (x * (n * p * (1 - p))[:, None]).T @ x + np.diag([1e-6, ridge * n.sum() * 1e-2, ridge * n.sum() * 1e-2])
        step = np.linalg.solve(hess, grad)
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in beta)


def score(docs: DataFrame, lex: Lexicon, key: str = "doc_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            scores = [lex.score(t) for t in texts]
            yield pa.record_batch([b.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    kind = docs.schema[key].dataType.simpleString()
    x = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id {kind}, score double")
    return x.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
