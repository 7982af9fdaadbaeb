"""Quality rules as a bitmask ledger (native: DataFrame functions only).

``measure`` takes every measurement of a text once. ``ledger`` evaluates every rule once on
them and stores one bit a failed rule, next to the measurements. Policies are versioned bit
masks over that ledger: applying one, or comparing two, is a bitwise AND and never reads a
text again. ``ablation`` counts, by one small aggregate over the distinct bit patterns, what each
rule rejects, what it alone rejects, and what would be kept without it.

Defined results: a null text has no words, so every count is 0 and ``too_few_words`` fails;
an empty text likewise. Repeated rows each get their own ledger row; nothing is joined, so a
hot source or a group of copies can't gather in one task. A null doc_id is carried through.
The columns ``measures``, ``failed``, ``base_failed`` and ``kept`` replace such columns of the input;
``keep`` returns the input's own columns, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm import common

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A named rule: its bit in the ledger and its failing condition over the measurements."""

    name: str
    bit: int
    fails: Callable[[Callable[[str], Column]], Column]


#: Bits are never reused: a retired rule keeps its number, so old ledgers stay readable.
RULES = [
    Rule("too_few_words", 0, lambda m: m("n_words") < 50),
    Rule("repeated_words", 1, lambda m: m("n_repeat_words") * 100 > m("n_words") * 50),
    Rule("symbols", 2, lambda m: m("n_symbols") * 10 > m("n_words")),
    Rule("duplicate_lines", 3, lambda m: m("n_dup_lines") * 2 > m("n_lines")),
    Rule("short_words", 4, lambda m: m("word_chars") < m("n_words") * 2),
    Rule("long_words", 5, lambda m: m("word_chars") > m("n_words") * 30),
    Rule("one_line_list", 6, lambda m: m("n_lines") * 2 > m("n_words")),
]
BASE = ("too_few_words", "repeated_words")

#: Versioned policies: the rules whose failure rejects a document.
POLICIES = {
    "base": BASE,
    "v1": (*BASE, "symbols", "duplicate_lines"),
    "v2": (*BASE, "symbols", "duplicate_lines", "short_words", "long_words"),
    "strict": tuple(r.name for r in RULES),
}
PRODUCTION = "v2"


def mask(names) -> int:
    """The bits of the named rules."""
    bits = {r.name: 1 << r.bit for r in RULES}
    return sum(bits[n] for n in names)


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with a struct ``measures`` of the measurements in ``MEASURES`` (bigint each).

    ``n_repeat_words`` counts the words that lie in a 3-word window found twice or more: the
    windows' 64-bit hashes are sorted with their positions, equal neighbours mark repeated
    windows, and the marked positions, in order, cover ``min(3, gap)`` words each. Sorting
    keeps a text of n words at n log n.
    """
    t, w, ln, s, p = common.temp_names(df, "_t", "_w", "_ln", "_s", "_p")
    x = df.withColumn(t, F.coalesce(F.col(text), F.lit("")))
    x = x.withColumn(w, common.words(F.col(t)))
    # lines that hold a word; \n-split, so other line ends stay part of a line
    x = x.withColumn(ln, F.filter(F.split(F.col(t), "\n"), lambda z: F.translate(z, " \t\x0b\x0c\r", "") != F.lit("")))
    # no function below refers to a column from inside a lambda: pushed into a filter, it would be worked out per element
    n = F.size(w)
    rest = lambda k: F.slice(F.col(w), k, n)
    runs = F.arrays_zip(F.col(w).alias("a"), rest(2).alias("b"), rest(3).alias("c"))
    windows = F.slice(F.transform(runs, lambda z, i: F.struct(F.xxhash64(z["a"], z["b"], z["c"]).alias("h"), i.alias("at"))), 1, n - 2)
    x = x.withColumn(s, F.when(n >= 3, F.sort_array(windows)))
    # both places of each pair of equal neighbours; a place that comes twice covers nothing more
    pairs = F.zip_with(F.col(s), F.slice(F.col(s), 2, F.size(s)), lambda y, z: F.when(y["h"] == z["h"], F.array(y["at"], z["at"])))
    x = x.withColumn(p, F.sort_array(F.flatten(F.filter(pairs, lambda z: z.isNotNull()))))
    covered = F.aggregate(
        F.col(p), F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, at: F.struct((a["n"] + F.least(F.lit(3), at - a["last"])).alias("n"), at.alias("last")),
        lambda a: a["n"])
    chars = F.length(F.translate(F.col(t), " \t\n\x0b\x0c\r", ""))
    values = {
        "n_words": n, "word_chars": chars,
        "n_symbols": F.length(t) - F.length(F.translate(F.col(t), SYMBOLS, "")),
        "n_dup_lines": F.size(ln) - F.size(F.array_distinct(ln)),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_lines": F.size(ln),
    }
    x = x.withColumn("measures", F.struct(*[v.cast("bigint").alias(k) for k, v in values.items()]))
    return x.drop(t, w, ln, s, p)


def ledger(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``measures`` and ``failed`` (bigint): bit k is set if rule k fails."""
    return measure(df, text).withColumn("failed", _failed())


def _failed() -> Column:
    """The failure bits of a row with ``measures``."""
    m = lambda k: F.col("measures")[k]
    bits = [F.when(r.fails(m), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("bigint") for r in RULES]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return total


def rejects(policy: str, failed: str = "failed") -> Column:
    """Whether ``policy`` rejects a ledger row."""
    return F.col(failed).bitwiseAND(F.lit(mask(POLICIES[policy])).cast("bigint")) != 0


def ablation(rows: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """Per rule of ``policy``: documents failing it, failing it alone, and kept without it.

    One aggregate over the ledger gives a count for each bit pattern (at most 2^rules rows,
    combined before the shuffle); the rules are then read off those patterns bitwise.
    """
    whole = mask(POLICIES[policy])
    patterns = rows.groupBy((F.col("failed").bitwiseAND(F.lit(whole).cast("bigint"))).alias("bits")).count()
    rules = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("bigint").alias("bit"))
                      for r in RULES if r.name in POLICIES[policy]])
    x = patterns.select("bits", "count", F.explode(rules).alias("r"))
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    rest = F.col("bits").bitwiseAND(F.bitwise_not(F.col("r.bit")))
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("count"))), F.lit(0)).cast("bigint")
    return x.groupBy(F.col("r.rule").alias("rule")).agg(
        total(hit).alias("fails"), total(hit & (rest == 0)).alias("fails_alone"),
        total(rest == 0).alias("kept_without"))


def verdicts(df: DataFrame, text: str = "text", policy: str = PRODUCTION) -> DataFrame:
    """``df`` with the ledger and the booleans ``base_failed`` and ``kept``."""
    x = ledger(df, text)
    base = rejects("base")
    return x.withColumn("base_failed", base).withColumn("kept", ~(base | rejects(policy)))


def keep(docs: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """Pipeline stage: the documents that ``policy`` keeps, with their own columns only."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text"))
    # the measurements stand behind a generator: a filter on the verdict would else be pushed below them and work
    # each out again wherever a rule reads it
    x = measure(packed).select(F.inline(F.array(F.struct("row", "measures")))).withColumn("failed", _failed())
    x = x.where(~(rejects("base") | rejects(policy)))
    return x.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
