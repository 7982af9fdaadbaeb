"""Benchmark decontamination by template canonicalisation (native: DataFrame functions only).

Texts become templates: numbers, units after a number, and names (capitalised words inside a
sentence) turn into typed placeholders, the rest into lower-case words. A benchmark item whose
numbers or names were exchanged keeps its template, so windows of template words still meet. Neighbouring names
are one placeholder, as are the parts of a name with an apostrophe or hyphen. Each text is read in three ways: a capitalised word that starts a sentence is a word, or
it is a name, or there are no placeholders at all (literal). Each reading is matched with its own kind. A text is
marked and split once; the three readings are taken from these tokens.

1. *Suspects.* All windows of ``window`` words of each document are hashed and joined with all windows of
   all items, as templates and as literal words (lower case, no placeholders).
2. *Windows.* The windows of documents with a hit are joined with the items' again, now with
   positions. Hits on one diagonal (same offset of document and item) line up; a word put in or left out
   shifts the offset, so hits of several diagonals count together as a chain that goes forward in both texts.
3. *Slots.* On each diagonal and chain the raw values behind the placeholders are paired. A copy or a
   re-parameterised question maps each value of the item to one value of the document; a diagonal
   where one value maps to two is an accidental likeness and is refused. A chain takes a hit only if its slots
   stay consistent (the longest chain up to each item window is kept, so this may miss a longer one; whole diagonals are looked at anyway).

A document is contaminated by an item if one diagonal or chain holds at least ``share`` percent of the
item's template windows with consistent slots, or of its literal windows. It holds a literal copy (``literal``) if all of the item's
literal windows are there. Template windows with fewer
than ``literals`` words that aren't placeholders are no evidence; literal windows all are, so an item of
numbers or names alone is found by its copies.

Defined results: null and empty texts match nothing; an item shorter than ``window`` words is one window of its
own length. Repeated documents each count; repeated items are told apart by
id (items with one id and several texts count as one item with all their windows). Null ids of documents are
carried. Extra columns aren't read. Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import stored

#: Placeholder marks (private-use characters): number, unit, name; a point inside a number, a space inside a name.
NUMBER, UNIT, NAME, POINT, JOIN = "\ue001", "\ue002", "\ue003", "\ue004", "\ue005"
#: Marks of words that the readings take differently: a capitalised word at the start of a sentence, a name right after
#: it (or its part after ' or -), and a further word or part of a name.
START, NEXT, MORE = "\ue006", "\ue007", "\ue008"
#: Readings of a text: templates whose sentences start with a word, or with a name; literal words.
PLAIN, INITIAL, EXACT = 0, 1, 2
UNITS = ["km", "cm", "mm", "m", "kg", "g", "mg", "l", "ml", "s", "ms", "h", "min", "hours?", "minutes?", "seconds?", "days?",
         "weeks?", "months?", "years?", "miles?", "feet", "foot", "inch(?:es)?", "pounds?", "lbs?", "ounces?", "dollars?",
         "cents?", "euros?", "percent", "degrees?", "mph", "kmh", "watts?", "volts?", "hz", "gb", "mb", "kb"]
#: Rows of a small side that may be broadcast (at most 32 bytes each: 16 MB); more go by a shuffle join.
BROADCAST_ROWS = 500_000


def marked(text: Column) -> Column:
    """The text in lower case with a mark before each number, unit and capitalised word; the values stay."""
    gap = "[ '’-]"
    x = F.regexp_replace(text, r"[.,](?<=\p{N}.)(?=\p{N})", POINT)
    x = F.regexp_replace(x, r"\p{Lu}(?<=[\p{Ll}\p{N},;:] \p{Lu})", f"{NAME}$0")
    x = F.regexp_replace(x, r"\p{Lu}(?<=(?:^|\n|[.!?\"”’)(“] {0,2})\p{Lu})(?<!\p{L}’\p{Lu})", f"{START}$0")
    x = F.regexp_replace(x, rf"['’-](?=\p{{Lu}})(?<=[{NAME}{START}][\p{{L}}'’-]{{1,60}})", f"$0{NAME}")
    x = F.regexp_replace(x, rf"({gap}){NAME}(?<={NAME}\p{{L}}{{1,40}}{gap}{NAME})", f"$1{MORE}")
    x = F.regexp_replace(x, rf"({gap}){NAME}(?<={START}\p{{L}}{{1,40}}{gap}{NAME})", f"$1{NEXT}")
    # a number without a unit leaves a lone mark, which isn't a word
    x = F.regexp_replace(x, rf"(\p{{N}}[\p{{N}}{POINT}]*)(?: ?((?i:{'|'.join(UNITS)}))(?![\p{{L}}\p{{N}}]))?", f" {NUMBER}$1 {UNIT}$2 ")
    return F.lower(x)


def _split(marked_text: Column) -> Column:
    return F.filter(F.split(F.coalesce(marked_text, F.lit("")), rf"[^\p{{L}}\p{{M}}\p{{N}}{NUMBER}-{MORE}]+"), lambda w: (w != "") & (w != UNIT))


def _mark(word: Column) -> Column:
    return F.substring(word, 1, 1)


def _bare(word: Column) -> Column:
    """A word without its mark."""
    return F.when((word >= NUMBER) & _mark(word).between(NUMBER, MORE), F.substring(word, 2, 1 << 30)).otherwise(word)


def raw_words(marked_text: Column, kind: int) -> Column:
    """The words of a marked text in a reading, with their values: a name of several words is one, its parts joined."""
    x = marked_text
    gap = "[ '’-]"
    if kind == INITIAL:
        x = F.replace(F.regexp_replace(x, rf"{gap}[{NEXT}{MORE}]", JOIN), F.lit(START), F.lit(NAME))
    elif kind == PLAIN:
        x = F.replace(F.regexp_replace(x, rf"{gap}{MORE}", JOIN), F.lit(START), F.lit(""))
        x = F.replace(x, F.lit(NEXT), F.lit(NAME))
    return _split(x) if kind != EXACT else F.transform(_split(x), _bare)


def template(words: Column) -> Column:
    """Template words: a marked value becomes its mark alone."""
    return F.transform(words, lambda w: F.when(_mark(w).isin(NUMBER, UNIT, NAME), _mark(w)).otherwise(w))


def readings(split: Column, of: Callable[[Column], Column] = lambda w: w) -> list[Column]:
    """``of`` the template words in the three readings, straight from the split words of a marked text."""
    def held(w: Column, *gone: str) -> Column:
        return (w < NUMBER) | ~_mark(w).isin(*gone)

    # nearly all words sort before the marks; one comparison settles them
    def plain(w: Column) -> Column:
        m = _mark(w)
        return F.when(w < NUMBER, w).when(m == START, F.substring(w, 2, 1 << 30)).when(m == NEXT, F.lit(NAME)).when(m.between(NUMBER, NAME), m).otherwise(w)

    def initial(w: Column) -> Column:
        m = _mark(w)
        return F.when(w < NUMBER, w).when(m == START, F.lit(NAME)).when(m.between(NUMBER, NAME), m).otherwise(w)

    return [F.transform(F.filter(split, lambda w: held(w, MORE)), lambda w: of(plain(w))),
            F.transform(F.filter(split, lambda w: held(w, NEXT, MORE)), lambda w: of(initial(w))), F.transform(split, lambda w: of(_bare(w)))]


def _hash(words: Column, at: Column, size: int) -> Column:
    """A window's hash from the words' hashes, read one by one (a slice of each window costs far more)."""
    return F.xxhash64(*[F.get(words, at + k) for k in range(size)])


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _starts(words: Column, size: Column | int) -> Column:
    return F.when(F.size(words) >= size, F.sequence(F.lit(0), F.size(words) - size))


def item_windows(items: DataFrame, window: int, literals: int, key: str = "item_id", text: str = "text") -> DataFrame:
    """``h, kind, size, item_id, item_at, n_windows, item_raw`` of every window of every item: all literal ones,
    and the template ones with enough plain words. A short item is one window."""
    raw = {k: raw_words(marked(F.col(text)), k) for k in (PLAIN, INITIAL, EXACT)}
    x = items.select(F.col(key).alias("item_id"), F.inline(F.array(*[
        F.struct(F.lit(k).alias("kind"), r.alias("raw"), (r if k == EXACT else template(r)).alias("t")) for k, r in raw.items()])))
    x = x.withColumn("size", F.least(F.lit(window), F.size("t"))).where("size > 0")
    x = x.select("item_id", "kind", "size", "raw", "t", F.explode(_starts(F.col("t"), F.col("size"))).alias("item_at"))
    plain = F.size(F.filter(F.slice("t", F.col("item_at") + 1, F.col("size")), lambda w: ~w.isin(NUMBER, UNIT, NAME)))
    x = x.where((F.col("kind") == EXACT) | (plain >= literals)).select(
        "item_id", "kind", "size", "item_at",
        F.xxhash64(_hashes(F.slice("t", F.col("item_at") + 1, F.col("size")))).alias("h"),
        F.slice("raw", F.col("item_at") + 1, F.col("size")).alias("item_raw"))
    counts = x.groupBy("item_id", "kind").agg(F.count_distinct("item_at").alias("n_windows"))
    return x.join(counts, ["item_id", "kind"])


def _consistent(slots: Column) -> Column:
    return F.size(slots) == F.size(F.array_distinct(F.transform(slots, lambda z: z["i"])))


SLOTS = "array<struct<i:string,d:string>>"


def _chain(hits: Column) -> Column:
    """``n, slots`` of the longest chain of hits forward in document and item whose slots agree.

    ``hits`` (at, back = -item_at, slots) come in order, of one place the later item window first. The longest chain up to
    each item window is kept, so the state is bounded by the item.
    """
    def step(chains: Column, h: Column) -> Column:
        fit = F.filter(chains, lambda c: (c["e"] < -h["back"]) & _consistent(F.array_union(c["slots"], h["slots"])))
        longest = F.array_max(F.transform(fit, lambda c: F.struct(c["n"].alias("n"), c["slots"].alias("slots"))))
        new = F.struct((-h["back"]).alias("e"), (F.coalesce(longest["n"], F.lit(0)) + 1).alias("n"),
                       F.array_union(F.coalesce(longest["slots"], F.array().cast(SLOTS)), h["slots"]).alias("slots"))
        held = F.transform(F.array(new), lambda x: F.when(
            F.exists(chains, lambda c: (c["e"] == x["e"]) & (c["n"] >= x["n"])), chains).otherwise(
            F.concat(F.filter(chains, lambda c: c["e"] != x["e"]), F.array(x))))
        return F.get(held, F.lit(0))

    chains = F.aggregate(hits, F.array().cast("array<struct<e:int,n:int,slots:" + SLOTS + ">>"), step)
    return F.array_max(F.transform(chains, lambda c: F.struct(c["n"].alias("n"), c["slots"].alias("slots"))))


def _small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it has few rows; else left to a shuffle join."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def matches(docs: DataFrame, items: DataFrame, window: int = 6, literals: int = 4, share: int = 50,
            key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per contaminated document and item: doc_id, item_id, n_windows, n_hits, literal, consistent.

    ``literal`` tells a copy from a re-parameterised question. Only consistent diagonals make a row.
    """
    own = stored(item_windows(items, window, literals), "item-windows")
    kinds = sorted((r["kind"], r["size"]) for r in own.select("kind", "size").distinct().collect())
    if not kinds:
        kinds = [(EXACT, window)]
    hashes = _small(own.select("h").distinct())

    def hashed(words: str, size: int) -> Column:
        return F.coalesce(F.transform(_starts(F.col(words), size), lambda at: _hash(F.col(words), at, size)), F.array().cast("array<bigint>"))

    x = docs.select(F.xxhash64(text).alias("same"), _split(marked(F.col(text))).alias("t"))
    x = x.select("same", *[r.alias(f"h{k}") for k, r in enumerate(readings(F.col("t"), F.xxhash64))])
    # places first, hashes after: a hash for each place is far cheaper than arrays of hashes. Literal words are the most.
    x = x.select("same", *[f"h{k}" for k in (PLAIN, INITIAL, EXACT)],
                 F.explode(F.sequence(F.lit(0), F.greatest(F.size(f"h{EXACT}"), F.lit(1)) - 1)).alias("at"))
    at = F.col("at")
    x = x.select("same", *[F.when(at + n <= F.size(f"h{k}"), _hash(F.col(f"h{k}"), at, n)).alias(f"w{i}") for i, (k, n) in enumerate(kinds)])
    # readings that agree on a window give one hash
    windows = [F.col("w0"), *[F.when(~F.col(f"w{i}").eqNullSafe(F.col(f"w{i - 1}")), F.col(f"w{i}")) for i in range(1, len(kinds))]]
    every = x.select("same", F.explode(F.array(*windows)).alias("h")).where("h IS NOT NULL")
    suspects = _small(stored(every.join(hashes, "h", "left_semi").select("same").distinct(), "suspects"))
    x = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("same"))
    x = x.join(suspects, ["same"], "left_semi").select("doc_id", "same", marked(F.col("text")).alias("m"))
    # each kind of window reads the suspects again: their marked texts, not all documents
    x = stored(x, "suspect-texts")
    x = x.select("doc_id", "same", *[raw_words(F.col("m"), k).alias(f"raw{k}") for k in (PLAIN, INITIAL, EXACT)])
    x = x.select("*", *[_hashes(F.col(f"raw{k}") if k == EXACT else template(F.col(f"raw{k}"))).alias(f"h{k}") for k in (PLAIN, INITIAL, EXACT)])
    parts = [x.select("doc_id", "same", F.lit(k).alias("kind"), F.lit(n).alias("size"), F.col(f"raw{k}").alias("raw"),
                      F.posexplode(hashed(f"h{k}", n)).alias("at", "h")) for k, n in kinds]
    x = reduce(DataFrame.unionByName, parts)
    x = x.join(_small(own), ["h", "kind", "size"]).withColumn("raw", F.slice("raw", F.col("at") + 1, F.col("size")))
    pairs = F.filter(F.arrays_zip(F.col("item_raw").alias("i"), F.col("raw").alias("d")),
                     lambda z: F.substring(z["i"], 1, 1).isin(NUMBER, UNIT, NAME))
    x = stored(x.select("doc_id", "same", "item_id", "kind", "n_windows", "at", "item_at", pairs.alias("slots")), "hits")
    group = ["doc_id", "same", "item_id", "kind", "n_windows"]
    enough = F.col("n_hits") * 100 >= F.col("n_windows") * share
    # an item's windows bound the rows of a diagonal, so its slots may be gathered
    one = x.groupBy(*group, (F.col("at") - F.col("item_at")).alias("diagonal")).agg(
        F.count_distinct("item_at").alias("n_hits"), F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"))
    one = one.where(enough & _consistent(F.col("slots"))).select(*group, "n_hits", "slots")
    # one document bounds the hits of a chain
    hits = F.collect_set(F.struct("at", (-F.col("item_at")).alias("back"), F.col("slots").cast(SLOTS).alias("slots")))
    some = x.groupBy(*group).agg(F.count_distinct("item_at").alias("n_hits"), F.sort_array(hits).alias("hits"))
    some = some.where(enough).select(*group, _chain(F.col("hits")).alias("c"))
    some = some.select(*group, F.col("c.n").cast("bigint").alias("n_hits"), F.col("c.slots").alias("slots")).where(enough)
    x = one.withColumn("slots", F.col("slots").cast(SLOTS)).unionByName(some)
    best = F.max(F.struct("n_hits", "n_windows"))
    return x.groupBy("doc_id", "item_id").agg(
        best["n_windows"].alias("n_windows"), best["n_hits"].alias("n_hits"),
        F.max((F.col("kind") == EXACT) & (F.col("n_hits") == F.col("n_windows"))).alias("literal"), F.lit(True).alias("consistent"))


def clean(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """Pipeline stage: the documents that no item contaminates; a null id is kept."""
    bad = _small(stored(matches(docs, items, **how).select("doc_id").distinct(), "contaminated"))
    return docs.join(bad, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
