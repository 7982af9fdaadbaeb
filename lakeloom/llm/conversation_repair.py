"""Conversation structure repair by Wagner-Fischer alignment to the alternating grammar.

A well-formed conversation's role initials are ``(s?(ua)+)?``. Its rows are aligned to the grammar strings
of every feasible length (edits: Keep, Rerole, Delete, Insert) and the cheapest edits win, of several
the ASCII-least. Three steps, so that no task ever holds the texts of a conversation:

1. *Order.* Light rows (role initial, flags, digest of role and text; no text) go to one task a conversation by one shuffle.
   Repeats are marked by a window over (conversation, digest) and the rows sorted in their order; both sort in that task and spill.
2. *Audit.* A streaming iterator keeps one character a row and aligns a conversation once its last row has
   passed (:func:`align`).
3. *Repair.* Texts are shuffled and sorted once, each conversation's audit before its first row; a streaming
   iterator applies the edits row by row and hashes what it passes.

``align`` works on suffixes: cell (i, j) is the least cost to turn rows i.. into the last j letters of the
alternating string. All lengths share one matrix, as shorter strings are suffixes of longer ones, and a leading
``s`` is one more first row that is kept. Two bands in the manner of Ukkonen keep it narrow: a column is looked at only
if the letters it has more or less than there are rows can be paid from the incumbent, the cost of a one-pass greedy repair; and
in each row a column stays only while it is no dearer than the row's incumbent, the cheapest column that expects the same letter
(what may precede the one may precede the other). Every length that reaches the least cost is traced back, and the audits are compared.

Defined results: nulls in role, turn and text are one space; a null conversation id is a conversation. Rows are in
order of turn, nulls first; rows of one turn by role, of no turn then by text, at last by digest of role and text. Roles other than
those that begin with s, u or a (an empty one too) can't be kept. Rows that are equal in all columns are each a row, so later ones are
duplicates. Extra columns aren't read. An empty table gives an empty result. A conversation's audit and its
hash are sequential, so one task reads a conversation's rows, in a stream; its state is the audit and one matrix row of a few
columns for each row.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeloom.llm.common import stored

KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 3, 4, 3, 3
FULL = {"s": "system", "u": "user", "a": "assistant"}
#: A row as one character: its initial (``x``: none of the grammar's); upper case if truncated; ``-`` if it must go.
MUST_GO = "-"
FAR = 1 << 60

COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
AUDIT_SCHEMA = f"conv_id bigint, {', '.join(f'{c} bigint' for c in COUNTS)}, audit string"
REPORT_SCHEMA = f"{AUDIT_SCHEMA}, repaired_sha256 string"
TURN_SCHEMA = "conv_id bigint, position bigint, role string, text string"
AUDIT_ARROW = pa.schema([(c, pa.int64()) for c in ("conv_id", *COUNTS)] + [("audit", pa.string())])
REPORT_ARROW = AUDIT_ARROW.append(pa.field("repaired_sha256", pa.string()))
TURN_ARROW = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())])


# --- alignment -----------------------------------------------------------------------------------------------------

def greedy(codes: str) -> int:
    """Cost of a repair found in one pass: a letter is put before a row that doesn't fit; other rows go."""
    cost, expects, pairs, opened = 0, "u", 0, False
    for i, c in enumerate(codes):
        plain = c.lower()
        if plain in "ua":
            cost += CUT_SHORT * c.isupper() + (0 if plain == expects else INSERT)
            expects = "a" if plain == "u" else "u"
            pairs += 1
        elif plain == "s" and i == 0:
            cost += CUT_SHORT * c.isupper()
            opened = True
        else:
            cost += DELETE
    # an open pair is closed; a lone s gets its pair
    return cost + (INSERT if expects == "a" else 0) + (2 * INSERT if opened and not pairs else 0)


def matrix(codes: str, most: int) -> tuple[list[int], list[array]]:
    """Cells of every suffix, row by row: the first column of each row's band, and its costs.

    Column j stands for the last j letters of the alternating string; even columns expect ``u``. ``most`` is the incumbent.
    """
    n = len(codes)
    cuts = sum(c.isupper() for c in codes)
    spare = most - DELETE * codes.count(MUST_GO) - CUT_SHORT * cuts
    # what is certain to be paid leaves this much for letters without a row, and for rows without a letter
    # (a truncated row that is deleted saves what it would cost else)
    cheap = DELETE - CUT_SHORT
    more = spare // INSERT
    fewer = min(cuts, spare // cheap) + max(0, spare - cheap * cuts) // DELETE
    first, cells = [0] * (n + 1), [array("q")] * (n + 1)
    rest, below, low = 0, array("q"), 0
    for i in range(n, -1, -1):
        c = codes[i] if i < n else ""
        rest += i < n and c != MUST_GO  # rows from here on that may stay
        cut, plain, end = CUT_SHORT * c.isupper(), c.lower(), low + len(below)
        # two columns past the band below are enough: a third would expect the letter of the first, and be dearer
        lo, hi = max(0, rest - fewer, low), min(rest + more, end + 1)
        row = array("q")
        for j in range(lo, hi + 1):
            best = 0 if i == n and j == 0 else below[j - low] + DELETE if j < end else FAR
            if c not in ("", MUST_GO) and low < j <= end:
                best = min(best, below[j - 1 - low] + (KEEP if plain == ("a" if j & 1 else "u") else REROLE) + cut)
            if row:
                best = min(best, row[-1] + INSERT)
            row.append(min(best, FAR))
        # the row's incumbents; column 0, after which nothing may follow, doesn't bind the others
        least = [min((row[j - lo] for j in range(max(lo, 1), hi + 1) if j & 1 == odd), default=FAR) for odd in (0, 1)]
        alive = [j for j in range(lo, hi + 1) if j == 0 or row[j - lo] <= least[j & 1]]
        for j in range(max(lo, 1), hi + 1):
            if row[j - lo] > least[j & 1]:
                row[j - lo] = FAR
        below, low = row[alive[0] - lo:alive[-1] - lo + 1], alive[0]
        first[i], cells[i] = low, below
    return first, cells


def trace(codes: str, first: list[int], cells: list[array], i: int, j: int) -> str:
    """The ASCII-least cheapest edits of rows i.. to the last j letters (D before I before K before R)."""
    at = lambda i, j: cells[i][j - first[i]] if 0 <= j - first[i] < len(cells[i]) else FAR
    n, out = len(codes), []
    while i < n or j:
        here = at(i, j)
        c = codes[i] if i < n else ""
        cut = CUT_SHORT * c.isupper()
        if i < n and here == at(i + 1, j) + DELETE:
            out.append("D")
            i += 1
        elif j and here == at(i, j - 1) + INSERT:
            out.append("I")
            j -= 1
        elif c.lower() == ("a" if j & 1 else "u"):
            out.append("K")
            i, j = i + 1, j - 1
        else:
            out.append("R")
            i, j = i + 1, j - 1
            if here != at(i, j) + REROLE + cut:
                raise AssertionError("trace left the band")
    return "".join(out)


def align(codes: str) -> tuple[int, str]:
    """Cost and audit of the cheapest edits of a conversation given as one character a row."""
    first, cells = matrix(codes, greedy(codes))
    best, starts = FAR, []

    def offer(cost: int, prefix: str, i: int, j: int) -> None:
        nonlocal best, starts
        if cost < best:
            best, starts = cost, []
        if cost == best < FAR:
            starts.append((prefix, i, j))

    for k, cost in enumerate(cells[0]):  # no s: all lengths of (ua)*
        if not (first[0] + k) & 1:
            offer(cost, "", 0, first[0] + k)
    for p, c in enumerate(codes):  # a kept s, all rows before it deleted, then (ua)+
        if DELETE * p > best:
            break
        if c in "sS":
            for k, cost in enumerate(cells[p + 1]):
                j = first[p + 1] + k
                if j and not j & 1:
                    offer(DELETE * p + CUT_SHORT * (c == "S") + cost, "D" * p + "K", p + 1, j)
    return best, min(prefix + trace(codes, first, cells, i, j) for prefix, i, j in starts)


align_short = lru_cache(maxsize=1 << 16)(align)
#: Conversations up to this many rows are remembered by their codes.
SHORT = 16


# --- rows ------------------------------------------------------------------------------------------------------------

def damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turn, role, text, copy``: rows with the faults that a checksum of id and turn decides.

    Dropped rows stay with ``copy`` -1, so that their conversation isn't lost.
    """
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    x = df.select(F.col(conv).cast("bigint").alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
                  one(role).alias("role"), one(text).alias("text"),
                  (F.crc32(F.concat(one(conv), F.lit(":"), one(turn)).cast("binary")) % 20).alias("fault"))
    new_text = F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    x = x.select("conv_id", "turn", F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), new_text.alias("text"),
                 "fault")
    copies = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).when(F.col("fault") == 0, F.array(F.lit(-1))).otherwise(F.array(F.lit(0)))
    return x.select("conv_id", "turn", "role", "text", F.explode(copies).alias("copy"))


def _order() -> list[Column]:
    """The order of a conversation's rows; ``tie`` is the text of rows without a turn."""
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("tie").asc_nulls_first(), F.col("d1"), F.col("d2"), F.col("copy")]


def _digests() -> list[Column]:
    return [F.when(F.col("turn").isNull(), F.col("text")).alias("tie"), F.xxhash64("role", "text").alias("d1"),
            F.xxhash64(F.lit(1), "text", "role").alias("d2")]


def coded(rows: DataFrame) -> DataFrame:
    """Light rows in order: ``conv_id, turn, initial, fault`` (0 none, 1 blank, 2 duplicate, 3 truncated; -1 a dropped row)."""
    last = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    x = rows.select("conv_id", "turn", "copy", "role", *_digests(), last.alias("last"))
    x = x.repartition("conv_id")
    # the rows are in their task already, so the window needs no shuffle
    seen = F.row_number().over(Window.partitionBy("conv_id", F.col("copy") < 0, "d1", "d2").orderBy(F.col("turn").asc_nulls_first(), "copy")) > 1
    fault = F.when(F.col("copy") < 0, -1).when(F.col("last") == "", 1).when(seen, 2).when(~F.col("last").isin(".", "!", "?"), 3).otherwise(0)
    x = x.select("conv_id", "turn", "copy", "role", "tie", "d1", "d2", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))
    return x.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *_order()).select("conv_id", "turn", "initial", "fault")


class _Conversation:
    """What is kept of a conversation while its rows pass."""

    def __init__(self, key: int | None):
        self.key, self.codes, self.counts, self.illegal = key, [], [0, 0, 0, 0], 0
        self.initial, self.turns, self.low, self.turn = None, 0, None, None

    def add(self, turn: int | None, initial: str, fault: int) -> None:
        if fault < 0:
            return
        self.counts[fault] += 1
        self.illegal += self.initial is not None and self.initial + initial not in ("su", "ua", "au")
        self.initial = initial
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.turn
            self.turn = turn
        code = initial if initial in ("s", "u", "a") else "x"
        self.codes.append(MUST_GO if fault in (1, 2) else code.upper() if fault == 3 else code)

    def row(self) -> tuple:
        codes = "".join(self.codes)
        cost, audit = align_short(codes) if len(codes) <= SHORT else align(codes)
        gaps = self.turn - self.low + 1 - self.turns if self.turns else 0
        return self.key, gaps, *self.counts[1:], self.illegal, cost, audit


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _sent(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    out = []
    for row in rows:
        out.append(row)
        if len(out) == 2048:
            yield _table(out, schema)
            out = []
    if out:
        yield _table(out, schema)


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Light rows sorted by conversation and order → one row a conversation."""
    def each() -> Iterator[tuple]:
        now = None
        for key, turn, initial, fault in _rows(batches):
            if now is None or now.key != key:
                if now is not None:
                    yield now.row()
                now = _Conversation(key)
            now.add(turn, initial, fault)
        if now is not None:
            yield now.row()

    return _sent(each(), AUDIT_ARROW)


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The repaired rows as ``(facts, role, text)``, and ``(facts, None, None)`` after each conversation.

    Rows come sorted, a conversation's audit (``copy`` -2) before its rows; ``facts`` is that row.
    """
    facts, audit, at, expects = None, "", 0, "u"
    for copy, role, text, *more in _rows(batches):
        if copy == -2:
            if facts is not None:
                yield facts, None, None
            facts, audit, at, expects = more, more[-1], 0, "u"
        else:
            edit, at = audit[at], at + 1
            if edit != "D":
                role = FULL[expects] if edit == "R" else role
                yield facts, role, text
                expects = "a" if role[0] == "u" else "u"
        while at < len(audit) and audit[at] == "I":
            yield facts, FULL[expects], ""
            at, expects = at + 1, "a" if expects == "u" else "u"
    if facts is not None:
        yield facts, None, None


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def each() -> Iterator[tuple]:
        seen, between = hashlib.sha256(), ""
        for facts, role, text in _turns(batches):
            if role is None:
                yield *facts, seen.hexdigest()
                seen, between = hashlib.sha256(), ""
            else:
                seen.update(f"{between}{role}:{text}".encode())
                between = "\n"

    return _sent(each(), REPORT_ARROW)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def each() -> Iterator[tuple]:
        position = 0
        for facts, role, text in _turns(batches):
            if role is not None:
                yield facts[0], position, role, text
            position = 0 if role is None else position + 1

    return _sent(each(), TURN_ARROW)


def _laid_out(rows: DataFrame) -> DataFrame:
    """Texts in order, each conversation's audit first: ``copy, role, text`` and the audit's columns."""
    audits = stored(coded(rows).mapInArrow(_audits, AUDIT_SCHEMA), "audits")
    facts = audits.columns[1:]
    texts = rows.where("copy >= 0").select("conv_id", "turn", "role", *_digests(), "copy", "text")
    x = texts.unionByName(audits.withColumn("copy", F.lit(-2)), allowMissingColumns=True)
    x = x.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("copy") != -2, *_order())
    return x.select("copy", "role", "text", "conv_id", *facts)


def repair(df: DataFrame, **columns: str) -> DataFrame:
    """The repaired turns of damaged conversations: ``conv_id, position, role, text`` (see :func:`damaged` for ``columns``)."""
    return _laid_out(damaged(df, **columns)).mapInArrow(_repaired, TURN_SCHEMA)


def report(df: DataFrame, **columns: str) -> DataFrame:
    """One row per conversation: its faults after damage, the cheapest audit with its cost, and a hash of the repaired text."""
    return _laid_out(damaged(df, **columns)).mapInArrow(_reports, REPORT_SCHEMA)
