"""Edit-aware token counts: a segment tree of pre-tokens per document.

``trees`` splits each text into pre-tokens, counts their tokens and stores, per leaf of up to
``LEAF`` pre-tokens, its characters and its tokens. ``recount`` takes a table of edits and brings
the counts up to date: an edit finds its leaves by descending the sums of characters, only
the leaves that it touches and the one before are split and encoded again, and
sums on the way to the root are updated. Splitting goes on leaf by leaf until a pre-token starts where
an untouched leaf does: the pattern only looks ahead, so from there on nothing changes.

The tokenizer is a byte-level BPE given as ranks; each distinct pre-token is encoded once a worker.

An edit is (doc_id, seq, at, size, text): at character ``at`` of the text as the edits before it
(by seq) have left it, ``size`` characters go and ``text`` comes in. Places beyond the end count as the end.

Defined results: a null text counts as empty with 0 tokens, a null edit text as empty, null ``at`` and
``size`` as 0. Edits with equal seq apply in order of at, size and text. Edits of unknown documents are
ignored. Repeated ids: every text with the id gets the edits, and every row its result. Documents with a
null id have no edits. Long texts are worked on whole; a document's edits are read as a stream.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import stored
from lakeloom.llm.idtable import TABLE_PIECES, looked_up, row_slices

#: Pre-tokens a leaf at most when it is made.
LEAF = 32
#: Characters of text split at once.
SLICE_CHARS = 1 << 21


class Counter:
    """Splits text into pre-tokens and counts their tokens."""

    def __init__(self, ranks: str, pattern: str):
        import regex
        import tiktoken

        with open(ranks, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, special_tokens={},
                                          mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs})
        self.pattern = regex.compile(pattern)
        self.split = self.pattern.findall
        self.known: dict[str, int] = {}

    def _learn(self, new: list[str]) -> None:
        encode = self.encoding.encode_ordinary
        self.known.update((x, len(encode(x))) for x in new)

    def counts(self, pieces: list[str]) -> list[int]:
        if len(self.known) > TABLE_PIECES:
            self.known.clear()
        return looked_up(pieces, self.known, self._learn)


class Tree:
    """Leaves with their text, and binary trees of sums over their characters and tokens."""

    def __init__(self, text: str, chars: list[int], tokens: list[int]):
        ends = [0, *accumulate(chars)]
        self.set([text[a:b] for a, b in zip(ends, ends[1:])], tokens)
        self.reencoded = 0

    def set(self, leaves: list[str], tokens: list[int]) -> None:
        """Node k sums nodes 2k and 2k + 1; the leaves follow from ``width`` on."""
        self.leaves = leaves
        self.width = w = 1 << max(0, len(leaves) - 1).bit_length()
        rest = [0] * (w - len(leaves))
        self.chars = [0] * w + [len(x) for x in leaves] + rest
        self.tokens = [0] * w + list(tokens) + rest
        for sums in (self.chars, self.tokens):
            for k in range(w - 1, 0, -1):
                sums[k] = sums[2 * k] + sums[2 * k + 1]

    def total(self, what: int) -> int:
        """The text's characters (0) or tokens (1)."""
        return (self.tokens if what else self.chars)[1]

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at`` (the last one for the end) and the leaf's first character."""
        if at >= self.chars[1]:
            last = max(0, len(self.leaves) - 1)
            return last, self.chars[1] - (len(self.leaves[last]) if self.leaves else 0)
        node, before, chars = 1, 0, self.chars
        while node < self.width:
            node *= 2
            if at >= before + chars[node]:
                before += chars[node]
                node += 1
        return node - self.width, before

    def put(self, leaf: int, text: str, tokens: int) -> None:
        """Change a leaf and the sums above it."""
        self.leaves[leaf] = text
        node = leaf + self.width
        more, also = len(text) - self.chars[node], tokens - self.tokens[node]
        while node:
            self.chars[node] += more
            self.tokens[node] += also
            node >>= 1

    def edit(self, at: int, size: int, text: str, counter: Counter) -> None:
        """Replace ``size`` characters at ``at`` by ``text`` and encode what that may have changed."""
        n = self.total(0)
        at = min(max(at, 0), n)
        size = min(max(size, 0), n - at)
        if not self.leaves:
            self.set([""], [0])
        # the pre-token before may end elsewhere now, and the one before that has looked one character ahead
        first, start = self.find(max(0, at - 1))
        if first:
            first, start = self.find(start - 1)
        while first and start > at - 2:
            first, start = self.find(start - 1)
        last, begin = self.find(at + size)
        own = "".join(self.leaves[first:last + 1])
        own = own[:at - start] + text + own[at - start + size:]
        while True:
            # with what follows in sight, does a pre-token start where the next leaf does?
            after = next((k for k in range(last + 1, len(self.leaves)) if self.leaves[k]), None)
            pieces, stop = [], 0
            for piece in counter.split(own if after is None else own + self.leaves[after]):
                if stop >= len(own):
                    break
                pieces.append(piece)
                stop += len(piece)
            if stop <= len(own) or after is None:
                break
            last = after
            own += self.leaves[last]
        tokens = sum(counter.counts(pieces))
        self.reencoded += len(own)
        for leaf in range(first + 1, last + 1):
            if self.leaves[leaf]:
                self.put(leaf, "", 0)
        self.put(first, own, tokens)
        if len(pieces) > 8 * LEAF:
            self.split_leaf(first, pieces, counter)

    def split_leaf(self, leaf: int, pieces: list[str], counter: Counter) -> None:
        """Make leaves of usual size again; empty ones go."""
        counts = counter.counts(pieces)
        new = [("".join(pieces[i:i + LEAF]), sum(counts[i:i + LEAF])) for i in range(0, len(pieces), LEAF)]
        old = list(zip(self.leaves, self.tokens[self.width:], strict=False))
        every = [x for x in [*old[:leaf], *new, *old[leaf + 1:]] if x[0]]
        self.set([x for x, _ in every], [n for _, n in every])


_COUNTERS: dict[tuple[str, str], Counter] = {}


def _counter(ranks: str, pattern: str) -> Counter:
    if (ranks, pattern) not in _COUNTERS:
        _COUNTERS[ranks, pattern] = Counter(ranks, pattern)
    return _COUNTERS[ranks, pattern]


def trees(docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, h, chars, tokens``: the leaves of each text's tree; ``h`` tells texts of one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = _counter(ranks, pattern)
        for b in batches:
            texts = b.column(2).to_pylist()
            for lo, hi in row_slices([len(t) for t in texts], SLICE_CHARS):
                split = [c.split(t) for t in texts[lo:hi]]
                flat = list(chain.from_iterable(split))
                sizes = np.fromiter(map(len, flat), np.int64, len(flat))
                counts = np.array(c.counts(flat), np.int64)
                # leaves start at each text's first pre-token and every LEAF-th after it
                n = np.fromiter(map(len, split), np.int64, len(split))
                leaves = -(-n // LEAF)
                within = np.arange(int(leaves.sum())) - np.repeat(np.cumsum(leaves) - leaves, leaves)
                at = np.repeat(np.cumsum(n) - n, leaves) + LEAF * within
                chars, tokens = (np.add.reduceat(x, at) if len(at) else x for x in (sizes, counts))
                off = pa.array(np.concatenate([[0], np.cumsum(leaves)]).astype(np.int32))
                yield pa.record_batch([b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo),
                                       *(pa.ListArray.from_arrays(off, pa.array(x, pa.int32())) for x in (chars, tokens))],
                                      ["doc_id", "h", "chars", "tokens"])

    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("h"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, h bigint, chars array<int>, tokens array<int>")


def recount(docs: DataFrame, built: DataFrame, edits: DataFrame, ranks: str, pattern: str,
            key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_before, n_after, n_chars, n_edits, n_reencoded`` of each document after its edits.

    Texts, trees and edits of a document meet in one sorted partition and are read as a stream.
    """
    blank = F.lit(None)
    leaves = built.select("doc_id", "h", F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("seq"), blank.cast("bigint").alias("at"),
                                     blank.cast("bigint").alias("size"), blank.cast("string").alias("text"), "chars", "tokens")
    none = [blank.cast("array<int>").alias("chars"), blank.cast("array<int>").alias("tokens")]
    texts = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("h"), F.lit(1).alias("kind"),
                        F.lit(0).cast("bigint").alias("seq"), blank.cast("bigint").alias("at"), blank.cast("bigint").alias("size"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"), *none)
    changes = edits.join(built.select("doc_id", "h").distinct(), "doc_id").select(
        "doc_id", "h", F.lit(2).alias("kind"), F.col("seq").cast("bigint").alias("seq"), F.coalesce(F.col("at"), F.lit(0)).cast("bigint").alias("at"),
        F.coalesce(F.col("size"), F.lit(0)).cast("bigint").alias("size"), F.coalesce("text", F.lit("")).alias("text"), *none)
    rows = leaves.unionByName(texts).unionByName(changes)
    rows = rows.repartition("doc_id", "h").sortWithinPartitions("doc_id", "h", "kind", "seq", "at", "size", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = _counter(ranks, pattern)
        own, tree, copies, edits_seen, before, shape = (None, None), None, 0, 0, 0, None
        out: list[tuple] = []

        def close() -> None:
            if copies:
                out.extend([(own[0], before, tree.total(1), tree.total(0), edits_seen, tree.reencoded)] * copies)

        def rows_out() -> pa.RecordBatch:
            kinds = [pa.int64()] * 6
            return pa.record_batch([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                   ["doc_id", "n_before", "n_after", "n_chars", "n_edits", "n_reencoded"])

        for b in batches:
            for doc, h, kind, _, at, size, text, chars, tokens in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if kind == 0:
                    if (doc, h) == own and not copies:  # a repeated row's tree is the same
                        continue
                    close()
                    own, tree, copies, edits_seen, shape = (doc, h), None, 0, 0, (chars, tokens)
                elif kind == 1:
                    copies += 1
                    if tree is None:
                        tree = Tree(text, *shape)
                        before = tree.total(1)
                else:
                    tree.edit(at, size, text, c)
                    edits_seen += 1
            if out:
                yield rows_out()
                out.clear()
        close()
        if out:
            yield rows_out()

    return rows.mapInArrow(run, "doc_id bigint, n_before bigint, n_after bigint, n_chars bigint, n_edits bigint, n_reencoded bigint")


def update(docs: DataFrame, edits: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Build and store the trees of ``docs``, then apply ``edits`` to them."""
    return recount(docs, stored(trees(docs, ranks, pattern, key, text), "token-trees"), edits, ranks, pattern, key, text)
