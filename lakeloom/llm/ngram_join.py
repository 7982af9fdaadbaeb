"""N-gram Jaccard self-join: size-aware, heavy and light sets apart.

Documents are joined on their sets of distinct 5-word shingles; two link when
``100 * |A ∩ B| >= 75 * |A ∪ B|``. The result is exact: no candidate is dropped by a cap or
by chance.

1. *Profile.* One pass counts shingle hashes in a sketch of fixed size (partial sums, merged by
   aggregation); a second makes each set, its 128-bit fingerprint, a few minimum hashes, and its
   prefix: the shingles first in the order (frequency class from the sketch, hash). The order
   only steers cost; any order is right.
2. *Classes.* Equal sets fall together by fingerprint; only one document of a class goes on, so
   thousands of copies cost one row each.
3. *Neighbourhoods.* Documents that share at least half of their minimum hashes with a more
   central document are grouped with it. Inside a group, links are found directly: first to the central
   document, then of what is left against all members, in blocks of bounded size; a
   block gives a spanning forest of its links, never all pairs.
   A document that meets many members of a group in one list is compared with all of them, again in blocks.
4. *Heavy-light join* of everything else across neighbourhoods. Sets of up to ``x`` shingles are light: they
   enumerate the 2-subsets of their prefix, and two light sets meet on an equal subset. Larger
   sets are heavy: they scan the inverted lists of their prefix shingles, which also hold the
   light sets large enough to link with a heavy one. Both prefixes are long enough that a
   link shares a subset (a shingle) in it; what a pair shares there is counted over all lists
   and bounds its overlap. ``x`` is where the estimated cost of enumerating passes that of scanning,
   summed over size classes. Pairs that the bound leaves are verified on whole sets. A list in which each entry
   would have very many partners isn't paired: its documents are a crowd, compared like a neighbourhood.
5. *Components* of the verified links and the classes.

Spark deals all of it out by key: lists by hash range, groups by block, candidates by centre. Texts
are only moved for documents that have candidates, found with a fixed-size bit map; so are profiles of
copied sets and, in :func:`keep_one`, the documents that may go.

Defined results: a null or empty text (or one of white space) has no shingles, links with nothing
and is its own component. Documents with the same id are one vertex. A null doc_id gives
its row with a null component and no links. An empty table gives an empty result. Extra columns aren't read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import stored, temp_names
from lakeloom.llm.components import components
from lakeloom.llm.shingles import mix, overlap, sets, shingle_hashes, slices


@dataclass(frozen=True)
class Params:
    """Words a shingle, similarity in percent, and settings of cost (never of the result).

    The sketch tells frequent shingles best with a cell for every ten shingles or fewer of the
    corpus: raise ``sketch_bits`` by one with each doubling (2^bits bytes are broadcast, 4 * 2^bits held by a task).
    """

    words: int = 5
    percent: int = 75
    sketch_bits: int = 24
    hashes: int = 8
    shared: int = 4
    block: int = 256
    bucket_rows: int = 1 << 20
    bitmap_bits: int = 26
    wide: int = 64
    ask_block: int = 1024
    crowd: int = 64

    def least(self, n: np.ndarray | int):
        """The least overlap that a set of ``n`` can link with."""
        return -(-self.percent * n // 100)

    def needed(self, a: np.ndarray | int, b: np.ndarray | int):
        """The overlap that sets of ``a`` and ``b`` need."""
        return -(-self.percent * (a + b) // (100 + self.percent))


# ---------------------------------------------------------------- counts in slices

SLICE_BITS = 16


def _emit_counts(counts: np.ndarray) -> Iterator[tuple[int, bytes]]:
    for k in range(0, len(counts), 1 << SLICE_BITS):
        part = counts[k:k + (1 << SLICE_BITS)]
        if part.any():
            yield k >> SLICE_BITS, zlib.compress(part.tobytes(), 1)


def _summed(slices: DataFrame, dtype: str, how: np.ufunc) -> dict[int, np.ndarray]:
    """Slices of counts, merged by slice number in tasks; only the merged table (of fixed size) is returned."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                x = np.frombuffer(zlib.decompress(raw), dtype)
                sums[k] = how(sums[k], x) if k in sums else x.copy()
        yield pa.record_batch([pa.array(list(sums), pa.int32()),
                               pa.array([zlib.compress(x.tobytes(), 1) for x in sums.values()], pa.binary())], ["slice", "counts"])

    rows = slices.repartition("slice").mapInArrow(merge, "slice int, counts binary").collect()
    return {r["slice"]: np.frombuffer(zlib.decompress(bytes(r["counts"])), dtype) for r in rows}


def frequency_classes(docs: DataFrame, p: Params) -> bytes:
    """Per sketch cell its frequency class (0: not above what chance gives), compressed; 2^sketch_bits bytes."""
    bits, words = p.sketch_bits, p.words

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(1 << bits, np.uint32)
        for b in batches:
            for lo, hi in slices(b.column(0)):
                flat, _ = shingle_hashes(b.column(0).slice(lo, hi - lo), words)
                np.add.at(sums, (flat >> np.uint64(64 - bits)).astype(np.int64), np.uint32(1))
        for k, raw in _emit_counts(sums):
            yield pa.record_batch([pa.array([k], pa.int32()), pa.array([raw], pa.binary())], ["slice", "counts"])

    found = _summed(docs.select("text").mapInArrow(count, "slice int, counts binary"), "<u4", np.add)
    mean = sum(int(x.sum(dtype=np.int64)) for x in found.values()) / (1 << bits)
    usual = mean + 4 * mean ** 0.5 + 2
    classes = np.zeros(1 << bits, np.uint8)
    for k, x in found.items():
        classes[k << SLICE_BITS:(k << SLICE_BITS) + len(x)] = np.where(x > usual, np.log2(np.maximum(x / usual, 1)).astype(np.uint8) + 1, 0)
    return zlib.compress(classes.tobytes(), 1)


# ---------------------------------------------------------------- profiles and classes

PROFILE = "doc_id bigint, n bigint, fp binary, mins array<bigint>, prefix binary"


def profile(docs: DataFrame, classes: bytes, p: Params) -> DataFrame:
    """Per document its set size, fingerprint, minimum hashes and prefix (first shingles in the order)."""
    spark = docs.sparkSession
    shared, bits = spark.sparkContext.broadcast(classes), p.sketch_bits
    odd = np.random.default_rng(7).integers(0, 1 << 63, p.hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        cls = np.frombuffer(zlib.decompress(shared.value), np.uint8)
        for b in batches:
            ids = b.column(0)
            for lo, hi in slices(b.column(1)):
                flat, at = shingle_hashes(b.column(1).slice(lo, hi - lo), p.words)
                full = np.flatnonzero(np.diff(at))
                least = np.zeros((hi - lo, p.hashes), np.uint64)
                for k, o in enumerate(odd if len(full) else ()):
                    least[full, k] = np.minimum.reduceat(flat * o, at[full])
                mins = pa.ListArray.from_arrays(
                    np.concatenate([[0], np.cumsum(np.where(np.diff(at) > 0, p.hashes, 0))]).astype(np.int32),
                    pa.array(least[full].ravel().view(np.int64)))
                ns, fps, prefixes = [], [], []
                for i, j in zip(at[:-1], at[1:], strict=True):
                    x = np.unique(flat[i:j])
                    n = len(x)
                    ns.append(n)
                    fps.append(xxhash.xxh3_128_digest(x))
                    first = np.argsort(cls[x >> np.uint64(64 - bits)], kind="stable")[:n - p.least(n) + 2]
                    prefixes.append(x[first].tobytes())
                yield pa.record_batch([ids.slice(lo, hi - lo), pa.array(ns, pa.int64()), pa.array(fps, pa.binary()),
                                       mins, pa.array(prefixes, pa.binary())],
                                      ["doc_id", "n", "fp", "mins", "prefix"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, PROFILE)


# ---------------------------------------------------------------- neighbourhoods

def neighbourhoods(reps: DataFrame, p: Params) -> DataFrame:
    """``(doc_id, home)`` for documents whose neighbourhood has another name than themselves.

    A document's centrality is how many documents share its minimum hashes. It joins the most
    central member of its buckets with which it shares ``p.shared`` hashes; three rounds of
    pointer jumping then lead to the neighbourhood's own centre.
    """
    m = reps.select("doc_id", F.posexplode("mins").alias("j", "v"))
    size = m.groupBy("j", "v").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    hits = m.join(size, ["j", "v"])
    score = hits.groupBy("doc_id").agg(F.sum("c").alias("score"))
    hits = stored(hits.select("doc_id", "j", "v").join(score, "doc_id"), "hits")
    rank = F.struct("score", (-F.col("doc_id")).alias("neg"))
    best = hits.groupBy("j", "v").agg(F.max(rank).alias("top"))
    links = hits.join(best, ["j", "v"]).where(F.col("top") > rank)
    links = links.groupBy("doc_id", "top").agg(F.count(F.lit(1)).alias("same")).where(F.col("same") >= p.shared)
    home = links.groupBy("doc_id").agg(F.max(F.struct("same", "top")).alias("m")).select(
        "doc_id", (-F.col("m.top.neg")).alias("home"))
    home = stored(home, "homes")
    for _ in range(3):
        up = home.select(F.col("doc_id").alias("home"), F.col("home").alias("up"))
        home = stored(home.join(up, "home", "left").select("doc_id", F.coalesce("up", "home").alias("home")), "homes")
    return home


# ---------------------------------------------------------------- bit maps, texts of some documents

def _places(numbers: pa.Array, bits: int) -> np.ndarray:
    return mix(numbers.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)) & np.uint64((1 << bits) - 1)


def _marked(bitmap: np.ndarray, numbers: pa.Array) -> pa.Array:
    at = _places(numbers, len(bitmap).bit_length() + 2)
    return pa.array(((bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1)).astype(bool))


def bit_map(numbers: DataFrame, p: Params) -> Broadcast[bytes]:
    """The compressed bit map, of fixed size, over the hashed numbers of a table's one column (none null)."""
    bits = p.bitmap_bits

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << bits >> 3, np.uint8)
        for b in batches:
            at = _places(b.column(0), bits)
            np.bitwise_or.at(seen, at >> np.uint64(3), (np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)))
        for k, raw in _emit_counts(seen):
            yield pa.record_batch([pa.array([k], pa.int32()), pa.array([raw], pa.binary())], ["slice", "counts"])

    slices = _summed(numbers.mapInArrow(mark, "slice int, counts binary"), "u1", np.bitwise_or)
    whole = np.zeros(1 << bits >> 3, np.uint8)
    for k, x in slices.items():
        whole[k << SLICE_BITS:(k << SLICE_BITS) + len(x)] = x
    return numbers.sparkSession.sparkContext.broadcast(zlib.compress(whole.tobytes(), 1))


def in_bit_map(number: Column, shared: Broadcast[bytes]) -> Column:
    """Whether a number's bit is set: true for every number of the map's table and few others; false for null. Only the numbers go to Python."""

    @F.arrow_udf("boolean")
    def marked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bitmap = np.frombuffer(zlib.decompress(shared.value), np.uint8)
        for b in batches:
            yield _marked(bitmap, b)

    return number.isNotNull() & marked(F.coalesce(number, F.lit(0).cast("bigint")))


def texts_of(docs: DataFrame, needed: DataFrame, p: Params) -> DataFrame:
    """``(doc_id, text)`` of the documents with an id in ``needed``.

    A bit map filters the scan before anything is shuffled; the join makes it exact.
    """
    needed = needed.select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    shared = bit_map(needed, p)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(zlib.decompress(shared.value), np.uint8)
        for b in batches:
            b = b.filter(b.column(0).is_valid())
            yield b.filter(_marked(bitmap, b.column(0)))

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(keep, "doc_id bigint, text string")
    return rows.join(needed, "doc_id")


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with equal first ``keys`` columns, from batches sorted by them."""
    key, rows = None, []
    for b in batches:
        for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if r[:keys] != key:
                if rows:
                    yield key, rows
                key, rows = r[:keys], []
            rows.append(r[keys:])
    if rows:
        yield key, rows


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found, strict=True)
    return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def verified(docs: DataFrame, pairs: DataFrame, p: Params) -> DataFrame:
    """The pairs ``(a, b)`` that link, by their whole sets.

    Pairs are grouped by ``a`` and a few salts of ``b``, so a centre with very many pairs is spread; a
    group is read as a stream, its centre's set first.
    """
    pairs = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.lit(64)).alias("salt"))
    texts = texts_of(docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")), p)
    centres = pairs.select("a", "salt").distinct().join(texts.withColumnRenamed("doc_id", "a"), "a").select(
        "a", "salt", F.lit(0).alias("role"), F.col("a").alias("b"), "text")
    members = pairs.join(texts.withColumnRenamed("doc_id", "b"), "b").select("a", "salt", F.lit(1).alias("role"), "b", "text")
    rows = centres.unionByName(members).repartition("a", "salt").sortWithinPartitions("a", "salt", "role", "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own = None, []
        for batch in batches:
            keys, found = zip(*(c.to_pylist() for c in batch.columns[:4]), strict=True), []
            for (a, salt, role, b), x in zip(keys, sets(batch.column(4), p.words), strict=True):
                if (a, salt) != at:
                    at, own = (a, salt), []
                if role == 0:
                    own.append(x)
                elif any(_link(len(y), len(x), overlap(y, x), p) for y in own):
                    found.append((a, b))
            if found:
                yield _edges(found)

    return rows.mapInArrow(check, "a bigint, b bigint")


def _link(a, b, both, p: Params):
    return (both > 0) & (100 * both >= p.percent * (a + b - both))


# ---------------------------------------------------------------- inside a neighbourhood

class _Forest:
    """Union-find over the rows of a block."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def block_links(ids: list[int], rows: list[np.ndarray], asks: list[int], known: list[int], p: Params) -> list[tuple[int, int]]:
    """A spanning forest of the links between the rows ``asks`` and all rows of a block.

    ``known`` rows are already in one component. Each asking row scans the inverted
    lists of its shingles and counts overlaps with all rows at once. A row that has come to the known
    rows' component needn't ask: whoever is outside asks it, here or in the block where the two change
    roles. Without known rows that holds for the first row's component only if every row asks here; else each
    asking row asks in full, for two blocks could each leave a link to the other.
    """
    forest, found = _Forest(len(ids)), []
    for i, j in zip(known[:-1], known[1:], strict=True):
        forest.join(i, j)
    sizes = np.array([len(x) for x in rows])
    flat = np.concatenate(rows) if rows else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(rows)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    main = known[0] if known else 0 if len(asks) == len(ids) else None
    for i in asks:
        if main is not None and i != main and forest.root(i) == forest.root(main):
            continue
        x = rows[i]
        lo, hi = np.searchsorted(flat, x, "left"), np.searchsorted(flat, x, "right")
        lens = hi - lo
        within = np.arange(int(lens.sum())) - np.repeat(np.cumsum(lens) - lens, lens)
        both = np.bincount(owner[np.repeat(lo, lens) + within], minlength=len(ids))
        for j in np.flatnonzero(_link(sizes[i], sizes, both, p)).tolist():
            if j != i and ids[j] != ids[i] and forest.join(i, j):
                found.append((ids[i], ids[j]))
    return found


def home_links(docs: DataFrame, homes: DataFrame, p: Params) -> DataFrame:
    """Links inside neighbourhoods, as a spanning forest a block.

    A neighbourhood of up to ``p.block`` documents is one block. In a larger one, members are
    first compared with the centre; those without that link are dealt into blocks that are
    compared with all blocks, where the linked ones count as one component.
    """
    members = homes.unionByName(homes.select(F.col("home").alias("doc_id"), "home").distinct()).distinct()
    sizes = members.groupBy("home").agg(F.count(F.lit(1)).alias("size"))
    members = stored(members.join(sizes, "home"), "members")
    large = members.where(F.col("size") > p.block)
    star = stored(verified(docs, large.where("doc_id <> home").select(F.col("home").alias("a"), F.col("doc_id").alias("b")), p), "star")

    near = star.select(F.col("a").alias("home"), F.col("b").alias("doc_id"), F.lit(1).alias("near"))
    blocks = F.ceil(F.col("size") / p.block)
    large = large.join(near, ["home", "doc_id"], "left").select(
        "home", "doc_id", (F.coalesce("near", F.lit(0)) + (F.col("doc_id") == F.col("home")).cast("int")).alias("near"),
        blocks.alias("blocks"), F.pmod(F.xxhash64("doc_id"), blocks).alias("mine"))
    left = large.where("near = 0")
    asking = left.groupBy("home").agg(F.count(F.lit(1)).alias("left"))
    asked = F.ceil(F.col("left") / p.block)
    every = large.join(asking, "home").select(
        "home", "doc_id", "near", "mine", F.explode(F.sequence(F.lit(0).cast("bigint"), asked - 1)).alias("ask"), F.lit(0).alias("asks"))
    ask = left.join(asking, "home").select(
        "home", "doc_id", "near", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("mine"),
        F.pmod(F.xxhash64("doc_id", F.lit(1)), asked).alias("ask"), F.lit(1).alias("asks"))
    small = members.where(F.col("size") <= p.block).select(
        "home", "doc_id", F.lit(0).alias("near"), F.lit(0).cast("bigint").alias("mine"), F.lit(0).cast("bigint").alias("ask"),
        F.when(F.col("doc_id") == F.col("home"), 3).otherwise(2).alias("asks"))
    plan = stored(small.unionByName(every).unionByName(ask), "blocks")
    texts = texts_of(docs, plan.select("doc_id"), p)
    rows = plan.join(texts, "doc_id").select("home", "mine", "ask", "asks", "near", "doc_id", "text")
    rows = rows.repartition("home", "mine", "ask").sortWithinPartitions("home", "mine", "ask", F.desc("asks"), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in _groups(batches, 3):
            own = sets(pa.array([r[3] for r in group], pa.string()), p.words)
            ids = [r[2] for r in group]
            # small neighbourhoods (2, 3): every row asks, the centre first; else rows marked 1 ask
            asks = [i for i, r in enumerate(group) if r[0]]
            known = [i for i, r in enumerate(group) if r[1]]
            found = block_links(ids, own, asks, known, p)
            if found:
                yield _edges(found)

    return star.unionByName(rows.mapInArrow(run, "a bigint, b bigint"))


# ---------------------------------------------------------------- across neighbourhoods

def boundary(reps: DataFrame, classes: bytes, p: Params) -> int:
    """The largest light set: where enumerating 2-subsets costs more than scanning lists.

    Per size class (24 a doubling, so a bounded table): subsets of the prefix against its
    shingles and their list lengths, which the sketch's classes estimate.
    """
    shared = reps.sparkSession.sparkContext.broadcast(classes)

    def cost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls = np.frombuffer(zlib.decompress(shared.value), np.uint8)
        for b in batches:
            n = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            raw = b.column(1).to_pylist()
            own = [np.exp2(cls[np.frombuffer(x, np.uint64) >> np.uint64(64 - p.sketch_bits)].astype(float)).sum() for x in raw]
            k = n - p.least(n) + 2
            yield pa.record_batch([pa.array(np.ceil(24 * np.log2(np.maximum(n, 1))).astype(np.int64)), pa.array(n),
                                   pa.array(k * (k - 1) / 2.0), pa.array(np.array(own) + k - 1.0)], ["class", "n", "subsets", "scans"])

    rows = reps.select("n", "prefix").mapInArrow(cost, "class bigint, n bigint, subsets double, scans double")
    table = rows.groupBy("class").agg(F.max("n").alias("n"), F.sum("subsets").alias("e"), F.sum("scans").alias("s")).orderBy("class").collect()
    best, x, total = 0.0, 0, 0.0
    for r in table:
        total += r["e"] - r["s"]
        if total < best:
            best, x = total, r["n"]
    return x


def _postings(prefix: np.ndarray, n: int, light: bool, scan: bool, p: Params) -> Iterator[tuple[int, np.ndarray]]:
    """(kind, keys) that a set posts: its prefix shingles, and for a light set 2-subsets of its prefix."""
    k = n - int(p.least(n))
    if scan:
        yield 0, prefix[:k + 1]
    if light:
        i, j = np.triu_indices(min(k + 2, len(prefix)), 1)
        lo, hi = np.minimum(prefix[i], prefix[j]), np.maximum(prefix[i], prefix[j])
        yield 1, mix(lo * np.uint64(0x9E3779B97F4A7C15) + mix(hi))


def _short(x: np.ndarray) -> bytes:
    """Counts in two bytes each where they fit, else four."""
    return x.astype("<u2" if x.max() < 1 << 16 else "<u4").tobytes()


def _long(raw: bytes, keys: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if 4 * len(raw) == len(keys) else "<u4").astype(np.int64)


def candidates(reps: DataFrame, homes: DataFrame, x: int, buckets: int, p: Params) -> tuple[DataFrame, DataFrame]:
    """Pairs ``(a, b)`` of documents of different neighbourhoods that share enough of their prefixes to link, and pairs ``(a, b, kind)`` of
    a document ``a`` and a neighbourhood ``b`` that it meets in a wide list (``WIDE``) or a crowd ``b`` that it is in (``CROWD``, :func:`list_pairs`).

    Postings travel packed: a row holds those of one bucket from one slice of documents. Each bucket counts
    what its pairs share; the counts of a pair are summed over buckets. What two sets share outside both
    prefixes lies behind the prefix that ends first, so the overlap is at most the shared
    prefix shingles and the longer rest; pairs that stay below the needed overlap go.
    """
    rows = reps.join(homes, "doc_id", "left").select("doc_id", F.coalesce("home", "doc_id").alias("home"), "n", "prefix")
    low = int(p.least(x + 1))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, homes_, sizes = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
            parts = []
            for i, (n, raw) in enumerate(zip(sizes.tolist(), b.column(3).to_pylist(), strict=True)):
                for kind, keys in _postings(np.frombuffer(raw, np.uint64), n, n <= x, n >= low, p):
                    if len(keys):  # a set of one shingle posts nothing
                        parts.append((keys, np.full(len(keys), i, np.int32), np.full(len(keys), kind, np.int8)))
            if not parts:
                continue
            key, own, kind = (np.concatenate(z) for z in zip(*parts, strict=True))
            bucket = (mix(key ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(buckets)).astype(np.int64) * 2 + kind
            order = np.argsort(bucket, kind="stable")
            key, own, bucket = key[order], own[order], bucket[order]
            cut = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
            out = []
            for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                docs, local = np.unique(own[lo:hi], return_inverse=True)
                out.append((int(bucket[lo]), key[lo:hi].tobytes(), _short(local),
                            np.stack([ids[docs], homes_[docs], sizes[docs]]).tobytes()))
            cols = list(zip(*out, strict=True))
            yield pa.record_batch([pa.array(cols[0], pa.int64()), *(pa.array(c, pa.binary()) for c in cols[1:])],
                                  ["bucket", "key", "own", "docs"])

    posts = rows.mapInArrow(post, "bucket bigint, key binary, own binary, docs binary")
    posts = posts.repartition("bucket").sortWithinPartitions("bucket")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent(a, b, na, nb, kind, count):
            columns = [a, b, na, nb, np.full(len(a), kind, np.int32), count]
            return pa.record_batch([pa.array(z) for z in columns], ["a", "b", "na", "nb", "kind", "shared"])

        for (bucket,), group in _groups(batches, 1):
            docs = [np.frombuffer(g[2], np.int64).reshape(3, -1) for g in group]
            base = np.cumsum([0, *(d.shape[1] for d in docs)])
            ids, homes_, sizes = np.concatenate(docs, axis=1)
            key = np.concatenate([np.frombuffer(g[0], np.uint64) for g in group])
            own = np.concatenate([_long(g[1], g[0]) + o for g, o in zip(group, base, strict=False)])
            del group, docs
            light = x if bucket % 2 == 0 else -1
            asks: list = []
            crowds: list = []
            for i, j, count in list_pairs(key, own, ids, homes_, sizes, light, asks, p, crowds):
                i, j = np.where(ids[i] < ids[j], i, j), np.where(ids[i] < ids[j], j, i)
                yield sent(ids[i], ids[j], sizes[i], sizes[j], bucket % 2, count)
            for kind, whole in (WIDE, asks), (CROWD, crowds):
                if whole:
                    a, b = np.concatenate(whole, axis=1)
                    # a bucket may number a document more than once
                    a, b = np.unique(np.stack([ids[a], b]), axis=1)
                    yield sent(a, b, np.zeros_like(a), np.zeros_like(a), kind, np.ones_like(a))

    pairs = posts.mapInArrow(meet, "a bigint, b bigint, na bigint, nb bigint, kind int, shared bigint")
    pairs = pairs.groupBy("a", "b", "na", "nb", "kind").agg(F.sum("shared").alias("shared"))
    # of m shared prefix shingles a light pair shares m(m-1)/2 subsets
    m = F.when(F.col("kind") == 0, F.col("shared")).otherwise(F.floor((1 + F.sqrt(1 + 8 * F.col("shared"))) / 2))
    need = F.ceil(p.percent * (F.col("na") + F.col("nb")) / (100 + p.percent))
    least = lambda n: F.ceil(p.percent * F.col(n) / 100)  # noqa: E731  what lies outside a prefix of n - least(n) + 1 (+ 1)
    rest = F.greatest(least("na"), least("nb")) - 1 - F.col("kind")
    promising = m + F.greatest(rest, F.lit(0)) >= need
    found = stored(pairs.where((F.col("kind") >= WIDE) | promising).select("a", "b", "kind").distinct(), "candidates")
    return found.where(F.col("kind") < WIDE).select("a", "b").distinct(), found.where(F.col("kind") >= WIDE)


#: Pairs of list entries looked at in one step: some 30 MB of arrays.
STEP = 1 << 18
#: Mark a pair of a document and a home that it asks as a whole, and of a document and the crowd that it is in.
WIDE, CROWD = 2, 3


def _crowd(size: np.ndarray, light: int, p: Params) -> np.ndarray | None:
    """The entries of a list, by their sizes, that have a partner of a near size, if each has ``p.crowd`` on average; else none."""
    order = np.argsort(size, kind="stable")
    s, at = size[order], np.arange(len(size))
    larger = np.searchsorted(s, 100 * s // p.percent, "right") - np.maximum(at + 1, np.searchsorted(s, light, "right"))
    if 2 * larger[larger > 0].sum() < p.crowd * len(s):
        return None
    return order[(larger > 0) | (s > light) & (np.searchsorted(100 * s, p.percent * s, "left") < at)]


def list_pairs(key, own, ids, home, size, light: int, asks: list, p: Params, crowds: list | None = None) -> Iterator[tuple[np.ndarray, ...]]:
    """``(i, j, lists shared)`` of entries with equal keys, different homes and near sizes.

    ``own`` numbers an entry's document, whose id, home and size the next three arrays hold. Pairs inside a home aren't
    looked at. A home that fills a list with ``p.wide`` entries or more isn't paired entry by entry: the list's other documents
    ask it as a whole, in blocks; of two such homes the one with fewer entries asks. ``asks`` takes arrays of (document,
    home). Pairs of two sets of up to ``light`` shingles are left to the subsets.

    With ``crowds``, a list whose other entries have ``p.crowd`` partners or more each isn't paired either, for its pairs
    grow with its square: it is a crowd, named by the member with the least hashed id, and ``crowds`` takes
    arrays of (document, name). Lists of much the same documents mostly give the same name, so a crowd is compared once.
    """
    n = len(key)
    if not n:
        return
    order = np.lexsort((home[own], key))
    key, own = key[order], own[order]
    starts = lambda *by: np.concatenate([[0], np.flatnonzero(np.logical_or.reduce([x[1:] != x[:-1] for x in by])) + 1])
    ends = lambda first: np.repeat(np.append(first[1:], n), np.diff(np.append(first, n)))  # noqa: E731  of each entry's group
    runs = starts(key, home[own])
    lens = np.diff(np.append(runs, n))
    # entries of large runs go to the end of their list
    large = np.repeat(lens >= p.wide, lens)
    order = np.lexsort((home[own], large, key))
    key, own, large = key[order], own[order], large[order]
    lists = starts(key)
    small_end = ends(lists) - np.repeat(np.add.reduceat(large, lists, dtype=np.int64), np.diff(np.append(lists, n)))
    runs = starts(key, home[own])
    home_end = ends(runs)
    for lo in lists[large[ends(lists)[lists] - 1]].tolist():
        hi = int(np.searchsorted(key, key[lo], "right"))
        here, mine = home[own[lo:hi]], own[lo:hi]
        hosts, filled = np.unique(here[large[lo:hi]], return_counts=True)
        rank = {h: k for k, h in enumerate(hosts[np.lexsort((hosts, filled))].tolist())}
        place = np.array([rank.get(h, -1) for h in here.tolist()])
        for h, k in rank.items():
            who = mine[place < k]
            asks.append(np.stack([who, np.full(len(who), h, np.int64)]))
    todo = ~large & (small_end > home_end)
    if crowds is not None:
        partners = np.add.reduceat(np.where(todo, small_end - home_end, 0), lists)
        for lo in lists[2 * partners >= p.crowd * np.maximum(small_end[lists] - lists, 1)].tolist():
            hi = int(small_end[lo])
            near = _crowd(size[own[lo:hi]], light, p)
            if near is not None:
                who = own[lo:hi][near]
                name = ids[who[np.argmin(mix(ids[who].view(np.uint64)))]]
                crowds.append(np.stack([who, np.full(len(who), name, np.int64)]))
                todo[lo:hi] = False
    todo = np.flatnonzero(todo)
    lens = (small_end - home_end)[todo]
    totals = np.cumsum(lens)
    lo = 0
    while lo < len(todo):
        # a step holds whole entries; one entry has at most as many partners as its list is long
        hi = max(lo + 1, int(np.searchsorted(totals, (totals[lo - 1] if lo else 0) + STEP, "right")))
        i = np.repeat(todo[lo:hi], lens[lo:hi])
        j = home_end[i] + np.arange(len(i)) - np.repeat(np.cumsum(lens[lo:hi]) - lens[lo:hi], lens[lo:hi])
        lo = hi
        i, j = own[i], own[j]
        ok = (p.needed(size[i], size[j]) <= np.minimum(size[i], size[j])) & (ids[i] != ids[j])
        if light >= 0:
            ok &= (size[i] > light) | (size[j] > light)
        i, j = i[ok], j[ok]
        if len(i):
            # numbers of two documents fit one word
            both, count = np.unique(np.minimum(i, j) << 32 | np.maximum(i, j), return_counts=True)
            yield both >> 32, both & 0xFFFFFFFF, count


def cross_links(docs: DataFrame, homes: DataFrame, asks: DataFrame, p: Params) -> DataFrame:
    """Links between documents ``a`` and the members of the homes ``b`` that they ask, as a spanning forest a pair of blocks."""
    members = homes.unionByName(homes.select(F.col("home").alias("doc_id"), "home").distinct()).distinct()
    blocks = lambda df: df.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / p.ask_block).alias("blocks"))
    asks = asks.select(F.col("b").alias("home"), F.col("a").alias("doc_id"))
    members = members.join(asks.select("home").distinct(), "home", "left_semi")
    sides = blocks(asks).withColumnRenamed("blocks", "na").join(blocks(members).withColumnRenamed("blocks", "nb"), "home")
    own = lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    one = asks.join(sides, "home").select("home", own("na").alias("i"), each("nb").alias("j"), F.lit(1).alias("asks"), "doc_id")
    two = members.join(sides, "home").select("home", each("na").alias("i"), own("nb").alias("j"), F.lit(0).alias("asks"), "doc_id")
    plan = stored(one.unionByName(two), "blocks")
    texts = texts_of(docs, plan.select("doc_id"), p)
    rows = plan.join(texts, "doc_id").select("home", "i", "j", "asks", "doc_id", "text")
    rows = rows.repartition("home", "i", "j").sortWithinPartitions("home", "i", "j", F.desc("asks"), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in _groups(batches, 3):
            sets_ = sets(pa.array([r[2] for r in group], pa.string()), p.words)
            found = block_links([r[1] for r in group], sets_, [k for k, r in enumerate(group) if r[0]], [], p)
            if found:
                yield _edges(found)

    return rows.mapInArrow(run, "a bigint, b bigint")


# ---------------------------------------------------------------- the join

def join(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, class_id (smallest id with the same set)."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    classes = frequency_classes(docs, p)
    prof = stored(profile(docs, classes, p), "profiles")
    full = prof.where("n > 0 AND doc_id IS NOT NULL")
    found = stored(full.groupBy("fp").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("size")), "classes")
    class_of = found.select("fp", "class_id")
    # a set that one row has is its own representative and stays where it is; rows of the others are shuffled
    number = F.xxhash64("fp")
    copied = in_bit_map(number, bit_map(found.where("size > 1").select(number), p))
    marked = full.select("doc_id", "n", "mins", "prefix", "fp", copied.alias("copied"))
    firsts = marked.where("copied").join(class_of.withColumnRenamed("class_id", "doc_id"), ["fp", "doc_id"]).dropDuplicates(["fp"])
    columns = ["doc_id", "n", "mins", "prefix"]
    reps = stored(marked.where("NOT copied").select(*columns).unionByName(firsts.select(*columns)), "reps")

    homes = neighbourhoods(reps, p)
    inside = home_links(docs, homes, p)
    x = boundary(reps, classes, p)
    postings = reps.agg(F.sum(F.length("prefix") / 8)).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(postings) // p.bucket_rows + 1)
    pairs, asks = candidates(reps, homes, x, buckets, p)
    across = verified(docs, pairs, p).unionByName(cross_links(docs, homes, asks.where(F.col("kind") == WIDE), p))
    # a crowd is compared like a neighbourhood, its name as the centre
    crowds = asks.where(F.col("kind") == CROWD).select(F.col("a").alias("doc_id"), F.col("b").alias("home"))
    across = across.unionByName(home_links(docs, crowds, replace(p, block=p.ask_block)))
    # a repeated id with several sets lies in several classes: they are one component
    ids = full.select("doc_id", "fp").join(class_of, "fp").select("doc_id", "class_id")
    several = ids.groupBy("doc_id").agg(F.min("class_id").alias("a"), F.max("class_id").alias("z")).where("a <> z")
    same = ids.join(several, "doc_id").select("a", F.col("class_id").alias("b"))
    linked = components(inside.unionByName(across).unionByName(same), "a", "b")
    out = prof.select("doc_id", "n", "fp").join(class_of, "fp", "left").join(
        linked.withColumnRenamed("node", "class_id"), "class_id", "left")
    own = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("class_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.coalesce(F.when(own.isNotNull(), F.coalesce("component", own)), "doc_id").alias("component_id"),
                      F.coalesce(own, "doc_id").alias("class_id"))


def keep_one(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """Pipeline stage: of each component the document with the smallest id stays, in one row.

    Rows with that id but other texts stay too, one row a text (the first by a hash of its columns). Documents with a null
    id have no links and all stay.
    """
    found = stored(join(docs, p).where("doc_id IS NOT NULL").select("doc_id", "component_id"), "joined")
    repeated = found.groupBy("doc_id").count().where("count > 1").select("doc_id")
    every = [F.col(f"`{c}`") for c in docs.columns]
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    # most documents stay and aren't shuffled; those with a bit in the map of the others' ids are looked up
    doubt = temp_names(docs, "doubt")[0]
    marked = docs.select(*every, in_bit_map(F.col("doc_id").cast("bigint"), bit_map(gone, p)).alias(doubt))
    looked_up = marked.where(F.col(doubt)).join(gone, "doc_id", "left_anti")
    kept = marked.where(~F.col(doubt)).select(*every).unionByName(looked_up.select(*every))
    if not repeated.isEmpty():
        once = kept.join(repeated, "doc_id", "left_semi").groupBy("doc_id", "text").agg(
            F.min_by(F.struct(*every), F.xxhash64(*every)).alias("row"))
        once = once.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
        kept = kept.join(repeated, "doc_id", "left_anti").select(*every).unionByName(once)
    return kept
