"""Token-ID output as ORC: integer run-length encoded id lists, row indexes, Bloom filters on doc_id.

``write_tokens`` range-partitions the texts by document id, sorts each range, encodes it and
writes one ORC file a range. The shuffle carries texts, not ids; the ids go straight
from the encoder into ORC's integer run-length encoding (version 2, bit-packed). Files hold
disjoint ascending id ranges, so a look-up by document prunes by file, stripe and row-group
statistics and by the Bloom filter, and stripes are read in parallel.

The encoder cuts each distinct white-space separated word into the tokenizer's pieces, runs the tokenizers library on each
distinct piece once and keeps the ids in a table of the worker; words that can't be cut safely go to the library whole. This is exact for a tokenizer whose steps never look across
white space; ``WordEncoder`` refuses any other.

Defined results: a null text counts as empty and gives the end id alone; repeated ids are kept
and ordered by text; a null doc_id comes first. Very long texts are encoded whole.
Extra columns are dropped. An empty table writes no rows and reads back empty.
"""

from __future__ import annotations

import gc
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import stored
from lakeloom.llm.idtable import IdTable, row_slices
from lakeloom.session import shared_dir

#: Characters of text encoded at once.
SLICE_CHARS = 1 << 20
TOKENS_SCHEMA = "doc_id bigint, ids array<int>, part int, seq bigint"


class WordEncoder:
    """Ids of texts from a table of word → ids, filled by the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.check(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.table = IdTable(self._learn)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = (spec["pre_tokenizer"] or {}).get("pretokenizers", [spec["pre_tokenizer"]])
        self.pieces = next(p["pattern"]["Regex"] for p in pre if p["type"] == "Split")
        suffix = spec["model"].get("end_of_word_suffix")
        self.ends = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.ends[i] = bool(suffix) and token.endswith(suffix)
        self.marked = bool(self.ends.any())
        self.lower = any(n and n["type"] == "Lowercase" for n in (spec["normalizer"] or {}).get("normalizers", [spec["normalizer"]]))

    #: Words that may be cut into pieces and encoded side by side: letters whose classes never change, in lower case either
    #: (and no signs of added tokens: see ``_plain``).
    PLAIN = "^[!-~\u00c0-\u012f\u0131-\u024f]+$"
    _fits = re.compile(PLAIN).fullmatch

    def _learn(self, keys: list[str]) -> list[list[int]]:
        """The ids of each key. Plain ones, which are pieces, go to the library a thousand to a text; each ends in a token with
        the end-of-word mark, so their ids are told apart. The others, and pieces that can't be told apart, go alone."""
        out: list = [None] * len(keys)
        plain = [i for i, w in enumerate(keys) if self._fits(w) and "<|" not in w] if self.marked else []
        for k in range(0, len(plain), 1000):
            part = plain[k:k + 1000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join([keys[i] for i in part])], add_special_tokens=False)[0].ids, np.int64)
            stops = np.concatenate([[0], np.flatnonzero(self.ends[ids]) + 1])
            if stops[-1] == len(ids) and len(stops) == len(part) + 1:
                cuts, listed = stops.tolist(), ids.tolist()
                for i, x, y in zip(part, cuts[:-1], cuts[1:], strict=True):
                    out[i] = listed[x:y]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, e in zip(rest, self.tokenizer.encode_batch([keys[i] for i in rest], add_special_tokens=False), strict=True):
            out[i] = e.ids
        return out

    def _cut(self, words: pa.Array) -> pa.Array:
        """The pieces of each word, as the tokenizer cuts it; a word that isn't plain, or of letters alone, is one."""
        if not self.marked:
            return pa.ListArray.from_arrays(pa.array(np.arange(len(words) + 1, dtype=np.int32)), words)
        mixed = pc.invert(pc.utf8_is_alpha(words))
        some = words.filter(mixed)
        plain = pc.and_not(pc.match_substring_regex(some, self.PLAIN), pc.match_substring(some, "<|"))
        cut = pc.replace_substring_regex(pc.ascii_lower(some) if self.lower else some, self.pieces, "\\0 ")
        cut = pc.ascii_rtrim_whitespace(cut)
        words = pc.replace_with_mask(words, mixed, pc.if_else(plain, cut, some))
        return pc.split_pattern(words, " ")

    @staticmethod
    def check(path: str) -> None:
        """Refuse a tokenizer that may treat a word differently beside other words."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        norms = (spec["normalizer"] or {}).get("normalizers", [spec["normalizer"]])
        pre = (spec["pre_tokenizer"] or {}).get("pretokenizers", [spec["pre_tokenizer"]])
        spaces_out = any(p and p["type"] == "Split" and p["invert"] and p["behavior"] == "Removed"
                         and not set(p["pattern"]["Regex"].replace("[^\\s", "")) & set(" .") and "\\s" not in
                         p["pattern"]["Regex"].replace("[^\\s", "") for p in pre)
        local = all(n is None or n["type"] in ("NFC", "Lowercase") or
                    (n["type"] == "Replace" and n["pattern"] == {"Regex": "\\s+"} and n["content"] == " ") for n in norms)
        added = all(not any(c.isspace() for c in a["content"]) for a in spec["added_tokens"])
        if not (spaces_out and local and added):
            raise ValueError("this tokenizer may look across white space; encode whole texts instead")

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, each followed by ``end_id``, and the texts' offsets in them."""
        # where the tokenizer lowers case itself, words that differ in A-Z only share an entry
        if self.lower:
            texts = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        # a text's white space at its ends gives empty words, which have no ids
        split = pc.ascii_split_whitespace(texts)
        words = pc.dictionary_encode(split.flatten())
        at, cut = words.indices.to_numpy(), self._cut(words.dictionary)
        pieces = pc.dictionary_encode(cut.flatten())
        keys, codes = pieces.dictionary.to_numpy(zero_copy_only=False).tolist(), pieces.indices.to_numpy()
        # from each text's words to its pieces
        starts, n = cut.offsets.to_numpy()[:-1], pc.list_value_length(cut).to_numpy()
        many = n[at]
        ends = np.cumsum(many)
        codes = codes[np.repeat(starts[at] - (ends - many), many) + np.arange(many.sum())]
        stops = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])]
        # lists of numbers hold no cycles; the collector would walk the whole table again and again
        collecting = gc.isenabled()
        gc.disable()
        try:
            return self.table.gather(keys, codes, np.diff(stops), end_id)
        finally:
            if collecting:
                gc.enable()


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    """The encoder of a tokenizer file, once a worker: its table serves all the worker's tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, files: int | None = None,
                 stripe_mb: int = 16, row_index: int = 1000, bloom_fpp: float = 0.01) -> None:
    """Encode ``docs`` (doc_id, text) and write ``doc_id, ids, part, seq`` as ORC in ascending doc_id order.

    ``files`` ranges are written (default: the session's shuffle partitions); ``part`` numbers
    them in id order, ``seq`` the rows of a file.
    """
    spark = docs.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    # empty texts have no end, so ties of a repeated id are ordered by the text itself
    rows = rows.repartitionByRange(files, F.col("doc_id")).sortWithinPartitions("doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder, done = _encoder(tokenizer), 0
        for b in batches:
            n = b.num_rows
            for lo, hi in row_slices(pc.utf8_length(b.column(1)).to_pylist(), SLICE_CHARS):
                ids, offsets = encoder.encode(b.column(1).slice(lo, hi - lo), end_id)
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                yield pa.record_batch([b.column(0).slice(lo, hi - lo), lists, pa.array(np.full(hi - lo, part, np.int32)),
                                       pa.array(np.arange(done + lo, done + hi))], ["doc_id", "ids", "part", "seq"])
            done += n

    out = rows.mapInArrow(encode, TOKENS_SCHEMA)
    (out.write.option("orc.compress", "ZSTD").option("orc.stripe.size", str(stripe_mb << 20))
        .option("orc.row.index.stride", str(row_index)).option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", str(bloom_fpp)).orc(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, ids, part, seq``; filters on doc_id prune files, stripes and row groups."""
    return spark.read.schema(TOKENS_SCHEMA).orc(path)


def checksums(tokens: DataFrame) -> DataFrame:
    """doc_id, part, seq, n_tokens and the unsigned crc32 of the ids as little-endian 32-bit integers."""

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            off = lists.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), dtype="<u4")).cast("B")
            sums = [zlib.crc32(raw[4 * x:4 * y]) for x, y in zip(off[:-1], off[1:], strict=True)]
            yield pa.record_batch([b.column(0), b.column(2), b.column(3), pa.array(np.diff(off).astype(np.int64)),
                                   pa.array(sums, pa.int64())], ["doc_id", "part", "seq", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "ids", "part", "seq").mapInArrow(
        crc, "doc_id bigint, part int, seq bigint, n_tokens bigint, ids_crc32 bigint")


def offsets(sums: DataFrame) -> DataFrame:
    """``sums`` with ``start``: the ids of all documents before it in file order.

    Totals a file give each file's start (one row a file); inside a file a running sum does the rest.
    """
    totals = sums.groupBy("part").agg(F.sum("n_tokens").alias("_total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_base") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    return sums.join(bases, "part").withColumn("start", start.cast("bigint")).drop("_base")


def token_table(docs: DataFrame, tokenizer: str, end_id: int = 1, path: str | None = None) -> DataFrame:
    """Write the ORC files, read them back and return doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    path = path or shared_dir(spark, "tokens")
    write_tokens(docs, path, tokenizer, end_id)
    # offsets read the checksums twice; the files are read and summed up once
    return offsets(stored(checksums(read_tokens(spark, path)), "checksums")).select("doc_id", "start", "n_tokens", "ids_crc32")
