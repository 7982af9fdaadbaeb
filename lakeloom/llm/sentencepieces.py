"""SentencePiece encoding and decoding on the tokenizers library.

``read_model`` parses the model's protobuf wire format: pieces with scores and types, the
trainer's model type and byte fallback, the normaliser's flags and character map. ``build``
makes a tokenizers pipeline of it: the character map, collapsed spaces, the dummy prefix and the ``▁``
marker as normalisers; unigram scores as a Unigram model, or for a BPE model the merges that
its scores imply (the split of each piece into two pieces, ranked by the piece's score);
byte fallback; and the decoder that undoes all of it. Whole batches go to the library's
multithreaded ``encode_batch`` and ``decode_batch``.

Where no piece holds a ``▁`` after another character, a merge never crosses the start of a
word, so texts are cut there (checked on the vocabulary, not assumed); the merges then cost
the same for a word in a long text as in a short one.

``verify`` encodes texts with the sentencepiece library too and counts differing ids.

Defined results: null and empty texts have no ids and decode to the empty text. Text is
encoded whole. Repeated rows and ids each keep their row; nothing is shuffled. Extra columns are kept;
new columns replace columns of their name.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.idtable import IdTable, row_slices

MARK = "▁"
#: Piece types and model types of the model file format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Characters of text handed to the library at once.
SLICE_CHARS = 1 << 18


@dataclass
class Model:
    """What a model file says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    suffix_mark: bool = False
    charsmap: bytes = b""
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    escape_whitespaces: bool = True

    def ids(self, kind: int) -> list[int]:
        return [i for i, p in enumerate(self.pieces) if p[2] == kind]


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The (number, value) fields of a protobuf message; nested messages stay bytes."""
    at, end = 0, len(raw)

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = raw[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    while at < end:
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        if size is None:
            if kind != 2:
                raise ValueError(f"unknown wire type {kind}")
            size = varint()
        yield tag >> 3, raw[at:at + size]
        at += size


def read_model(path: str) -> Model:
    """Parse a SentencePiece model file."""
    with open(path, "rb") as f:
        raw = f.read()
    m = Model()
    for number, value in _fields(raw):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    piece = v.decode("utf-8")
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            m.pieces.append((piece, score, kind))
        elif number == 2:
            for n, v in _fields(value):
                if n == 3:
                    m.model_type = v
                elif n == 24:
                    m.suffix_mark = bool(v)
                elif n == 35:
                    m.byte_fallback = bool(v)
        elif number == 3:
            for n, v in _fields(value):
                if n == 2:
                    m.charsmap = v
                elif n == 3:
                    m.add_dummy_prefix = bool(v)
                elif n == 4:
                    m.remove_extra_whitespaces = bool(v)
                elif n == 5:
                    m.escape_whitespaces = bool(v)
    return m


def merges(m: Model) -> list[tuple[str, str]]:
    """The merges of a BPE model: every split of a piece into two pieces, best score first."""
    score = {p: s for p, s, kind in m.pieces if kind in (NORMAL, USER_DEFINED, UNUSED)}
    found = []
    for piece, s in score.items():
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in score and right in score:
                found.append((-s, len(found), left, right))
    return [(a, b) for _, _, a, b in sorted(found)]


def words_are_apart(m: Model) -> bool:
    """Whether no piece holds a mark after another character."""
    return not any(MARK in p.lstrip(MARK) for p, _, kind in m.pieces if kind in (NORMAL, USER_DEFINED))


def build(m: Model):
    """The tokenizers pipeline equal to the model."""
    from tokenizers import AddedToken, Regex, Tokenizer, models, normalizers, pre_tokenizers

    if m.model_type not in (UNIGRAM, BPE) or m.suffix_mark or not m.escape_whitespaces:
        raise ValueError("only unigram and BPE models with a leading, escaped space mark are rebuilt")
    unk = m.ids(UNKNOWN)[0]
    if m.model_type == UNIGRAM:
        model = models.Unigram([(p, s) for p, s, _ in m.pieces], unk, m.byte_fallback)
    else:
        model = models.BPE({p: i for i, (p, _, _) in enumerate(m.pieces)}, merges(m), unk_token=m.pieces[unk][0],
                           fuse_unk=True, byte_fallback=m.byte_fallback)
    t = Tokenizer(model)
    steps = [normalizers.Precompiled(m.charsmap)] if m.charsmap else []
    if m.remove_extra_whitespaces:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    steps += [normalizers.Prepend(" ")] if m.add_dummy_prefix else []
    t.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
    if words_are_apart(m):
        t.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
    fixed = [AddedToken(m.pieces[i][0], normalized=False) for i in m.ids(USER_DEFINED)]
    if fixed:
        t.add_tokens(fixed)
    t.decoder = _decoder(m, strip=m.add_dummy_prefix)
    return t


def _decoder(m: Model, strip: bool):
    from tokenizers import decoders

    steps = [decoders.Replace(MARK, " ")] + ([decoders.ByteFallback()] if m.byte_fallback else []) + [decoders.Fuse()]
    return decoders.Sequence(steps + ([decoders.Strip(" ", 1, 0)] if strip else []))


class Codec:
    """Encodes and decodes batches of texts with the rebuilt tokenizer.

    Where words are apart, each distinct word of a worker goes through the library once, in
    multithreaded batches, and texts are put together from the words' ids; otherwise whole texts go.
    """

    def __init__(self, path: str):
        m = read_model(path)
        self.whole = build(m)
        self.apart = words_are_apart(m) and not m.ids(USER_DEFINED)
        self.prefix, self.same_chars, self.squeeze = m.add_dummy_prefix, not m.charsmap, m.remove_extra_whitespaces
        self.table = IdTable(lambda new: [e.ids for e in self.words.encode_batch(new, add_special_tokens=False)])
        if self.apart:
            self.words = build(m)
            self.words.normalizer = None
            self.cut = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall
        raw = [bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(MARK, " ").encode() for p, _, kind in m.pieces]
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.sizes = np.array([len(x) for x in raw], np.int64)
        self.at = np.cumsum(self.sizes) - self.sizes

    def normal(self, text: str) -> str:
        """The normalised text with marks; without a character map this is a matter of spaces only."""
        if not self.same_chars:
            return self.whole.normalizer.normalize_str(text)
        if self.squeeze:
            text = re.sub(" {2,}", " ", text.strip(" "))
        return f"{MARK if self.prefix else ''}{text.replace(' ', MARK)}"

    def plain(self, text: str) -> str:
        """What decoding should give for a text: its normal form with plain spaces."""
        if not text:
            return ""
        x = self.normal(text).replace(MARK, " ")
        return x.removeprefix(" ") if self.prefix else x

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the texts' offsets in them; an empty text has none."""
        if self.apart:
            return self.table.encode([self.cut(self.normal(x)) if x else [] for x in texts])
        found = [e.ids if x else [] for x, e in zip(texts, self.whole.encode_batch(texts, add_special_tokens=False), strict=True)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for x in found for i in x), np.int32, int(sizes.sum())), np.concatenate([[0], np.cumsum(sizes)])

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts of flat ids: the pieces' bytes put together; a text whose bytes aren't UTF-8 goes to the library."""
        sizes = self.sizes[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        raw = self.bytes[np.repeat(self.at[ids] - ends[:-1], sizes) + np.arange(int(ends[-1]))].tobytes()
        cuts = ends[offsets].tolist()
        out = []
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            try:
                text = raw[a:b].decode("utf-8")
                out.append(text.removeprefix(" ") if self.prefix else text)
            except UnicodeDecodeError:
                out.append(self.whole.decode(ids[offsets[k]:offsets[k + 1]].tolist(), skip_special_tokens=False))
        return out


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of a model file, once a worker."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def _schema(df: DataFrame, *more: str) -> str:
    """The schema of ``df`` as text, with more columns."""
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), *more])


def _without(df: DataFrame, keep: str, *names: str) -> DataFrame:
    """``df`` without columns of these names (case ignored), but for the column to work on."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c == keep or c.lower() not in gone])


def encode(df: DataFrame, model: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the ids of each text as ``array<int>``."""
    df = _without(df, text, ids)
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in row_slices(pc.fill_null(pc.utf8_length(b.column(at)), 0).to_pylist(), SLICE_CHARS):
                flat, offsets = codec(model).encode([x or "" for x in b.column(at).slice(lo, hi - lo).to_pylist()])
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*b.slice(lo, hi - lo).columns, lists], names=[*b.schema.names, ids])

    return df.mapInArrow(run, _schema(df, f"{ids} array<int>"))


def decode(df: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of each list of ids (null: empty)."""
    df = _without(df, ids, text)
    at = df.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in row_slices(pc.fill_null(pc.list_value_length(b.column(at)), 0).to_pylist(), SLICE_CHARS):
                part = b.slice(lo, hi - lo)
                offsets = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(part.column(at)), 0).to_numpy(zero_copy_only=False))])
                flat = part.column(at).flatten().to_numpy(zero_copy_only=False).astype(np.int32)
                texts = codec(model).decode(flat, offsets)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*b.schema.names, text])

    return df.mapInArrow(run, _schema(df, f"{text} string"))


def round_trip(df: DataFrame, model: str, text: str = "text", ids: str | None = None) -> DataFrame:
    """``df`` without its text, with n_tokens, ids_crc32 (little-endian 32-bit ids), n_chars and exact.

    Encodes each text, decodes the ids and compares: ``exact`` is whether the decoded text is
    the normalised text without its dummy prefix (for a model that changes nothing, the text itself).
    With ``ids`` the ids are kept under that name.
    """
    df = _without(df, text, "n_tokens", "ids_crc32", "n_chars", "exact", *([ids] if ids else []))
    at = df.columns.index(text)
    rest = df.drop(text)
    more = ["n_tokens bigint", "ids_crc32 bigint", "n_chars bigint", "exact boolean", *([f"{ids} array<int>"] if ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in row_slices(pc.fill_null(pc.utf8_length(b.column(at)), 0).to_pylist(), SLICE_CHARS):
                c, own = codec(model), [x or "" for x in b.column(at).slice(lo, hi - lo).to_pylist()]
                flat, offsets = c.encode(own)
                back = c.decode(flat, offsets)
                raw = memoryview(np.ascontiguousarray(flat, "<u4")).cast("B")
                sums = [zlib.crc32(raw[4 * x:4 * y]) for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                part = b.slice(lo, hi - lo)
                found = [pa.array(np.diff(offsets)), pa.array(sums, pa.int64()), pa.array([len(x) for x in back], pa.int64()),
                         pa.array([x == c.plain(y) for x, y in zip(back, own, strict=True)])]
                if ids:
                    found.append(pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat)))
                yield pa.RecordBatch.from_arrays([*(x for i, x in enumerate(part.columns) if i != at), *found],
                                                 names=[*(n for i, n in enumerate(b.schema.names) if i != at), *(m.split()[0] for m in more)])

    return df.mapInArrow(run, _schema(rest, *more))


def verify(df: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``df`` without its text, with n_tokens and whether the sentencepiece library gives the same ids."""
    df = _without(df, text, "n_tokens", "parity")
    at = df.columns.index(text)
    rest = df.drop(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        own = sentencepiece.SentencePieceProcessor(model_file=model)
        for b in batches:
            texts = [x or "" for x in b.column(at).to_pylist()]
            flat, offsets = codec(model).encode(texts)
            same = [own.encode(x) == flat[lo:hi].tolist() for x, lo, hi in zip(texts, offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(col for i, col in enumerate(b.columns) if i != at), pa.array(np.diff(offsets)), pa.array(same)],
                names=[*(n for i, n in enumerate(b.schema.names) if i != at), "n_tokens", "parity"])

    return df.mapInArrow(run, _schema(rest, "n_tokens bigint", "parity boolean"))
