"""Encoders, token files, edit-aware counts, toxicity and page extraction against the libraries and by hand."""

import random
import struct
import zlib

import public_tokenizers as vocabularies
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import html_extract, sentencepieces, token_counts, token_output, toxicity

PIECES = vocabularies.path("piece_bpe_32k.model")
WORDS = vocabularies.path("word_bpe_49k.json")
RANKS = vocabularies.path("byte_bpe_50k.tiktoken")

ODD = ["", "  ", " a", "a ", " a  b ", "\n\nx\t y", "日本語 テスト", "😀 emoji 😀😀", "▁odd▁mark", "a▁ b", "<s> </s> <unk>", "naïve  café",
       "x" * 5000, "\xa0nb", "<0x0A>", "<|endoftext|> x<|startoftext|>", "Straße\x85y z", "é ́", "don't we'll I'D", "w " * 3000, "ΑΣ ΣΑΣ"]


def table(spark, texts, **more):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumns(more)


def test_sentencepiece_parity_and_round_trip(spark):
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    df = table(spark, [*ODD, None], ids=F.lit("clash"), N_tokens=F.lit(1), parity=F.lit(0))
    ids = sentencepieces.encode(df, PIECES)
    for r in ids.collect():
        assert r["ids"] == own.encode(r["text"] or "")
    assert all(r["parity"] for r in sentencepieces.verify(df, PIECES).collect())
    for r in sentencepieces.decode(ids, PIECES).collect():
        if "▁" not in (r["text"] or ""):  # a mark in the text reads as a space afterwards
            assert r["decoded"] == (r["text"] or "")
    got = sentencepieces.round_trip(df, PIECES, ids="ids").collect()
    for r in got:
        assert r["exact"] and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(r['ids'])}I", *r["ids"]))
    assert sentencepieces.encode(df.limit(0), PIECES).count() == 0
    assert [r["decoded"] for r in sentencepieces.decode(spark.createDataFrame([(None,), ([],)], "ids array<int>"), PIECES).collect()] == ["", ""]


def _protobuf(pieces, model_type, charsmap=b"", squeeze=True):
    """A model file written by hand."""

    def field(number, kind, payload):
        def varint(n):
            out = b""
            while True:
                out += bytes([n & 127 | (128 if n > 127 else 0)])
                n >>= 7
                if not n:
                    return out

        return varint(number << 3 | kind) + (varint(payload) if kind == 0 else payload if kind == 5 else varint(len(payload)) + payload)

    raw = b""
    for text, score, kind in pieces:
        raw += field(1, 2, field(1, 2, text.encode()) + field(2, 5, struct.pack("<f", score)) + field(3, 0, kind))
    raw += field(2, 2, field(3, 0, model_type) + field(40, 0, 0) + field(41, 0, 1) + field(42, 0, 2))
    return raw + field(3, 2, field(1, 2, b"identity") + (field(2, 2, charsmap) if charsmap else b"") + field(3, 0, 1) + field(4, 0, int(squeeze)) + field(5, 0, 1))


def test_unigram_model_parity(spark, tmp_path):
    """A hand-made unigram model: scores decide between splits, and pieces with an inner mark forbid cutting at words."""
    import sentencepiece

    base = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    letters = [(c, -6.0, 1) for c in "abcdef▁"]
    for name, extra in (("apart", []), ("across", [("a▁b", -2.5, 1)])):
        path = str(tmp_path / f"{name}.model")
        with open(path, "wb") as f:
            f.write(_protobuf(base + letters + [("ab", -3.0, 1), ("▁ab", -3.2, 1), ("bc", -3.1, 1), ("abc", -5.9, 1), ("▁c", -4.0, 1)] + extra, 1))
        own = sentencepiece.SentencePieceProcessor(model_file=path)
        texts = ["abc", "ab c", " abc  abcab ", "a b a b", "cab cab", "fed  abz zz", "", None, "a"]
        assert sentencepieces.words_are_apart(sentencepieces.read_model(path)) == (name == "apart")
        for r in sentencepieces.encode(table(spark, texts), path).collect():
            assert r["ids"] == own.encode(r["text"] or ""), r["text"]


def test_token_files(spark, tmp_path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORDS)
    data = [(i * 5 % 37, x) for i, x in enumerate(ODD)] + [(3, None), (3, None), (3, "same id"), (None, "no id"), (2**40, "last one")]
    df = spark.createDataFrame([(i, x, 0) for i, x in data], "doc_id long, text string, part int").repartition(4)
    path = str(tmp_path / "ids")
    got = token_output.token_table(df, WORDS, path=path).collect()
    want = {}
    for i, x in data:
        ids = t.encode(x or "", add_special_tokens=False).ids + [1]
        want.setdefault(i, []).append((len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
    found = {}
    for r in got:
        found.setdefault(r["doc_id"], []).append((r["n_tokens"], r["ids_crc32"]))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}
    # starts follow the order of ids without a gap
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    order = [-1 if r["doc_id"] is None else r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order == sorted(order)
    # the files read by id
    one = token_output.read_tokens(spark, path).where("doc_id = 1099511627776")
    assert one.first()["ids"] == t.encode("last one").ids + [1]
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,1099511627776)]" in one._jdf.queryExecution().toString()
    assert token_output.token_table(df.limit(0), WORDS).count() == 0


def test_token_files_hold_bloom_filters_and_row_indexes(spark, tmp_path):
    import glob

    import pyarrow.orc as orc

    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), "id").alias("text"))
    token_output.write_tokens(df, str(tmp_path / "x"), WORDS, files=2, row_index=1000)
    files = sorted(glob.glob(str(tmp_path / "x" / "*.orc")))
    assert len(files) == 2
    seen = []
    for f in files:
        o = orc.ORCFile(f)
        assert o.row_index_stride == 1000 and o.compression == "ZSTD"
        ids = o.read(columns=["doc_id"])["doc_id"].to_pylist()
        assert ids == sorted(ids)
        seen.append((min(ids), max(ids)))
        with open(f, "rb") as raw:
            assert raw.read(3) == b"ORC"
    seen.sort()
    assert seen[0][1] < seen[1][0]


def test_encoder_learns_pieces_not_words():
    import pyarrow as pa
    from tokenizers import Tokenizer

    t, own = Tokenizer.from_file(WORDS), token_output.WordEncoder(WORDS)
    rng = random.Random(6)
    odd = [*"abZ019'.,#|<>\t\n \x1f\u00a0\u3000ÉéİıßſÅΣς×ªº½\u0307漢ﬁ", "'s", "'LL", "''re", "<|endoftext|>", "e\u0301"]
    texts = ["Red. red, RED! (red) red's", "x'LLy <|endoftext|>", "", *["".join(rng.choices(odd, k=rng.randrange(40))) for _ in range(3000)]]
    ids, ends = own.encode(pa.array(texts), 1)
    for x, a, b in zip(texts, ends[:-1], ends[1:], strict=True):
        assert ids[a:b].tolist() == [*t.encode(x, add_special_tokens=False).ids, 1], x
    # words that differ in their signs alone share a piece
    own = token_output.WordEncoder(WORDS)
    own.encode(pa.array(texts[:1]), 1)
    assert set(own.table.at) == {"red", ".", ",", "!", "(", ")", "'s"}


def test_encoder_refuses_tokenizers_that_look_across_spaces():
    with pytest.raises(ValueError):
        token_output.WordEncoder(vocabularies.path("byte_bpe_50k.json"))


def test_trees_under_random_edits(monkeypatch):
    monkeypatch.setattr(token_counts, "LEAF", 3)
    c = token_counts.Counter(RANKS, vocabularies.PATTERN)
    r, alphabet = random.Random(11), "ab c'st 12\n\n  é.,!xY"
    for _ in range(600):
        t = "".join(r.choice(alphabet) for _ in range(r.choice([0, 1, 5, 40, 200])))
        pieces = c.split(t)
        leaves = [pieces[i:i + 3] for i in range(0, len(pieces), 3)]
        tree = token_counts.Tree(t, [sum(map(len, x)) for x in leaves], [sum(c.counts(x)) for x in leaves])
        for _ in range(r.randrange(1, 6)):
            at, size = r.randrange(0, len(t) + 3), r.choice([0, 0, 1, 2, 9, 60])
            new = "".join(r.choice(alphabet) for _ in range(r.choice([0, 1, 3, 30, 150])))
            where = min(at, len(t))
            t = t[:where] + new + t[where + size:]
            tree.edit(at, size, new, c)
            assert "".join(tree.leaves) == t
            assert (tree.total(0), tree.total(1)) == (len(t), len(c.encoding.encode_ordinary(t)))


def test_small_edits_of_a_long_text_encode_little():
    c = token_counts.Counter(RANKS, vocabularies.PATTERN)
    text = "some words of a long text, " * 20000
    pieces = c.split(text)
    leaves = [pieces[i:i + 64] for i in range(0, len(pieces), 64)]
    tree = token_counts.Tree(text, [sum(map(len, x)) for x in leaves], [sum(c.counts(x)) for x in leaves])
    for k in range(10):
        tree.edit(50_000 * k, 3, "new", c)
    assert tree.reencoded < 20_000


def test_recount(spark):
    c = token_counts.Counter(RANKS, vocabularies.PATTERN)
    docs = [(1, "Hello there, world."), (2, None), (3, ""), (4, "x " * 4000), (5, "twice"), (5, "twice"), (6, "one id"), (6, "two texts"), (None, "no id")]
    edits = [(1, 0, 5, 6, ""), (1, 1, 999, 0, " End"), (2, 0, 0, 0, "now text"), (3, 0, None, None, "abc"), (4, 0, 4001, 1, None), (5, 1, 0, 2, "b"),
             (5, 0, 0, 0, "aa"), (6, 0, 0, 3, ""), (99, 0, 0, 0, "nobody"), (None, 0, 0, 0, "null")]
    order = {}
    for e in sorted((e for e in edits if e[0]), key=lambda e: (e[0], e[1])):
        order.setdefault(e[0], []).append(e)
    want = []
    for i, t in docs:
        before = t = t or ""
        for _, _, at, size, new in order.get(i, []):
            at = min(at or 0, len(t))
            t = t[:at] + (new or "") + t[at + (size or 0):]
        want.append((i, len(c.encoding.encode_ordinary(before)), len(c.encoding.encode_ordinary(t)), len(t), len(order.get(i, []))))
    d = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, seq int")
    e = spark.createDataFrame(edits, "doc_id long, seq int, at int, size int, text string")
    got = token_counts.update(d, e, RANKS, vocabularies.PATTERN)
    key = lambda x: (x[0] is not None, x)
    assert sorted((tuple(r)[:5] for r in got.collect()), key=key) == sorted(want, key=key)
    assert token_counts.update(d.limit(0), e, RANKS, vocabularies.PATTERN).count() == 0
    assert {r["n_edits"] for r in token_counts.update(d, e.limit(0), RANKS, vocabularies.PATTERN).collect()} == {0}


def test_folding_keeps_places():
    for t in ["Іdi0t ÀÉ ß 1d10T", "İstanbul ﬁ ǅ", "plain ASCII!", "日本 🙂"]:
        assert len(toxicity.fold(t)) == len(t)
    lex = toxicity.Lexicon(words={toxicity.fold("idiot"): 5.0}, stems={toxicity.fold("vequ"): 4.0}, exceptions=[toxicity.fold("dear idiot")])
    hits = lambda t: [t[a:b] for a, b, _ in lex.hits(t)]
    assert hits("you 1d10t, Іdіоt! idiots xidiot idiot%%% vequa dear idiot") == ["1d10t", "Іdіоt", "idiot", "vequ"]
    assert hits("") == [] and toxicity.Lexicon().score("idiot") == 0.0


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    odd = spark.createDataFrame([(None, "idiot moron"), (90001, None), (90002, ""), (90003, "scum " * 50)], "doc_id long, text string")
    lex = toxicity.learn(docs, labels)
    got = toxicity.score(docs.unionByName(odd).withColumn("score", F.lit("clash")), lex).toPandas()
    m = got.merge(labels.toPandas(), on="doc_id")
    held = m[m.held_out]
    assert len(held) > 1000 and ((held.score >= 0.7) != (held.toxic == 1)).sum() <= 0.02 * len(held)  # the labels of this table hold some noise
    assert got.score.between(0, 1).all() and not got.predicted.isna().any()
    by = got.set_index("doc_id").score
    assert by[90001] == by[90002] == got.score.min() and by[90003] >= 0.7
    for r in got[got.doc_id.notna()].itertuples():
        assert r.held_out == (zlib.crc32(str(int(r.doc_id)).encode()) % 3 == 1)
    # labels of the held-out third don't matter
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.learn(docs, flipped).__getstate__() == lex.__getstate__()
    assert toxicity.learn(docs, labels.limit(0)).words == {} and toxicity.learn(docs.limit(0), labels).words == {}
    assert toxicity.score(docs.limit(0), lex).count() == 0


PAGES = [
    (None, ""), ("", ""), ("plain text only. yes", "plain text only. yes"), ("<p>1 < 2 and 3 > 2, so.</p>", "1 < 2 and 3 > 2, so."),
    ("<body><div><p>Hello <b>wor</b>ld,\n this  is it.<p>two &lt;b&gt; &#233;<ul><li>three<li>four</ul></div></body>", "Hello world, this is it. two <b> é three four"),
    ("""<html><body class="has-sidebar"><header><h1>Site</h1></header><div id="wrap"><div class="menu"><a href=x>Home</a></div><div class="content">
     <h2>Title</h2><p>First long paragraph, with text. And more, of it.</p><ul><li>one</li></ul><p>Second &amp; last&nbsp;one, is here.</p>
     <form>Name <input> <button>Go</button></form><div class="comments"><p>great post, thanks! I like it, very much, I do.</p></div></div>
     <div class="sidebar"><p>Buy now, please, do.</p></div></div><script>var t="</p>";</script><footer>c</footer></body></html>""",
     "Title First long paragraph, with text. And more, of it. one Second & last one, is here."),
    ("<main><article><header><h1>Head</h1></header><p>Short.</p></article><article class='comment'><p>Me first, yes, first, really, first!</p></article></main>", "Head Short."),
    ("<div>" * 3000 + "deep, text.", "deep, text."), ("<p " * 3000, "<p " * 2999 + "<p"), ("<nav>only, menus.</nav>", ""), ("<!-- c --><style>p{}</style>x, y.<br>z", "x, y. z"),
]


def test_pages(spark):
    data = [(i, f"u{i}", h) for i, (h, _) in enumerate(PAGES)] + [(None, None, "<p>a, b.</p>"), (0, "u0", None)]
    got = html_extract.extract(spark.createDataFrame(data, "page_id long, url string, html string").withColumn("text", F.lit(1))).collect()
    assert len(got) == len(data)
    for r in got:
        assert r["n_chars"] == len(r["text"])
        assert r["text"] == ("a, b." if r["page_id"] is None else PAGES[r["page_id"]][1]), r["page_id"]


def test_pages_of_the_table(spark):
    """The whole article, by its own tags, on every page of the table."""
    import re
    from html import unescape

    for r in html_extract.extract(spark.read.parquet("/root/testdata/sf0.001/pages.parquet")).join(
            spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "html"), "page_id").collect():
        inner = re.search("<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = (" ".join(unescape(re.sub("</?b>", "", x)).split()) for x in re.split("</?(?:p|h1|br)>", inner))
        assert r["text"] == " ".join(x for x in blocks if x)
