"""The pipeline against brute force on a whole small table, its stages on odd rows, and the registered names."""

import re
import zlib
import struct

import public_tokenizers as vocabularies

import __spark_entry__ as entry
import corpus_pipeline
from lakeloom.llm import quality
from test_ngram_join import brute as components_of
from test_text_operators import brute_lines, brute_quality

SF = "/root/testdata/sf0.001"


def brute(rows, items):
    """(doc_id, source, text) that the first four stages keep."""
    kept = []
    for i, t, s in rows:
        n, chars, symbols, dup, repeat, lines = brute_quality(t)
        if not (n < 50 or 100 * repeat > 50 * n or 10 * symbols > n or 2 * dup > lines or chars < 2 * n or chars > 30 * n):
            kept.append((i, t, s))
    source = {i: s for i, _, s in kept}
    texts = dict(brute_lines(kept, 8))
    lead = {c for _, _, c in components_of(sorted(texts.items()))}
    return [(i, source[i], t) for i, t in texts.items() if i in lead and not any(x in t for x in items)]


def test_run_equals_brute_force(spark):
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=vocabularies.path("piece_bpe_32k.model"))
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = {}
    for i, s, t in brute([tuple(r) for r in docs], items):
        ids = own.encode(t)
        want[i] = (s, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)), len(t), True)
    got = corpus_pipeline.run(spark, SF).collect()
    assert len(got) == len(want) > 50
    assert {r["doc_id"]: (r["source"], r["n_tokens"], r["ids_crc32"], r["n_chars"], r["exact"]) for r in got} == want


def test_stages_take_odd_rows_and_keep_the_columns(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "near_duplicates", "decontamination", "sentencepiece"]
    long = " ".join(f"word{i}" for i in range(60))
    rows = [(1, long, "en", "a", 9, "x", 1), (1, long, "en", "a", 9, "x", 1), (2, None, None, None, None, None, None), (3, "", "en", "b", 0, "", 2),
            (None, long + " more", None, None, None, None, None), (None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, kept string, component_id long")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        n = {"quality_rules": 3, "near_duplicates": 5}.get(name, 6)
        assert out.count() == n, name
        assert stage(spark, docs.limit(0), SF).count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == 6 and last.where("NOT exact").count() == 0


def test_registered_queries():
    found = [k for k in entry.queries() if re.match(r"op\d+_", k)]
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in found) == list(range(1, 14))
    assert "pipeline" in entry.queries()
    assert {k for k in entry.oracle_sql() if k.startswith("op")} == {"op6_line_dedup", "op10_quality_rules", "op11_license_scan", "op13_hard_negatives"}


def test_policies_only_name_rules():
    names = {r.name for r in quality.RULES}
    assert all(set(p) <= names for p in quality.POLICIES.values())
    assert len({r.bit for r in quality.RULES}) == len(quality.RULES)
