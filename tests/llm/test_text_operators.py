"""Quality rules, sharding, line dedup, decontamination: brute force on small fixtures with odd rows."""

import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakeloom.llm import decontaminate, line_dedup, quality, sharding

DOCS = "doc_id long, text string, lang string, source string, n_chars int, Kept string, MEASURES int, n_lines long"


def rows(texts, sources=None):
    return [(i, t, "en", (sources or {}).get(i, f"s{(i or 0) % 3}"), None if t is None else len(t), "x", i, 7) for i, t in texts]


def words(t):
    return [w for w in re.split("[\x20\x09-\x0d]+", t or "") if w]


TEXTS = [
    (1, "a b c a b c d"), (2, None), (3, ""), (4, " \n\t\x0b "), (5, "x\ny\nx\n\nx y\n \nx"), (6, "one two"),
    (7, "w " * 5000), (8, " ".join(f"w{i}" for i in range(60))), (8, " ".join(f"w{i}" for i in range(60))), (None, "null id here"),
    (9, "é ü%%% <tag> # | $5 " * 20), (10, "a b c\x85d e\x1cf"), (11, "\n".join(f"line number {i} of many lines" for i in range(300))),
    (12, " ".join(f"w{i % 40}" for i in range(100))),
]


def brute_quality(t):
    w = words(t)
    lines = [x for x in (t or "").split("\n") if words(x)]
    wins = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if wins[w[i], w[i + 1], w[i + 2]] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), len(lines))


def test_quality_measures_and_verdicts(spark):
    df = spark.createDataFrame(rows(TEXTS), DOCS)
    got = quality.verdicts(df).select("doc_id", "text", "measures", "failed", "base_failed", "kept").collect()
    assert len(got) == len(TEXTS)
    for r in got:
        n, chars, symbols, dup, repeat, lines = brute_quality(r["text"])
        assert tuple(r["measures"]) == (n, chars, symbols, dup, repeat, lines)
        assert r["base_failed"] == (n < 50 or 100 * repeat > 50 * n)
        bits = [n < 50, 100 * repeat > 50 * n, 10 * symbols > n, 2 * dup > lines, chars < 2 * n, chars > 30 * n, 2 * lines > n]
        assert r["failed"] == sum(1 << i for i, b in enumerate(bits) if b)
        assert r["kept"] == (not any(bits[:6]))


def test_quality_policies_and_ablation(spark):
    df = quality.ledger(spark.createDataFrame(rows(TEXTS), DOCS))
    failed = [r["failed"] for r in df.collect()]
    for policy, names in quality.POLICIES.items():
        m = quality.mask(names)
        assert df.where(quality.rejects(policy)).count() == sum(1 for f in failed if f & m)
    m = quality.mask(quality.POLICIES[quality.PRODUCTION])
    for r in quality.ablation(df).collect():
        bit = quality.mask([r["rule"]])
        assert r["fails"] == sum(1 for f in failed if f & bit)
        assert r["fails_alone"] == sum(1 for f in failed if f & m == bit)
        assert r["kept_without"] == sum(1 for f in failed if not f & m & ~bit)


def test_quality_stage_keeps_columns_and_repeats(spark):
    df = spark.createDataFrame(rows(TEXTS), DOCS)
    kept = quality.keep(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [8, 8]
    assert quality.keep(df.limit(0)).count() == 0
    assert quality.ablation(quality.ledger(df.limit(0))).count() == 0


def brute_jump(key, shards):
    b, j, key = -1, 0, key % 2**64
    while j < shards:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_sharding(spark):
    data = [(i * 7919 - 3000, "text" if i % 3 == 0 else f"t{i}é") for i in range(1000)] + [(None, None), (None, "n"), (5, ""), (5, ""), (2**62, "z")]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumn("slot", F.lit("clash"))
    got = sharding.assign(df, shards=40, ranges=4).collect()
    assert len(got) == len(data)
    by = {}
    for r in got:
        key = -1 if r["doc_id"] is None else r["doc_id"]
        assert (r["shard"], r["grown_shard"], r["law"]) == (brute_jump(key, 40), brute_jump(key, 41), "key")
        assert r["grown_shard"] in (r["shard"], 40)
        by.setdefault(r["shard"], []).append(r)
    for part in by.values():
        part.sort(key=lambda r: r["slot"])
        assert [r["slot"] for r in part] == list(range(len(part)))
        ids = [(r["doc_id"] is not None, -1 if r["doc_id"] is None else r["doc_id"]) for r in part]
        assert ids == sorted(ids)
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in data)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    # the result doesn't depend on how it is dealt out
    again = sharding.assign(df, shards=40, ranges=1).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert sharding.assign(df.limit(0)).count() == 0
    assert sharding.moved(df, "doc_id", 40).where("grown_shard <> 40").count() == 0
    with pytest.raises(ValueError):
        sharding.jump(F.lit(1), 0)


def brute_lines(data, least):
    sites = {}
    for _, t, s in data:
        for x in (t or "").split("\n"):
            if words(x):
                sites.setdefault(" ".join(words(x)), set()).add(s)
    spread = {x for x, s in sites.items() if len(s) >= least}
    out = []
    for i, t, _ in data:
        if t is not None:
            lines = t.split("\n")
            hit = [" ".join(words(x)) in spread for x in lines]
            gone = sum(len(words(x)) for x, h in zip(lines, hit) if h)
            if any(hit) and gone < len(words(t)):
                t = "\n".join(x for x, h in zip(lines, hit) if not h)
        out.append((i, t))
    return out


LINES = [(i, f"Share  this page\nown words of document {i} that nobody else has\nmore of them {i}\n\nshare this page", f"s{i}") for i in range(6)]
LINES += [(10, "Share this page", "s1"), (11, None, "s1"), (12, "", None), (13, "on two sites\nx y z a b c d e", "s1"), (14, "on two sites\nq r s t u v w", None),
          (15, "Share this page\nlong own line of enough words here", None), (15, "Share this page\nlong own line of enough words here", None),
          (None, "Share this page\nanother own line with quite some words", "s9"),
          (16, "Share this page\nown\nshare this page\n\nShare this page", "s2"), (17, "Share this page\nshare this page", "s2")]


def test_line_dedup(spark):
    df = spark.createDataFrame([(*r, 3, "k") for r in LINES], "doc_id long, text string, source string, n_chars int, N_Dropped string")
    for least in (2, 3, 7, 8):
        got = line_dedup.clean(df, least)
        assert got.columns == df.columns
        want = brute_lines(LINES, least)
        assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter(want)
    assert {r["N_Dropped"] for r in line_dedup.clean(df, 3).collect()} == {"k"}
    # most of 16 is boilerplate and goes all the same; 17 holds nothing else and stays
    left = {r["doc_id"]: r["text"] for r in line_dedup.clean(df, 3).collect()}
    assert left[16] == "own\n" and left[17] == "Share this page\nshare this page"
    assert line_dedup.clean(df.limit(0), 3).count() == 0


def test_line_spread_is_exact_near_the_threshold(spark):
    """Lines on 28 to 32 sites, each on very many rows: the sketch alone may be off, the exact count isn't."""
    data = [(f"line {k}", f"s{j % k}") for k in range(28, 33) for j in range(200)]
    df = spark.createDataFrame(data, "text string, source string")
    assert line_dedup.spread(df, 30, lg_k=4).count() == 3
    assert line_dedup.spread(df, 30).count() == 3


ITEM = "A train leaves Paris at 3 km per hour and Bob walks 12 miles to meet Alice near the old red barn today."
ITEMS = [(1, ITEM), (2, "too short"), (3, None), (4, "the quick brown fox jumps over the lazy dog while seven wizards quietly brew jinxed potions tonight")]


def test_decontamination(spark):
    clean_text = " ".join(f"plain{i}" for i in range(200))
    cases = [
        (1, f"{clean_text} {ITEM} {clean_text}", {1}), (2, ITEM.replace("Paris", "London").replace("Bob", "Tom").replace("12", "7,500"), {1}),
        (3, clean_text, set()), (4, None, set()), (5, "", set()), (None, ITEM, {1}), (6, ITEM.upper(), set()), (7, ITEM + " " + ITEMS[3][1], {1, 4}),
        (8, "the quick brown fox jumps over the lazy cat", set()), (9, ITEMS[3][1].upper(), {4}), (9, ITEMS[3][1].upper(), {4}),
        (10, " ".join(ITEMS[3][1].split()[:9]) + " then something else entirely follows here", set()), (11, "3 4 5 6 7 8 9 10 11 12 13 14", set()),
    ]
    docs = spark.createDataFrame([(i, t, "clash") for i, t, _ in cases], "doc_id long, text string, item_id string")
    items = spark.createDataFrame(ITEMS + [ITEMS[0]], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.matches(docs, items).collect()}
    want = {(i, k) for i, _, ks in cases for k in ks if i != 6}
    got6 = {k for k in got if k[0] == 6}  # names in capitals make another template; either is defined as it falls
    assert set(got) - got6 == want
    assert got[1, 1]["literal"] and not got[2, 1]["literal"] and got[2, 1]["consistent"]
    left = decontaminate.clean(docs, items)
    assert left.columns == docs.columns
    assert Counter(r["doc_id"] for r in left.collect()) == Counter([3, 4, 5, None, 8, 10, 11] + ([] if got6 else [6]))
    assert decontaminate.matches(docs.limit(0), items).count() == 0
    assert decontaminate.matches(docs, items.limit(0)).count() == 0


def test_decontamination_finds_every_literal_copy(spark):
    """Copies at every offset of items of 6 to 10 words, of items under the window, of items dense in numbers and names."""
    items = [(n, " ".join(f"item{n}word{k}" for k in range(n))) for n in range(6, 11)]
    items += [(20, "Compute 12 + 15 * 3 - 4 / 2"), (21, "Name them: Ann Bob Carl Dora Emil Fred Gina Hugo"), (22, "seven quiet brewers"), (23, "4 5 6")]
    docs, want = [], set()
    for k, t in items:
        for lead in range(6):
            docs.append((len(docs), " ".join([f"lead{i}" for i in range(lead)] + [t] + [f"tail{i}" for i in range(9)])))
            want.add((docs[-1][0], k))
    docs += [(1000, "Compute 13 + 16 * 4 - 5 / 3"), (1001, "7 8 9 10 11"), (1002, "seven quiet bakers")]
    got = decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want
    assert all(r["literal"] for r in got)


def test_decontamination_marks_suspects_once(spark, tmp_path, monkeypatch):
    """The readings and window sizes of the second pass are taken from the suspects' marked texts, not from all documents."""
    plans, stored = {}, decontaminate.stored

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return stored(df, name)

    monkeypatch.setattr(decontaminate, "stored", seen)
    spark.createDataFrame([(1, "Ann buys 3 red apples and 4 green pears today"), (2, "nothing at all")], "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    items = spark.createDataFrame([(1, "Bob buys 5 red apples and 7 green pears today"), (2, "red apples")], "item_id long, text string")
    got = decontaminate.matches(spark.read.parquet(str(tmp_path / "docs")), items)
    assert {(r["doc_id"], r["item_id"], r["literal"]) for r in got.collect()} == {(1, 1, False), (1, 2, True)}
    assert str(tmp_path)[:30] not in plans["hits"] and "/docs" not in plans["hits"] and "/suspect-texts" in plans["hits"]


def test_decontamination_finds_shifted_and_sentence_initial_values(spark):
    """A name of another number of words, a word put in, names that start the sentences, names in lower case."""
    items = [(1, "every morning before work the old farmer asks young Ann about new brown hens that live behind the red barn"),
             (2, "Ann buys red apples at market. Ann eats two of them. Ann gives her friend some more. Ann counts what is left."),
             (3, "yesterday Carl met Dora near Paris while Emil drove Fred from Rome towards Genoa with Hugo")]
    cases = [(1, items[0][1].replace("Ann", "Mary Ann Smith"), {1}), (2, items[0][1].replace("asks", "often asks").replace("Ann", "Tom"), {1}),
             (3, "Well now. " + items[1][1].replace("Ann", "Bob"), {2}), (4, items[1][1].replace("Ann", "Mary Lou"), {2}),
             (5, items[2][1].lower(), {3}), (6, "the red barn is where brown hens live and an old farmer works before every morning", set()),
             (7, items[0][1].replace("about new", "about seven big new"), {1})]
    docs = spark.createDataFrame([(i, t) for i, t, _ in cases], "doc_id long, text string")
    got = decontaminate.matches(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(i, k) for i, _, ks in cases for k in ks}
    assert not any(r["literal"] for r in got if r["doc_id"] in (1, 2, 3, 4))


def test_decontamination_finds_names_with_apostrophe_or_hyphen(spark):
    """One name becomes one of several parts; a number word instead of another isn't a literal copy."""
    item = "every morning before work farmer Omar asks young Petra about seven brown hens that live behind the red barn"
    names = item.replace("Omar", "O'Neil").replace("Petra", "Jean-Luc")
    start = "Omar asks young Petra about brown hens behind the barn. Omar feeds them. Omar counts all hens that are left."
    cases = [(1, names, {1}), (2, names.lower(), {1}), (3, item.replace("seven", "nine"), {1}), (4, item, {1}),
             (5, start.replace("Omar", "Jean-Luc Picard").replace("Petra", "D’Arcy"), {2})]
    docs = spark.createDataFrame([(i, f"well {t} indeed" if i < 5 else t) for i, t, _ in cases], "doc_id long, text string")
    items = spark.createDataFrame([(1, item), (2, start)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["literal"] for r in decontaminate.matches(docs, items).collect()}
    assert {k for k in got if k[0] != 2} == {(i, k) for i, _, ks in cases for k in ks if i != 2}
    assert [k for k, literal in got.items() if literal] == [(4, 1)]


def test_decontamination_readings_agree(spark):
    """The first pass reads templates off the split words as the second does off the marked text."""
    texts = ["Mary Ann Smith met Jean-Luc O'Neil at 3.5 km, Bob’s. Jean-Luc Picard saw Ann’s dog\nBob Jones", "", "5km 1,000 x2y É-É A-B’C \n\nÄ", None]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").unionByName(
        spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text"))
    m = decontaminate.marked(F.col("text"))
    kinds = (decontaminate.PLAIN, decontaminate.INITIAL, decontaminate.EXACT)
    raw = [decontaminate.raw_words(m, k) for k in kinds]
    want = [r if k == decontaminate.EXACT else decontaminate.template(r) for k, r in zip(kinds, raw, strict=True)]
    got = decontaminate.readings(decontaminate._split(m))
    rows = docs.select(*[(g == w).alias(f"same{k}") for k, g, w in zip(kinds, got, want, strict=True)])
    assert rows.where("NOT (same0 AND same1 AND same2)").count() == 0


def test_decontamination_refuses_inconsistent_slots(spark):
    item = "Alice gave Bob nine red apples and then Alice asked Bob how many green apples Bob wanted from Alice that day"
    fine = item.replace("Alice", "Carol").replace("Bob", "Dave")
    broken = "So Carol gave Dave nine red apples and then Erin asked Frank how many green apples Gina wanted from Hugo that day"
    docs = spark.createDataFrame([(1, "So " + fine), (2, broken)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "So " + item)], "item_id long, text string")
    assert [r["doc_id"] for r in decontaminate.matches(docs, items).collect()] == [1]


def test_decontamination_finds_leaks_in_the_table(spark):
    sf = "/root/testdata/sf0.001"
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    want = {(d["doc_id"], b["item_id"]) for d in docs.collect() for b in items.collect() if b["text"] in (d["text"] or "")}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(docs, items).collect()}
    assert want and got == want
