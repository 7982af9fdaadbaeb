"""The n-gram Jaccard join against brute force: odd rows, dense groups in small blocks, light and heavy sets."""

import random
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest

from lakeloom.llm import ngram_join, shingles
from lakeloom.llm.components import components


def shingle_set(t):
    w = (t or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(data):
    """doc_id → (set sizes, component)."""
    sets = [(i, shingle_set(t)) for i, t in data]
    ids = sorted({i for i, _ in data if i is not None})
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            both = len(a & b)
            if i is not None and j is not None and both and 100 * both >= 75 * len(a | b):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return sorted((i, len(s), None if i is None else root(i)) for i, s in sets if i is not None)


def near(r, base, edits):
    w = list(base)
    for _ in range(edits):
        w[r.randrange(len(w))] = f"z{r.randrange(10**6)}"
    return " ".join(w)


def corpus(seed, n=220):
    r = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(400)]
    passage = [r.choice(vocabulary) for _ in range(60)]
    data, base = [], [r.choice(vocabulary) for _ in range(120)]
    for i in range(n):
        kind = r.randrange(6)
        if kind == 0:  # a dense group about the threshold
            t = near(r, base, r.randrange(0, 12))
        elif kind == 1:  # a passage that many share
            t = " ".join(passage + [r.choice(vocabulary) for _ in range(r.randrange(0, 60))])
        elif kind == 2:  # short texts of few words
            t = " ".join(r.choice("ab") for _ in range(r.randrange(1, 14)))
        elif kind == 3 and data:  # copies
            t = r.choice(data)[1]
        elif kind == 4 and data:  # chains of near copies
            w = (r.choice(data)[1] or "x").split() or ["x"]
            t = near(r, w, r.randrange(0, 1 + len(w) // 25))
        else:
            t = " ".join(r.choice(vocabulary) for _ in range(r.randrange(1, 150)))
        data.append((i * 3 + 1, t))
    return data


ODD = [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "Hello World"), (1004, "hello\x0bworld"), (1005, "hello"), (None, "hello world"),
       (1006, "x " * 3000), (1006, "x " * 3000), (1007, "A b C d E"), (1008, "a B c D e"), (1009, "ä b c d e"), (1010, "Ä b c d e")]


@pytest.mark.parametrize("seed,settings", [
    (1, {}), (2, {"block": 8, "sketch_bits": 17, "bucket_rows": 500}), (3, {"block": 4, "shared": 7, "hashes": 8, "bitmap_bits": 17}),
    (5, {"wide": 2, "block": 6, "shared": 7, "ask_block": 5}),  # most pairs of neighbourhoods are compared in blocks
    (4, {"shared": 99}),  # no neighbourhoods at all: everything goes through the heavy-light join
])
def test_join_equals_brute_force(spark, seed, settings):
    data = corpus(seed, 220 if seed != 2 else 160) + ODD
    df = spark.createDataFrame([(i, t, "x") for i, t in data], "doc_id long, text string, n long").repartition(3) if False else \
        spark.createDataFrame([(i, t, 5) for i, t in data], "doc_id long, text string, n long").repartition(3)
    got = ngram_join.join(df, replace(ngram_join.Params(), **settings)).collect()
    assert len(got) == len(data)
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None) == brute(data)
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [None]


def test_repeated_ids_are_one_vertex(spark):
    a, b, c = ("one two three four five six " * 3, "red green blue black white grey " * 3, "up down left right back forth " * 3)
    data = [(1, a), (5, a), (5, b), (5, c), (7, b), (9, c)]
    got = ngram_join.join(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert {r["component_id"] for r in got} == {1}


def test_stage_keeps_one_of_each_group(spark):
    data = corpus(5, 120) + ODD
    df = spark.createDataFrame([(i, t, i) for i, t in data], "doc_id long, text string, component_id long")
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns
    want = sorted({c for _, _, c in brute(data)})
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == want and ids.count(None) == 1
    assert ngram_join.keep_one(df.limit(0)).count() == 0


def test_stage_keeps_every_text_of_a_repeated_id(spark):
    a, b = "one two three four five six " * 3, "red green blue black white grey " * 3
    data = [(1, a, "x"), (1, b, "x"), (1, b, "y"), (2, a, "x"), (3, b, "x"), (4, "alone here", "x")]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    kept = sorted((r["doc_id"], r["text"]) for r in ngram_join.keep_one(df).collect())
    assert kept == [(1, a), (1, b), (4, "alone here")]


def test_wide_homes_are_asked_as_a_whole():
    """Lists with two homes of many entries, some small homes and singles: every pair is listed, or one of the two asks the other's home."""
    r = np.random.default_rng(3)
    n = 400
    ids, home, size = np.arange(n) * 7, r.choice([1, 2, 3, *range(100, 130)], n, p=[.3, .3, .1, *[.01] * 30]), r.integers(90, 110, n)
    key = np.repeat(np.arange(6, dtype=np.uint64), 150)
    own = np.concatenate([r.choice(n, 150, replace=False) for _ in range(6)])
    asks, got = [], {}
    for i, j, c in ngram_join.list_pairs(key, own, ids, home, size, -1, asks, replace(ngram_join.Params(), wide=20)):
        for x, y, z in zip(i.tolist(), j.tolist(), c.tolist(), strict=True):
            got[x, y] = got.get((x, y), 0) + z
    asked = {tuple(x) for x in np.concatenate(asks, axis=1).T.tolist()}
    assert {h for _, h in asked} <= {1, 2, 3} and all(home[d] != h for d, h in asked)
    for k in range(6):
        entries = own[key == k].tolist()
        for a in entries:
            for b in entries:
                if a < b and home[a] != home[b]:
                    assert got.get((a, b), 0) > 0 or (a, home[b]) in asked or (b, home[a]) in asked
    assert all(home[a] != home[b] for a, b in got)
    assert list(ngram_join.list_pairs(key[:0], own[:0], ids, home, size, -1, asks, ngram_join.Params())) == []


def test_crowded_lists_are_not_paired():
    """Each pair of a list is listed, or both are in one crowd; a crowd gives a row a document, however long its lists are."""
    r = np.random.default_rng(5)
    p = replace(ngram_join.Params(), crowd=20)
    for light in (-1, 100):
        for n in (300, 600):
            ids, home, size = r.permutation(n) * 7 - 900, r.permutation(n), r.choice([60, 95, 100, 105, 300], n)
            own = np.concatenate([*(r.choice(n, n // 2, replace=False) for _ in range(4)), r.choice(n, 12, replace=False)])
            key = np.repeat(np.arange(5, dtype=np.uint64), [n // 2] * 4 + [12])
            crowds, got, every = [], set(), 0
            for i, j, c in ngram_join.list_pairs(key, own, ids, home, size, light, [], p, crowds):
                got |= set(zip(i.tolist(), j.tolist(), strict=True))
            member = {}
            for d, name in np.concatenate(crowds, axis=1).T.tolist():
                member.setdefault(d, set()).add(name)
            assert all(names <= set(ids.tolist()) for names in member.values())
            for k in range(5):
                entries = own[key == k].tolist()
                for a in entries:
                    for b in entries:
                        if a < b and p.needed(size[a], size[b]) <= min(size[a], size[b]) and max(size[a], size[b]) > light:
                            every += 1
                            assert (a, b) in got or member.get(a, set()) & member.get(b, set())
            assert len(got) <= 66 and every > n * p.crowd and sum(map(len, member.values())) <= 2 * n


def test_sets_of_one_shingle_post_nothing(spark):
    data = [(1, "one"), (2, "two words"), (3, "one"), (4, "three more words")]
    got = ngram_join.join(spark.createDataFrame(data, "doc_id long, text string").coalesce(1)).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == [(1, 1, 1), (2, 1, 2), (3, 1, 1), (4, 1, 4)]


def test_near_copies_without_neighbourhoods_are_a_crowd(spark):
    """No row a pair for a group of near copies that no neighbourhood holds, and the links are those of brute force."""
    r = random.Random(8)
    base, n = [f"b{i}" for i in range(110)], 160
    data = [(i, near(r, base, r.randrange(0, 6))) for i in range(1, n)] + [(n, " ".join(f"c{i}" for i in range(70)))]
    df = spark.createDataFrame(data, "doc_id long, text string")
    p = replace(ngram_join.Params(), shared=99)
    classes = ngram_join.frequency_classes(df, p)
    prof = ngram_join.profile(df, classes, p).dropDuplicates(["fp"])
    pairs, groups = ngram_join.candidates(prof, spark.createDataFrame([], "doc_id long, home long"), 0, 3, p)
    assert pairs.count() <= n * p.crowd // 2 and groups.where(f"kind <> {ngram_join.CROWD}").isEmpty()
    assert n / 2 < groups.count() <= 8 * n
    for settings in ({"shared": 99}, {"shared": 99, "crowd": 4, "ask_block": 9, "bitmap_bits": 17}):
        got = ngram_join.join(df, replace(ngram_join.Params(), **settings)).collect()
        assert sorted((x["doc_id"], x["n_shingles"], x["component_id"]) for x in got) == brute(data)


@pytest.mark.parametrize("seed,settings", [(7, {"shared": 99, "crowd": 3, "ask_block": 7}), (8, {"crowd": 2, "wide": 4, "shared": 7, "bitmap_bits": 17})])
def test_join_with_crowds_equals_brute_force(spark, seed, settings):
    data = corpus(seed, 160) + ODD
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = ngram_join.join(df, replace(ngram_join.Params(), **settings)).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None) == brute(data)


def test_stage_shuffles_only_documents_that_may_go(spark):
    """Documents whose id has no bit in the map stay in place: they reach the result beside the join, not through it."""
    data = [(i, f"text {i} of its own kind here", "x") for i in range(400)] + [(1000, "text 7 of its own kind here", "x"), (None, "none", "x")]
    df = spark.createDataFrame(data, "doc_id long, text string, doubt string")
    ids = spark.range(0, 400, 3).select("id")
    shared = ngram_join.bit_map(ids, replace(ngram_join.Params(), bitmap_bits=19))
    hit = {r["doc_id"] for r in df.where(ngram_join.in_bit_map(df.doc_id, shared)).collect()}
    assert set(range(0, 400, 3)) <= hit and len(hit) < 150 and None not in hit
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == list(range(400))
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.strip().startswith("Union") and plan.count("LeftAnti") == 1


def test_large_neighbourhoods_whose_centre_links_with_nobody(spark):
    """Two clusters joined by one link, in small blocks: no block may leave that link to another that leaves it too."""
    data, homes, want, size = [], [], set(), 23
    for seed in range(60):
        r = random.Random(seed)
        ids = r.sample(range(seed * 1000, seed * 1000 + 1000), size)
        text = [f"w{seed}x{k}" for k in range(200)]
        # 140 shingles each: two of them link if their offsets differ by 20 or less, so only 10 and 30 join the clusters
        for i, at in zip(ids[1:], [*range(11), *range(30, 41)], strict=True):
            data.append((i, " ".join(text[at:at + 144])))
            homes.append((i, ids[0]))
        data.append((ids[0], " ".join(f"c{seed}x{k}" for k in range(144))))
        want.add(frozenset(ids[1:]))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    links = ngram_join.home_links(docs, spark.createDataFrame(homes, "doc_id long, home long"), replace(ngram_join.Params(), block=4, bitmap_bits=17))
    got = {}
    for x in components(links, "a", "b").collect():
        got.setdefault(x["component"], set()).add(x["node"])
    assert {frozenset(g) for g in got.values()} == want


def test_every_light_boundary_is_right(spark):
    """Pairs between light and heavy sets are found wherever the boundary lies."""
    data = corpus(6, 150)
    df = spark.createDataFrame(data, "doc_id long, text string")
    p = ngram_join.Params()
    classes = ngram_join.frequency_classes(df, p)
    prof = ngram_join.profile(df, classes, p).where("n > 0").dropDuplicates(["fp"]).cache()
    sets = {r["doc_id"]: shingle_set(dict(data)[r["doc_id"]]) for r in prof.select("doc_id").collect()}
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    homes = spark.createDataFrame([], "doc_id long, home long")
    for x in (0, 4, 12, 60, 1000):
        pairs, asks = ngram_join.candidates(prof, homes, x, 8, p)
        assert want <= {(r["a"], r["b"]) for r in pairs.collect()} and asks.isEmpty()
        assert {tuple(r) for r in ngram_join.verified(df, pairs, p).collect()} == want


def test_shingle_sets():
    texts = ["", None, "a", "a b", "A B\x0bc d e F", "a b c d e f", "x\x85y z", "z" * (3 << 20) + " q r s t u", "a b c d e " * 400000, "q"]
    got = shingles.sets(pa.array(texts))
    assert [len(g) for g in got] == [len(shingle_set(t)) for t in texts]
    assert np.array_equal(got[4], got[5])
    assert shingles.overlap(got[4], got[8]) == len(shingle_set(texts[4]) & shingle_set(texts[8]))
    assert shingles.sets(pa.array([], pa.string())) == []


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(70)] + [(7, 7), (None, 3)]
    up = {}

    def root(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in edges:
        if a is not None and a != b:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert {(x["node"], x["component"]) for x in got} == {(i, root(i)) for i in up}
    assert len(got) == len(up)
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0
