"""License scan, conversation repair, hard negatives: brute force on small fixtures with odd rows."""

import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import conversation_repair as cr
from lakeloom.llm import hard_negatives as hn
from lakeloom.llm import license_scan as ls

SF = "/root/testdata/sf0.001"


# --- license scan ------------------------------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BASE = {"gpl": ["gnu", "general", "public", "license"], "apache": ["apache", "license"], "cc-by": ["cc", "by"], "mit": ["mit", "license"]}
ISC = ls.NOTICES[[n for n, _ in ls.NOTICES].index("isc")][1]
TEXTS = [
    (1, "GNU General Public License and the Apache License; CC-BY, cc by cc by. MIT\nLICENSE"), (2, None), (3, ""), (4, "... --- !!!"),
    (5, "É gnu general PUBLIC license É" * 3), (6, "CC BY " * 4000 + "mit license"), (7, "mit"), (8, "gnu general public"),
    (9, "x " * 30 + ISC + " y" * 30), (10, "x " * 30 + ISC.replace("modify, and/or distribute", "modify and distribute freely") + " y" * 30),
    (11, " ".join(ISC.split()[:12])), (12, "Licensed under CC BY-SA 4.0."), (12, "Licensed under CC BY-SA 4.0."), (13, "Licensed under CC BY-NC 4.0."),
    (None, "released under the MIT license"), (14, "apache license" + "\x00" + "mit\x7flicense"), (15, "ＭＩＴ license mitlicense"),
    (16, "Licensed under the Apache License, Version 2.0. " * 3),
]


def brute_base(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    hits = [(i, label) for label, p in BASE.items() for i in range(len(w)) if w[i:i + len(p)] == p]
    places = [i for i, _ in hits]
    return (len(w), len(hits), min(places, default=None), max(places, default=None), ",".join(sorted({label for _, label in hits})))


def license_rows(spark, rows):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, template string, AT int")
    return ls.scan(df).collect()


def test_license_base_places_equal_brute_force(spark):
    got = license_rows(spark, TEXTS)
    want = sorted(((i, *brute_base(t)) for i, t in TEXTS), key=str)
    assert sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got), key=str) == want
    for r in got:
        assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))


def test_license_notices_with_changed_words(spark):
    got = {r["doc_id"]: r for r in license_rows(spark, TEXTS)}
    assert got[9]["labels"] == "isc" and got[9]["score"] == 1
    assert got[10]["labels"] == "isc" and 0.75 <= got[10]["score"] < 1
    assert got[11]["labels"] == "" and 0 < got[11]["score"] < 0.75
    assert got[12]["labels"] == "cc-by,cc-by-sa" and got[13]["labels"] == "cc-by,cc-by-nc"
    assert got[16]["labels"] == "apache,apache-2.0" and got[16]["n_base"] == 3
    assert got[2]["score"] == got[3]["score"] == got[4]["score"] == 0


def test_license_scan_of_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert ls.scan(df).collect() == []
    with pytest.raises(ValueError):
        ls.templates(spark, [("x", "", False)])


def test_license_random_texts_equal_sql(spark):
    rng = random.Random(5)
    pool = sorted({w for _, t, _ in ls.TEMPLATES for w in WORD.findall(t.lower())}) + ["x", "y"]
    texts = []
    for i in range(60):
        parts = [" ".join(rng.choices(pool, k=rng.randrange(0, 6)))]
        for _ in range(rng.randrange(0, 4)):
            w = rng.choice(ls.TEMPLATES)[1].split()
            for _ in range(rng.randrange(0, 4)):
                at = rng.randrange(len(w) + 1)
                w[at:at + rng.randrange(0, 2)] = rng.choices(pool, k=rng.randrange(0, 2))
            parts.append(" ".join(w))
        texts.append((i, " ".join(parts)))
    got = sorted(tuple(r) for r in license_rows(spark, texts))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", texts)
    assert got == sorted(con.execute(ls.oracle()).fetchall())


# --- conversation repair -----------------------------------------------------------------------------------------

GRAMMAR = re.compile("(s?(ua)+)?")


def brute_align(codes):
    """All edit scripts by breadth over cost, without the grammar's states: initials are matched at the end."""
    n = len(codes)
    longest = n + 4

    def scripts(i, made):
        # least (cost, audit) for rows i.. once ``made`` initials stand
        if (i, made) in memo:
            return memo[i, made]
        memo[i, made] = None
        best = None
        if i == n and GRAMMAR.fullmatch(made):
            best = (0, "")
        moves = []
        if i < n:
            c = codes[i]
            moves.append(("D", 4, i + 1, made))
            if c != "-":
                cut = 3 * c.isupper()
                if c.lower() != "x":
                    moves.append(("K", cut, i + 1, made + c.lower()))
                moves += [("R", 3 + cut, i + 1, made + x) for x in "ua"]
        moves += [("I", 3, i, made + x) for x in "ua"]
        for letter, cost, j, then in moves:
            # a start of a well-formed string only
            if len(then) <= longest and re.fullmatch("|s?(ua)*u?", then):
                rest = scripts(j, then)
                if rest is not None:
                    best = min(filter(None, (best, (rest[0] + cost, letter + rest[1]))))
        memo[i, made] = best
        return best

    memo = {}
    return scripts(0, "")


def test_alignment_equals_all_scripts():
    for n in range(5):
        for codes in itertools.product("suaxUA-", repeat=n):
            codes = "".join(codes)
            assert cr.align(codes) == brute_align(codes), codes
    rng = random.Random(1)
    for _ in range(300):
        codes = "".join(rng.choices("suaSUAx-", [1, 6, 6, 1, 2, 2, 1, 2], k=rng.randrange(5, 13)))
        assert cr.greedy(codes) >= cr.align(codes)[0]
        assert cr.align(codes) == brute_align(codes), codes


def test_alignment_of_a_long_conversation_costs_what_the_automaton_says():
    rng = random.Random(2)
    codes = "".join(rng.choices("uaUA-x", [9, 9, 1, 1, 1, 1], k=6000))
    state = {0: 0, 1: math.inf}  # expects u, expects a
    for c in codes:
        nxt = {e: state[e] + 4 for e in state}
        for e in state:
            if c != "-":
                cost = (0 if c.lower() == "ua"[e] else 3) + 3 * c.isupper()
                nxt[1 - e] = min(nxt[1 - e], state[e] + cost)
        state = {e: min(nxt[e], nxt[1 - e] + 3) for e in nxt}
    cost, audit = cr.align(codes)
    assert cost == state[0] and len(audit) - audit.count("I") == len(codes)


def brute_report(rows):
    """conv_id → the contract's columns, row by row."""
    out = {}
    for conv in {r[0] for r in rows}:
        kept = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            one = lambda v: " " if v is None else str(v)
            fault = zlib.crc32(f"{one(c)}:{one(turn)}".encode()) % 20
            role, text = one(role), one(text)
            if fault == 1:
                text = ""
            if fault == 2:
                text = re.sub("[.!?]", "", text)
            if fault == 4:
                role = "user"
            kept += [(turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2] if r[0] is None else "",))
        codes, counts, seen, illegal = "", {"blank": 0, "duplicate": 0, "truncated": 0}, set(), 0
        for i, (_, role, text) in enumerate(kept):
            solid = re.sub("[\x20\x09-\x0d]", "", text)
            code = role[:1] if role[:1] in ("s", "u", "a") else "x"
            if not solid:
                kind, code = "blank", "-"
            elif (role, text) in seen:
                kind, code = "duplicate", "-"
            elif solid[-1] not in ".!?":
                kind, code = "truncated", code.upper()
            else:
                kind = None
            if kind:
                counts[kind] += 1
            seen.add((role, text))
            codes += code
            illegal += i > 0 and kept[i - 1][1][:1] + role[:1] not in ("su", "ua", "au")
        cost, audit = brute_align(codes)
        made, at, initials = [], 0, ""
        for letter in audit:
            wanted = "user" if re.fullmatch("s?(ua)*", initials) else "assistant"
            role, text = kept[at][1:] if letter != "I" else (wanted, "")
            at += letter != "I"
            if letter == "D":
                continue
            role = wanted if letter == "R" else role
            made.append(f"{role}:{text}")
            initials += role[0]
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
                     hashlib.sha256("\n".join(made).encode()).hexdigest())
    return out


def reported(df):
    rows = cr.report(df).collect()
    assert len(rows) == len({r["conv_id"] for r in rows})
    return {r[0]: tuple(r)[1:] for r in rows}


def test_conversations_of_a_whole_table_equal_brute_force(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert reported(df) == brute_report(rows)


def test_conversations_with_odd_rows(spark):
    rng = random.Random(4)
    rows = []
    for conv in [None, -1, *range(40)]:
        for turn in range(rng.randrange(0, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = rng.choice(["Yes.", "No", "Why?  \n", None, "", " \t\x0b", "Yes.", "é…", "long. " * 400])
            rows.append((conv, rng.choice([turn, turn * 2]) if rng.random() > 0.1 else None, role, text))
    rows.sort(key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0))
    # one row for each turn, so that the order is the contract's alone; rows without a turn may repeat
    rows = list({(r[0], r[1] if r[1] is not None else (i,)): r for i, r in enumerate(rows)}.values())
    rows = [(c, t if isinstance(t, int) else None, r, x) for c, t, r, x in rows]
    rows += [r for r in rows if r[1] is None][:3]
    df = spark.createDataFrame([(*r, 7, "z") for r in rows], "conv_id long, turn long, role string, text string, copy int, D1 string")
    assert reported(df) == brute_report(rows)
    assert cr.report(df.limit(0)).collect() == [] and cr.repair(df.limit(0)).collect() == []


def test_a_conversation_without_rows_after_damage(spark):
    gone = next((c, t) for c in range(100) for t in range(20) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(*gone, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    assert reported(df) == {gone[0]: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_repaired_turns_alternate(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    turns = cr.repair(df).groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "role"))),
                                                                          lambda t: F.substring(t["role"], 1, 1)), "").alias("r")).collect()
    assert turns and all(GRAMMAR.fullmatch(t["r"]) for t in turns)


def test_one_conversation_with_a_third_of_the_rows(spark):
    rows = [(0, t, "user" if t % 2 else "assistant", f"Turn {t % 700}.") for t in range(3000)]
    rows += [(c, t, "user" if t % 2 else "assistant", "Hello.") for c in range(1, 1000) for t in range(6)]
    got = reported(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert len(got) == 1000 and got[0][2] > 1500


# --- hard negatives ----------------------------------------------------------------------------------------------

def brute_mine(rows, positives=5, negatives=3):
    part = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        part.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a in {r[0] for r in part if r[0] % 50 == 0}:
        _, label, v = min(r for r in part if r[0] == a)
        same = sorted((-dot(v, w), i) for i, lab, w in part if lab == label and i != a)[:positives]
        others = sorted((-dot(v, w), i) for i, lab, w in part if lab != label)
        for p, pid in same:
            inside = [(n, i) for n, i in others if 50 * -p <= 100 * -n <= 95 * -p][:negatives]
            out += [(a, pid, k + 1, i, -p, -n) for k, (n, i) in enumerate(inside)]
    return sorted(out)


VECTORS = "vec_id long, embedding array<double>, label int, KEY string, a long"


def mined(spark, rows, **how):
    return sorted(tuple(r) for r in hn.mine(spark.createDataFrame([(*r, "x", 1) for r in rows], VECTORS), **how).collect())


@pytest.mark.parametrize("block_rows", [7, 64, 8192])
def test_hard_negatives_equal_brute_force(spark, block_rows):
    rng = random.Random(block_rows)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 1.0, rng.random()]) for _ in range(4)], rng.randrange(3)) for i in range(400)]
    rows[3:9] = [(3, None, 1), (4, [1.0, None, 1.0, 1.0], 1), (5, [1.0, math.nan, 0.0, 0.0], 2), (None, [1.0] * 4, 1), (7, [math.inf] * 4, 1),
                 (8, [1.0] * 4, None)]
    rows += [(150, [1.0] * 4, 1), (150, [0.5] * 4, 0), (20, [1.0], 0), (21, [], 1)] + [(31, [1.0] * 4, 2)] * 5
    assert mined(spark, rows, block_rows=block_rows) == brute_mine(rows)


def test_hard_negatives_with_ties_and_a_hot_label(spark):
    rows = [(i, [1.0, 1.0] if i % 3 else [1.0, 0.6], 1 if i % 10 < 7 else i % 10) for i in range(600)]
    got = mined(spark, rows, block_rows=50)
    assert got == brute_mine(rows) and got


def test_hard_negatives_of_zero_and_negative_scores(spark):
    rows = [(0, [1.0, 0.0], 1)] + [(i, [0.0 if i % 2 else -0.5, 1.0], 1 + i % 3) for i in range(1, 49)]
    got = mined(spark, rows)
    assert got == brute_mine(rows) and {r[4] for r in got} == {0}


def test_hard_negatives_of_large_components_are_exact(spark):
    rows = [(i, [float(1 << 20) + i, 3.0], 1 + i % 2) for i in range(60)]
    assert mined(spark, rows, high=100) and mined(spark, rows) == brute_mine(rows)
    keys = hn.pack(hn.np.array([-5, 5]), hn.np.array([-(1 << 62), 1 << 62]), hn.POSITIVE, hn.np.array([-1, 1]))
    assert [c.tolist() for c in hn.unpack(keys.column(0))] == [[-5, 5], [-(1 << 62), 1 << 62], [0, 0], [-1, 1]]


def test_hard_negatives_of_an_empty_table(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, [1.0], 1)]) == [] and mined(spark, [(50, [1.0], 1)]) == []
