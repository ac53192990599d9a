"""Decontamination, toxicity, the Jaccard join, secrets and lines against brute force."""

import random
import re
from itertools import combinations

import numpy as np
import pytest

from pointframe.llm.components import connected_components
from pointframe.llm.decontaminate import MASKS, drop_contaminated, find_overlaps, own_masks
from pointframe.llm.jaccard_join import drop_near_duplicates, near_duplicates, shingle_sets
from pointframe.llm.line_dedup import drop_duplicate_lines, duplicate_lines, line_report
from pointframe.llm.secrets import join_spans, scan_secrets
from pointframe.llm.toxicity import drop_toxic, score_toxicity

DOCS = "doc_id long, text string, source string, `TEXT` string, `n` int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "clash", 1) for i, t, s in rows], DOCS)


def prose(rng, n, vocabulary=5000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


# -- decontamination

def test_overlaps_tolerate_substitutions(spark):
    rng = random.Random(1)
    items = [(k, prose(rng, 20 + k)) for k in range(8)] + [(100, "tiny item here"), (101, None), (102, "... !!")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows, want = [], set()
    for d in range(40):
        words = prose(rng, 200, 10**9).split()
        if d % 4 == 0:  # a passage with a substitution in every seven words
            item = items[d % 8][1].split()
            for p in range(3, len(item), 7):
                item[p] = "other"
            words[50:50] = [w.upper() + "," for w in item]
            want.add((d, d % 8))
        rows.append((d, " ".join(words), "a"))
    rows += [(500, "Tiny item, here!", None), (501, None, "a"), (502, "", "a"), (503, items[3][1], "a"), (503, items[3][1], "a")]
    want |= {(500, 100), (503, 3)}
    docs = frame(spark, rows)
    got = find_overlaps(docs, bench).collect()
    assert {(r.id, r.item_id) for r in got} == want and len(got) == len(want)
    assert {(r.id, r.item_id) for r in find_overlaps(docs, bench, max_broadcast=0).collect()} == want
    left = drop_contaminated(docs, bench)
    assert left.columns == docs.columns and {r[0] for r in left.collect()} == {r[0] for r in rows} - {d for d, _ in want}


def test_first_mask_hits_all_pairs_of_substitutions():
    for a in range(13):
        for b in range(a + 1, 13):
            assert any(all(x == "0" or s + i not in (a, b) for i, x in enumerate(MASKS[0])) for s in range(13 - len(MASKS[0]) + 1))


def test_overlaps_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert find_overlaps(frame(spark, [(1, "a b c", "s")]), none).count() == 0
    assert find_overlaps(frame(spark, []), none).count() == 0


@pytest.mark.parametrize("words", range(1, 12))
def test_own_masks_ignore_every_admitted_substitution(words):
    wrong = words - -(-words * 8 // 10)
    masks = own_masks(words, 0.8)
    assert all(len(m) == words and "1" in m for m in masks)
    for at in combinations(range(words), wrong):
        assert any(all(m[i] == "0" for i in at) for m in masks)


def test_short_items_with_every_substitution(spark):
    rng = random.Random(9)
    items = [(n, prose(rng, n, 10**9)) for n in range(1, 14)]
    rows, want = [], set()
    for n, text in items:
        for wrong in range(3):
            for k, at in enumerate(list(combinations(range(n), wrong))[:80]):
                w = text.split()
                for i in at:
                    w[i] = f"other{i}"
                d = n * 10_000 + wrong * 1000 + k
                lead = rng.choice(["", prose(rng, 20, 10**9) + " "])
                rows.append((d, lead + " ".join(w) + rng.choice(["", " " + prose(rng, 20, 10**9)]), "a"))
                if n - wrong >= -(-n * 8 // 10):
                    want.add((d, n))
    got = {(r.id, r.item_id) for r in find_overlaps(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == want


def test_contaminated_rows_go_by_id_and_text(spark):
    bench = spark.createDataFrame([(1, "six words that no text holds")], "item_id long, text string")
    bad = "here are six words that no text holds at all"
    rows = [(None, bad, "a"), (None, "clean", "a"), (4, bad, "a"), (4, "clean too", "a"), (5, None, "a")]
    assert sorted(str(r[1]) for r in drop_contaminated(frame(spark, rows), bench).collect()) == ["None", "clean", "clean too"]


# -- Jaccard join

def sets_of(rows, n):
    out = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        out[i] = frozenset(tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()
    return out


def brute(rows, n, num):
    sets = sets_of(rows, n)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for k, x in enumerate(ids):
        for y in ids[:k]:
            both = len(sets[x] & sets[y])
            if both and 100 * both >= num * len(sets[x] | sets[y]):
                a, b = sorted((find(x), find(y)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_rows(rng):
    base = [prose(rng, 60 + 7 * k) for k in range(12)]
    shared = prose(rng, 40)
    rows = []
    for i in range(160):
        w = base[i % 12].split()
        for _ in range(i % 5):  # chains around the threshold
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        if i % 3 == 0:
            w = shared.split() + w
        rows.append((i, " ".join(w) if i % 11 else (" ".join(w)).upper()))
    rows += [(900, None), (901, ""), (902, " \t\n"), (903, "one two"), (904, "One  two"), (905, "one two three")]
    return rows + [(i + 1000, t) for i, t in rows[:40]]


@pytest.mark.parametrize("options", [{}, {"frequent": 2, "max_broadcast": 0}])
def test_near_duplicates_match_brute_force(spark, options):
    rows = near_rows(random.Random(3))
    got = near_duplicates(frame(spark, [(i, t, "s") for i, t in rows]), **options).collect()
    assert {r.id: (r.n, r.component) for r in got} == brute(rows, 4, 85)


def edited(rng, base, edits):
    w = base.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"x{rng.randrange(10**9)}"
    return " ".join(w)


@pytest.mark.parametrize("seed", range(1))
def test_a_group_around_one_text_matches_brute_force(spark, seed):
    """Many edits of a few texts, most of them too far from any other: links between such are derived from the reference."""
    rng = random.Random(seed)
    a = prose(rng, 120)
    b = edited(rng, a, 6)  # similar to the first, and linked to some of what is linked to it
    rows = [(1000 * seed + k, edited(rng, rng.choice([a, a, a, b]), rng.choice([0, 1, 2, 3, 4, 5, 6, 8]))) for k in range(250)]
    rows += [(rng.randrange(10**6, 10**7), edited(rng, rng.choice(rows)[1], rng.randrange(3))) for _ in range(150)]
    rows += [(rng.randrange(10**7, 10**8), " ".join(rng.choice(rows)[1].split()[:rng.randrange(90, 121)])) for _ in range(60)]
    rows = list(dict(rows).items())
    got = near_duplicates(frame(spark, [(i, t, "s") for i, t in rows])).collect()
    assert {r.id: (r.n, r.component) for r in got} == brute(rows, 4, 85)


def test_near_duplicate_rows_that_repeat_and_null_ids(spark):
    rows = [(1, "a b c d e f", "s"), (1, "a b c d e f", "s"), (None, "a b c d e f", "s"), (2, "A B C D E F", "s")]
    got = sorted(((r.id, r.n, r.component) for r in near_duplicates(frame(spark, rows)).collect()), key=str)
    assert got == [(1, 3, 1), (1, 3, 1), (2, 3, 1), (None, 3, None)]
    left = drop_near_duplicates(frame(spark, rows))
    assert left.columns == ["doc_id", "text", "source", "TEXT", "n"] and sorted(str(r[0]) for r in left.collect()) == ["None"]
    # rows are told apart by id and text: of the texts that share an id only the near copy goes
    rows = [(7, "one text of its own here", "s"), (7, "a b c d e f", "s"), (3, "A b c d e f", "s"), (None, "of null ids", "s"), (None, "a B c d e f", "s")]
    assert sorted((str(r[0]), r[1]) for r in drop_near_duplicates(frame(spark, rows)).collect()) == [
        ("7", rows[0][1]), ("None", "a B c d e f"), ("None", "of null ids")]
    assert near_duplicates(frame(spark, [])).count() == 0


def test_shingle_sets_of_long_texts_do_not_depend_on_chunks(monkeypatch):
    import pointframe.llm.jaccard_join as j
    text = prose(random.Random(5), 3000)
    whole = shingle_sets([text], 4)[0]
    monkeypatch.setattr(j, "CHUNK", 100)
    assert np.array_equal(whole, shingle_sets([text], 4)[0]) and len(whole) == len(sets_of([(0, text)], 4)[0])


def test_connected_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(500, 500), (7, 8)]
    got = {r.v: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(50)}


# -- toxicity

def toxic_rows(rng):
    rows, labels = [], []
    for i in range(900):
        w = prose(rng, 40, 300).split()
        bad = i % 6 == 0
        if bad:
            for _ in range(3):
                w[rng.randrange(len(w))] = rng.choice(["zorgle", "zorglung", "krivax"])
        rows.append((i, " ".join(w), "s"))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_separates_held_out_rows(spark):
    rows, labels = toxic_rows(random.Random(2))
    docs = frame(spark, [*rows, (5000, None, "s"), (5001, "", None), (None, "a b", "s")])
    table = spark.createDataFrame([*labels, (None, 1), (3, None), (6, 0)], "doc_id long, toxic int")
    scores = {r.id: r.score for r in score_toxicity(docs, table, learn=__import__("pyspark.sql.functions", fromlist=["expr"]).expr("id % 3 != 1"), slots=1 << 16).collect()}
    assert len(scores) == len(rows) + 3 and all(0 <= s <= 1 for s in scores.values())
    held = [(i, t) for i, t in labels if i % 3 == 1]
    assert sum((scores[i] >= 0.7) == bool(t) for i, t in held) >= 0.97 * len(held)
    assert scores[5000] == scores[5001] < 0.7
    left = {r[0] for r in drop_toxic(docs, table, slots=1 << 16).collect()}
    assert {5000, 5001, None} <= left and len(left & {i for i, t in labels if t}) <= 5


def test_toxicity_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in score_toxicity(frame(spark, [(1, "a", "s")]), none, slots=1 << 10).collect()} == {0.0}
    assert score_toxicity(frame(spark, []), none, slots=1 << 10).count() == 0


# -- secrets

PATTERNS = {
    "assign": re.compile(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile("AKIA[A-Z0-9]+"), "hex": re.compile("[0-9a-f]+")}


def base_spans(t):
    found = []
    for k, (kind, p) in enumerate(PATTERNS.items()):
        for m in p.finditer(t):
            if len(m[1] if kind == "assign" else m[0]) >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                found.append((m.start(), k, kind, m.end()))
    return ",".join(f"{kind}:{a}:{e}" for a, _, kind, e in sorted(found))


def test_base_spans_and_ownership(spark):
    rng = random.Random(4)
    bits = ["token=token:abcdefgh ", "PASSWORD = 'hunter22' ", "api_key:\"a/b+c=d.e\"", "AKIA" + "Z9" * 8, "AKIA123 ", "é😀 ", "0123456789abcdef" * 2 + " ",
            "secret=abc ", "passwd =x-y_z.0", "\n", "words and words ", "Apikey= 0123456789abcdef01234567 "]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(30))) for _ in range(120)] + ["deadbeef" * 3 + " é " + ("token=abcdefg " * 1500)]
    live, copied = "Qw3rTy7uIoP9aSdF5gHjK", "ExAmPle1KeY2fRoM3dOcS4x"
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(900, None, "s"), (901, "", None), (902, f"é {live} here", "a")]
    rows += [(1000 + i, f"see {copied}", f"o{i % 4}") for i in range(40)]
    got = scan_secrets(frame(spark, rows)).select("id", join_spans("base").alias("base"), join_spans("spans").alias("spans")).collect()
    assert len(got) == len(rows)
    by = {r.id: r for r in got}
    for i, t, _ in rows:
        assert by[i].base == base_spans(t or ""), (i, t)
    assert by[902].spans == f"owned:2:{2 + len(live)}" and all(by[1000 + i].spans == "" for i in range(40))
    assert scan_secrets(frame(spark, [])).count() == 0


def test_an_owner_may_use_a_key_in_many_texts(spark):
    key = "Qw3rTy7uIoP9aSdF5gHjK"
    rows = [(i, f"text {i} {key}", "one") for i in range(9)]
    found = scan_secrets(frame(spark, rows)).collect()
    assert all([x.kind for x in r.spans] == ["owned"] for r in found)
    assert all(not r.spans for r in scan_secrets(frame(spark, rows), repository="doc_id").collect())
    assert all(r.spans for r in scan_secrets(frame(spark, rows), repository="doc_id", max_repositories=9).collect())


# -- lines

def test_line_dedup_keeps_one_line_per_component(spark):
    rng = random.Random(6)
    lines = [prose(rng, 40, 10**6) for _ in range(30)]
    near = lines[0].split()
    near[20] = "changed"
    rows = [(i, "\n".join([lines[i], lines[(i + 1) % 30], "", "  "]), "s") for i in range(30)]
    rows += [(100, " ".join(near), "s"), (101, lines[3].upper(), "s"), (102, None, "s"), (103, "", "s"), (104, "日本語" * 30, "s"), (105, "日本語" * 30 + "の違い" * 9, "s")]
    docs = frame(spark, rows)
    gone = {(r.id, r.line_no): (r.keep_id, r.keep_line) for r in duplicate_lines(docs).collect()}
    # line i stands in documents i - 1 (second) and i (first); the earlier document keeps it
    want = {(i, 0): (i - 1, 1) for i in range(1, 30)} | {(29, 1): (0, 0), (100, 0): (0, 0), (101, 0): (2, 1)}
    assert gone == want
    report = {r.id: (r.n_lines, r.n_dropped, r.dropped) for r in line_report(docs).collect()}
    assert report[5] == (4, 1, [0]) and report[102] == (1, 0, []) and len(report) == len(rows)
    left = drop_duplicate_lines(docs)
    assert left.columns == docs.columns
    text = {r[0]: r[1] for r in left.collect()}
    assert text[0] == rows[0][1] and text[5] == "\n".join([lines[6], "", "  "]) and text[102] is None and text[101] == ""
    assert duplicate_lines(frame(spark, [])).count() == 0


def test_line_dedup_recall_and_precision(spark):
    rng = random.Random(8)
    rows, pairs = [], []
    for k in range(150):
        w = prose(rng, 50, 10**6).split()
        rows.append((2 * k, " ".join(w), "s"))
        w[rng.randrange(50)] = "changed"
        rows.append((2 * k + 1, " ".join(w), "s"))
    gone = {r.id for r in duplicate_lines(frame(spark, rows)).collect()}
    pairs = {2 * k + 1 for k in range(150)}
    assert gone <= pairs and len(gone) >= 147


@pytest.mark.parametrize("make", [lambda r, n: prose(r, n, 10**6), lambda r, n: " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(4, 9))) for _ in range(n)),
                                  lambda r, n: "".join(chr(0x4E00 + r.randrange(3000)) for _ in range(5 * n))], ids=["numbers", "words", "unspaced"])
def test_line_dedup_finds_one_character_edits_in_short_and_unspaced_lines(spark, make):
    rng = random.Random(9)
    rows, want = [], set()
    grams = lambda t: {t[k:k + 5] for k in range(max(1, len(t) - 4))}
    for k in range(150):
        line = make(rng, 8 + k % 13)
        at = rng.randrange(len(line)) if k % 2 else len(line) - 1
        other = line[:at] + "#" + line[at + 1:]
        rows += [(2 * k, line, "s"), (2 * k + 1, other, "s")]
        a, b = grams(line), grams(other)
        if len(a & b) >= 0.8 * len(a | b):
            want.add(2 * k + 1)
    gone = {r.id for r in duplicate_lines(frame(spark, rows)).collect()}
    assert gone <= want and len(want) >= 75 and len(gone) >= 0.97 * len(want)


def test_line_sets_and_keys_do_not_depend_on_runs(monkeypatch):
    import pointframe.llm.line_dedup as d
    lines = [prose(random.Random(5), 300), "abc", "日本語" * 50, "x" * 9, "a"] * 3
    sets, keys = [x.tolist() for x in d.shingle_sets(lines)], d.band_keys(lines, 4, 3)
    assert [len(x) for x in sets] == [len({t[k:k + 5] for k in range(max(1, len(t) - 4))}) for t in lines]
    assert (keys[:5] == keys[5:10]).all() and len({tuple(k) for k in keys.tolist()}) == 5
    monkeypatch.setattr(d, "CHUNK", 50)
    monkeypatch.setattr(d, "LINES", 2)
    assert sets == [x.tolist() for x in d.shingle_sets(lines)] and (keys == d.band_keys(lines, 4, 3)).all()


def test_line_components_match_brute_force(spark):
    """Every candidate pair is decided exactly: with one minimum in a band and many bands no pair of 0.8 is missed here."""
    rng = random.Random(11)
    base = [prose(rng, 12, 300) for _ in range(12)]
    lines = {}
    for k in range(240):
        t = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 2, 3, 5, 8])):
            t[rng.randrange(len(t))] = rng.choice("abcxyz #")
        lines[k] = " ".join("".join(t).split())
    sets = {k: {t[i:i + 5] for i in range(max(1, len(t) - 4))} for k, t in lines.items()}
    root = {k: k for k in lines}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in lines:
        for b in range(a):
            if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    gone = {r.id: r.keep_id for r in duplicate_lines(frame(spark, [(k, t, "s") for k, t in lines.items()]), bands=40, rows=1).collect()}
    assert {k: gone.get(k, k) for k in lines} == {k: find(k) for k in lines}


def test_line_sets_are_stored_by_a_dictionary(spark):
    """Hashes that many lines share take a place in a dictionary each time, also when there are more of them than Parquet's usual dictionary holds."""
    import os

    from pyspark.sql import functions as F

    from pointframe.llm.common import materialize
    from pointframe.llm.line_dedup import SETS_AS
    # skewed as the shingles of texts are: a few are everywhere, most come once or twice
    draw = lambda k: F.floor(600_000 * F.pow(F.pmod(F.xxhash64("id", k), F.lit(1 << 20)) / (1 << 20), 6.0))
    sets = spark.range(0, 20_000, 1, 1).select("id", F.transform(F.sequence(F.lit(0), F.lit(59)), lambda k: F.xxhash64(draw(k))).alias("tokens"))
    size = lambda t: sum(os.path.getsize(f.removeprefix("file://")) for f in t.inputFiles())
    usual, small = materialize(sets, "sets"), materialize(sets, "sets", **SETS_AS)
    assert size(small) < 0.75 * size(usual)
    assert small.exceptAll(sets).isEmpty() and small.count() == 20_000
