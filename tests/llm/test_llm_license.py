"""License scans against brute force over all blocks and notices."""

import random

import pytest

from pointframe.llm.license_scan import NOTICES, PHRASES, cut_texts, licensed, needed, scan_licenses, similar_blocks, stride, text_words

DOCS = "doc_id long, text string, word string, `TEXT` string, `row` int, block int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", "clash", 1, 2) for i, t in rows], DOCS)


def brute(text, phrases, notices, num, den):
    w, size = text_words(text or ""), stride(notices)
    places = sorted((i, label) for p, label in phrases for i in range(len(w)) if w[i:i + len(text_words(p))] == text_words(p))
    matches = []
    for k in range(max(1, -(-len(w) // size) - 1) if w else 0):
        held = set(w[k * size:(k + 2) * size])
        for label, t in notices:
            s = set(text_words(t))
            if len(held & s) * den >= len(s) * num:
                matches.append((k * size, min(len(w), (k + 2) * size), label, len(held & s) / len(s)))
    labels = {x[1] for x in places}
    return (len(w), places, sorted(matches), sorted(labels), sorted(labels | {m[2] for m in matches}),
            1.0 if places else max((m[3] for m in matches), default=0.0))


def got(df):
    return sorted(((r.id or 0, (r.n_words, [tuple(x) for x in r.places], [tuple(x) for x in r.matches], r.base_labels, r.labels, r.score)) for r in df.collect()), key=repr)


def texts(rng):
    pool = [w for _, t in NOTICES for w in t.split()] + ["lorem", "ipsum", "éa", "x1", "License,", "MIT", "license"]
    out = [None, "", " .,;\n", "mit license", "MIT\nLicense MIT-License mitlicense", "general public public license", "x" * 5000, "Ünïcode mit — license"]
    for _ in range(150):
        ws = [rng.choice(pool) for _ in range(rng.randrange(200))]
        for _ in range(rng.randrange(3)):
            notice = rng.choice(NOTICES)[1].split()
            for _ in range(rng.randrange(4)):
                notice[rng.randrange(len(notice))] = rng.choice(["some", "other"])
            at = rng.randrange(len(ws) + 1)
            ws[at:at] = notice
        out.append(rng.choice([" ", "\n", " * "]).join(ws))
    return out


@pytest.mark.parametrize("num", [90, 60, 100])
def test_scan_matches_brute_force(spark, num):
    rows = list(enumerate(texts(random.Random(num)))) + [(None, "Released under the MIT License."), (3, "again"), (3, "again")]
    assert got(scan_licenses(frame(spark, rows), num=num)) == sorted(((i or 0, brute(t, PHRASES, NOTICES, num, 100)) for i, t in rows), key=repr)


def test_a_long_text_is_scanned_whole(spark):
    text = "word " * 50_000 + "Licensed under CC BY-NC 4.0. " + "word " * 50_000 + NOTICES[2][1]
    r = scan_licenses(frame(spark, [(1, text)])).first()
    assert r.labels == ["bsd", "cc-by-nc"] and r.base_labels == [] and r.score == 1.0
    assert {m.label: m.first_word <= at < m.end_word for m, at in zip(r.matches, [50_000, 50_000, 100_010], strict=False)}["cc-by-nc"]


def test_other_notices_and_none(spark):
    docs = frame(spark, [(1, "alpha beta gamma delta"), (2, "alpha beta")])
    assert [r.labels for r in scan_licenses(docs, phrases=(("beta", "b"),), notices=(("x", "alpha gamma"),), num=100).orderBy("id").collect()] == [["b", "x"], ["b"]]
    assert [r.labels for r in scan_licenses(docs, phrases=(), notices=()).collect()] == [[], []]
    assert [r.id for r in licensed(docs, ["x"], notices=(("x", "alpha gamma"),)).collect()] == [1]


def test_empty_table(spark):
    assert scan_licenses(frame(spark, [])).count() == 0


def test_candidates_stay_narrow(spark):
    """No Python, no shuffle of blocks; the join with the notices is by prefix words."""
    docs = frame(spark, [(1, "Released under the MIT License. " * 20)])
    size = stride(NOTICES)
    pairs = similar_blocks(cut_texts(docs, "doc_id", "text", PHRASES, sorted({x for _, t in NOTICES for x in text_words(t)}), size), NOTICES, 90, 100, size)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "Python" not in plan and "Arrow" not in plan
    assert needed(7, 90, 100) == 7 and needed(30, 90, 100) == 27
