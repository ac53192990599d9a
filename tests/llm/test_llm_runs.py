"""Periodic runs against brute force, through the Spark operator and below it."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from pointframe.llm.periodic_runs import drop_repeats, find_runs, least_overlap, text_runs
from pointframe.llm.queries import op11_periodic_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, min_length=24, min_exponent=3):
    """Every stretch that cannot be extended, per period; the smallest period of a stretch stands."""
    n, found = len(words), {}
    for q in range(1, n):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(min_length, min_exponent * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def made(rng, n, letters):
    """Random words with planted repeats: copies of earlier stretches, once and several times."""
    words = [rng.choice(letters) for _ in range(rng.randrange(n))]
    for _ in range(rng.randrange(4)):
        p = rng.randrange(1, 12)
        unit = [rng.choice(letters) for _ in range(p)]
        at = rng.randrange(len(words) + 1)
        words[at:at] = (unit * 12)[:rng.randrange(p, 8 * p + 1)] * rng.choice([1, 1, 2])
    return words


@pytest.mark.parametrize("letters", ["ab", "abcdefgh", [f"w{i}" for i in range(200)]])
@pytest.mark.parametrize("rule", [(24, 3), (6, 2), (1, 2), (10, 4)])
def test_runs_match_brute_force(letters, rule):
    rng = random.Random(f"{letters}{rule}")
    docs = [made(rng, 120, letters) for _ in range(60)] + [["a"] * 100, ["a", "b"] * 60, [], ["a"], list("aab" * 40) + list("aab" * 3)]
    split, runs = text_runs([" ".join(d).encode() for d in docs], *rule)
    assert [[w.decode() for w in s] for s in split] == docs
    assert runs == [brute(d, *rule) for d in docs]


def test_least_overlap():
    assert least_overlap(24, 3) == 16 and least_overlap(1, 2) == 1


def test_one_word_many_times_is_not_quadratic():
    _, runs = text_runs([b"a " * 60_000, (b"a b c " * 20_000)], 24, 3)
    assert runs == [[(0, 60_000, 1)], [(0, 60_000, 3)]]


def test_defined_results(spark):
    rows = [(1, None, "x"), (None, "", "x"), (2, " \t\n ", "x"), (3, "go " * 30, "x"), (3, "go " * 30, "x"), (None, "é f " * 24, "x"), (4, "a b c", "x")]
    docs = spark.createDataFrame([(i, t, c, c) for i, t, c in rows], "doc_id long, text string, runs string, `TEXT` string")
    got = sorted(((r.id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in find_runs(docs).collect()))
    assert got == sorted([(1, 0, [], ""), (0, 0, [], ""), (2, 0, [], ""), (3, 30, [(0, 30, 1)], "go"), (3, 30, [(0, 30, 1)], "go"),
                          (0, 24, [(0, 24, 1)], "é f"), (4, 3, [], "a b c")])
    assert find_runs(docs.limit(0)).count() == 0
    assert drop_repeats(docs).columns == ["doc_id", "text"]
    with pytest.raises(ValueError):
        find_runs(docs, min_exponent=1)


def test_query_matches_brute_force(spark):
    small = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    want = []
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for i, t in texts.items():
        w = WORD.findall(t or "")
        n, h = len(w), zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        runs = brute(w)
        gone = {k for s, m, q in runs for k in range(s + q, s + m)}
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
        want.append((i, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2], sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
                     sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    cols = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = op11_periodic_runs(spark, small).select(*[F.col(c) for c in cols])
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint"] * 6 + ["string"] * 2
    assert sorted(map(tuple, got.collect())) == sorted(want) and sum(r[1] for r in want) > 5
