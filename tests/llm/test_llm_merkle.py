"""Merkle manifests against a plain fold in Python."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pointframe.llm import merkle
from pointframe.llm.common import pick
from pointframe.llm.merkle import fold, leaf_digest, merkle_manifest, prove, ranked, siblings

DOCS = "doc_id long, source string, lang string, n_chars long, text string, `TEXT` string, g int, digest int"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]])


def tree(digests):
    """Per node its siblings' digests level by level, and the last node."""
    paths, owners, nodes = [[] for _ in digests], [[k] for k in range(len(digests))], list(digests)
    while len(nodes) > 1:
        runs = range(0, len(nodes), 8)
        for k in runs:
            for i in range(k, min(k + 8, len(nodes))):
                for owner in owners[i]:
                    paths[owner].append(("".join(nodes[k:i]), "".join(nodes[i + 1:k + 8])))
        nodes, owners = [H(*nodes[k:k + 8]) for k in runs], [sum(owners[k:k + 8], []) for k in runs]
    return paths, nodes[0]


def expected(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0], leaf(r)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = tree([d for _, d in groups[g]])
    over, root = tree([trees[g][1] for g in names])
    return sorted(((i, g, d, trees[g][1], root, tuple(p + over[k]))
                   for k, g in enumerate(names) for (i, d), p in zip(groups[g], trees[g][0], strict=True)), key=repr)


def got(df):
    return sorted(((r.doc_id, r.lang, r.leaf, r.subroot, r.root, tuple((x.left, x.right) for x in r.path)) for r in df.collect()), key=repr)


def made(counts):
    rows = []
    for lang, n in counts.items():
        rows += [(len(rows) * 7 % 1009 if k % 50 else None, "s" if k % 3 else None, lang, k, f"text é {k % 40}" if k % 9 else None, "x", 1, 2) for k in range(n)]
    return rows + rows[:5]


@pytest.mark.parametrize("counts", [{"en": 1}, {"en": 8, None: 9, "": 1, "é": 65, "z": 64}, {f"l{k}": 1 + k % 3 for k in range(70)}])
def test_manifest_matches_a_plain_tree(spark, counts):
    rows = made(counts)
    assert got(merkle_manifest(spark.createDataFrame(rows, DOCS))) == expected(rows)


@pytest.mark.parametrize("broadcast", [20_000, 0])
def test_blocks_above_blocks(spark, monkeypatch, broadcast):
    """With blocks of 64 a group of 700 needs a tree of blocks over them; joined by broadcast or by shuffle."""
    monkeypatch.setattr(merkle, "DEPTH", 2)
    monkeypatch.setattr(merkle, "BLOCK", 64)
    monkeypatch.setattr(merkle, "MAX_BLOCKS", broadcast)
    rows = made({"en": 4200, "de": 64, "fr": 65, None: 1})
    assert got(merkle_manifest(spark.createDataFrame(rows, DOCS))) == expected(rows)


def test_tampering_is_found_and_only_there(spark):
    rows = made({"en": 100, "de": 3})
    docs = pick(spark.createDataFrame([(k, *r[1:]) for k, r in enumerate(rows)], DOCS), **{c: c for c in FIELDS})
    other = F.when(F.col("doc_id") % 5 == 0, F.concat(F.coalesce(docs["text"], F.lit("")), F.lit("!"))).otherwise(docs["text"])
    leaves = docs.select("doc_id", "lang", leaf_digest(*[docs[c] for c in FIELDS[:4]], docs["text"]).alias("leaf"),
                         leaf_digest(*[docs[c] for c in FIELDS[:4]], other).alias("shown"))
    out = prove(leaves, order="doc_id", group="lang", leaf="leaf", carry=("shown",))
    for r in out.select("doc_id", "root", fold(F.col("shown"), F.col("path")).alias("folded"), fold(F.col("leaf"), F.col("path")).alias("own"),
                        F.length(siblings(F.col("path"))).alias("size")).collect():
        assert r.own == r.root and (r.folded == r.root) == (r.doc_id % 5 != 0) and r["size"] % 64 == 0


def test_null_moved_between_fields_changes_the_leaf(spark):
    row = spark.range(1).select(leaf_digest(F.lit(None).cast("string"), F.lit("a")).alias("x"), leaf_digest(F.lit("a"), F.lit(None).cast("string")).alias("y"),
                                leaf_digest(F.lit("-"), F.lit("a")).alias("z"), leaf_digest(F.lit("é")).alias("e")).first()
    assert len(set(row)) == 4 and row.x == H("-", "1:a") and row.e == H("2:é")


def test_empty_table(spark):
    assert merkle_manifest(spark.createDataFrame([], DOCS)).count() == 0


def test_ranks_span_partitions(spark, tmpdir_path):
    spark.range(5000).selectExpr("if(id % 3 = 0, 'b', 'a') as g", "id * 31 % 5000 as v").write.parquet(f"{tmpdir_path}/t")
    out = ranked(spark.read.parquet(f"{tmpdir_path}/t"), "v").collect()
    for g in "ab":
        mine = sorted((r.rank, r.v) for r in out if r.g == g)
        assert [k for k, _ in mine] == list(range(len(mine))) and [v for _, v in mine] == sorted(v for _, v in mine)
        assert {r.n for r in out if r.g == g} == {len(mine)}


def test_one_shuffle_for_all_levels(spark):
    nodes = spark.range(100).selectExpr("string(id % 3) as g", "id as n", "id as rank", "sha2(string(id), 256) as digest")
    plan = merkle.rollup(nodes)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
