"""Exact dedup against grouping in Python; mixing against its contract."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from pointframe.llm.exact_dedup import bucketed, build_index, decide, directory, drop_duplicates_exact, exact_dedup
from pointframe.llm.mixing import mix, split_tree, targets

DOCS = "doc_id long, text string, source string, `TEXT` string, `key` int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "clash", 1) for i, t, s in rows], DOCS)


def test_exact_dedup_matches_grouping(spark):
    rows = [(i, f"text {i % 7}" if i % 3 else None, "a") for i in range(100)] + [(200, "", "a"), (5, "text 5", "a"), (None, "alone", None)]
    rows += [(1000 + i, "hot", "a") for i in range(3000)]
    got = exact_dedup(frame(spark, rows)).collect()
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[t or ""].append(i)
    want = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            want[(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest())] += 1
    assert Counter((r.id, r.keep_id, r.group_size, r.kept, r.sha) for r in got) == want


def test_repeated_rows_keep_one(spark):
    rows = [(1, "x", "a"), (3, "x", "a"), (3, "x", "a"), (4, "y", None), (None, None, "a")]
    out = drop_duplicates_exact(frame(spark, rows))
    assert out.columns == ["doc_id", "text", "source", "TEXT", "key"]
    assert sorted((r[0] or 0, r[1] or "") for r in out.collect()) == [(0, ""), (3, "x"), (4, "y")]


def test_exact_dedup_empty(spark):
    assert exact_dedup(frame(spark, [])).count() == 0
    assert drop_duplicates_exact(frame(spark, [])).count() == 0


def test_directory_splits_until_buckets_fit(spark, tmpdir_path):
    # a third of the keys share their first 4 bits, so one half of the directory is deeper
    keys = spark.range(5000).selectExpr("id", "if(id % 3 = 0, xxhash64(id) & 1152921504606846975, xxhash64(id)) as key")
    keys.write.parquet(f"{tmpdir_path}/keys")
    keys = spark.read.parquet(f"{tmpdir_path}/keys")
    slots, depth = directory(keys, 300)
    rows = slots.collect()
    assert sorted(r.slot for r in rows) == sorted({r.slot for r in rows}) and all(r.n <= 300 for r in rows)
    assert len({r.depth for r in rows}) > 1 and max(r.depth for r in rows) == depth
    assert sum(n for _, n in {(r.bucket, r.n) for r in rows}) == 5000
    held = bucketed(keys, slots, depth).groupBy("bucket").count().collect()
    assert {r.bucket: r["count"] for r in held} == {r.bucket: r.n for r in rows}


@pytest.mark.parametrize("capacity", [1, 50_000])
def test_equal_keys_chain(spark, capacity, tmpdir_path):
    """Different texts under one key are told apart by their bytes, in the index and in what rows look up."""
    made = [(1, 7, "a"), (2, 7, "b"), (3, 7, "b"), (None, 7, "c"), (9, -5, "d"), (8, -5, "d"), (4, 11, "e")]
    texts = spark.createDataFrame(made, "id long, key long, text string")
    texts.drop("text").write.parquet(f"{tmpdir_path}/rows")
    rows = spark.read.parquet(f"{tmpdir_path}/rows")
    index, slots, depth = build_index(texts, rows, capacity)
    got = {(r.key, r.chain, r.entry, r.keep_id, r.group_size, r.text) for r in index.collect()}
    assert got == {(7, 3, 1, 1, 1, "a"), (7, 3, 2, 3, 2, "b"), (7, 3, 3, None, 1, "c"), (-5, 1, 1, 9, 2, None), (11, 1, 1, 4, 1, None)}
    found = sorted(((r.id or 0, r.keep_id, r.group_size) for r in decide(texts, rows, index, slots, depth).collect()), key=str)
    assert found == sorted([(1, 1, 1), (2, 3, 2), (3, 3, 2), (0, None, 1), (9, 9, 2), (8, 9, 2), (4, 4, 1)], key=str)


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1000, 1, 1], [1, 2, 1000, 3, 0, 50], [0, 0], []])
def test_targets_fill_up(sizes):
    t = targets(sizes)
    assert all(x <= 3 * s + 1e-9 for x, s in zip(t, sizes, strict=True))
    assert abs(sum(t) - sum(sizes)) < 1e-6
    unit = [x / (1, 2, 3)[i % 3] for i, (x, s) in enumerate(zip(t, sizes, strict=True)) if s and x < 3 * s - 1e-9]
    assert not unit or max(unit) - min(unit) < 1e-6


def test_split_tree_is_exact_and_repeatable():
    blocks = np.array([100, 3, 0, 57])
    a, b = split_tree(blocks, 6, 1), split_tree(blocks, 6, 1)
    assert (a == b).all() and (a.sum(axis=0) == blocks).all() and (a >= 0).all()
    assert a.sum(axis=1).max() - a.sum(axis=1).min() <= 3


def test_mix_meets_targets(spark):
    rows = [(i, " ".join(["w"] * (i % 40)), "abc"[i % 3] if i % 10 else None) for i in range(400)]
    rows += [(9999, "five words are in here", "b")] * 50 + [(None, None, "zz"), (1, "a b", "rare"), (2, "w " * 5000, "long")]
    got = mix(frame(spark, rows), block_words=50).collect()
    assert len(got) == len(rows)
    words, size, goal = Counter(), Counter(), {}
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and (0 <= r.shard < 16 if r.taken else r.shard is None)
        words[r.source] += r.taken
        size[r.source] += r.size
        goal[r.source] = r.target
    order = sorted(size, key=lambda s: (s is None, s or ""))
    want = dict(zip(order, targets([size[s] for s in order]), strict=True))
    for s in order:
        assert abs(want[s] - goal[s]) < 1e-6 and abs(words[s] - goal[s]) <= 1
    again = mix(frame(spark, rows).repartition(7), block_words=50).collect()
    key = lambda r: tuple((x is None, x) for x in (r.id, r.source, r.size, r.taken, r.shard))
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mix_empty(spark):
    assert mix(frame(spark, [])).count() == 0


def test_every_shard_holds_its_part_of_every_source(spark):
    # a: a part of one pass; b: one pass and a rest; c: two passes and a rest
    rows = [(i, "w " * 10, "a" if i < 4000 else "b" if i < 5400 else "c") for i in range(6800)]
    got = mix(frame(spark, rows), block_words=20).collect()
    words, goal = Counter(), {}
    for r in got:
        words[r.source, r.shard] += r.taken
        goal[r.source] = r.target
    for s, target in goal.items():
        assert all(0.4 * target / 16 <= words[s, k] <= 1.7 * target / 16 for k in range(16)), (s, target / 16, [words[s, k] for k in range(16)])
    for k in range(16):
        assert abs(sum(words[s, k] for s in goal) - 68_000 / 16) <= 0.25 * 68_000 / 16


def test_production_parameters_put_every_source_in_every_shard(spark):
    rows = [(i, "w " * (20 + i % 30), f"s{i % 5}") for i in range(4000)] + [(9000 + i, "w " * 40, "s0") for i in range(3000)]
    got = [r for r in mix(frame(spark, rows)).collect() if r.taken]
    words = defaultdict(int)
    for r in got:
        words[r.source, r.shard] += r.taken
    goal = {r.source: r.target for r in got}
    for s, t in goal.items():
        held = [words[s, k] for k in range(16)]
        assert min(held) > 0 and max(held) < 3 * t / 16
    assert all(r.shard is None for r in mix(frame(spark, rows)).collect() if not r.taken)
