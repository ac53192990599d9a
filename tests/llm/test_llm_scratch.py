"""Scratch tables of the similarity joins: what goes when, what is stored, and which heads sets are compared with."""

import os
import time

import pytest
from pyspark.sql import functions as F

from pointframe.llm import common
from pointframe.llm.common import in_parts, materialize, parted, scratch
from pointframe.llm.jaccard_join import drop_near_duplicates
from pointframe.llm.line_dedup import duplicate_lines, entries_that_meet, expand, shingle_sets
from pointframe.llm.relations import leaders


def held(path):
    return {name for _, dirs, _ in os.walk(path) for name in dirs}


@pytest.fixture
def shared(tmpdir_path, monkeypatch):
    monkeypatch.setattr(common, "shared_dir", lambda spark: f"file://{tmpdir_path}")
    return tmpdir_path


def copies(n=40):
    return [" ".join(f"w{(k * 7 + i) % 90 if i % 30 != k % 30 else k * 1000 + i}" for i in range(120)) for k in (0, 1, 2) for _ in range(n // 3)]


def test_tables_of_a_block_go_and_kept_ones_stay(spark, shared):
    with scratch() as keep:
        inner = materialize(spark.range(5), "inner")
        with scratch() as keep_inner:
            low = keep_inner(materialize(inner.selectExpr("id + 1 as id"), "lowest"), "low")
        assert "lowest" not in held(shared) and {"inner", "low"} <= held(shared)
        kept = keep(low.where("id > 2"), "kept")
    assert held(shared) & {"inner", "low", "lowest", "kept"} == {"kept"}
    assert sorted(r.id for r in kept.collect()) == [3, 4, 5]
    with pytest.raises(ZeroDivisionError), scratch():
        materialize(spark.range(2), "failed")
        1 / 0
    assert "failed" not in held(shared) and materialize(spark.range(2), "after").count() == 2


def test_joins_leave_no_sets_or_lists_behind(spark, shared):
    rows = [(i, t + f" end{i}") for i, t in enumerate(copies())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    large = {"sizes", "prefixes", "listed", "sets", "right", "overlaps", "placed", "mixed", "groups", "members", "hooked", "keyed", "posts"}
    assert drop_near_duplicates(docs).count() < len(rows)
    assert "gone" in held(shared) and not held(shared) & (large | {"rows", "links", "near"})
    lines = spark.createDataFrame([(i, f"a line that many texts hold, number {i % 3}\nown words {i} of text {i * i}") for i in range(12)], "doc_id long, text string")
    assert duplicate_lines(lines).count() > 0
    assert not held(shared) & (large - {"groups"})


def test_a_head_that_links_with_nobody_is_no_leader(spark):
    """Set 0 has too many private tokens to link with the others, which are all on its lists."""
    rows = [(h, i, 100, 2 if i else 30, 98 if i else 70) for h in range(40) for i in range(10)]
    posts = spark.createDataFrame(rows, "h long, id long, n long, pos long, cap long")
    got = {r.a: r.b for r in leaders(posts, 80, 100, 3).collect()}
    assert got == {i: 1 for i in range(2, 10)}


def test_a_much_shorter_head_is_no_leader_of_longer_sets(spark):
    rows = [(h, i, 100 if i else 50, 0, 100 if i else 50) for h in range(40) for i in range(6)]
    posts = spark.createDataFrame(rows, "h long, id long, n long, pos long, cap long")
    assert {r.a: r.b for r in leaders(posts, 80, 100, 3).collect()} == {i: 1 for i in range(2, 6)}


def test_sets_are_made_of_the_lines_of_pairs(spark):
    lines = ["the quick brown fox", "abc", "the quick brown fax", "\u00e9t\u00e9 \U0001f600 x"]
    pairs = [(i, j, a, b) for i, a in enumerate(lines) for j, b in enumerate(lines)]
    got = expand(spark.createDataFrame(pairs, "a long, b long, ta string, tb string")).collect()
    sets = [x.tolist() for x in shingle_sets(lines)]
    assert sorted((r.a, r.b, r.ta, r.tb) for r in got) == [(i, j, sets[i], sets[j]) for i, j, _, _ in pairs]


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {str(files.apply(k)) for k in range(files.size()) if "shuffle_" in str(files.apply(k))}


def test_a_written_table_leaves_no_shuffle_files(spark, shared):
    before, setting = shuffle_files(spark), spark.conf.get(common.CLEANUP, None)
    counts = spark.range(20_000).groupBy((F.col("id") % 997).alias("k")).agg(F.count("*").alias("n"))
    table = materialize(counts.join(counts.withColumnRenamed("n", "m"), "k"), "counts")
    for _ in range(40):  # the files go in the background
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.25)
    assert not left and table.count() == 997 and spark.conf.get(common.CLEANUP, None) == setting


def test_entries_stay_that_share_two_lists_with_one_line(spark, shared):
    """1 and 2 share two lists, 3 and 4 three; 5 shares one list each with 1, 2 and 4; 6 is on one list."""
    lists = {1: (10, 20, 30), 2: (10, 20, 40), 3: (50, 60, 70), 4: (50, 60, 70, 80), 5: (30, 40, 80), 6: (10,)}
    listed = spark.createDataFrame([(i, h) for i, hs in lists.items() for h in hs], "id long, h long")
    got = lambda shared, most: {(r.id, r.h) for r in entries_that_meet(listed, shared, most).collect()}
    pair, triple = {(i, h) for i in (1, 2) for h in (10, 20)}, {(i, h) for i in (3, 4) for h in (50, 60, 70)}
    assert got(2, 1000) == pair | triple and triple <= got(3, 1000)
    every = {(i, h) for i, hs in lists.items() for h in hs}
    assert got(2, 5) == every - {(6, 10)} and got(1, 1000) == every


def test_pairs_of_lists_are_dealt_out_without_the_lists(spark, shared):
    """Lines 1 and 2 share the last two of 70 lists, 3 shares one with each; a bit per list comes back, beyond 64 of them too."""
    lists = {1: [*range(100, 168), 1000, 1001], 2: [*range(200, 268), 1000, 1001], 3: [100, 200, 300]}
    listed = spark.createDataFrame([(i, h) for i, hs in lists.items() for h in hs], "id long, h long")
    got = entries_that_meet(listed, 2, 100_000)
    assert {(r.id, r.h) for r in got.collect()} == {(i, h) for i in (1, 2) for h in (1000, 1001)}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    semi = next(x for x in plan.split("\n") if "LeftSemi" in x)
    assert "bit_or" in plan and semi and not any("other#" in x for x in plan.split("\n") if "Aggregate" in x)


def test_parts_are_written_in_turn_and_go_when_they_are_read(spark, shared, monkeypatch):
    """Of the parts that are still to be read and the one that is, shuffle files and tables take up space, of no other."""
    rows = spark.range(40).selectExpr("id % 8 as k", "id")
    assert [r.n for part in in_parts(rows, 1, "k") for r in part.groupBy().agg(F.count("*").alias("n")).collect()] == [40]
    monkeypatch.setattr(common, "PART_ROWS", 1)
    folders = lambda: {d for d in held(shared) if d.startswith("part_=")}
    with scratch() as keep:
        whole, parts = parted(rows, F.col("k") % 4)
        assert whole.count() == 40 and whole.columns == ["k", "id"]
        seen = []

        def counted():
            for part in parts:
                seen.append(folders())
                yield part.groupBy("k").agg(F.count("*").alias("n"))

        table = keep(counted(), "counted")
        assert seen == [{f"part_={j}" for j in range(k, 4)} for k in range(4)] and not folders()
    assert sorted((r.k, r.n) for r in table.collect()) == [(k, 5) for k in range(8)]


def test_lines_in_parts_give_the_same_groups(spark, shared, monkeypatch):
    words = "the quick brown fox jumps over a lazy dog while seven old wizards quietly mix poison under pale moonlight".split()
    line = lambda k: " ".join(words[(k * 5 + i) % len(words)] for i in range(14))
    rows = [(i, f"{line(i % 7)} {i % 3}\nown {i * i} words {i}\n{line(i % 7)}") for i in range(30)] + [(None, None), (3, line(2))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = lambda: sorted(map(tuple, duplicate_lines(docs).collect()), key=repr)
    whole = found()
    written = []
    monkeypatch.setattr(common, "PART_ROWS", 1)
    monkeypatch.setattr(common, "_shuffles_go", lambda spark, go=common._shuffles_go: written.append(1) or go(spark))
    assert found() == whole and len(whole) > 30 and len(written) > 30
