"""The pipeline stage by stage on the small tables, and the registered queries' columns and folds."""

import os
import re
import sys
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from pointframe.llm.mixing import targets  # noqa: E402
from pointframe.llm.queries import ORACLE, QUERIES  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def near_components(rows, n=5, num=80):
    sets = {}
    for i, t in rows:
        w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = frozenset(tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            by[g].append(i)
    pairs = {(a, b) for ids in by.values() for a in ids for b in ids if a < b}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= num * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: find(i) for i in sets}


def test_stages_on_the_small_tables(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact", "near", "benchmark", "mix"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    columns, held = docs.columns, {r.doc_id: r.text for r in docs.collect()}

    out = stage["toxicity"](spark, docs, SMALL)
    kept = {r.doc_id: r.text for r in out.collect()}
    assert out.columns == columns and set(kept) <= set(held)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    clean = {i for i, t in labels.items() if t == 0}
    assert len(clean & set(kept)) >= 0.97 * len(clean)

    out = stage["exact"](spark, docs, SMALL)
    largest = defaultdict(int)
    for i, t in held.items():
        largest[t] = max(largest[t], i)
    exact = {r.doc_id: r.text for r in out.collect()}
    assert out.columns == columns and set(exact) == set(largest.values())

    out = stage["near"](spark, docs, SMALL)
    roots = near_components(list(held.items()))
    assert out.columns == columns and {r.doc_id for r in out.collect()} == set(roots.values())

    out = stage["benchmark"](spark, docs, SMALL)
    items = [re.findall(r"\w+", r.text.lower()) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    left = {r.doc_id for r in out.collect()}
    grams = {tuple(w[k:k + 13]) for w in items for k in range(len(w) - 12)}
    for i, t in held.items():
        w = re.findall(r"\w+", t.lower())
        if any(tuple(w[k:k + 13]) in grams for k in range(len(w) - 12)):
            assert i not in left
    assert out.columns == columns and len(left) >= 0.9 * len(held)

    sizes = defaultdict(int)
    for r in docs.collect():
        sizes[r.source] += len(words(r.text))
    taken = defaultdict(int)
    for r in stage["mix"](spark, docs, SMALL).collect():
        taken[r.source] += r.taken
    order = sorted(sizes)
    for s, t in zip(order, targets([sizes[s] for s in order]), strict=True):
        assert abs(taken[s] - t) <= 1


def test_run_applies_every_stage(spark):
    out = corpus_pipeline.run(spark, SMALL)
    rows = out.collect()
    ids = [r.doc_id for r in rows]
    assert len(ids) == len(set(ids)) > 50 and all(0 < r.taken <= 3 * r.size for r in rows)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert len({texts[i] for i in ids}) == len(ids)


CONTRACT = {
    "op2_chat": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars", "op3_url_filter": "page_id host path rule verdict",
    "op4_mixing": "doc_id size source_size target taken", "op5_toxicity": "doc_id held_out score predicted",
    "op7_secrets": "doc_id n_assign n_access n_hex base_sha256 spans", "op8_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op9_jaccard": "doc_id n_shingles component_id", "op10_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op1_decontaminate": "doc_id item_id", "op6_line_dedup": "doc_id n_lines n_dropped"}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_queries_return_their_columns(spark, name):
    df = QUERIES[name](spark, SMALL)
    assert set(CONTRACT[name].split()) <= set(df.columns)
    rows = df.collect()
    if name in ("op4_mixing", "op5_toxicity", "op6_line_dedup", "op7_secrets", "op9_jaccard", "op10_exact_dedup"):
        assert len(rows) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    if name == "op5_toxicity":
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_their_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "conversations", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SMALL)
    cols = sorted(df.columns)
    got = sorted(tuple(r) for r in df.select(*[F.col(c) for c in cols]).collect())
    assert got == sorted(con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLE[name]})").fetchall())
