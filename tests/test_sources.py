"""Collections, range layout, tokenizers and sparse helpers."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from pointframe.functions import text as TX
from pointframe.operators import indexes as IX
from pointframe.operators import sparse as SP
from pointframe.sources.collection import make_checked_collection, validation_report, make_collection
from tests.conftest import SF_SMALL


def test_checked_collection_raises_and_quarantines(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0]), (3, [float("nan"), 1.0]), (None, [1.0, 1.0]), (4, None),
            (5, [0.5, 0.5])]
    df = spark.createDataFrame(rows, "id long, v array<float>")
    with pytest.raises(ValueError):
        make_checked_collection(df, "id", {"": ("v", 2, "Cosine")})
    rep = validation_report(make_collection(df, "id", {"": ("v", 2, "Cosine")})).first().asDict()
    assert rep == {"n_points": 7, "null_ids": 1, "duplicate_ids": 1, "vector_null": 1, "vector_bad_dim": 1,
                   "vector_non_finite": 1}
    q = make_checked_collection(df, "id", {"": ("v", 2, "Cosine")}, on_invalid="quarantine")
    assert sorted(r["id"] for r in q.df.collect()) == [1, 1, 4, 5]


def test_range_layout_lets_filters_skip_files(spark, tmpdir_path):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    path = os.path.join(tmpdir_path, "orders_by_price")
    IX.range_layout(orders, "o_totalprice", 8).write.parquet(path)
    back = spark.read.parquet(path)
    hit_files = (back.filter((F.col("o_totalprice") > 100000) & (F.col("o_totalprice") < 120000))
                     .select(F.input_file_name()).distinct().count())
    total_files = len([f for f in os.listdir(path) if f.endswith(".parquet")])
    assert total_files >= 6 and hit_files <= 2
    summary = IX.range_layout_summary(IX.range_layout(orders, "o_totalprice", 8), "o_totalprice").orderBy("lo").collect()
    assert all(a["hi"] <= b["lo"] for a, b in zip(summary, summary[1:]))  # ranges do not overlap


def test_tokenizer_bounds_and_prefix(spark):
    df = spark.createDataFrame([("Ab, cdef_gh  X1 é",)], "t string")
    got = df.select(TX.tokens(F.col("t"), "word").alias("w"), TX.tokens(F.col("t"), "multilingual").alias("m"),
                    TX.tokens(F.col("t"), "whitespace", lowercase=False).alias("s"),
                    TX.tokens(F.col("t"), "word", min_len=2, max_len=3).alias("b"),
                    TX.tokens(F.col("t"), "prefix", min_len=2, max_len=3).alias("p")).first()
    assert got["w"] == ["ab", "cdef_gh", "x1", "é"]
    assert got["m"] == ["ab", "cdef", "gh", "x1", "é"]
    assert got["s"] == ["Ab,", "cdef_gh", "X1", "é"]
    assert got["b"] == ["ab", "x1"]
    assert got["p"] == ["ab", "cd", "cde", "x1"]


def test_sparse_pack_explode_round_trip_and_dot(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(20)
    packed = SP.text_to_sparse(docs, "doc_id", "text")
    long = SP.explode_sparse(packed, "id", "sparse")
    direct = SP.token_counts(docs, "doc_id", "text")
    assert sorted(map(tuple, long.collect())) == sorted(map(tuple, direct.collect()))
    a, b = packed.orderBy("id").limit(2).collect()
    va = dict(zip(a["sparse"]["indices"], a["sparse"]["values"]))
    vb = dict(zip(b["sparse"]["indices"], b["sparse"]["values"]))
    want = sum(v * vb.get(i, 0.0) for i, v in va.items())
    lit = spark.createDataFrame([(a["sparse"], b["sparse"])],
                                "a struct<indices: array<int>, values: array<float>>, "
                                "b struct<indices: array<int>, values: array<float>>")
    got = lit.select(SP.sparse_dot(F.col("a"), F.col("b")).alias("d")).first()["d"]
    assert got == pytest.approx(want)
    assert np.isfinite(got)
