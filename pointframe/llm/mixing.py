"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Targets: the sources in code-point order (null last) weigh 1, 2, 3, repeating,
and share all words; a target stops at ``cap`` times its source's words and the
excess is reshared by weight until none is above.

Drawing: every source is a deck of blocks, its documents dealt by a hash of
(seed, source, id). A source's target is so many whole passes over its deck plus
a rest; the rest takes blocks in their permuted order, then documents in the
permuted order of the last block, then the leading words of one last document,
so the words taken meet the rounded target exactly. The blocks drawn (a block counts
once for every pass that takes it, the cut last block included) are
partitioned among the output shards by a binary tree: each node knows how many
draws of each source it holds, and draws from the multivariate hypergeometric
distribution how many of each go to its left half. Shards so get disjoint
permuted runs of every source; a block's draws stay together, in the shard of the
first of them, so a shard's number is exact up to the draws of one block. Inside a shard the documents are
ordered by a hash (a local shuffle).

The driver holds one row per source and the tree's counts (sources x shards,
checked against ``max_cells``); everything per document stays in Spark. Draws
hang on the seed alone, so reruns agree.

Defined results: null or blank texts have size 0 and are taken 0 times; rows
that repeat one id, source and size are dealt as one item and share what it is
taken, the first copies first. A null source is a source of its own. An empty
table gives an empty mix. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pointframe.llm.common import materialize, pick, word_count


def targets(sizes: list[int], cap: float = 3.0, weights: tuple[int, ...] = (1, 2, 3)) -> list[float]:
    """Target per source (in order) by filling up: capped sources pass their excess on."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    out, open_, left = [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s > 0], float(sum(sizes))
    while open_:
        unit = left / sum(w[i] for i in open_)
        full = [i for i in open_ if unit * w[i] > cap * sizes[i]]
        if not full:
            for i in open_:
                out[i] = unit * w[i]
            return out
        for i in full:
            out[i] = cap * float(sizes[i])
            left -= out[i]
        open_ = [i for i in open_ if i not in set(full)]
    return out


def split_tree(blocks: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """blocks[s] of each source dealt to ``shards`` leaves: an array (shards, sources) that sums to it."""
    out = np.zeros((shards, len(blocks)), dtype=np.int64)

    def node(counts: np.ndarray, low: int, high: int) -> None:
        if high - low == 1:
            out[low] = counts
            return
        mid, total = (low + high) // 2, int(counts.sum())
        left = total * (mid - low) // (high - low)
        rng = np.random.default_rng([seed, low, high])
        draw = np.zeros_like(counts)
        need, rest = left, total
        for i, c in enumerate(counts):  # the marginals of the multivariate law, one source after another
            rest -= int(c)
            draw[i] = _hypergeometric(rng, int(c), rest, need)
            need -= int(draw[i])
        node(draw, low, mid)
        node(counts - draw, mid, high)

    node(np.asarray(blocks, dtype=np.int64), 0, shards)
    return out


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    low, high = max(0, draws - bad), min(good, draws)
    if low == high or good + bad >= 1_000_000_000:  # beyond the sampler's range the rounded mean, always feasible
        return min(high, max(low, round(draws * good / max(1, good + bad))))
    return int(rng.hypergeometric(good, bad, draws))


def mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", *, cap: float = 3.0,
        weights: tuple[int, ...] = (1, 2, 3), block_words: int = 50_000, shards: int = 16, draws_per_shard: int = 8, seed: int = 7,
        max_cells: int = 20_000_000) -> DataFrame:
    """Per row of ``docs``: id, source, size, source_size, target, passes, rest, taken, shard, position.

    ``passes`` whole copies and the first ``rest`` words are taken (``taken`` = passes x size + rest).
    ``shard`` and ``position`` place the document in the mix (all its copies together with its block);
    documents of which nothing is taken have no shard. A block holds at most about ``block_words`` words, and so few
    that a source's quota is ``draws_per_shard`` draws for each shard.
    """
    spark = docs.sparkSession
    rows = pick(docs, id=id, text=text, source=source).select("id", "source", word_count("text").alias("size"))
    items = materialize(rows.groupBy("id", "source", "size").agg(F.count("*").alias("n")), "items")
    stats = items.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words"), F.count("*").alias("items")).limit(max_cells + 1).collect()
    if len(stats) * shards > max_cells:
        raise ValueError(f"more than {max_cells} sources x shards; raise max_cells or group the sources")
    stats.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    goal = targets([r["words"] for r in stats], cap, weights)
    quota, decks = [], []
    for r, t in zip(stats, goal, strict=True):
        whole = round(t)
        passes, rest = divmod(whole, r["words"]) if r["words"] else (0, 0)
        quota.append((r["source"], r["words"], t, int(passes), int(rest)))
        block = max(1, min(block_words, whole // (shards * draws_per_shard)))
        decks.append(max(1, min(r["items"], math.ceil(r["words"] / block)), math.ceil(r["items"] / block_words)))
    table = spark.createDataFrame([(*q, n) for q, n in zip(quota, decks, strict=True)],
                                  "source string, source_size long, target double, passes long, rest_words long, blocks long")
    small = len(stats) * (shards + 8) * 8 <= 32 << 20
    table = F.broadcast(table) if small else table

    # the deck: a block by one hash, the order in it by another
    dealt = items.join(table.withColumnRenamed("source", "s_"), F.col("source").eqNullSafe(F.col("s_"))).drop("s_")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "source", "id", "size"), F.col("blocks")))
    dealt = dealt.withColumn("order", F.xxhash64(F.lit(seed + 1), "source", "id", "size"))
    sums = dealt.groupBy("source", "block").agg(F.sum(F.col("size") * F.col("n")).alias("block_words"))
    before = sums.withColumn("before", F.coalesce(F.sum("block_words").over(
        Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    before = materialize(before.select(F.col("source").alias("s_"), F.col("block").alias("b_"), "before"), "blocks")

    # the quota's draws, block after block: the blocks of the rest have one more than the others
    cut = before.join(table, F.col("source").eqNullSafe(F.col("s_"))).where("before < rest_words")
    cut = {r["s_"]: r["n"] for r in cut.groupBy("s_").agg((F.max("b_") + 1).alias("n")).collect()}
    draws = np.array([q[3] * n + cut.get(q[0], 0) for q, n in zip(quota, decks, strict=True)], dtype=np.int64)
    tree = np.cumsum(split_tree(draws, shards, seed), axis=0) if decks else np.zeros((shards, 0), int)
    ends = spark.createDataFrame([(q[0], q[3], cut.get(q[0], 0), tree[:, i].tolist()) for i, q in enumerate(quota)],
                                 "e_ string, p_ long, cut long, ends array<long>")
    before = before.join(F.broadcast(ends) if small else ends, F.col("s_").eqNullSafe(F.col("e_")))
    draw = F.col("b_") * F.col("p_") + F.least("b_", "cut")
    before = before.select("s_", "b_", "before", F.least(F.lit(shards - 1), F.size(F.filter("ends", lambda e: e <= draw))).alias("shard"))
    placed = dealt.join(before, F.col("source").eqNullSafe(F.col("s_")) & (F.col("block") == F.col("b_"))).drop("s_", "b_")
    in_block = Window.partitionBy("source", "block").orderBy("order", "id", "size")
    start = F.col("before") + F.coalesce(F.sum(F.col("size") * F.col("n")).over(
        in_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = placed.withColumn("start", start)
    placed = placed.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    rest = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest_words") - F.col("start") - (F.col("copy") - 1) * F.col("size")))
    return placed.select(
        "id", "source", "size", "source_size", "target", "passes", rest.alias("rest"),
        (F.col("passes") * F.col("size") + rest).alias("taken"), F.when(F.col("passes") * F.col("size") + rest > 0, F.col("shard")).alias("shard"),
        F.xxhash64(F.lit(seed + 2), "id", "copy").alias("position"))
