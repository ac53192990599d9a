"""Benchmark decontamination by spaced seeds.

A fixed mask such as 11011011 looks at some of eight neighbouring words and
ignores the others, so a substituted word at an ignored position leaves the hash
as it was. Hashes of all masks at every position of the benchmark items are
joined with those of the documents. Around each hit the document's words are
laid against the item's on the hit's diagonal, and the pair counts as an overlap
when a window of ``min_words`` words (or the whole of a shorter item) agrees in
at least ``similarity`` of its positions, whatever was substituted.

Words are runs of letters, marks and digits, lower-cased. All steps are DataFrame expressions: documents
are scanned once and never shuffled while the seed table is small enough to
broadcast (checked by its count; beyond that the same join shuffles).

An item of fewer than ``SHORT`` words has masks of its own length: its positions are
cut into groups, and each mask ignores as many groups as substitutions are
admitted, so whichever words are substituted, one mask ignores them all.

While the seeds are few enough to broadcast, positions stay beside their text and only hits cut
their window out of it. Beyond that positions move, and each carries its window of words, cut
before the join, so what moves does not grow with a text's length.

Defined results: null, blank and pure-punctuation texts overlap nothing. Repeated documents or
items give one row per pair of ids; a null id is an id like others. Empty tables
give no rows; other columns are not read.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointframe.llm.common import is_small, materialize, pick, plain, sized

# spaced seeds (1 = compared, 0 = ignored); the first alone hits every way to substitute
# two of thirteen words, the second also some ways to substitute three
MASKS = ("11010011", "1100101011")
# fixed value: words are runs of letters, marks and digits
NO_WORD = r"[^\p{L}\p{M}\p{N}]+"
SEED_ROWS = 4_000_000
SHORT = 12


def word_hashes(text: Column) -> Column:
    """Words of a text as 64-bit hashes, in order."""
    t = F.lower(F.coalesce(text, F.lit("")))
    return F.transform(F.array_remove(F.split(t, NO_WORD, -1), ""), lambda w: F.xxhash64(w))


def own_masks(words: int, similarity: float) -> tuple[str, ...]:
    """Masks for an item of so many words: of groups of its positions each ignores as many as may be substituted."""
    wrong = words - math.ceil(words * similarity)
    if not wrong:
        return ("1" * words,)
    groups = min(words, wrong + 2)
    held = [i * groups // words for i in range(words)]
    return tuple("".join("0" if g in out else "1" for g in held) for out in combinations(range(groups), wrong))


def _key(array: Column, pos: Column, mask: str, number: int) -> Column:
    return F.xxhash64(F.lit(number), *[F.get(array, pos + i) for i, x in enumerate(mask) if x == "1"])


def _keys(array: Column, pos: Column, masks: dict[int, str]) -> Column:
    size = F.size(array)
    return F.array(*[F.when(pos + len(m) <= size, _key(array, pos, m, k)) for k, m in masks.items()])


def _items(benchmark: DataFrame, id: str, text: str) -> DataFrame:
    return (pick(benchmark, item_id=id, text=text).select("item_id", word_hashes(F.col("text")).alias("item"))
            .where("size(item) > 0").distinct())


def seeds(items: DataFrame, masks: dict[int, str], short: dict[int, dict[int, str]]) -> DataFrame:
    """Seed table: key, item_id, item_pos, item (the item's word hashes). ``short``: the masks of items of so many words."""
    long_ = items.where(F.size("item") >= SHORT).select("item_id", "item", F.posexplode("item").alias("item_pos", "w")).drop("w")
    out = long_.withColumn("key", F.explode(_keys(F.col("item"), F.col("item_pos"), masks)))
    for n, own in short.items():
        at = items.where(F.size("item") == n).withColumn("item_pos", F.lit(0))
        out = out.unionByName(at.withColumn("key", F.explode(_keys(F.col("item"), F.col("item_pos"), own))))
    return out.where("key is not null").select("key", "item_id", "item_pos", "item")


def windows(docs: DataFrame, masks: dict[int, str], before: int, after: int) -> DataFrame:
    """Per position and mask of ``docs`` (id, ws): id, key, pos (place in the window), ws (the window's words)."""
    n = F.size("ws")
    at = F.transform(F.sequence(F.lit(0), n - 1), lambda p: F.struct(
        F.least(F.lit(before), p).alias("pos"), F.slice("ws", F.greatest(F.lit(1), p - before + 1), F.least(F.lit(before), p) + after).alias("ws")))
    cut = docs.select("id", F.explode(F.when(n > 0, at)).alias("at")).select("id", "at.pos", "at.ws")
    return cut.select("id", "pos", "ws", F.explode(_keys(F.col("ws"), F.col("pos"), masks)).alias("key")).where("key is not null")


def agreement(hits: DataFrame, width: int, *keep: str) -> DataFrame:
    """Adds ``matched``: the most words that agree in any window of ``width`` words around the hit.

    ``hits`` has ws, pos, item, item_pos. Both word lists are cut to less than a
    window on either side of the hit and laid side by side; a long keeps a bit for
    each position that agrees, and a window is a run of ``width`` bits.
    """
    if not 0 < width <= 32:
        raise ValueError("min_words must lie between 1 and 32")
    near = hits.select(*keep, "ws", "pos", "item", "item_pos", F.least(F.lit(width - 1), "pos", "item_pos").alias("lead"))
    cut = near.select(*keep, F.slice("ws", F.col("pos") - F.col("lead") + 1, F.col("lead") + width).alias("a"),
                      F.slice("item", F.col("item_pos") - F.col("lead") + 1, F.col("lead") + width).alias("b"))
    same = F.zip_with("a", "b", lambda x, y: F.when(x == y, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long")))
    bits = cut.select(*keep, F.aggregate(same, F.lit(0).cast("long"), lambda acc, x: acc * 2 + x).alias("bits"))
    one = F.lit((1 << width) - 1).cast("long")
    counts = [F.bit_count(F.shiftright("bits", j).bitwiseAND(one)) for j in range(width)]
    return bits.select(*keep, (F.greatest(*counts) if width > 1 else counts[0]).alias("matched"))


def find_overlaps(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", *,
                  item_id: str = "item_id", item_text: str = "text", masks: tuple[str, ...] = MASKS,
                  min_words: int = 13, similarity: float = 0.8, max_broadcast: int = SEED_ROWS) -> DataFrame:
    """One row per document and item that overlap: id, item_id, item_words, matched, overlap.

    ``matched`` is the largest number of agreeing words in a window on one diagonal;
    ``overlap`` divides it by the window's length.
    """
    items = materialize(_items(benchmark, item_id, item_text), "items")
    lengths = sorted(r["n"] for r in items.where(F.size("item") < SHORT).select(F.size("item").alias("n")).distinct().collect())
    general, short, number = dict(enumerate(masks)), {}, len(masks)
    for n in lengths:  # fewer than SHORT
        short[n] = dict(enumerate(own_masks(n, similarity), number))
        number += len(short[n])
    table = materialize(seeds(items, general, short), "seeds")
    hashed = pick(docs, id=id, text=text).select("id", word_hashes(F.col("text")).alias("ws"))
    every = general | {k: m for own in short.values() for k, m in own.items()}
    if is_small(table, max_broadcast):
        at = hashed.select("id", "ws", F.posexplode_outer("ws").alias("pos", "w")).drop("w")
        at = at.select("id", "ws", "pos", F.explode(_keys(F.col("ws"), F.col("pos"), every)).alias("key")).where("key is not null")
        hits = at.join(F.broadcast(table), "key")
    else:
        hits = windows(hashed, every, min_words - 1, max(min_words, *map(len, every.values()))).join(table, "key")
    scored = agreement(hits.withColumn("item_words", F.size("item")), min_words, "id", "item_id", "item_words")
    width = F.least(F.lit(min_words), F.col("item_words"))
    # the threshold stands above the aggregate: inside the join's condition it would keep the join,
    # and with it the rows' word lists, out of generated code
    best = scored.groupBy("id", "item_id").agg(F.max("item_words").alias("item_words"), F.max("matched").alias("matched"))
    return best.where(F.col("matched") >= F.ceil(width * F.lit(similarity))).withColumn("overlap", F.col("matched") / width)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that overlap some benchmark item. Rows are told apart by id and text."""
    tmp, names = plain(docs)
    i, t = f"c{names.index(id)}", f"c{names.index(text)}"
    key = F.xxhash64(F.col(i), F.col(t), F.col(t).isNull())
    keyed = tmp.select(key.alias("key"), F.col(t).alias("text"))
    found = materialize(find_overlaps(keyed, benchmark, "key", "text", **options).select(F.col("id").alias("bad_")).distinct(), "leaks")
    return tmp.join(sized(found, 4_000_000), key == F.col("bad_"), "left_anti").toDF(*names)
