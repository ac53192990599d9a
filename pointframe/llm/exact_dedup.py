"""Exact deduplication over an extendible-hash index kept on shared files.

Keys are 64-bit hashes of the whole text. A directory over the leading bits of the keys
addresses buckets: it doubles, and overfull buckets split, until no bucket holds more
than ``capacity`` keys. Directory and buckets are tables below the shared folder; the
driver holds their depth only.

Texts whose key comes once are entries as they are. Texts that share a key are
compared byte by byte (grouped by bucket, key and text, which combines map-side, so a
text that a third of all rows share is one row per map task); what differs under one key
becomes a chain of entries, each with the row that stays and the size of its group.
Owner tasks hold ranges of (bucket, key), number the chains and write the index in that
order. A row finds its decision through the directory: its key's slot names the bucket, and the
bucket's entry (of a chain: the one with its bytes) the row that stays.

Defined results: null text counts as the empty text, and empty texts equal each
other. The row with the largest id stays; null ids sort lowest. Rows that
repeat one id and text count one by one in ``group_size`` and share their
decision (``drop_duplicates_exact`` keeps one of them). An empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointframe.llm.common import materialize, pick, plain, sized

MAX_DOUBLINGS = 8  # beyond the depth that evenly spread keys need; a bucket that is overfull still stays so


def _prefix(key: Column, depth: int) -> Column:
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def directory(keys: DataFrame, capacity: int) -> tuple[DataFrame, int]:
    """The directory (slot, bucket, depth of the bucket, n) of a written table of distinct keys, and its depth.

    A slot is a prefix at the directory's depth; several slots can point at one bucket, which has
    the first of them as its number. Each doubling counts only below the overfull buckets.
    """
    depth = max(0, math.ceil(math.log2(max(1, keys.count()) / capacity)))
    done, over, last = [], None, depth + MAX_DOUBLINGS
    while True:
        prefix = _prefix(F.col("key"), depth)
        rows = keys if over is None else keys.join(over, _prefix(F.col("key"), depth - 1) == F.col("full"), "left_semi")
        counts = materialize(rows.groupBy(prefix.alias("p")).agg(F.count("*").alias("n")), "counts")
        fits = F.col("n") <= (capacity if depth < last else 1 << 62)
        done.append((counts.where(fits), depth))
        over = sized(materialize(counts.where(~fits).select(F.col("p").alias("full")), "overfull"))
        if over.isEmpty():
            break
        depth += 1
    buckets = None
    for found, d in done:
        low = F.shiftleft("p", depth - d)
        slots = found.select(F.explode(F.sequence(low, F.shiftleft(F.col("p") + 1, depth - d) - 1)).alias("slot"),
                             low.alias("bucket"), F.lit(d).alias("depth"), "n")
        buckets = slots if buckets is None else buckets.unionByName(slots)
    return materialize(buckets, "directory"), depth


def bucketed(rows: DataFrame, slots: DataFrame, depth: int) -> DataFrame:
    """``rows`` (key) with the bucket that the directory names."""
    at = rows.withColumn("slot", _prefix(F.col("key"), depth))
    return at.join(sized(slots.select("slot", "bucket")), "slot").drop("slot")


def build_index(texts: DataFrame, rows: DataFrame, capacity: int = 50_000) -> tuple[DataFrame, DataFrame, int]:
    """The index (bucket, key, chain, entry, keep_id, group_size, text), its directory and the directory's depth.

    ``texts``: id, key, text; ``rows``: the same without the texts, written. ``chain`` is the
    number of entries with the same key and ``entry`` the place among them; only chains of two and more carry their texts.
    """
    keys = materialize(rows.groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("id")), "keys")
    slots, depth = directory(keys, capacity)
    keys = bucketed(keys, slots, depth)
    once = keys.where("n = 1").select("bucket", "key", F.col("id").alias("keep_id"), F.col("n").alias("group_size"), F.lit(None).cast("string").alias("text"))
    often = sized(materialize(keys.where("n > 1").select("bucket", "key"), "often"))
    same = texts.join(often, "key").groupBy("bucket", "key", "text").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    owned = once.unionByName(same.select(*once.columns)).repartitionByRange("bucket", "key")
    chain = Window.partitionBy("bucket", "key")
    owned = owned.withColumn("chain", F.count("*").over(chain)).withColumn("entry", F.row_number().over(chain.orderBy("text")))
    owned = owned.withColumn("text", F.when(F.col("chain") > 1, F.col("text")))
    return materialize(owned.select("bucket", "key", "chain", "entry", "keep_id", "group_size", "text"), "index"), slots, depth


def decide(texts: DataFrame, rows: DataFrame, index: DataFrame, slots: DataFrame, depth: int) -> DataFrame:
    """``rows`` with keep_id and group_size, looked up in the index; a key without a group there is its row's own."""
    groups = index.where("group_size > 1 and chain = 1").select("bucket", "key", "keep_id", "group_size")
    chained = index.where("chain > 1").select("bucket", "key", "keep_id", "group_size", F.col("text").alias("bytes"))
    at = bucketed(rows, slots, depth)
    if not chained.isEmpty():  # two texts with one key: the row's bytes tell which entry is its own
        twins = materialize(chained.select("bucket", "key").distinct(), "twins")
        mine = bucketed(texts, slots, depth).join(sized(twins), ["bucket", "key"])
        found = mine.join(chained, ["bucket", "key"]).where("text = bytes").select(*at.columns, "keep_id", "group_size")
        at = at.join(sized(twins), ["bucket", "key"], "left_anti")
    groups = sized(materialize(groups, "groups"))
    out = at.join(groups, ["bucket", "key"], "left").withColumn("grouped", F.col("group_size").isNotNull())
    out = out.select(*at.columns, F.when(F.col("grouped"), F.col("keep_id")).otherwise(F.col("id")).alias("keep_id"),
                     F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"))
    return out if chained.isEmpty() else out.unionByName(found)


def keyed_texts(docs: DataFrame, id: str, text: str) -> DataFrame:
    texts = pick(docs, id=id, text=text).select("id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.select("id", F.xxhash64("text").alias("key"), F.sha2("text", 256).alias("sha"), "text")


def exact_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", capacity: int = 50_000) -> DataFrame:
    """Per row of ``docs``: id, key, sha, keep_id, group_size, kept."""
    texts = keyed_texts(docs, id, text)
    rows = materialize(texts.drop("text"), "rows")
    index, slots, depth = build_index(texts, rows, capacity)
    decided = decide(texts, rows, index, slots, depth).drop("bucket")
    return decided.withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")))


def drop_duplicates_exact(docs: DataFrame, id: str = "doc_id", text: str = "text", capacity: int = 50_000) -> DataFrame:
    """``docs`` with one row per distinct text, its columns as they were."""
    decisions = materialize(exact_dedup(docs, id, text, capacity).select("id", "key", "sha", "kept"), "decisions")
    tmp, names = plain(docs)
    i, t = f"c{names.index(id)}", f"c{names.index(text)}"
    tmp = tmp.withColumn("h_", F.xxhash64(F.coalesce(t, F.lit(""))))

    def same(keys: DataFrame):
        return (F.col("h_") == keys["key"]) & tmp[i].eqNullSafe(keys["id"])

    gone = sized(materialize(decisions.where(~F.col("kept")).select("key", "id").distinct(), "gone"), 4_000_000)
    rest = tmp.join(gone, same(gone), "left_anti")
    again = materialize(decisions.where("kept").groupBy("key", "id").count().where("count > 1").select("key", "id"), "again")
    if not again.isEmpty():  # rows that repeat one id and text: one of them stays
        again = sized(again, 4_000_000)
        once = rest.join(again, same(again), "left_semi").dropDuplicates([i, "h_"])
        rest = rest.join(again, same(again), "left_anti").unionByName(once)
    return rest.drop("h_").toDF(*names)
