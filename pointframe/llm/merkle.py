"""Merkle manifest of a dataset: leaf per row, tree per group, one root, a proof for every row.

H is the lowercase hex SHA-256 of its concatenated inputs; digests go in as hex text.
Within a group leaves ascend by their order column, and every ``FAN`` consecutive
nodes become their H until one node remains, the group's subroot (a lone leaf is its
own). Subroots in the order of their groups make the root alike.

Ranks come from a range-partitioned sort and the counts of its partitions, so no group
passes through one task. A block is ``FAN ** DEPTH`` consecutive ranks of a group. Its
rows are shuffled together once; then the digits of the rank are grouped away, the
lowest first, and every grouping nests the structs of the children in the struct of
their parent. Transforms down the finished struct give each leaf its siblings level by
level, and one explode emits the rows: no level is joined with another. Blocks are the
leaves of the next tree above, which is made alike; only whole blocks are joined with
what stands above them (one row for ``FAN ** DEPTH`` rows, or for a group).

Defined results: a null group is a group and the first; groups are ordered by their
UTF-8 bytes. Rows that repeat an order value follow by leaf digest, equal leaves in any
order (their digests agree, their proofs differ by place). A null order value comes
first. An empty table has no rows and no root. Texts of any length are hashed whole;
other columns are not read, whatever they are called.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointframe.llm.common import materialize, pick, sized

FAN, DEPTH = 8, 4
BLOCK = FAN**DEPTH
MAX_BLOCKS = 20_000  # rows of a few KB that may be broadcast


def leaf_digest(*fields: Column) -> Column:
    """H of the fields: ``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    def tagged(c: Column) -> Column:
        s = c.cast("string")
        return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))

    return F.sha2(F.concat(*[tagged(c) for c in fields]), 256)


def levels(n: Column) -> Column:
    """How often ``FAN`` nodes become one until one of ``n`` is left."""
    return reduce(Column.__add__, [(n > FAN**k).cast("int") for k in range(21)])


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf leads to along its path (array of left, right: the siblings' digests beside the node)."""
    return F.aggregate(path, leaf, lambda node, side: F.sha2(F.concat(side["left"], node, side["right"]), 256))


def siblings(path: Column) -> Column:
    """All sibling digests of a path in one text, level by level, left to right."""
    return F.array_join(F.transform(path, lambda side: F.concat(side["left"], side["right"])), "")


def ranked(nodes: DataFrame, *order: str) -> DataFrame:
    """``nodes`` (g and others, a written table) with rank, from 0 within g, and n, the size of g."""
    laid = nodes.withColumn("tie", F.monotonically_increasing_id())
    laid = laid.repartitionByRange("g", *order, "tie").sortWithinPartitions("g", *order, "tie").drop("tie")
    laid = materialize(laid.withColumn("at", F.monotonically_increasing_id()), "laid")  # partition and place in it
    laid = laid.withColumn("part", F.shiftrightunsigned("at", 33))
    parts = laid.groupBy("g", "part").agg(F.count("*").alias("c"), F.min("at").alias("first"))
    whole = Window.partitionBy("g")
    before = F.sum("c").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = materialize(parts.select("g", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("offset"),
                                       F.sum("c").over(whole).alias("n")), "offsets")
    placed = laid.join(sized(offsets, 500_000), ["g", "part"])
    return placed.withColumn("rank", F.col("at") + F.col("offset")).drop("at", "part", "offset")


def rollup(nodes: DataFrame, *carried: str) -> DataFrame:
    """Blocks of ``nodes`` (g, n, rank, digest and the carried columns): g, n, block, node; a node has its digest and kids."""
    places = [F.floor(F.col("rank") / FAN**k).cast("long") for k in range(DEPTH + 1)]
    rows = nodes.select("g", "n", places[DEPTH].alias("block"), *[(places[k] % FAN).alias(f"digit{k}") for k in range(DEPTH)],
                        F.struct("digest", *carried).alias("node")).repartition("g", "block")
    for k in range(DEPTH):
        keys = ["g", "n", "block", *[f"digit{j}" for j in range(k + 1, DEPTH)]]
        rows = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(f"digit{k}", "node"))).alias("run"))
        kids = F.col("run")["node"]
        digest = F.when(levels(F.col("n")) > k, F.sha2(F.array_join(kids["digest"], ""), 256)).otherwise(F.element_at(kids, 1)["digest"])
        rows = rows.select(*keys, F.struct(digest.alias("digest"), kids.alias("kids")).alias("node"))
    return rows


def _leaves(node: Column, depth: int) -> Column:
    """The leaves below a node of ``depth`` levels: array of (node, path)."""
    kids = node["kids"]

    def beside(i: Column) -> Column:
        digests = kids["digest"]
        return F.struct(F.array_join(F.slice(digests, F.lit(1), i), "").alias("left"),
                        F.array_join(F.slice(digests, i + 2, F.lit(FAN)), "").alias("right"))

    def with_path(kid: Column, i: Column) -> Column:
        own = F.array(beside(i))
        if depth == 1:
            return F.array(F.struct(kid.alias("node"), own.alias("path")))
        return F.transform(_leaves(kid, depth - 1), lambda x: F.struct(x["node"].alias("node"), F.concat(x["path"], own).alias("path")))

    return F.flatten(F.transform(kids, with_path))


NO_PATH = "array<struct<left: string, right: string>>"


def _climb(nodes: DataFrame, *carried: str) -> tuple[DataFrame, DataFrame]:
    """(blocks of ``nodes`` with up, the path above the block, and top, the digest of their group's last node; groups g, digest)."""
    blocks = materialize(rollup(nodes, *carried), "blocks")
    if blocks.where(F.col("n") > BLOCK).isEmpty():
        return (blocks.withColumn("up", F.array().cast(NO_PATH)).withColumn("top", F.col("node.digest")),
                blocks.select("g", F.col("node.digest").alias("digest")))
    above = blocks.select("g", F.col("block").alias("rank"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("node.digest").alias("digest"))
    upper, groups = _climb(above, "rank")
    paths = materialize(_emit(upper).select("g", F.col("node.rank").alias("block"), F.col("path").alias("up"), "top"), "paths")
    return blocks.join(sized(paths, MAX_BLOCKS), ["g", "block"]), groups


def _emit(blocks: DataFrame, *also: str) -> DataFrame:
    """The nodes below the blocks: g, node, path up to the group's last node, top and further columns of the blocks."""
    rows = blocks.select("g", "n", "up", "top", *also, F.explode(_leaves(F.col("node"), DEPTH)).alias("leaf"))
    path = F.slice(F.concat("leaf.path", "up"), F.lit(1), levels(F.col("n")))
    return rows.select("g", "leaf.node", path.alias("path"), "top", *also)


def prove(leaves: DataFrame, *, order: str, group: str, leaf: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row of ``leaves`` (leaf digests): order, group, leaf, the carried columns, subroot, root and path
    (array of left, right from the leaf to the root; ``fold`` and ``siblings`` read it)."""
    extra = [f"x{k}" for k in range(len(carry))]
    rows = pick(leaves, id=order, lang=group, digest=leaf, **dict(zip(extra, carry, strict=True)))
    key = F.when(F.col("lang").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("lang").cast("string")))
    rows = ranked(materialize(rows.withColumn("g", key), "leaves"), "id", "digest")
    blocks, groups = _climb(rows, "id", "lang", *extra)
    groups = materialize(groups.select(F.lit("").alias("g"), F.col("g").alias("name"), "digest"), "groups")
    top, _ = _climb(ranked(groups, "name"), "name")
    tops = materialize(_emit(top).select(F.col("node.name").alias("g"), F.col("path").alias("over"), F.col("top").alias("root")), "tops")
    found = _emit(blocks.join(sized(tops, MAX_BLOCKS), "g"), "over", "root")
    return found.select(F.col("node.id").alias(order), F.col("node.lang").alias(group), F.col("node.digest").alias(leaf),
                        *[F.col(f"node.{x}").alias(c) for x, c in zip(extra, carry, strict=True)],
                        F.col("top").alias("subroot"), "root", F.concat("path", "over").alias("path"))


def merkle_manifest(docs: DataFrame, fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), *, order: str = "doc_id",
                    group: str = "lang") -> DataFrame:
    """Per row of ``docs``: order, group, leaf (H of the fields), subroot, root and path."""
    rows = pick(docs, id_=order, group_=group, **{f"f{k}": c for k, c in enumerate(fields)})
    rows = rows.select(F.col("id_").alias(order), F.col("group_").alias(group), leaf_digest(*[F.col(f"f{k}") for k in range(len(fields))]).alias("leaf"))
    return prove(rows, order=order, group=group, leaf="leaf")
