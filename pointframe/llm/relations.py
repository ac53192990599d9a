"""Links between the sets of an inverted index, found by set relations (DataFrame operations only).

``posts`` holds the entries of the lists: h (token), id, n (size of the set), pos
(place of the token in the set, in one order for all sets; 0 if there is none), cap
(how much of the set can be in any other set: n without its private tokens).
``sets`` has the sets (id, n, tokens) that ``posts`` names. Two sets link when
den x intersection >= num x union, which is to say that their symmetric difference
holds at most (den - num) / (den + num) of both sizes together.

1. Leaders. Each set is compared with one leader, the head of most of its lists: among sets of about its size
   the one with the fewest private tokens, as a head with too many links with nobody. A set that
   is similar to its leader (a third of the union in common) gets the leader's own root as its reference,
   if it is similar to that as well, and keeps its difference from the reference.
2. Answers from the reference. For x and y with one reference the difference of x and y is the
   difference of their differences, so whether they link is read off what sets them apart from the
   reference. These small sets get lists and an order of their own, the rarest tokens first; a token that only one
   component has counts as private. A group of near copies meets on what its members
   changed, not on what all of them hold. Parities of a difference's cells bound from below how much two sets differ.
3. Different references. Lists are cut into blocks by size and by position, and a pair of blocks that
   cannot reach the threshold is skipped before any pair is made. What is left is paired as
   groups (one entry for all sets of a reference in a block); the references are intersected once. A
   reference without sets of its own that is similar to another joins that one's sets in step 2; any other
   pair of groups is opened only if the references' overlap and what the members have beside them reach the threshold.

Pairs that are connected already are not looked at again. No link between two
components is lost: every cut is a bound on the intersection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointframe.llm.common import in_parts, materialize, parts_of, scratch, sized
from pointframe.llm.components import connected_components

SKETCH = 4  # longs of parities, a power of two
STARS = 2  # rounds in which sets of one reference try a head of their lists


def link(overlap: Column, a: Column, b: Column, num: int, den: int) -> Column:
    return (overlap * (num + den) >= (a + b) * num) & (overlap > 0)


def fits(n: Column, m: Column, num: int, den: int) -> Column:
    """Sizes that a link allows."""
    return F.least(n, m) * den >= F.greatest(n, m) * num


def size_block(n: Column, num: int, den: int) -> Column:
    """Blocks of sizes within a factor of den / num."""
    return F.floor(F.ln(n) / F.ln(F.lit(den / num))).cast("int")


def enough(count: str, n: Column, m: Column, num: int, den: int, shared: int) -> Column:
    """Linked sets meet in ``shared`` lists, or in as many as their overlap must count if that is less."""
    return F.col(count) >= F.least(F.lit(shared), F.ceil((n + m) * num / (num + den)))


def compare(pairs: DataFrame, sets: DataFrame, expand=None, *, difference: bool = False) -> DataFrame:
    """pairs (a, b) with the sizes na, nb, i of the intersection and, where a third of the union is common, diff.

    With ``expand``, ``sets`` holds something shorter than the tokens, which the function makes of it for pairs.
    """
    with scratch() as keep:
        pairs = materialize(pairs, "pairs")
        right = materialize(sets.join(sized(materialize(pairs.select(F.col("b").alias("id")).distinct(), "needed")), "id", "left_semi")
                            .select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb")), "right")
        left = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
        both = left.join(sized(pairs), "a").join(sized(right), "b")
        both = both if expand is None else expand(both)
        both = both.withColumn("i", F.size(F.array_intersect("ta", "tb")).cast("long"))
        diff = F.when(F.col("i") * 4 >= F.col("na") + F.col("nb"), F.concat(F.array_except("ta", "tb"), F.array_except("tb", "ta")))
        return keep(both.select("a", "b", "na", "nb", "i", *([diff.alias("diff")] if difference else [])), "overlaps")


def leaders(posts: DataFrame, num: int, den: int, shared: int) -> DataFrame:
    """(a, b): every set that can link with the head of one of its lists, and the head that most of them name."""
    posts = posts.withColumn("size", size_block(F.col("n"), num, den))
    heads = posts.groupBy("h", "size").agg(F.min(F.struct((F.col("n") - F.col("cap")).alias("private"), "id", "n", "pos", "cap")).alias("head"))
    met = posts.join(heads, ["h", "size"]).where("id != head.id")
    n, m = F.col("n"), F.col("head.n")
    most = F.least(n - F.col("pos"), m - F.col("head.pos"), F.col("cap") - shared + 1, F.col("head.cap") - shared + 1) + (shared - 1)
    met = met.where(fits(n, m, num, den) & (most * (num + den) >= (n + m) * num))
    votes = met.groupBy(F.col("id").alias("a"), F.col("head.id").alias("b")).agg(
        F.count("*").alias("v"), F.max("n").alias("n"), F.max("head.n").alias("m"))
    votes = votes.where(enough("v", F.col("n"), F.col("m"), num, den, shared))
    return votes.groupBy("a").agg(F.min_by("b", F.struct(-F.col("v"), F.col("b"))).alias("b"))


def references(posts: DataFrame, sets: DataFrame, num: int, den: int, shared: int, expand=None) -> tuple[DataFrame, DataFrame]:
    """All comparisons with leaders (a, b, na, nb, i), and per similar set (id, n, ref, nref, i, diff).

    A leader is below its set in the order of private tokens and id, so following leaders ends at a root; the way
    there is halved in each round.
    """
    first = compare(leaders(posts, num, den, shared), sets, expand, difference=True)
    near = first.where("diff is not null")
    roots = materialize(near.select(F.col("a").alias("id"), F.col("b").alias("root")), "roots")
    while True:
        up = roots.select(F.col("id").alias("root"), F.col("root").alias("top"))
        jumped = materialize(roots.join(up, "root", "left").select("id", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved")), "roots")
        moved = not jumped.where("moved").isEmpty()
        roots = jumped.select("id", "root")
        if not moved:
            break
    far = roots.join(near.select(F.col("a").alias("id"), "b"), "id").where("root != b").select(F.col("id").alias("a"), F.col("root").alias("b"))
    second = compare(far, sets, expand, difference=True)
    cols = [F.col("a").alias("id"), F.col("na").alias("n"), F.col("b").alias("ref"), F.col("nb").alias("nref"), "i", "diff"]
    rooted = second.where("diff is not null").select(*cols)
    member = rooted.unionByName(near.select(*cols).join(rooted.select("id"), "id", "left_anti"))
    done = first.drop("diff").unionByName(second.drop("diff"))
    return done, materialize(member, "members")


def parity(tokens: Column, word: int) -> Column:
    """Word ``word`` of the parities: whether an odd number of the tokens falls into each of 64 cells. A token
    that only one of two sets holds changes one bit of all words, so bits that differ never outnumber such tokens."""
    def flip(acc: Column, t: Column) -> Column:
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), t.bitwiseAND(F.lit(63).cast("long")).cast("int"))
        own = F.shiftright(t, 6).bitwiseAND(F.lit(SKETCH - 1).cast("long")) == word
        return acc.bitwiseXOR(F.when(own, bit).otherwise(F.lit(0).cast("long")))

    return F.aggregate(tokens, F.lit(0).cast("long"), flip)


def same_reference(member: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) between sets of one reference and different components, at least one of them not linked to the reference.

    ``member``: id, n, ref, nref, diff, linked (to the reference), comp; a set may have several references.
    """
    with scratch() as keep:
        return keep(_same_reference(member, num, den), "same_reference")


def _same_reference(member: DataFrame, num: int, den: int) -> DataFrame:
    total, gap = num + den, den - num
    open_ = sized(materialize(member.where("not linked").select("ref").distinct(), "open"))
    words = [f"w{k}" for k in range(SKETCH)]
    member = member.join(open_, "ref", "left_semi").withColumn("d", F.size("diff").cast("long"))
    member = materialize(member.select("*", *[parity(F.col("diff"), k).alias(w) for k, w in enumerate(words)]), "open_members")
    key = ["ref", "id", "n", "nref", "d", "linked", "comp", *words]
    rows = member.select(*key, F.explode("diff").alias("t"))
    parts = parts_of(member.agg(F.sum("d")).first()[0])
    lists = (part.groupBy("ref", "t").agg(F.count("*").alias("c"), F.min("comp").alias("low"), F.max("comp").alias("high"))
             .where("low != high").select("ref", "t", "c") for part in in_parts(rows, parts, "t"))
    lists = sized(materialize(lists, "own_lists"))

    def entries(rows: DataFrame) -> DataFrame:
        own = rows.join(lists, ["ref", "t"]).groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("c", "t"))).alias("l"))
        # reach: how many tokens of the set follow from this one on, in the order that has private ones first
        entry = own.select(*key, F.size("l").alias("s"), F.posexplode("l").alias("p", "x")).select(
            *key, F.col("x.t").alias("t"), (F.col("s") - F.col("p")).alias("reach"))
        # with a set that does not link to the reference more than half of the own difference must be common ...
        half = 2 * F.col("reach") * total >= F.col("d") * total + gap * (F.col("nref") - F.col("n"))
        # ... and of such a set all but what the sizes leave to be missing
        wide = F.col("reach") * num >= F.col("d") * num - F.col("n") * gap
        return entry.withColumn("half", half).where(half | (~F.col("linked") & wide))

    entry = materialize((entries(part) for part in in_parts(rows, parts, "ref", "id")), "entries")
    if entry.isEmpty():
        return member.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)
    sets = member.select(F.struct("ref", "id").alias("id"), F.col("d").alias("n"), F.col("diff").alias("tokens"))
    apart = sum((F.bit_count(F.col(f"x_{w}").bitwiseXOR(F.col(f"y_{w}"))) for w in words), F.lit(0))
    need = (F.col("x_d") + F.col("y_d")) * total - gap * (F.col("x_n") + F.col("y_n"))
    once = F.col("x_linked") | (F.col("y_half") & (F.col("x_id") < F.col("y_id")))
    can = ((F.col("x_comp") != F.col("y_comp")) & fits(F.col("x_n"), F.col("y_n"), num, den)
           & (2 * F.least("x_reach", "y_reach") * total >= need) & (apart * total <= gap * (F.col("x_n") + F.col("y_n"))))
    cols = ("id", "n", "d", "linked", "half", "comp", "reach", *words)

    def sides() -> tuple[DataFrame, DataFrame]:
        return tuple(entry.where(w).select("ref", "t", *[F.col(c).alias(f"{side}_{c}") for c in cols]) for side, w in (("x", "half"), ("y", "not linked")))

    def verified(pairs: DataFrame) -> DataFrame:
        """Of pairs (ref, x_id, y_id, x_n, y_n, x_comp, y_comp) those that link."""
        pairs = materialize(pairs.select(F.struct("ref", F.col("x_id").alias("id")).alias("a"), F.struct("ref", F.col("y_id").alias("id")).alias("b"),
                                         (F.col("x_n") + F.col("y_n")).alias("sizes"), "x_comp", "y_comp"), "pairs")
        found = compare(pairs.select("a", "b"), sets).join(sized(pairs), ["a", "b"])
        return materialize(found.where((F.col("na") + F.col("nb") - 2 * F.col("i")) * total <= gap * F.col("sizes")).select(
            F.col("a.id").alias("a"), F.col("b.id").alias("b"), "x_comp", "y_comp"), "linked")

    edges = None
    for k in range(STARS):  # most links lie inside groups: every set tries one head of its lists first, another one each round
        x, y = sides()
        draw = F.xxhash64(F.lit(k), "ref", "x_id")
        heads = x.groupBy("ref", "t").agg(F.min(F.struct(draw, *[c for c in x.columns if c not in ("ref", "t")])).alias("head")).select("ref", "t", "head.*")
        met = y.join(heads, ["ref", "t"]).where(can).groupBy("ref", "y_id", "x_id", "x_n", "y_n", "x_comp", "y_comp").agg(F.count("*").alias("v"))
        best = met.groupBy("ref", "y_id").agg(F.max(F.struct("v", "x_id", "x_n", "y_n", "x_comp", "y_comp")).alias("m")).select("ref", "y_id", "m.*")
        found = verified(best)
        edges = found.select("a", "b") if edges is None else edges.unionByName(found.select("a", "b"))
        if found.isEmpty():
            break
        joined = connected_components(found.select(F.col("x_comp").alias("a"), F.col("y_comp").alias("b")))
        entry = entry.join(sized(materialize(joined.select(F.col("v").alias("comp"), "root"), "joined")), "comp", "left")
        entry = materialize(entry.withColumn("comp", F.coalesce("root", "comp")).drop("root"), "entries")
    x, y = sides()
    rest = x.join(y, ["ref", "t"]).where(can & once).select("ref", "x_id", "y_id", "x_n", "y_n", "x_comp", "y_comp").distinct()
    return edges.unionByName(verified(rest).select("a", "b"))


def _sides(df: DataFrame, *cols: str) -> tuple[DataFrame, DataFrame]:
    x, y = (df.select("h", *[F.col(c).alias(f"{s}_{c}") for c in cols]) for s in "xy")
    return x, y


def meetings(posts: DataFrame, sets: DataFrame, member: DataFrame, comp: DataFrame, num: int, den: int, shared: int, expand=None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Where groups of different references and components meet.

    The entries of such lists (h, id, n, reach, comp, ref, beside), the lists of every pair of groups (h, x_ref, y_ref), and
    per pair x_ref, y_ref, x_lo, y_lo (least sizes), x_beside, y_beside, x_more, y_more (whether it has sets but the reference), and
    the references' na, nb, i and diff.
    """
    with scratch() as keep:
        return _meetings(posts, sets, member, comp, num, den, shared, expand, keep)


def _meetings(posts: DataFrame, sets: DataFrame, member: DataFrame, comp: DataFrame, num: int, den: int, shared: int,
              expand, keep) -> tuple[DataFrame, DataFrame, DataFrame]:
    total = num + den
    own = member.select("id", "ref", (F.col("n") - F.col("i")).alias("beside"))
    with scratch():
        at = posts.join(comp, "id", "left").join(own, "id", "left").select(
            "h", "id", "n", "pos", "cap", F.coalesce("comp", "id").alias("comp"), F.coalesce("ref", "id").alias("ref"), F.coalesce("beside", F.lit(0)).alias("beside"))
        at = materialize(at, "placed")
        mixed = at.groupBy("h").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.min("ref").alias("r0"), F.max("ref").alias("r1"))
        mixed = mixed.where("c0 != c1 and r0 != r1").select("h")
        # blocks: sizes within a factor of den / num, positions within a factor of two
        reach = F.least(F.col("n") - F.col("pos") + (shared - 1), F.col("cap"))
        rest = at.join(mixed, "h").withColumn("reach", reach).withColumn(
            "block", size_block(F.col("n"), num, den) * 64 + F.floor(F.log2(F.col("pos") + 1)).cast("int"))
        rest = keep(rest, "mixed")
    best = [F.min("n").alias("lo"), F.max("n").alias("hi"), F.max("reach").alias("reach")]
    can = (F.col("x_lo") * num <= F.col("y_hi") * den) & (F.col("y_lo") * num <= F.col("x_hi") * den) & (
        F.least("x_reach", "y_reach") * total >= (F.col("x_lo") + F.col("y_lo")) * num)
    x, y = _sides(rest.groupBy("h", "block").agg(*best), "block", "lo", "hi", "reach")
    open_blocks = materialize(x.join(y, "h").where(can).select("h", "x_block", "y_block"), "blocks")
    groups = materialize(rest.groupBy("h", "block", "ref").agg(*best, F.max("beside").alias("beside"), F.min("comp").alias("low"), F.max("comp").alias("high"),
                                                               F.max(F.col("id") != F.col("ref")).alias("more")), "groups")
    x, y = _sides(groups, "block", "ref", "lo", "hi", "reach", "beside", "low", "high", "more")
    apart = (F.col("x_low") != F.col("y_low")) | (F.col("x_high") != F.col("y_high")) | (F.col("x_low") != F.col("x_high"))
    met = x.join(open_blocks, ["h", "x_block"]).join(y, ["h", "y_block"]).where((F.col("x_ref") < F.col("y_ref")) & can & apart)
    of_pair = [F.min("x_lo").alias("x_lo"), F.min("y_lo").alias("y_lo"), F.max("x_beside").alias("x_beside"), F.max("y_beside").alias("y_beside"),
               F.max("x_more").alias("x_more"), F.max("y_more").alias("y_more")]
    lists = keep(met.groupBy("x_ref", "y_ref", "h").agg(*of_pair), "lists")  # blocks of a list count once
    met = lists.groupBy("x_ref", "y_ref").agg(F.count("*").alias("v"), *of_pair)
    met = materialize(met.where(enough("v", F.col("x_lo"), F.col("y_lo"), num, den, shared)), "met")
    heads = compare(met.select(F.col("x_ref").alias("a"), F.col("y_ref").alias("b")), sets, expand, difference=True)
    met = met.join(heads.withColumnsRenamed({"a": "x_ref", "b": "y_ref"}), ["x_ref", "y_ref"])
    return rest.select("h", "id", "n", "reach", "comp", "ref", "beside"), lists.select("h", "x_ref", "y_ref"), keep(met, "met_heads")


def opened(rest: DataFrame, lists: DataFrame, met: DataFrame, sets: DataFrame, num: int, den: int, shared: int, expand=None) -> DataFrame:
    """Links (a, b) between sets of the pairs of groups ``met``, found in the lists where these meet."""
    total = num + den
    bound = F.col("i") + F.col("x_beside") + F.col("y_beside")
    more = materialize(met.where(bound * total >= (F.col("x_lo") + F.col("y_lo")) * num).select("x_ref", "y_ref", "i"), "opened")
    if more.isEmpty():
        return met.select(F.col("x_ref").alias("a"), F.col("y_ref").alias("b")).limit(0)
    x, y = _sides(rest, "id", "n", "reach", "comp", "ref", "beside")
    pairs = x.join(lists.join(sized(more), ["x_ref", "y_ref"]), ["h", "x_ref"]).join(y, ["h", "y_ref"]).where(
        (F.col("x_comp") != F.col("y_comp")) & fits(F.col("x_n"), F.col("y_n"), num, den)
        & (F.least(F.col("x_reach"), F.col("y_reach"), bound) * total >= (F.col("x_n") + F.col("y_n")) * num))
    pairs = pairs.where("x_id != x_ref or y_id != y_ref").groupBy(F.col("x_id").alias("a"), F.col("y_id").alias("b")).agg(
        F.count("*").alias("v"), F.max("x_n").alias("n"), F.max("y_n").alias("m"))
    found = compare(pairs.where(enough("v", F.col("n"), F.col("m"), num, den, shared)).select("a", "b"), sets, expand)
    return found.where(link(F.col("i"), F.col("na"), F.col("nb"), num, den)).select("a", "b")


def links(posts: DataFrame, sets: DataFrame, num: int, den: int, *, shared: int = 1, expand=None) -> DataFrame:
    """Edges (a, b), all of them links, whose components are those of all links that the lists hold.

    ``shared``: the number of lists in which two linked sets meet at least (or their
    smallest overlap, if that is less). ``posts`` and ``sets`` are written tables;
    ``expand``: see ``compare``.
    """
    with scratch() as keep:
        return keep(_links(posts, sets, num, den, shared, expand), "links")


def _links(posts: DataFrame, sets: DataFrame, num: int, den: int, shared: int, expand) -> DataFrame:
    done, member = references(posts, sets, num, den, shared, expand)
    edges = done.where(link(F.col("i"), F.col("na"), F.col("nb"), num, den)).select("a", "b")
    comp = connected_components(edges).select(F.col("v").alias("id"), F.col("root").alias("comp"))
    rest, lists, met = meetings(posts, sets, member, comp, num, den, shared, expand)
    direct = met.where(link(F.col("i"), F.col("na"), F.col("nb"), num, den)).select(F.col("x_ref").alias("a"), F.col("y_ref").alias("b"))
    # a similar reference without sets of its own in these lists joins the other's
    similar = F.col("diff").isNotNull() & (F.col("x_more") != F.col("y_more"))
    side = lambda s, n, r, m: [F.col(s).alias("id"), F.col(n).alias("n"), F.col(r).alias("ref"), F.col(m).alias("nref"), "i", "diff"]
    joined = met.where(similar & F.col("x_more")).select(*side("y_ref", "nb", "x_ref", "na")).unionByName(
        met.where(similar & F.col("y_more")).select(*side("x_ref", "na", "y_ref", "nb")))
    placed = member.unionByName(joined).join(comp, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    linked = link(F.col("i"), F.col("n"), F.col("nref"), num, den)
    inner = same_reference(placed.withColumn("linked", linked).drop("i"), num, den)
    outer = opened(rest, lists, met.where((F.col("x_more") | F.col("y_more")) & ~similar), sets, num, den, shared, expand)
    return edges.unionByName(direct).unionByName(inner).unionByName(outer)
