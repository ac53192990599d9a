"""Exact Jaccard self-join over word n-grams, resolved to connected components by set relations.

The method has two parts. Lists: an inverted index over the prefixes of the sets
(in a global token order that puts frequent tokens last) holds each entry's size
and position; an entry is skipped by position when even a match of all that
follows could not reach the threshold, and so are whole blocks of a list
(``relations.other_references``). Relations: equal sets share one class; then each set is
compared with one leader, and whether it links to the other sets near that leader is
derived from the answers for the leader, by what sets the two apart from it
(``relations.same_reference``). No link is lost: a pair is left out only if a bound
on its overlap fails or if it is connected already.

Texts are lower-cased (A-Z only) and cut at ASCII white space; a set holds the
64-bit hashes of the distinct n-grams. Fewer words than n: the whole sequence as
one. NumPy builds the sets in Arrow batches; lists, candidates, intersections and
components are DataFrame operations. Full sets are written once, and only of documents
that share a token of their prefixes with another one and can link with it.

Defined results: null, empty and blank texts have no n-grams, link with nothing
and are a component of their own. Rows that repeat an id count as linked with each
other, whatever their texts; a null id is never linked and its component is null.
An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointframe.llm.common import materialize, pick, plain, scratch, sized
from pointframe.llm.components import connected_components
from pointframe.llm.relations import links
from pointframe.session import ship_package

CHUNK = 1 << 18
# linked sets have so many tokens of their prefixes in common, so a single common phrase is no candidate
SHARED = 3
U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
INVERSE = U(pow(int(BASE), -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U)
    out[0] = 1
    return np.multiply.accumulate(out)


_LETTERS = _mix(np.arange(1, 257, dtype=U) * BASE)
_TABLES: list[np.ndarray] = []


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of lower-cased bytes, in order: differences of prefix sums."""
    b = np.frombuffer(text, dtype=np.uint8)
    if not len(b):
        return np.zeros(0, dtype=U)
    if not _TABLES or len(_TABLES[0]) < len(b):
        _TABLES[:] = [_powers(INVERSE, max(len(b), 2 * CHUNK)), _powers(BASE, max(len(b), 2 * CHUNK))]
    down, up = _TABLES
    black = ~((b == 32) | ((b >= 9) & (b <= 13)))
    edge = np.flatnonzero(np.diff(np.concatenate([[False], black, [False]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, dtype=U)
    total = np.concatenate([np.zeros(1, dtype=U), np.cumsum(_LETTERS[b] * down[:len(b)], dtype=U)])
    return _mix((total[end] - total[start]) * up[end - 1] + (end - start).astype(U) * BASE)


def shingle_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes (int64) of its word n-grams."""
    out: list[np.ndarray] = []
    for t in texts:
        raw = (t or "").encode("utf-8", "surrogatepass").lower()
        parts, at = [], 0
        while at < len(raw):  # long texts are hashed in runs cut between words
            end = len(raw)
            if end - at > CHUNK:
                end = at + CHUNK
                while end < len(raw) and raw[end] != 32 and not 9 <= raw[end] <= 13:
                    end += 1
            parts.append(word_hashes(raw[at:end]))
            at = end
        w = np.concatenate(parts) if parts else np.zeros(0, dtype=U)
        m = min(n, len(w))
        if not m:
            out.append(np.zeros(0, dtype=np.int64))
            continue
        k = len(w) - m + 1
        h = np.full(k, U(m), dtype=U)
        for i in range(m):
            h = h * BASE + w[i:i + k]
        out.append(np.unique(_mix(h).view(np.int64)))
    return out


def _sets(docs: DataFrame, n: int, make, schema: str) -> DataFrame:
    """One Arrow pass over (id, text): ``make(ids, sets)`` gives the columns of ``schema``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                yield make(part.column("id"), shingle_sets(part.column("text").to_pylist(), n))

    return docs.mapInArrow(run, schema)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int64)))


def _head(s: np.ndarray, num: int, den: int) -> np.ndarray:
    """The prefix in which a linked set must meet ``SHARED`` tokens: size - ceil(num x size / den) + SHARED."""
    return s[:len(s) + num * len(s) // -den + SHARED]


class JaccardJoin:
    """The join of one table; ``num / den`` is the threshold."""

    def __init__(self, docs: DataFrame, id: str = "doc_id", text: str = "text", *, n: int = 4, num: int = 85, den: int = 100,
                 frequent: int = 16, max_frequent: int = 2_000_000, max_broadcast: int = 2_000_000):
        self.docs = pick(docs, id=id, text=text)
        self.id_type = self.docs.schema["id"].dataType.simpleString()
        self.n, self.num, self.den = n, num, den
        self.frequent, self.max_frequent, self.max_broadcast = frequent, max_frequent, max_broadcast
        ship_package(docs.sparkSession)

    # -- passes over the texts

    def sizes(self) -> DataFrame:
        """(id, n, d1, d2, prefix): size, digest and hash-order prefix of each row's set."""
        num, den = self.num, self.den

        def make(ids, sets):
            digests = [np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), dtype=np.int64) for s in sets]
            return pa.RecordBatch.from_pydict({
                "id": ids, "n": pa.array([len(s) for s in sets], pa.int64()), "d1": pa.array([int(d[0]) for d in digests], pa.int64()),
                "d2": pa.array([int(d[1]) for d in digests], pa.int64()),
                "prefix": _lists([_head(s, num, den) for s in sets])})

        return _sets(self.docs, self.n, make, f"id {self.id_type}, n long, d1 long, d2 long, prefix array<long>")

    def prefixes(self, docs: DataFrame, last: np.ndarray) -> DataFrame:
        """(id, n, prefix) in the order that puts the tokens ``last`` (sorted) behind all others."""
        shared, num, den = docs.sparkSession.sparkContext.broadcast(last), self.num, self.den

        def make(ids, sets):
            out, seen = [], shared.value
            for s in sets:
                if len(seen) and len(s):
                    late = seen[np.minimum(np.searchsorted(seen, s), len(seen) - 1)] == s
                    s = np.concatenate([s[~late], s[late]])
                out.append(_head(s, num, den))
            return pa.RecordBatch.from_pydict({"id": ids, "n": pa.array([len(s) for s in sets], pa.int64()), "prefix": _lists(out)})

        return _sets(docs, self.n, make, f"id {self.id_type}, n long, prefix array<long>")

    def full(self, docs: DataFrame) -> DataFrame:
        def make(ids, sets):
            return pa.RecordBatch.from_pydict({"id": ids, "n": pa.array([len(s) for s in sets], pa.int64()), "tokens": _lists(sets)})

        return _sets(docs, self.n, make, f"id {self.id_type}, n long, tokens array<long>")

    # -- the join

    def _long_lists(self, counts: DataFrame, name: str) -> np.ndarray:
        """Tokens counted ``frequent`` times and more, the most frequent ``max_frequent`` of them at
        most: they go to the order's end. Any choice gives the same links, a good one short lists."""
        counts = materialize(counts.groupBy("h").agg(F.sum("c").alias("c")).where(F.col("c") >= self.frequent), name)
        by = {r["k"]: r["n"] for r in counts.groupBy(F.floor(F.log2("c")).alias("k")).agg(F.count("*").alias("n")).collect()}
        low = min(by, default=0)
        while sum(n for k, n in by.items() if k >= low) > self.max_frequent:
            low += 1
        kept = counts.where(F.floor(F.log2("c")) >= low).select("h").toArrow()
        return np.sort(kept.column("h").to_numpy())

    def _counted(self, docs: DataFrame) -> DataFrame:
        """(h, c): tokens of whole sets, counted within batches."""
        def make(ids, sets):
            h, c = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.zeros(0, np.int64),) * 2
            return pa.RecordBatch.from_pydict({"h": pa.array(h), "c": pa.array(c.astype(np.int64))})

        return _sets(docs, self.n, make, "h long, c long")

    def _frequent(self, reps: DataFrame, first: DataFrame) -> np.ndarray:
        """The order's tail. Prefixes by hash show the frequent tokens among the small hashes; of the
        texts whose prefixes mostly consist of them (large groups of near copies) whole sets are counted."""
        prefix = self._long_lists(reps.select(F.explode("prefix").alias("h"), F.lit(1).cast("long").alias("c")), "frequent")
        if not len(prefix):
            return prefix
        shared = reps.sparkSession.sparkContext.broadcast(prefix)
        id_type = self.id_type

        def heavy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen = shared.value
            for b in batches:
                column = b.column("prefix")
                tokens, ends = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy() - column.offsets[0].as_py()
                late = np.concatenate([[0], np.cumsum(seen[np.minimum(np.searchsorted(seen, tokens), len(seen) - 1)] == tokens)])
                yield pa.RecordBatch.from_pydict({"id": b.column("id").filter(pa.array(
                    late[ends[1:]] - late[ends[:-1]] >= 0.3 * (ends[1:] - ends[:-1])))})

        ids = materialize(reps.select("id", "prefix").mapInArrow(heavy, f"id {id_type}"), "heavy")
        whole = self._long_lists(self._counted(first.join(sized(ids, self.max_broadcast), "id", "left_semi")), "whole")
        return np.union1d(prefix, whole)

    def components(self) -> DataFrame:
        """Per row: id, n, component."""
        with scratch() as keep:
            sizes = materialize(self.sizes(), "sizes")
            # the prefixes by hash are the larger part, and only the order's tail is read off them
            rows = keep(sizes.drop("prefix"), "rows")
            classes = materialize(rows.where("n > 0 and id is not null").groupBy("n", "d1", "d2").agg(
                F.min("id").alias("rep")), "classes")
            members = rows.where("id is not null").join(classes, ["n", "d1", "d2"])
            same = keep(members.where("id != rep").select(F.col("id").alias("a"), F.col("rep").alias("b")).distinct(), "same")
            reps = sizes.join(classes, (sizes["n"] == classes["n"]) & (sizes["d1"] == classes["d1"]) & (sizes["d2"] == classes["d2"])
                              & (sizes["id"] == classes["rep"]), "left_semi")
            # copies need no lists of their own; an id that also represents another text of its own stays
            copies = same.select(F.col("a").alias("id")).distinct().join(classes.select(F.col("rep").alias("id")).distinct(), "id", "left_anti")
            copies = sized(keep(copies, "copies"), self.max_broadcast)
            first = self.docs.where("id is not null").join(copies, "id", "left_anti")
            last = self._frequent(reps, first)
        with scratch() as keep:
            posts = keep(self._posts(first, last), "postings")
        with scratch() as keep:
            ids = sized(materialize(posts.select("id").distinct(), "indexed"), self.max_broadcast)
            sets = materialize(self.full(first.join(ids, "id", "left_semi")), "sets")
            edges = keep(links(posts, sets, self.num, self.den, shared=SHARED), "links")
        comp = connected_components(edges.unionByName(same))
        out = rows.select("id", "n").join(comp, F.col("id") == F.col("v"), "left")
        return out.select("id", "n", F.coalesce("root", "id").alias("component"))

    def _posts(self, first: DataFrame, last: np.ndarray) -> DataFrame:
        """The lists (h, id, n, pos, cap) on which sets can meet."""
        index = materialize(self.prefixes(first, last).where("n > 0"), "prefixes")
        posts = index.select("id", "n", F.size("prefix").alias("length"), F.posexplode("prefix").alias("pos", "h"))
        for k in range(2):
            # a token on no list of two is private; a set with too many of them links with none, and
            # what its tokens met may be private in turn
            lists = posts.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h")
            lists = sized(materialize(lists, "lists"), self.max_broadcast)
            posts = materialize(posts.join(lists, "h").select("h", "id", "n", "pos", "length").distinct(), "listed")
            listed = posts.groupBy("id", "n", "length").agg(F.count("*").alias("k"))
            listed = listed.withColumn("cap", F.col("n") - F.greatest(F.lit(0), F.col("length") - F.col("k"))).drop("k")
            posts = posts.join(listed.where(F.col("cap") * self.den >= F.col("n") * self.num), ["id", "n", "length"])
            posts = posts if k else posts.drop("cap")
        return posts.select("h", "id", "n", "pos", "cap")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per row of ``docs``: id, n (size of its set), component (smallest id reachable by links)."""
    return JaccardJoin(docs, id, text, **options).components()


def drop_near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", *, n: int = 5, num: int = 80, den: int = 100,
                         **options) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id (null first).

    Rows are told apart by id and text, so a repeated or null id takes no other text along;
    rows that repeat both stay or go together.
    """
    tmp, names = plain(docs)
    i, t = f"c{names.index(id)}", f"c{names.index(text)}"
    key = F.xxhash64(F.col(i), F.col(t), F.col(t).isNull())
    keyed = tmp.select(key.alias("key"), F.col(i).alias("id"), F.col(t).alias("text"))
    with scratch() as keep:
        found = near_duplicates(keyed, "key", "text", n=n, num=num, den=den, **options).where("n > 0").select("id", "component")
        found = materialize(found.distinct(), "near")
        grouped = found.join(found.groupBy("component").count().where("count > 1").select("component"), "component")
        grouped = materialize(keyed.select("key", F.col("id").alias("own")).distinct().join(
            sized(materialize(grouped.select(F.col("id").alias("key"), "component"), "grouped")), "key"), "grouped")
        kept = grouped.groupBy("component").agg(F.min(F.struct("own", "key")).alias("keep")).select(F.col("keep.key").alias("key"))
        gone = keep(grouped.select("key").distinct().join(kept, "key", "left_anti").withColumnRenamed("key", "gone_"), "gone")
    return tmp.join(sized(gone, 4_000_000), key == F.col("gone_"), "left_anti").toDF(*names)
