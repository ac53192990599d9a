"""Periodic runs of words, found as maximal pairs of the LCP-interval tree.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical) and at least ``max(min_length, min_exponent x q)`` words that no
neighbouring word extends keeping the period. Two places i and i + q whose words
agree for exactly L words, and whose left words differ, are a maximal pair; the
stretch from i over L + q words then has period q and ends on both sides, so no
extension follows. The length rules become rules on a pair's distance:
``min_length - L <= q <= L / (min_exponent - 1)``. They also leave out every interval
of the tree whose LCP value is below ``least_overlap``.

Per document: words become numbers, equal words equal ones. Prefix doubling ranks all places of a batch at once
in NumPy; a place whose rank is alone is finished, and after the least overlap only
documents with a repeat go on. The sorted places and their LCP values give the
intervals, visited bottom-up: a node keeps its places in order, cut into classes of
one left word, and a child's places meet those of the node so far within the longest
distance the node allows, class by class, skipping their own. The smaller side is
put into the larger. Of pairs with the same stretch the least distance is its period.

Documents are independent, so Spark scans them without a shuffle; a task holds one
slice of ``SLICE`` bytes of texts (or one longer text) at a time.

Defined results: null, empty and blank texts have no words, no runs and the empty
text as collapsed text. Rows are judged one by one, whatever ids repeat or are null.
An empty table gives no rows; other columns are not read, whatever they are called.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pointframe.llm.common import pick
from pointframe.session import ship_package

SLICE = 1 << 22
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def least_overlap(min_length: int, min_exponent: int) -> int:
    """The fewest words in which the two places of an admitted pair agree."""
    return min(max(min_length - q, (min_exponent - 1) * q) for q in range(1, max(min_length, 1) + 1))


def _ranks(order_key: np.ndarray) -> np.ndarray:
    """Dense ranks from 1 (0 is left for what lies behind a document's end)."""
    return np.unique(order_key, return_inverse=True)[1].astype(np.int64) + 1


def _behind(rank: np.ndarray, at: np.ndarray, h: int, end: np.ndarray) -> np.ndarray:
    """The rank ``h`` words on, 0 behind the document's end."""
    inside = at + h < end
    return np.where(inside, rank[np.minimum(at + h, len(rank) - 1)], 0)


def sorted_repeats(seq: np.ndarray, starts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places whose next ``least`` words stand at another place of their document too, in suffix order by
    document, and with each how many words it shares with the one before (0 at a document's first).

    ``seq``: word numbers from 1 of all documents in turn, which begin at ``starts`` (and the end).
    """
    doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    end = np.repeat(starts[1:], np.diff(starts))
    at = np.arange(len(seq))
    rank, h, levels = seq, 1, [(1, seq)]
    while 2 * h <= least:  # ranks by the next 2h words, equal across documents
        rank = _ranks(rank * (len(seq) + 2) + _behind(rank, at, h, end))
        h *= 2
        levels.append((h, rank))
    key = rank if h == least else _ranks(rank * (len(seq) + 2) + _behind(rank, at, least - h, end))
    room = at + least <= end
    group = _ranks(np.where(room, doc * (len(seq) + 2) + key, -1))
    count = np.bincount(group)
    live = at[room & (count[group] > 1)]
    if not len(live):
        return live, live
    # the documents with a repeat go on by themselves
    own = np.zeros(len(starts) - 1, dtype=bool)
    own[doc[live]] = True
    some = np.flatnonzero(own[doc])
    new = np.full(len(seq), -1)
    new[some] = np.arange(len(some))
    levels = [(h, r[some]) for h, r in levels]
    doc_, end_ = doc[some], np.searchsorted(some, end[some])
    rank, at, live = levels[-1][1], np.arange(len(some)), new[live]
    while True:  # places alone with their rank are finished
        key = doc_[live] * (len(seq) + 2) + rank[live]
        count = np.unique(key, return_inverse=True, return_counts=True)
        if len(count[0]) == len(live):
            break
        if h >= int(np.diff(starts).max(initial=0)):
            break
        rank = _ranks(rank * (len(some) + len(seq) + 2) + _behind(rank, at, h, end_))
        h *= 2
        levels.append((h, rank))
    live = live[np.lexsort((rank[live], doc_[live]))]
    lcp = np.zeros(len(live), dtype=np.int64)
    a, b = live[:-1].copy(), live[1:].copy()
    shared = np.zeros(len(a), dtype=np.int64)
    same = doc_[a] == doc_[b]
    for h, r in reversed(levels):
        x, y = a + shared, b + shared
        fits = same & (np.maximum(x, y) + h <= end_[a])
        equal = fits & (r[np.minimum(x, len(r) - 1)] == r[np.minimum(y, len(r) - 1)])
        shared[equal] += h
    lcp[1:] = shared
    return some[live], lcp


class _Node:
    """An LCP interval: its places in order, and ``heads``, where a class of equal left words begins among them."""

    __slots__ = ("heads", "lcp", "places")

    def __init__(self, lcp: int, places: list[int], heads: list[int]):
        self.lcp, self.places, self.heads = lcp, places, heads

    def meet(self, p: int, left, low: int, high: int) -> Iterator[tuple[int, int]]:
        """Pairs of ``p`` with the places at a distance from ``low`` to ``high`` whose left word is another."""
        places, heads, own = self.places, self.heads, left[p]
        i, last = bisect_left(places, p - high), bisect_right(places, p + high)
        k = bisect_right(heads, places[i]) if i < last else 0
        while i < last:
            stop = bisect_left(places, heads[k], i, last) if k < len(heads) else last
            if left[places[i]] != own:
                for q in places[i:stop]:
                    if abs(q - p) >= low:
                        yield (p, q) if p < q else (q, p)
            i, k = stop, k + 1

    def add(self, p: int, left) -> None:
        places, heads = self.places, self.heads
        i = bisect_left(places, p)
        before, after = left[places[i - 1]] if i else None, left[places[i]] if i < len(places) else None
        if i < len(places):
            k = bisect_left(heads, places[i])
            headed = k < len(heads) and heads[k] == places[i]
            if headed and after == left[p]:
                del heads[k]
            elif not headed and after != left[p]:
                heads.insert(k, places[i])
        if before != left[p]:
            insort(heads, p)
        places.insert(i, p)


def maximal_pairs(places: list[int], lcp: list[int], left, least: int, min_length: int, min_exponent: int) -> Iterator[tuple[int, int, int]]:
    """(i, j, words shared) of the maximal pairs within the distance rules; ``left``: the left word of every place.

    The open intervals stand on a stack by rising LCP value; ``done`` is the finished child of the topmost.
    """
    stack: list[_Node] = []
    done: _Node | None = None

    def close(child: _Node) -> tuple[_Node, list[tuple[int, int, int]]]:
        node = stack[-1]
        if len(child.places) > len(node.places):
            node.places, node.heads, child.places, child.heads = child.places, child.heads, node.places, node.heads
        low, high = max(1, min_length - node.lcp), node.lcp // (min_exponent - 1)
        # all of them meet the node first: places of one child make no pair of this interval
        found = [(i, j, node.lcp) for p in child.places for i, j in node.meet(p, left, low, high)]
        for p in child.places:
            node.add(p, left)
        return node, found

    for p, shared in zip([*places, -1], [*lcp, 0], strict=True):
        if shared < least:
            shared = 0
        while stack and stack[-1].lcp > shared:
            node, found = close(done)
            yield from found
            done = stack.pop()
        if shared and stack and stack[-1].lcp == shared:
            yield from close(done)[1]
        elif shared:
            done.lcp = shared
            stack.append(done)
        done = _Node(0, [p], [p])


def text_runs(texts: list[bytes], min_length: int, min_exponent: int) -> tuple[list[list[bytes]], list[list[tuple[int, int, int]]]]:
    """Per text its words, and its runs (start, length, period) by start, then period."""
    number: dict[bytes, int] = {}
    split = [t.split() for t in texts]  # bytes are cut at the six ASCII white-space characters
    seq = np.array([number.setdefault(w, len(number) + 1) for words in split for w in words], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum([len(w) for w in split])]).astype(np.int64)
    runs: list[dict[tuple[int, int], int]] = [{} for _ in texts]
    least = least_overlap(min_length, min_exponent)
    places, lcp = sorted_repeats(seq, starts, least)
    if len(places):
        left = np.concatenate([[0], seq[:-1]])
        left[starts[:-1][np.diff(starts) > 0]] = 0
        left = left.tolist()
        doc = (np.searchsorted(starts, np.arange(len(seq)), side="right") - 1).tolist()
        for i, j, shared in maximal_pairs(places.tolist(), lcp.tolist(), left, least, min_length, min_exponent):
            own, stretch = runs[doc[i]], (i - int(starts[doc[i]]), shared + j - i)
            own[stretch] = min(own.get(stretch, j - i), j - i)
    return split, [sorted(((s, n, q) for (s, n), q in own.items()), key=lambda r: (r[0], r[2])) for own in runs]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run repeats, joined by single blanks."""
    if not runs:
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    gone = np.cumsum(depth) > 0
    return b" ".join([w for w, g in zip(words, gone[:-1].tolist(), strict=True) if not g])


def _slices(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of rows (first, behind the last) with at most SLICE bytes, or of one row."""
    at, size = 0, 0
    for k, n in enumerate(lengths.tolist()):
        if k > at and size + n > SLICE:
            yield at, k
            at, size = k, 0
        size += n
    if at < len(lengths):
        yield at, len(lengths)


def find_runs(docs: DataFrame, id: str = "doc_id", text: str = "text", *, min_length: int = 24, min_exponent: int = 3) -> DataFrame:
    """Per row of ``docs``: id, n_words, runs (start, length, period; by start, then period) and collapsed,
    the text without the words that a run repeats, its words joined by single blanks."""
    if min_exponent < 2 or min_length < 1:
        raise ValueError("a run needs an exponent of 2 or more and a length of 1 or more")
    rows = pick(docs, id=id, text=text)
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").cast(pa.binary())
            ends = np.diff(np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset:texts.offset + len(texts) + 1]) if len(texts) else np.zeros(0)
            for first, last in _slices(ends):
                split, runs = text_runs([t or b"" for t in texts[first:last].to_pylist()], min_length, min_exponent)
                flat = np.array([r for own in runs for r in own], dtype=np.int64).reshape(-1, 3)
                offsets = np.concatenate([[0], np.cumsum([len(own) for own in runs])]).astype(np.int32)
                yield pa.RecordBatch.from_pydict({
                    "id": b.column("id")[first:last], "n_words": pa.array([len(w) for w in split], pa.int64()),
                    "runs": pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(c) for c in flat.T.copy()], fields=list(RUN))),
                    "collapsed": pa.array([collapse(w, own) for w, own in zip(split, runs, strict=True)], pa.binary()).view(pa.string())})

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_words long, "
                                "runs array<struct<start: long, length: long, period: long>>, collapsed string")


def drop_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """id and text of every row, texts collapsed."""
    return find_runs(docs, id, text, **options).select("id", "collapsed").toDF(id, text)
