"""Passages of a benchmark in texts, also with small edits.

An item is found where a stretch of a text is within ``EDITS`` edits per character of it. Both
are compared as code points, each in lower case where that is one code point.

1. All q-grams of the items are looked up in a text. An item of n characters with e edits keeps
   n - q + 1 - q * e of its q-grams (the q-gram lemma), and these lie on diagonals (place in the text
   less place in the item) at most e apart. So hits are counted by item and stretches of e + 1
   diagonals, and two neighbouring stretches with that many hits are a candidate. Nothing within the
   edits is lost, whatever kind they are and wherever in the item.
2. Candidates are verified by the exact edit distance of the item to the best stretch there.

Items are compared in groups of ``ITEMS`` that each fit into a task; texts of any length are
worked through whole. An item of fewer than 32 characters may have as many edits as leave one of its q-grams, if that is
less; below two q-grams it must be there exactly. One that is shorter than a q-gram says nothing inside a text: it is found
where it is a whole text, blanks at both ends aside. Null and blank items are ignored. Null texts count as empty. Repeated rows are each searched, and so are repeated
items; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, tidy

EDITS = 0.1
ITEMS = 20_000
_Q = 8
_TABLE_BITS = 22
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STRETCH = 1 << 18  # characters searched at once
_HITS = 1 << 21  # pairs of places counted at once


def _lower() -> np.ndarray:
    """Each code point's lower case, itself where that is several code points."""
    lows = (chr(i).lower() if not 0xD800 <= i < 0xE000 else chr(i) for i in range(0x20000))
    return np.array([ord(low) if len(low) == 1 else i for i, low in enumerate(lows)], "u4")


_LOWER = _lower()


def _points(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(points < len(_LOWER), _LOWER[np.minimum(points, len(_LOWER) - 1)], points)


def _stripped(points: np.ndarray) -> np.ndarray:
    """Without blanks at both ends."""
    text = points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").strip()
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _grams(points: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each q-gram."""
    n = len(points) - _Q + 1
    if n <= 0:
        return np.zeros(0, "u8")
    key = points[:n].astype("u8")
    for j in range(1, _Q):
        key = key * np.uint64(1_000_003) + points[j : j + n]
    return key * _MIX


def _places(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - _TABLE_BITS)).astype("u4")


class Index:
    """Items of one group, ready to be searched for in texts."""

    def __init__(self, items: list[tuple[object, str]]):
        pairs = [(i, _points(t)) for i, t in items]
        self.whole: dict[bytes, list] = {}
        for i, p in pairs:
            if 0 < len(own := _stripped(p)) < _Q:
                self.whole.setdefault(own.tobytes(), []).append(i)
        pairs = [(i, p) for i, p in pairs if len(_stripped(p)) >= _Q]
        self.ids, self.items = [i for i, _ in pairs], [p for _, p in pairs]
        sizes = np.array([len(p) for p in self.items], "i8")
        self.longest = int(sizes.max(initial=0))
        # at least one q-gram must be left
        self.most = np.array([min(int(n * EDITS), n // _Q - 1) for n in sizes.tolist()], "i8")
        self.least = sizes - _Q + 1 - _Q * self.most
        # places (item, offset) of every q-gram, ordered by it
        grams = [_grams(p) for p in self.items]
        every = np.concatenate([np.zeros(0, "u8"), *grams])
        order = np.argsort(every, kind="stable")
        self.keys, self.first, self.times = np.unique(every[order], return_index=True, return_counts=True)
        self.item = np.repeat(np.arange(len(grams), dtype="i4"), [len(g) for g in grams])[order]
        self.offset = np.concatenate([np.zeros(0, "i4"), *(np.arange(len(g), dtype="i4") for g in grams)])[order]
        self.seen = np.zeros(1 << _TABLE_BITS, bool)
        self.seen[_places(self.keys)] = True

    def search(self, texts: list[str | None]) -> list[list[tuple[object, int, int, int]]]:
        """For each text (item, start, end, edits) of every item found, once for each place."""
        found: list[set[tuple[int, int, int, int]]] = [set() for _ in texts]
        for own, text in zip(found, texts):
            for base, points in self._parts(text):
                self._verify(points, base, self._candidates(points), own)
        rows = [[(self.ids[k], a, b, e) for k, a, b, e in sorted(own)] for own in found]
        for own, text in zip(rows, texts) if self.whole else ():
            if text and len(text.strip()) < _Q:
                points = _points(text)
                start = len(points) - len(_points(text.lstrip()))
                size = len(_stripped(points))
                own += [(i, start, start + size, 0) for i in self.whole.get(_stripped(points).tobytes(), ())]
        return rows

    def _parts(self, text: str | None) -> Iterator[tuple[int, np.ndarray]]:
        """Parts of a text that overlap by more than an item, with the place of each."""
        if not text or not self.items:
            return
        points = _points(text)
        for base in range(0, len(points), _STRETCH):
            # an item and its edits, which begins in the part, and as much before it is verified
            yield base, points[base : base + _STRETCH + 4 * self.longest]

    def _candidates(self, points: np.ndarray) -> list[tuple[int, int]]:
        """Items and the first of the diagonals on which they have enough hits, both rising."""
        grams = _grams(points)
        at = np.flatnonzero(self.seen[_places(grams)])
        if not len(at):
            return []
        place = np.minimum(np.searchsorted(self.keys, grams[at]), len(self.keys) - 1)
        same = self.keys[place] == grams[at]
        at, place = at[same], place[same]
        times = self.times[place]
        if not len(at) or times.sum() < self.least.min():
            return []
        span = len(points) + self.longest + 1
        keys, counts = np.zeros(0, "i8"), np.zeros(0, "i8")
        ends = np.cumsum(times)
        begin = 0
        while begin < len(at):  # pieces of bounded size, though a q-gram may be in every item
            done = ends[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(ends, done + _HITS)))
            n = times[begin:stop]
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            where = np.repeat(self.first[place[begin:stop]], n) + within
            item = self.item[where].astype("i8")
            diagonal = np.repeat(at[begin:stop], n) - self.offset[where] + self.longest
            new, number = np.unique(item * span + diagonal // (self.most[item] + 1), return_counts=True)
            if len(keys):
                new, back = np.unique(np.concatenate([keys, new]), return_inverse=True)
                number = np.bincount(back, np.concatenate([counts, number]), len(new)).astype("i8")
            keys, counts = new, number
            begin = stop
        both = counts.copy()
        both[:-1] += np.where(keys[1:] == keys[:-1] + 1, counts[1:], 0)
        # the second stretch alone is the first of a pair too
        item = keys // span
        enough = both >= self.least[item]
        item = item[enough]
        return list(zip(item.tolist(), (keys[enough] % span * (self.most[item] + 1) - self.longest).tolist()))

    def _verify(self, points: np.ndarray, base: int, candidates: list[tuple[int, int]], found: set) -> None:
        """Adds what is within the edits."""
        at = 0
        while at < len(candidates):
            k, first = candidates[at]
            size, most = len(self.items[k]), int(self.most[k])
            last = first
            # neighbouring stretches are verified together
            while at < len(candidates) and candidates[at][0] == k and candidates[at][1] <= first + size // 2:
                last = candidates[at][1]
                at += 1
            begin = max(0, first - most - 1)
            stop = min(len(points), last + 2 * (most + 1) + size + most + 1)
            match = _nearest(self.items[k], points[begin:stop], most)
            if match and begin + match[0] < _STRETCH:
                found.add((k, base + begin + match[0], base + begin + match[1], match[2]))


def _distances(item: list[int], points: list[int], free: bool) -> Iterator[int]:
    """Edits between the item and the points up to each place, from any place if free, else from the first
    (the bit-parallel recurrence of Myers)."""
    full, high = (1 << len(item)) - 1, 1 << (len(item) - 1)
    own: dict[int, int] = {}
    for i, c in enumerate(item):
        own[c] = own.get(c, 0) | 1 << i
    more, less, edits = full, 0, len(item)
    yield edits
    for c in points:
        equal = own.get(c, 0)
        down = equal | less
        across = (((equal & more) + more) ^ more) | equal
        up = less | full & ~(across | more)
        fall = more & across
        edits += bool(up & high) - bool(fall & high)
        up = (up << 1 | (not free)) & full
        fall = fall << 1 & full
        more = fall | full & ~(down | up)
        less = up & down
        yield edits


def _nearest(item: np.ndarray, points: np.ndarray, most: int) -> tuple[int, int, int] | None:
    """(start, end, edits) of the stretch nearest to the item, if within ``most`` edits."""
    own, text = item.tolist(), points.tolist()
    ends = list(_distances(own, text, True))
    edits = min(ends)
    if edits > most:
        return None
    end = ends.index(edits)
    # the same backwards from that end gives the start
    back = list(_distances(own[::-1], text[max(0, end - len(own) - most) : end][::-1], False))
    return end - back.index(min(back)), end, edits


def _indexes(benchmark: DataFrame) -> list[Index]:
    """Benchmark items in groups of bounded size; a benchmark is small, its groups are searched in turn."""
    items = [
        (r["item_id"], r["text"])
        for r in benchmark.select("item_id", "text").filter(F.col("text").isNotNull()).orderBy("item_id", "text").toLocalIterator()
    ]
    return [Index(items[i : i + ITEMS]) for i in range(0, len(items), ITEMS)]


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, start, end, edits``: a row for each place where a text has an item."""
    doc_kind, item_kind = docs.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", doc_kind),
            T.StructField("item_id", item_kind),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("edits", T.LongType()),
        ]
    )
    small_batches(docs.sparkSession)
    found = docs.sparkSession.createDataFrame([], schema)
    for index in _indexes(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            search = shared.value.search
            for batch in batches:
                matches = search(list(batch["text"]))
                rows = [(i, *m) for i, own in zip(batch["doc_id"], matches) for m in own]
                if rows:
                    yield pd.DataFrame(rows, columns=schema.names)

        found = found.unionByName(docs.select("doc_id", "text").mapInPandas(tidy(run), schema))
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows whose text has no item, all columns kept. No shuffle."""
    small_batches(docs.sparkSession)

    def without(shared) -> Callable:
        def searched(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                yield pd.Series([not own for own in shared.value.search(list(texts))], dtype=bool)

        def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            yield from tidy(searched)(batches)

        return F.pandas_udf(clean, "boolean")

    kept = docs
    for index in _indexes(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        kept = kept.filter(without(shared)(F.coalesce("text", F.lit(""))))
    return kept
