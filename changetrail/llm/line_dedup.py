"""Drop lines that an earlier document holds, by probing sharded minimal perfect hashes.

A line's key is the line without blanks (space, tab to carriage return) at both ends, A-Z lower-cased. Keys of at
least ``MIN_CHARS`` code points found in at least two documents stay only in the document with the smallest doc_id
that holds them; there all of their lines stay.

First the keys' 128-bit hashes are counted: each batch of documents reduces its own to one row each, Spark's
partial aggregation reduces those of a task, so a line that every document holds costs a row a task. Hashes of
keys found in one document only are done with. The others are dealt into shards by hash; each shard becomes a
minimal perfect hash over its hashes with three arrays in its order: a 64-bit fingerprint (the other half of the
hash), the smallest doc_id and the number of rows. Documents are then read once more, whole, and their lines probe
the arrays; no line is joined and no text is shuffled. A line whose key is in no array fails on the fingerprint,
but for a chance of 2**-64.

Shards are sent to the tasks by groups of at most ``GROUP_BYTES`` (a shard is some 1 MB). One group is the rule; beyond
it each further group is one more scan of the documents, whose lines marked so far are written to the shared folder
in between. Nothing is left out at any size, and neither driver nor task holds more than a group.

A null or empty text is one empty line. A null doc_id counts as the largest id, 2**63 - 1. Rows with one and the
same doc_id are one document for the count, each with its own result. One text is handled in one task, whatever its
length. An empty table gives an empty result. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, small_batches
from .perfect_hash import PerfectHash

MIN_CHARS = 10
#: Bytes of arrays that the driver collects and sends to all tasks at once.
GROUP_BYTES = 64 << 20
#: Hashes in a shard, on average, and the least number of shards, so that many tasks build them.
SHARD_KEYS = 1 << 15
LEAST_SHARDS = 64

_BLANKS = b" \t\n\x0b\x0c\r"
_LAST_ID = 2**63 - 1


def _long_keys(text: bytes, min_chars: int) -> tuple[int, list[int], list[bytes]]:
    """Number of lines, and the places and keys of those that are long enough."""
    lines = text.lower().split(b"\n")
    places, keys = [], []
    for place, line in enumerate(lines):
        key = line.strip(_BLANKS)
        size = len(key)
        if size >= min_chars and (size >= 4 * min_chars or key.isascii() or len(key.decode()) >= min_chars):
            places.append(place)
            keys.append(key)
    return len(lines), places, keys


def _hashes(keys: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The halves of the keys' 128-bit hashes."""
    halves = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), "<u8").reshape(-1, 2)
    return halves[:, 0], halves[:, 1]


def _bytes(column: pa.Array) -> list[bytes]:
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def _given(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST_ID)).alias("own"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def _repeated(given: DataFrame, min_chars: int) -> DataFrame:
    """``low``, ``high``, ``first`` (smallest id) and ``copies`` of each key found in two documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, sizes = [], []
            for text in _bytes(batch.column("text")):
                keys = set(_long_keys(text, min_chars)[2])
                found.extend(keys)
                sizes.append(len(keys))
            if not found:
                continue
            low, high = _hashes(found)
            own = np.repeat(batch.column("own").to_numpy(), sizes)
            order = np.lexsort((high, low))
            low, high, own = low[order], high[order], own[order]
            starts = np.flatnonzero(np.r_[True, (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(low[starts].view(np.int64)),
                    pa.array(high[starts].view(np.int64)),
                    pa.array(np.minimum.reduceat(own, starts)),
                    pa.array(np.maximum.reduceat(own, starts)),
                    pa.array(np.diff(np.r_[starts, len(own)]).astype(np.int64)),
                ],
                ["low", "high", "first", "last", "copies"],
            )

    counted = given.select("own", "text").mapInArrow(
        count, "low long, high long, first long, last long, copies long"
    )
    return (
        counted.groupBy("low", "high")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("copies").alias("copies"))
        .where("first < last")
        .drop("last")
    )


def _shards(repeated: DataFrame, n_shards: int) -> DataFrame:
    """One row per shard: its arrays, and their size."""

    def build(keys: pd.DataFrame) -> pd.DataFrame:
        low, high = (keys[half].to_numpy().view(np.uint64) for half in ("low", "high"))
        places = PerfectHash(low, high)
        order = np.empty(len(keys), np.int64)
        order[places.index(low, high)] = np.arange(len(keys))
        copies = np.minimum(keys["copies"].to_numpy()[order], 2**32 - 1).astype(np.uint32)
        image = pickle.dumps((places, high[order], keys["first"].to_numpy()[order], copies))
        return pd.DataFrame({"shard": keys["shard"].iloc[:1].to_numpy(), "size": [len(image)], "image": [image]})

    dealt = repeated.withColumn("shard", F.pmod("low", F.lit(n_shards)).cast("int"))
    return dealt.groupBy("shard").applyInPandas(build, "shard int, size long, image binary")


class _Group:
    """Some shards as tasks hold them."""

    def __init__(self, images: dict[int, bytes], n_shards: int):
        self.shards = {shard: pickle.loads(image) for shard, image in images.items()}
        self.n_shards = n_shards

    def probe(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Smallest doc_id and number of rows of each key, 0 rows where it is in none of the shards."""
        first, copies = np.zeros(len(low), np.int64), np.zeros(len(low), np.int64)
        # as Spark deals them: the remainder of the signed number, made positive
        shard = np.mod(low.view(np.int64), self.n_shards)
        order = np.argsort(shard, kind="stable")
        bounds = np.searchsorted(shard[order], np.arange(self.n_shards + 1))
        for number, (places, fingerprints, firsts, counts) in self.shards.items():
            own = order[bounds[number] : bounds[number + 1]]
            index = places.index(low[own], high[own])
            own, index = own[index >= 0], index[index >= 0]
            same = fingerprints[index] == high[own]
            first[own[same]], copies[own[same]] = firsts[index[same]], counts[index[same]]
        return first, copies


def _probed(docs: DataFrame, images: dict[int, bytes], n_shards: int, min_chars: int, last: bool) -> DataFrame:
    """Mark the lines that lose against the group's shards; at the last group, drop the marked ones."""
    sent = docs.sparkSession.sparkContext.broadcast((images, n_shards))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = _Group(*sent.value)
        for batch in batches:
            texts, marks = _bytes(batch.column("text")), batch.column("marks").to_pylist()
            most = batch.column("copies").to_numpy().copy()
            cut = [_long_keys(text, min_chars) for text in texts]
            sizes = [len(places) for _, places, _ in cut]
            low, high = _hashes(key for _, _, keys in cut for key in keys)
            first, copies = group.probe(low, high)
            own = np.repeat(batch.column("own").to_numpy(), sizes)
            row = np.repeat(np.arange(len(texts)), sizes)
            place = np.array([p for _, places, _ in cut for p in places], np.int64)
            np.maximum.at(most, row, copies)
            lost = (copies > 0) & (first != own)
            ends = np.searchsorted(row[lost], np.arange(len(texts) + 1))
            places = place[lost].astype("<i4")
            marks = [
                (old or b"") + places[a:b].tobytes() for old, a, b in zip(marks, ends[:-1], ends[1:])
            ]
            if last:
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array([n for n, _, _ in cut], pa.int64()),
                        pa.array([len(m) // 4 for m in marks], pa.int64()),
                        pa.array(most),
                        pa.array([_without(t, m) for t, m in zip(texts, marks)], pa.string()),
                    ],
                    ["doc_id", "n_lines", "n_dropped", "copies", "kept"],
                )
            else:
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c) for c in ("doc_id", "own", "text")],
                        pa.array(marks, pa.binary()),
                        pa.array(most),
                    ],
                    ["doc_id", "own", "text", "marks", "copies"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    inner = f"doc_id {kind}, own long, text string, marks binary, copies long"
    outer = f"doc_id {kind}, n_lines long, n_dropped long, copies long, kept string"
    return docs.mapInArrow(run, outer if last else inner)


def _without(text: bytes, marks: bytes) -> bytes:
    """The text without the lines whose numbers are marked."""
    if not marks:
        return text
    gone = set(np.frombuffer(marks, "<i4").tolist())
    return b"\n".join(line for place, line in enumerate(text.split(b"\n")) if place not in gone)


def _groups(shards: DataFrame, group_bytes: int) -> Iterator[dict[int, bytes]]:
    """Shards in groups of at most ``group_bytes``, or of one shard; at least one group, perhaps empty."""
    sizes = {r["shard"]: r["size"] for r in shards.select("shard", "size").collect()}
    group: list[int] = []
    filled = 0
    for shard, size in sorted(sizes.items()):
        if group and filled + size > group_bytes:
            yield _collected(shards, group)
            group, filled = [], 0
        group.append(shard)
        filled += size
    yield _collected(shards, group)


def _collected(shards: DataFrame, numbers: list[int]) -> dict[int, bytes]:
    if not numbers:
        return {}
    wanted = shards.where(F.col("shard").between(numbers[0], numbers[-1]))
    return {r["shard"]: bytes(r["image"]) for r in wanted.select("shard", "image").collect()}


def drop_repeated_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_dropped``, ``copies`` (rows that hold its most frequent repeated line, 0 if
    there is none) and ``kept`` (the text of the lines that stay) of each row."""
    small_batches(docs.sparkSession)
    given = _given(docs)
    repeated = saved(_repeated(given, min_chars), "repeated-lines")
    n_shards = max(LEAST_SHARDS, -(-repeated.count() // SHARD_KEYS))
    shards = saved(_shards(repeated, n_shards), "line-shards")
    marked = given.withColumns({"marks": F.lit(None).cast("binary"), "copies": F.lit(0).cast("long")})
    groups = _groups(shards, group_bytes)
    images = next(groups)
    for following in groups:
        marked = saved(_probed(marked, images, n_shards, min_chars, last=False), "marked-lines")
        images = following
    return _probed(marked, images, n_shards, min_chars, last=True)


#: Columns of the query op11, in DuckDB.
ORACLE = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS row FROM documents
), lines AS (
  SELECT doc_id, row, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS place FROM texts
), keyed AS (
  SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM lines
), repeated AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
)
SELECT k.doc_id, count(*) AS n_lines, count(r.key) FILTER (WHERE k.doc_id <> r.first) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place)
                       FILTER (WHERE r.key IS NULL OR k.doc_id = r.first), '')) AS kept_sha256
FROM keyed k LEFT JOIN repeated r USING (key) GROUP BY k.doc_id, k.row
"""
