"""Ranked lexical search that scores each distinct bag of words once.

Documents are reduced to the items' vocabulary: a document becomes its bag, the numbers of the vocabulary's terms
in it with their frequencies, beside its number of terms. Corpus statistics come from that one pass: N and L from the
rows, document frequencies from one vector of counts per task. With N and L known each document has its m, and
documents with the same bag and the same m have the same score for every item. Such classes are found by
a 128-bit hash of the bag and m, and verified by the bag itself. A class keeps its ``top`` smallest doc_ids, as no more of equal
score can be among an item's ``top`` documents; that limit works before the shuffle too, so a class with a third of
all rows is at most ``top`` rows a task. Each class is scored once against all items, each task keeps its best
``top`` documents of every item, members expanded by ascending doc_id, and one ranking over those is the result.

Items are taken in blocks of at most ``BLOCK_BYTES`` of text (or of one item); a block's vocabulary is what is sent to
tasks. Documents are read once for each block.

Terms, weights and scores are those of ``m_of``, ``weight`` and ``_scores``. All sums are exact 64-bit integers.
A null or empty text has no terms: as a document it counts nowhere and is never found, as an item it finds nothing.
Every row is a document of its own, also where rows repeat; a null doc_id comes after all others of equal score. Repeated items
(same item_id and text) are one; different texts with the same item_id, null included, are ranked each on their own. An empty
table gives an empty result. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import saved, small_batches

TOP = 20
BLOCK_BYTES = 1 << 20
#: Pairs of class and item, or of term and item, that a task holds at a time.
_CELLS = 1 << 20

# Everything but ASCII letters, digits and what is not ASCII parts terms; A-Z are lower-cased.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def weight(n_docs: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequency + 1)))


def m_of(n: Column, n_docs: int, n_terms: int) -> Column:
    """A document's m from its number of terms; wide decimals keep the product exact."""
    product = (25 * n).cast("decimal(20,0)") * F.lit(n_docs).cast("decimal(18,0)")
    return F.lit(75).cast("long") + F.call_function("div", product, F.lit(n_terms).cast("decimal(38,0)"))


class Block:
    """Some items: their vocabulary, and for each term the items that hold it and how often."""

    def __init__(self, items: list[tuple[int, list[bytes]]]):
        self.numbers = np.array([number for number, _ in items], np.int64)
        counts = [Counter(words) for _, words in items]
        self.vocabulary = {t: i for i, t in enumerate(sorted(set().union(*counts)))}
        posted = sorted(
            (self.vocabulary[t], place, n) for place, found in enumerate(counts) for t, n in found.items()
        )
        term, place, times = np.array(posted, np.int64).reshape(-1, 3).T
        self.starts = np.searchsorted(term, np.arange(len(self.vocabulary) + 1))
        self.places, self.times = place, times


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[tuple[list[tuple[int, object]], Block]]:
    """Blocks of items, each with the item_id of its items by number. The driver holds one block at a time."""
    ids: list[tuple[int, object]] = []
    block: list[tuple[int, list[bytes]]] = []
    filled = 0
    for number, row in enumerate(items.select("item_id", "text").distinct().toLocalIterator()):
        text = (row["text"] or "").encode()
        if block and filled + len(text) > block_bytes:
            yield ids, Block(block)
            ids, block, filled = [], [], 0
        ids.append((number, row["item_id"]))
        block.append((number, terms(text)))
        filled += len(text)
    if block:
        yield ids, Block(block)


def _bags(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id``, ``n`` and, where the vocabulary occurs, ``bag`` and its ``hashed`` value of each document.

    Each task adds one row without ``n`` that holds in how many of its documents each term occurs.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def reduce_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        frequency = np.zeros(len(known), np.int64)
        ids = None

        def rows(ids: pa.Array, n: list, bags: list, counts: list) -> pa.RecordBatch:
            hashed = [None if bag is None else xxhash.xxh3_128_digest(bag) for bag in bags]
            columns = [pa.array(n, pa.int64()), pa.array(bags, pa.binary()), pa.array(hashed, pa.binary())]
            return pa.RecordBatch.from_arrays(
                [ids, *columns, pa.array(counts, pa.list_(pa.int64()))], ["doc_id", "n", "bag", "hashed", "frequency"]
            )

        for batch in batches:
            ids = batch.column("doc_id")
            texts = batch.column("text")
            texts = texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary())
            n, bags = [], []
            for text in texts.to_pylist():
                words = terms(text)
                found = sorted((known[t], times) for t, times in Counter(words).items() if t in known)
                n.append(len(words))
                if found:
                    bag = np.array(found, "<u4").T
                    frequency[bag[0]] += 1
                    bags.append(bag.tobytes())
                else:
                    bags.append(None)
            yield rows(ids, n, bags, [None] * len(n))
        if ids is not None:
            yield rows(pa.nulls(1, ids.type), [None], [None], [frequency.tolist()])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        reduce_texts, f"doc_id {kind}, n long, bag binary, hashed binary, frequency array<long>"
    )


def _classes(bags: DataFrame, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """One row per class: ``m``, ``bag`` and its ``top`` smallest doc_ids."""
    alike = ["hashed", "m", "bag"]
    ranked = W.partitionBy(*alike).orderBy(F.col("doc_id").asc_nulls_last())
    return (
        bags.where("bag IS NOT NULL")
        .select("hashed", m_of(F.col("n"), n_docs, n_terms).alias("m"), "bag", "doc_id")
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= top)
        .groupBy(*alike)
        # null ids are kept, as structs; the list has ``top`` entries at most
        .agg(F.collect_list(F.struct("doc_id")).alias("members"))
        .select("m", "bag", "members")
    )


def _scores(
    block: Block, weights: np.ndarray, row: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray, n: int
) -> np.ndarray:
    """Score of each of ``n`` classes for each item. The four arrays give each class's terms one after the other."""
    gain = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
    sizes = block.starts[term + 1] - block.starts[term]
    ends = np.cumsum(sizes)
    posting = np.arange(sizes.sum()) + np.repeat(block.starts[term] - (ends - sizes), sizes)
    cell = np.repeat(row, sizes) * len(block.numbers) + block.places[posting]
    gain = np.repeat(gain, sizes) * block.times[posting]
    # sums of halves are exact as doubles
    low, high = gain & 0x3FFFFFF, gain >> 26
    shape = (n, len(block.numbers))
    sums = [np.bincount(cell, part, n * len(block.numbers)).astype(np.int64) for part in (low, high)]
    return (sums[0] + (sums[1] << 26)).reshape(shape)


class _Best:
    """The best documents of each item that a task has seen."""

    def __init__(self, n_items: int, top: int):
        self.top = top
        self.floor = np.ones(n_items, np.int64)
        self.rows = [np.zeros(0, np.int64) for _ in range(3)] + [np.zeros(0, bool)]

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, no_id: np.ndarray) -> None:
        item, score, doc, no_id = (np.concatenate(x) for x in zip(self.rows, (item, score, doc, no_id)))
        order = np.lexsort((doc, no_id, -score, item))
        item, score, doc, no_id = item[order], score[order], doc[order], no_id[order]
        starts = np.searchsorted(item, item)
        rank = np.arange(len(item)) - starts
        last = rank == self.top - 1
        self.floor[item[last]] = score[last]
        self.rows = [x[rank < self.top] for x in (item, score, doc, no_id)]


def _ranked_by_task(classes: DataFrame, block: Block, weights: np.ndarray, top: int, kind: T.DataType) -> DataFrame:
    """``number`` (of the item), ``doc_id`` and ``score``: each task's best documents of every item."""
    sent = classes.sparkSession.sparkContext.broadcast((block, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weights = sent.value
        best, ids_type = _Best(len(block.numbers), top), None
        posted = np.diff(block.starts)
        for batch in batches:
            m = batch.column("m").to_numpy()
            bags = [np.frombuffer(bag, "<u4").reshape(2, -1) for bag in batch.column("bag").to_pylist()]
            lists = batch.column("members")
            starts, ids = lists.offsets.to_numpy(), lists.values.field(0)
            ids_type = ids.type
            no_id = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.cast(pa.int64()).fill_null(0).to_numpy()
            work = np.cumsum([max(posted[bag[0]].sum(), len(block.numbers)) for bag in bags])
            cuts = [0, *np.flatnonzero(np.diff(work // _CELLS)) + 1, len(bags)] if bags else []
            for a, b in zip(cuts[:-1], cuts[1:]):
                sizes = [bag.shape[1] for bag in bags[a:b]]
                term, tf = np.concatenate(bags[a:b], axis=1).astype(np.int64)
                row = np.repeat(np.arange(b - a), sizes)
                scores = _scores(block, weights, row, term, tf, np.repeat(m[a:b], sizes), b - a)
                number, item = np.nonzero(scores >= best.floor)
                members = starts[a + number + 1] - starts[a + number]
                ends = np.cumsum(members)
                place = np.arange(members.sum()) + np.repeat(starts[a + number] - (ends - members), members)
                found = np.repeat(scores[number, item], members)
                best.add(np.repeat(item, members), found, ids[place], no_id[place])
        if ids_type is not None:
            item, score, doc, no_id = best.rows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block.numbers[item]),
                    pa.array(doc, mask=no_id).cast(ids_type),
                    pa.array(score),
                ],
                ["number", "doc_id", "score"],
            )

    return classes.mapInArrow(run, f"number long, doc_id {kind.simpleString()}, score long")


def _frequencies(bags: DataFrame, size: int) -> np.ndarray:
    """In how many documents each term of the vocabulary occurs."""
    by_term = bags.where("frequency IS NOT NULL").select(F.posexplode("frequency").alias("term", "n"))
    found = np.zeros(size, np.int64)
    for row in by_term.groupBy("term").agg(F.sum("n").alias("n")).collect():
        found[row["term"]] = row["n"]
    return found


def _ranked(spark: SparkSession, docs: DataFrame, ids: list, block: Block, kind: str, top: int) -> DataFrame:
    """The block's items with their best documents."""
    bags = saved(_bags(docs, block.vocabulary), "bags")
    counts = bags.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    frequency = _frequencies(bags, len(block.vocabulary))
    weights = np.array([weight(counts["docs"], int(n)) for n in frequency], np.int64)
    classes = _classes(bags, counts["docs"], max(1, counts["terms"]), top)
    found = _ranked_by_task(classes, block, weights, top, docs.schema["doc_id"].dataType)
    best = W.partitionBy("number").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    # one row per item of the block
    named = spark.createDataFrame(ids, f"number long, item_id {kind}")
    return found.join(F.broadcast(named), "number").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id`` and ``score`` of each item's ``top`` best documents."""
    spark = docs.sparkSession
    small_batches(spark)
    kind = items.schema["item_id"].dataType.simpleString()
    parts = [_ranked(spark, docs, ids, block, kind, top) for ids, block in _blocks(items, block_bytes)]
    if not parts:
        doc_kind = docs.schema["doc_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id {doc_kind}, score long")
    return reduce(DataFrame.unionByName, parts)


#: The query op13, in DuckDB.
ORACLE = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
corpus AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM sizes),
weights AS (
  SELECT term, cast(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf CROSS JOIN corpus GROUP BY term, docs
), asked AS (
  SELECT item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), scores AS (
  SELECT item_id, doc_id,
         cast(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN sizes USING (doc_id) CROSS JOIN corpus
  GROUP BY item_id, doc_id
)
SELECT item_id, cast(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
       doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 20
"""
