"""Homomorphic multiset hashes of documents.

A text is the multiset of its paragraphs (lines). Each paragraph gives a wide vector of numbers,
and the fingerprint is the sum of these vectors, each entry modulo 2**32. So the order of
paragraphs does not matter, and a paragraph is put in or taken out by adding or subtracting its
vector (``added``, ``removed``), whatever the rest is. The entries are, in this order:

* ``EQUAL`` hashes of the paragraph: fingerprints of texts with different paragraphs differ,
  but for a chance of about 2**-256;
* ``NEAR`` counts: of the paragraph's pieces (it is cut after words that end in e, s or n), how
  many have a hash with that bit set. Their differences estimate how many pieces two texts
  share: ``likeness`` is 1 for equal fingerprints and near 0 for texts without common pieces;
* the number of pieces.

Null texts count as empty, which is one empty paragraph. Equal texts have equal fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

EQUAL, NEAR = 8, 64
_MODULUS = 1 << 32
#: Pieces whose counts are added up in 8 bits each.
_CHUNK = 127
#: Documents in one window partition when each is paired with the next.
_BLOCK = 64
#: Between pieces: the end of a paragraph, or spaces after certain letters.
_CUTS = r"\n|[esn][\x20\x09\x0B-\x0D]+"


def with_vector(frame: DataFrame, text: str, name: str) -> DataFrame:
    """Adds the vector of a text column: array of EQUAL + NEAR + 1 longs. No shuffle."""
    lines, pieces, packed = f"{name}_lines", f"{name}_pieces", f"{name}_packed"
    total = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x)
    low = lambda x: x.bitwiseAND(F.lit(_MODULUS - 1))
    line_hash = lambda i: lambda x: low(F.xxhash64(F.lit(i), x))
    hashes = [total(F.transform(lines, line_hash(i))) for i in range(EQUAL)]
    # eight counts of 8 bits share a long: bits i, i + 8, ... of the pieces' hashes; over _CHUNK
    # pieces, none of them overflows
    eighth = NEAR // 8
    eight = F.lit(sum(1 << (8 * q) for q in range(8)))
    chunks = F.transform(
        F.sequence(F.lit(0), F.floor(F.greatest(F.size(pieces) - 1, F.lit(0)) / _CHUNK).cast("int")),
        lambda c: F.slice(pieces, c * _CHUNK + 1, F.lit(_CHUNK)),
    )
    adding = lambda i: lambda a, h: a + F.shiftrightunsigned(h, i).bitwiseAND(eight)
    sums = F.transform(
        F.col(packed),
        lambda chunk: F.array(
            *[
                F.aggregate(chunk, F.lit(0).cast("long"), adding(i))
                for i in range(eighth)
            ]
        ),
    )
    count_of = lambda i, q: lambda c: F.shiftrightunsigned(F.get(c, i), 8 * q).bitwiseAND(F.lit(0xFF))
    counts = [
        total(F.transform(packed, count_of(i, q)))
        for q in range(8)
        for i in range(eighth)
    ]
    return (
        frame.withColumn(lines, F.split(F.coalesce(text, F.lit("")), "\n", -1))
        .withColumn(pieces, F.transform(F.split(F.coalesce(text, F.lit("")), _CUTS, -1), lambda x: F.xxhash64(x)))
        .withColumn(packed, chunks)
        .withColumn(packed, sums)
        .withColumn(
            name,
            F.transform(F.array(*hashes, *counts, F.size(pieces).cast("long")), low),
        )
        .drop(lines, pieces, packed)
    )


def added(a: Column, b: Column) -> Column:
    """Vector of both texts' paragraphs together."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x + y, F.lit(_MODULUS)))


def removed(a: Column, b: Column) -> Column:
    """Vector of the first text without the second's paragraphs."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x - y, F.lit(_MODULUS)))


def as_text(vector: Column) -> Column:
    """Eight lowercase hex digits for each entry."""
    return F.lower(F.array_join(F.transform(vector, lambda x: F.lpad(F.hex(x), 8, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common pieces, from 0 to 1; 1 for equal vectors."""
    def centred(v: Column) -> Column:
        n = F.get(v, EQUAL + NEAR)
        return F.transform(F.slice(v, EQUAL + 1, NEAR), lambda x: (2 * x - n).cast("double"))
    add = lambda xs: F.aggregate(xs, F.lit(0.0), lambda s, x: s + x)
    square = lambda xs: add(F.transform(xs, lambda x: x * x))
    apart = square(F.zip_with(centred(a), centred(b), lambda x, y: x - y))
    sizes = square(centred(a)) + square(centred(b))
    near = F.when(sizes > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - apart / sizes))).otherwise(0.0)
    return F.when(a == b, 1.0).otherwise(near)


def ranked(docs: DataFrame) -> tuple[DataFrame, int]:
    """Places of distinct (doc_id, text) by descending doc_id, then by a hash of the text; their number.

    Only ids and hashes are sorted. Equal rows have one place. A null id comes last.
    """
    own = docs.select(F.struct("doc_id").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"))
    dealt = own.distinct().repartitionByRange(F.col("id.doc_id").desc_nulls_last(), F.col("tie"))
    dealt = saved(dealt.withColumn("part", F.spark_partition_id()), "ranks")
    counts = dealt.groupBy("part").count()
    # one row for each partition
    offsets = counts.select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("offset"))
    within = Window.partitionBy("part").orderBy(F.col("id.doc_id").desc_nulls_last(), "tie")
    placed = dealt.withColumn("place", F.row_number().over(within)).join(F.broadcast(offsets), "part")
    return placed.select("id", "tie", (F.col("offset") + F.col("place") - 1).alias("rank")), dealt.count()


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts, and how like they are to an edited text and to the next document.

    The edited text has its last third of code points replaced by as many first ones of the next
    document (all, if that is shorter), the next being the one with the next smaller doc_id (after
    the last, the first; the only one is its own next). Repeated rows have the same next and the
    same result, once per row; texts with the same doc_id follow each other by a hash.
    Extra columns are ignored.
    """
    places, number = ranked(docs)
    own = docs.select(F.struct("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    own = own.withColumn("tie", F.xxhash64("text")).join(places, ["id", "tie"])
    # a block's first document is also put behind the block before it (the very first behind the last)
    behind = F.when(F.col("rank") == 0, F.lit(number)).otherwise(F.col("rank"))
    copies = F.array(
        F.struct(F.floor(F.col("rank") / _BLOCK).alias("block"), F.col("rank").alias("at"), F.lit(True).alias("own")),
        F.struct(F.floor((behind - 1) / _BLOCK).alias("block"), behind.alias("at"), F.lit(False).alias("own")),
    )
    wanted = F.when(F.col("rank") % _BLOCK == 0, copies).otherwise(F.slice(copies, 1, 1))
    following = Window.partitionBy("block").orderBy("at").rangeBetween(1, 1)
    n, k = F.char_length("text"), F.floor(F.char_length("text") / 3).cast("int")
    pairs = (
        own.select("id", "text", F.explode(wanted).alias("copy"))
        .select("id", "text", "copy.*")
        .withColumn("next", F.first("text").over(following))
        .filter("own")
        .select(
            "id",
            "text",
            "next",
            n.cast("long").alias("n_chars"),
            F.concat(F.substring("text", F.lit(1), n - k), F.substring("next", F.lit(1), k)).alias("edited"),
        )
    )
    # the paragraphs before the edit are the same in both texts: what follows them is taken out
    # of the text's vector, and what is new put in
    same = F.char_length(F.regexp_extract(F.substring("text", F.lit(1), n - k), r"^(?s:.*)\n", 0))
    after = lambda c: F.substring(c, F.col("same") + 1, F.lit(2**31 - 1))
    vectors = pairs.withColumn("same", same).withColumn("rest", after(F.col("text"))).withColumn("new", after(F.col("edited")))
    # the next document's vector is computed again here: vectors would be more to shuffle
    for text, name in (("text", "vector"), ("next", "next_vector"), ("rest", "rest_vector"), ("new", "new_vector")):
        vectors = with_vector(vectors, text, name)
    edited_vector = added(removed(F.col("vector"), F.col("rest_vector")), F.col("new_vector"))
    sums = vectors.select(
        "id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "vector",
        edited_vector.alias("edited_vector"),
        "next_vector",
    )
    return (
        sums.select(
            F.col("id.doc_id").alias("doc_id"),
            "n_chars",
            "edited_sha256",
            as_text(F.col("vector")).alias("fingerprint"),
            as_text(F.col("edited_vector")).alias("edited_fingerprint"),
            likeness(F.col("vector"), F.col("edited_vector")).alias("near_edited"),
            likeness(F.col("vector"), F.col("next_vector")).alias("near_next"),
        )
    )
