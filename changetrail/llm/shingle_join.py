"""Near-duplicate texts by a Jaccard join on word shingles.

Two texts are linked when their sets of distinct five-word shingles have a Jaccard similarity of
0.8 or more; a group is what links reach. The join is exact, in these steps:

1. Texts with the same set are one node (told apart by a 64-bit hash of the set), so that copies
   are never paired with each other.
2. Prefix filter: in any global order of shingles, linked sets of size n and m share one of their
   first n - ceil(0.8 n) + 1 and m - ceil(0.8 m) + 1 shingles. The first order puts shingles that
   many texts hold last (found by counting prefixes, then all of the texts that have such), the
   others by hash. Only prefixes are sent, and only shingles of two different nodes are kept.
3. Nodes that share a prefix shingle are first paired with one pivot only, the node with the fewest
   rare shingles; so a group of m near copies gives m pairs, not m squared. Pairs must fit in
   size and in the place of the shingle.
4. Candidates must also share prefix shingles in ``ORDERS`` further orders; those that do are
   verified by counting.
5. Links so far give groups. Of the nodes that share a shingle but are in different groups, every
   pair that fits and was not tried is tried likewise, so that no link between groups is lost.
   Pairs inside a group would not change it and are left out.

Null texts and texts without words have the empty set and are linked with nothing; texts of fewer
than five words have one shingle, the whole. Repeated rows are one node, each row is returned. A
group's id is the smallest doc_id in it, nulls aside. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, saved, small_batches, tidy

WORDS = 5
#: A shingle in more prefixes than this is put behind the others.
OFTEN = 64
#: Such shingles that are sent to every task, at most (the most frequent ones; 8 bytes each).
MOST_FREQUENT = 1 << 18
#: Bits of a filter of ids, for each of them; and as a power of two, those of all parts together (32 MB) and of one part.
BITS_PER_ID = 128
MOST_BITS, PART_BITS = 28, 15
ORDERS = (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)

# A-Z count as lower case; words are cut at the bytes \x20 and \x09-\x0D
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_CUTS = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_NONE = np.zeros(0, "u8")
#: Shingles that a task adds up at a time, which bounds its memory (besides one shard of them).
_COUNTED = 1 << 19
#: Shards, by their first bits, in which shingles are sent to be counted: a row for each shard and ``_COUNTED`` shingles.
_SHARD_BITS = 12
#: Postings that a task hands on at a time.
_SENT_ROWS = 1 << 16
#: Nodes that a task remembers, so as not to send the shingles of copies again.
_REMEMBERED = 1 << 18
_M1, _M2 = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _M1
    return x ^ (x >> np.uint64(29))


#: One random number for each byte, after lower case; bytes between words count nothing.
_VALUES = np.where(_CUTS, np.uint64(0), _mixed(np.frombuffer(_LOWER, "u1").astype("u8") + np.uint64(0x51ED270B)))


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, "u8")
    powers[0] = 1
    return np.multiply.accumulate(powers)


_TABLE = 1 << 16
_UP, _DOWN = (_powers(base, _TABLE) for base in (int(_M2), pow(int(_M2), -1, 1 << 64)))


def _words(data: bytes) -> np.ndarray:
    """A hash of each word: the sum of its bytes' numbers, each times a power of its place, mixed."""
    values = _VALUES[np.frombuffer(data, "u1")]
    inside = values != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = np.flatnonzero(first)
    n = len(values)
    if not len(starts):
        return np.zeros(0, "u8")
    up, down = (_UP, _DOWN) if n <= _TABLE else (_powers(int(b[1]), n) for b in (_UP, _DOWN))
    # powers of the place in the text, then taken back to those of the place in the word
    values *= up[:n]
    return _mixed(np.add.reduceat(values, starts) * down[starts])


def _encoded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    return _shingles(_encoded(text))


def _shingles(data: bytes) -> np.ndarray:
    ids = _words(data)
    if not len(ids):
        return ids
    size = min(WORDS, len(ids))
    n = len(ids) - size + 1
    key = np.full(n, size, "u8")
    for i in range(size):
        key = (key ^ ids[i : i + n]) * _M2
        key ^= key >> np.uint64(31)
    key = np.sort(_mixed(key))
    return key[np.concatenate([[True], key[1:] != key[:-1]])]


def node_of(hashes: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes())))) if len(hashes) else 0


def _prefix(hashes: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, int]:
    """The prefix in the first order, and how many of all shingles are not frequent."""
    n = len(hashes)
    rare = n
    if len(often):
        place = np.minimum(np.searchsorted(often, hashes), len(often) - 1)
        frequent = often[place] == hashes
        rare = n - int(frequent.sum())
        hashes = np.concatenate([hashes[~frequent], hashes[frequent]])
    return hashes[: n - (4 * n + 4) // 5 + 1], rare


def _texts(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def nodes(docs: DataFrame) -> DataFrame:
    """``doc_id, node, n, prefix`` of every row: its set's hash and size, and the prefix in order of hashes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingles(text) for text in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "node": [node_of(s) for s in sets],
                    "n": [len(s) for s in sets],
                    "prefix": [_prefix(s, _NONE)[0].view("i8") if len(s) else s.view("i8") for s in sets],
                }
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _texts(docs).mapInPandas(tidy(run), f"doc_id {kind}, node long, n long, prefix array<long>")


def _postings(docs: DataFrame, often: np.ndarray) -> DataFrame:
    """``token, node, n, most, rare``: a row for each prefix shingle of a node, or some more if tasks share the node.

    ``most`` is the largest set that can be linked with this one if this is the first shingle that
    both hold.
    """
    shared = docs.sparkSession.sparkContext.broadcast(often)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        often = shared.value
        done: set[int] = set()
        names = ("token", "node", "n", "most", "rare")
        for batch in batches:
            columns: list[list[np.ndarray]] = [[], [], [], [], []]
            held = 0
            for text in batch["text"]:
                hashes = shingles(text)
                n = len(hashes)
                node = node_of(hashes)
                if not n or node in done:
                    continue
                if len(done) >= _REMEMBERED:
                    done.clear()
                done.add(node)
                prefix, rare = _prefix(hashes, often)
                places = np.arange(len(prefix))
                values = (prefix.view("i8"), node, n, (n - places) * 9 // 4 - n, rare)
                for column, value in zip(columns, values):
                    column.append(np.broadcast_to(value, len(prefix)))
                held += len(prefix)
                if held >= _SENT_ROWS:
                    yield pd.DataFrame({k: np.concatenate(c).astype("i8") for k, c in zip(names, columns)})
                    columns, held = [[], [], [], [], []], 0
            if columns[0]:
                yield pd.DataFrame({k: np.concatenate(c).astype("i8") for k, c in zip(names, columns)})

    return _texts(docs).mapInPandas(tidy(run), "token long, node long, n long, most long, rare long")


def _array(frame: DataFrame, column: str) -> np.ndarray:
    # as Arrow: rows of Python's objects would be some twenty times as large on the driver
    return np.sort(frame.select(column).toArrow().column(column).to_numpy().astype("i8").view("u8"))


def _counts_of_touched(docs: DataFrame, often: np.ndarray) -> DataFrame:
    """``token, count`` above ``OFTEN``: all shingles, not only the prefixes, of the nodes whose prefix holds a frequent one.

    A node counts once for each task that meets it, which copies make more than one. Nearly all of these shingles
    are rare, so they are not rows of their own: they are sent as arrays, and added up shard by shard.
    """
    shared = docs.sparkSession.sparkContext.broadcast(often)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        often = shared.value
        found: list[np.ndarray] = []
        held = 0
        done: set[int] = set()

        def counted() -> pd.DataFrame:
            token, count = np.unique(np.concatenate(found), return_counts=True)
            shard = token >> np.uint64(64 - _SHARD_BITS)
            starts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
            ends = [*starts[1:].tolist(), len(token)]
            parts = [slice(*x) for x in zip(starts.tolist(), ends)]
            return pd.DataFrame(
                {
                    "shard": shard[starts].astype("i4"),
                    "tokens": [token[x].tobytes() for x in parts],
                    "counts": [count[x].astype("<u4").tobytes() for x in parts],
                }
            )

        for batch in batches:
            for text in batch["text"]:
                hashes = shingles(text)
                prefix = hashes[: len(hashes) - (4 * len(hashes) + 4) // 5 + 1]
                if len(prefix) and len(often):
                    place = np.minimum(np.searchsorted(often, prefix), len(often) - 1)
                    if (often[place] == prefix).any() and (node := node_of(hashes)) not in done:
                        if len(done) >= _REMEMBERED:
                            done.clear()
                        done.add(node)
                        found.append(hashes)
                        held += len(hashes)
                if held >= _COUNTED:
                    yield counted()
                    found, held = [], 0
        if found:
            yield counted()

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        held, last = 0, None

        def often_found() -> pd.DataFrame:
            token, place = np.unique(np.concatenate(tokens), return_inverse=True)
            count = np.bincount(place, np.concatenate(counts), len(token)).astype("i8")
            return pd.DataFrame({"token": token.view("i8"), "count": count})[count > OFTEN]

        for batch in batches:
            for shard, own, number in zip(batch["shard"], batch["tokens"], batch["counts"]):
                if shard != last and held >= _COUNTED:
                    yield often_found()
                    tokens, counts, held = [], [], 0
                last = shard
                tokens.append(np.frombuffer(own, "u8"))
                counts.append(np.frombuffer(number, "<u4"))
                held += len(tokens[-1])
        if held:
            yield often_found()

    sent = _texts(docs).mapInPandas(tidy(run), "shard int, tokens binary, counts binary")
    return sent.repartition("shard").sortWithinPartitions("shard").mapInPandas(tidy(added), "token long, count long")


def _frequent(docs: DataFrame, members: DataFrame) -> np.ndarray:
    """The frequent shingles, put last.

    Putting shingles last brings others of the same texts into the prefixes. So where a prefix holds a frequent
    shingle, all of the text's shingles are counted: what is frequent among them is put last at once. Then
    a text's own shingles come first, and a place far back in both texts tells that they have too little in common.
    """
    first = members.select(F.explode("prefix").alias("token")).groupBy("token").count().filter(F.col("count") > OFTEN)
    often = _most_frequent(first)
    if len(often):
        often = np.union1d(often, _most_frequent(saved(_counts_of_touched(docs, often), "frequent")))
    return often


def _most_frequent(counts: DataFrame) -> np.ndarray:
    return _array(counts.orderBy(F.desc("count"), "token").limit(MOST_FREQUENT // 2), "token")


def _marked(rows: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """The rows with a column ``name``: true where ``id`` is among the distinct ids, and for a few others.

    The ids set bits at places given by their hash. Only these bits are sent to the tasks, so rows, which hold texts,
    stay where they are. More ids than the bits are meant for make more of the other rows true.
    """
    bits = min(MOST_BITS, max(PART_BITS, (BITS_PER_ID * ids.count()).bit_length()))
    place = F.xxhash64("id").bitwiseAND((1 << bits) - 1)
    part = F.shiftright(place, PART_BITS).alias("part")
    places = ids.select(part, place.bitwiseAND((1 << PART_BITS) - 1).alias("place")).repartition("part")
    parts = places.groupBy("part").agg(F.bitmap_construct_agg("place").alias("bits"))
    byte = F.substring("bits", F.shiftright("place", 3) % (1 << PART_BITS - 3) + 1, F.lit(1))
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), F.col("place") % 8) == 1
    joined = rows.select("*", part, place.alias("place")).join(F.broadcast(parts), "part", "left")
    return joined.select(*rows.columns, F.coalesce(is_set, F.lit(False)).alias(name))


def _packed_texts(docs: DataFrame, members: DataFrame, pairs: DataFrame) -> DataFrame:
    """``node, packed`` of the nodes in the pairs, from one document of each, and of a few others.

    A compressed text is about a quarter of the size of its set of 64-bit hashes.
    """
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    one = members.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    ids = saved(one.select(F.struct("doc_id").alias("id")).distinct(), "candidates")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            yield pd.DataFrame(
                {
                    "node": [node_of(shingles(text)) for text in batch["text"]],
                    "packed": [pack(_encoded(text)) for text in batch["text"]],
                }
            )

    rows = docs.select(F.struct("doc_id").alias("id"), "doc_id", "text")
    texts = _marked(rows, ids, "wanted").filter("wanted")
    return _texts(texts).mapInPandas(tidy(run), "node long, packed binary").groupBy("node").agg(
        F.first("packed").alias("packed")
    )


def _common(a: np.ndarray, b: np.ndarray) -> int:
    both = np.concatenate([a, b])
    both.sort()
    return int(np.count_nonzero(both[1:] == both[:-1]))


def _with_heads(hashes: np.ndarray) -> tuple[np.ndarray, ...]:
    """A set, and its prefixes in the further orders."""
    size = len(hashes) - (4 * len(hashes) + 4) // 5 + 1
    # mixing is one to one, so places in an order may stand for the shingles themselves
    return hashes, *(np.partition(_mixed(hashes * np.uint64(seed)), size - 1)[:size] for seed in ORDERS)


def _linked(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> bool:
    if not all(_common(x, y) for x, y in zip(a[1:], b[1:])):  # the prefixes of further orders must meet too
        return False
    common = _common(a[0], b[0])
    return 100 * common >= 80 * (len(a[0]) + len(b[0]) - common)


def _verified(docs: DataFrame, members: DataFrame, pairs: DataFrame) -> DataFrame:
    """``a, b, linked`` of distinct pairs of nodes, saved."""
    texts = _packed_texts(docs, members, pairs)
    left = texts.select(F.col("node").alias("a"), F.col("packed").alias("packed_a"))
    right = texts.select(F.col("node").alias("b"), F.col("packed").alias("packed_b"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor().decompress
        set_of = lru_cache(256)(lambda packed: _with_heads(_shingles(unpack(packed))))
        for batch in batches:
            linked = [_linked(set_of(x), set_of(y)) for x, y in zip(batch["packed_a"], batch["packed_b"])]
            yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "linked": linked})

    joined = pairs.select("a", "b").join(left, "a").join(right, "b")
    return saved(joined.mapInPandas(tidy(run), "a long, b long, linked boolean"), "pairs")


def groups(links: DataFrame) -> DataFrame:
    """``node, label``: the smallest node that links (a, b) reach, for every node in a link.

    Alternates large-star and small-star: all larger neighbours, then all smaller ones, are tied to
    the smallest neighbour, until the edges are stars. Each round is saved.
    """
    edges = saved(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    print_of = lambda frame: tuple(
        frame.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
    )
    before = print_of(edges)
    while before[0]:
        around = edges.union(edges.select("v", "u"))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = around.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        edges = large.filter("u > v")
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        small = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = small.union(least.select("u", F.col("m").alias("v"))).filter("u > v").distinct()
        edges = saved(edges, "edges")
        after = print_of(edges)
        if after == before:
            break
        before = after
    tips = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return tips.union(edges.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct()


def components(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    cut = saved(nodes(docs), "prefixes")
    members = saved(cut.drop("prefix"), "nodes")
    often = _frequent(docs, cut)
    discard(cut)
    # dealt by shingle once: the lists are found and joined where the rows lie, a row a list
    found = _postings(docs, often).repartition("token")
    lists = found.groupBy("token").agg(
        F.min("node").alias("low"),
        F.max("node").alias("high"),
        F.min(F.struct("rare", "node", "n", "most")).alias("pivot"),
    )
    own = found.join(lists.filter("low != high").select("token", "pivot").hint("merge"), "token")
    own = saved(own, "shared-shingles")

    fits = lambda n, most, m, most_m: (n <= most_m) & (m <= most) & (5 * F.least(n, m) >= 4 * F.greatest(n, m))
    p = F.col("pivot")
    star = (
        own.filter((F.col("node") != p["node"]) & fits(F.col("n"), F.col("most"), p["n"], p["most"]))
        .select(F.least("node", p["node"]).alias("a"), F.greatest("node", p["node"]).alias("b"))
        .distinct()
    )
    tried = _verified(docs, members, saved(star, "star-pairs"))
    first = saved(groups(tried.filter("linked")), "groups")

    labelled = own.join(first, "node", "left").select(
        "token", "node", "n", "most", F.coalesce("label", "node").alias("label")
    ).repartition("token")
    open_lists = labelled.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    open_lists = open_lists.filter("low != high").select("token")
    rest = saved(labelled.join(open_lists, "token", "left_semi").distinct(), "open-lists")
    discard(own)
    x, y = rest.alias("x"), rest.alias("y")
    crossing = (
        x.join(
            y,
            (F.col("x.token") == F.col("y.token"))
            & (F.col("x.node") < F.col("y.node"))
            & (F.col("x.label") != F.col("y.label"))
            & fits(F.col("x.n"), F.col("x.most"), F.col("y.n"), F.col("y.most")),
        )
        .select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        .distinct()
        .join(tried.select("a", "b"), ["a", "b"], "left_anti")
    )
    more = _verified(docs, members, saved(crossing, "crossing-pairs"))
    final = groups(tried.filter("linked").union(more.filter("linked")))

    grouped = members.join(final, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = grouped.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return grouped.join(least, "label").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each group, that with its smallest doc_id (of equal rows one); all columns kept.

    Rows without a doc_id stay only if no row of their group has one, and one of them for each text.
    """
    found = components(docs)
    keeps = F.col("doc_id").eqNullSafe(F.col("component_id"))
    ids = saved(found.groupBy(F.struct("doc_id").alias("id")).agg(F.count_if(keeps).alias("count")), "kept")
    kept = ids.filter("count > 0")
    rows = docs.select(F.struct("doc_id").alias("id"), F.struct("*").alias("row"))
    rows = _marked(_marked(rows, ids.filter("count != 1"), "other"), kept, "kept")
    alone = rows.filter("not other").select("row.*")
    # only texts that both filters let through are shuffled; of these, rows that share doc_id and text are the same
    # document (where one row of a doc_id keeps it, its texts differ)
    open_rows = rows.filter("other and kept").join(kept, "id", "left_semi")
    open_rows = open_rows.groupBy("id", F.xxhash64("row.text").alias("tie")).agg(F.first("row").alias("row"))
    return alone.unionByName(open_rows.select("row.*"))
