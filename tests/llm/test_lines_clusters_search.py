"""Line dedup, centroid clusters and lexical search on odd tables, against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from changetrail.llm import centroid_clusters, lexical_search, line_dedup
from changetrail.llm.perfect_hash import PerfectHash
from tests.llm.test_operators import TEXTS, documents

BLANKS = " \t\n\x0b\x0c\r"
LAST = 2**63 - 1


def folded(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


@pytest.fixture(scope="module")
def vocabulary_texts():
    dice = random.Random(11)
    words = [f"{a}{b}" for a in ("ab", "Cd", "ÉÑ", "9x", "日") for b in range(30)]
    texts = [" ".join(dice.choices(words, k=dice.randint(0, 60))) for _ in range(120)]
    return words, texts + texts[:20] + [None, "", "...", "ab1,ab1;AB1\x00ab1 ab1"] + TEXTS


def kept_lines(rows):
    """(doc_id, n_lines, n_dropped, copies, kept) of each (doc_id, text), by the words of the contract."""
    ids = [LAST if i is None else i for i, _ in rows]
    lines = [(t or "").split("\n") for _, t in rows]
    keys = [[folded(x.strip(BLANKS)) for x in own] for own in lines]
    holders: dict = {}
    for i, own in zip(ids, keys):
        for key in {k for k in own if len(k) >= 10}:
            holders.setdefault(key, []).append(i)
    repeated = {k: (min(v), len(v)) for k, v in holders.items() if len(set(v)) > 1}
    for (doc, _), i, own, key in zip(rows, ids, lines, keys):
        stay = [x for x, k in zip(own, key) if k not in repeated or repeated[k][0] == i]
        copies = max([repeated[k][1] for k in key if k in repeated], default=0)
        yield doc, len(own), len(own) - len(stay), copies, "\n".join(stay)


def line_rows():
    dice = random.Random(3)
    shared = [f"  Shared line number {i}\t" for i in range(40)] + ["日本語日本語日本語日", "日本語日本語日本語", "short", " " * 20]
    texts = [
        "\n".join(dice.choices(shared, k=dice.randint(0, 30)) + [f"own line of text {n}"] * dice.randint(0, 2))
        for n in range(150)
    ]
    texts += ["SHARED LINE NUMBER 1\r\n\n\n", "\n", "\x85Shared line number 1", "a\nb\nc", "every line\n" * 500]
    rows = [*enumerate(texts), (-5, shared[2]), (77, shared[3]), (77, shared[3]), (77, shared[4] + "\nfresh words here"), (None, shared[5])]
    return rows + [(1000 + i, t) for i, t in enumerate(TEXTS)]


def test_lines_that_stay_are_those_of_brute_force(spark):
    rows = line_rows()
    docs = documents(spark, [t for _, t in rows], [i for i, _ in rows])
    got = line_dedup.drop_repeated_lines(docs)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "copies", "kept"]
    want = Counter(kept_lines(rows))
    assert Counter(map(tuple, got.collect())) == want
    assert sum(r[2] for r in want) > 1000


def test_groups_of_shards_give_the_same_lines(spark, monkeypatch):
    """Shards sent one at a time, and the marks of earlier ones carried on."""
    monkeypatch.setattr(line_dedup, "LEAST_SHARDS", 3)
    rows = line_rows()
    docs = documents(spark, [t for _, t in rows], [i for i, _ in rows])
    got = line_dedup.drop_repeated_lines(docs, group_bytes=1)
    assert Counter(map(tuple, got.collect())) == Counter(kept_lines(rows))


def test_lines_of_no_documents(spark):
    assert line_dedup.drop_repeated_lines(documents(spark, [])).collect() == []


def test_perfect_hash_is_minimal_and_perfect():
    dice = np.random.default_rng(5)
    for n in (0, 1, 2, 63, 64, 65, 20_000):
        low, high = dice.integers(0, 2**64, (2, n), dtype=np.uint64)
        low[: n // 3] = 7  # halves may be alike
        places = PerfectHash(low, high)
        assert sorted(places.index(low, high)) == list(range(n))
        assert places.nbytes <= 2 * n + 200
    others = places.index(*dice.integers(0, 2**64, (2, 500), dtype=np.uint64))
    assert others.min() >= -1 and others.max() < n


def clustered(vectors, n_clusters=40, rounds=5):
    """Plain nearest centroids over (vec_id, integers)."""
    def hashed(i):
        return "~" if i is None else hashlib.sha256(f"2:{i}".encode()).hexdigest()

    centroids = [v for _, _, v in sorted((hashed(i), v, v) for i, v in vectors)][:n_clusters]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        own: dict = {}
        for _, v in vectors:
            own.setdefault(nearest(v)[1], []).append(v)
        centroids = [
            [sum(x) // len(own[k]) for x in zip(*own[k])] if k in own else c for k, c in enumerate(centroids)
        ]
    found = [(i, *nearest(v)) for i, v in vectors]
    sums = Counter()
    for _, d, k in found:
        sums[k] += d
    total = sum(sums.values())
    for i, d, k in found:
        yield i, k, min(d, LAST), min(sums[k], LAST), min(total, LAST), ",".join(map(str, centroids[k]))


def vector_table(spark, rows, kind="float"):
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    return frame.selectExpr("*", "1 label", "2 cluster", "'c' centroid", "3 distance")


def as_integers(rows):
    return [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows]


@pytest.mark.parametrize("scale", [1.0, 3e4, 1e30])
def test_clusters_are_those_of_brute_force(spark, scale):
    """Also where numbers leave 64 bits behind."""
    dice = np.random.default_rng(8)
    middles = dice.normal(0, 1, (7, 64))
    points = np.float32(scale * (middles[dice.integers(0, 7, 130)] + dice.normal(0, 0.3, (130, 64))))
    rows = [(i, v.tolist()) for i, v in enumerate(points)]
    rows += [(5, rows[5][1]), (5, rows[6][1]), (None, rows[9][1]), *[(200 + i, rows[3][1]) for i in range(30)]]
    kept = as_integers(rows)
    good = rows[0][1]
    odd = [(900, None), (901, []), (902, good[:63]), (903, [*good, 1.0]), (904, [None, *good[1:]])]
    odd += [(905, [float("nan"), *good[1:]]), (906, [float("inf"), *good[1:]])]
    got = centroid_clusters.cluster(vector_table(spark, rows + odd))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    assert Counter(map(tuple, got.collect())) == Counter(clustered(kept))


def test_few_or_no_vectors(spark):
    rows = [(1, [0.5] * 64), (2, [0.5] * 64), (3, [-1.0] * 64)]
    got = centroid_clusters.cluster(vector_table(spark, rows, "double"))
    assert Counter(map(tuple, got.collect())) == Counter(clustered(as_integers(rows)))
    assert centroid_clusters.cluster(vector_table(spark, [])).collect() == []
    assert centroid_clusters.cluster(vector_table(spark, [(1, None), (2, [1.0])])).collect() == []


def test_ties_go_to_the_smaller_centroid():
    vectors = np.array([[0, 0, 0, 0], [1, 1, 1, 1], [5, 5, 5, 5]])
    middles = np.array([[1, 0, 0, 0], [0, 1, 0, 0], [0, 0, 0, 0], [0, 0, 0, 0]])
    number, distance = centroid_clusters.nearest(vectors, middles[:2], (1, 1, 2))
    assert number.tolist() == [0, 0, 0] and distance.tolist() == [1, 3, 16 + 75]
    number, distance = centroid_clusters.nearest(vectors, middles[[2, 3, 0]], (1, 1, 2))
    assert number.tolist() == [0, 2, 2] and distance.tolist() == [0, 3, 91]


def searched(docs, items, top=20):
    """Rows of the contract's formula; docs (doc_id, text), items (item_id, text)."""
    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", folded(text or ""))

    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, bag, bag.total()) for i, bag in bags if bag]
    n_docs, n_terms = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    for item, text in dict.fromkeys(items):
        asked = terms(text)
        found = []
        for i, bag, n in bags:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((1000000000 * bag[t]) // (1000 * bag[t] + 12 * m))
                for t in asked
                if t in bag
            )
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(found, key=lambda x: x[:3])[:top], 1):
            yield item, rank, i, -score


def item_table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 rank", "2 score", "3 number")


@pytest.mark.parametrize("block_bytes", [lexical_search.BLOCK_BYTES, 300])
def test_search_is_that_of_brute_force(spark, vocabulary_texts, block_bytes):
    words, texts = vocabulary_texts
    dice = random.Random(12)
    docs = [*enumerate(texts), *[(5000 - i, texts[7]) for i in range(60)], (5, texts[8]), (5, texts[8]), (None, texts[9])]
    items = [(i, " ".join(dice.choices(words, k=dice.randint(0, 12)))) for i in range(25)]
    items += [(1, items[1][1]), (1, "ab1 AB1 ab1 cd2"), (None, "ab3"), (90, None), (91, ""), (92, "unknown"), (93, texts[7])]
    frame = documents(spark, [t for _, t in docs], [i for i, _ in docs]).selectExpr("*", "1 n", "2 bag", "3 m", "4 rank")
    got = lexical_search.search(frame, item_table(spark, items), block_bytes=block_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, got.collect())) == Counter(searched(docs, items))


def test_search_scores_equal_bags_once(spark, vocabulary_texts):
    """Copies, and texts that differ outside the vocabulary only, are one class."""
    docs = documents(spark, ["ab1 x cd2", "ab1 y cd2", "cd2 ab1 zz", "ab1 ab1 cd2", None] + ["cd2, AB1! q"] * 50)
    block = lexical_search.Block([(0, lexical_search.terms(b"ab1 cd2 Ab1"))])
    assert sorted(block.vocabulary) == [b"ab1", b"cd2"] and block.times.tolist() == [2, 1]
    bags = lexical_search._bags(docs, block.vocabulary)
    classes = lexical_search._classes(bags, 54, 162, 20).collect()
    assert sorted(len(r["members"]) for r in classes) == [1, 20]
    assert sorted(r[0] for r in max(classes, key=lambda r: len(r["members"]))["members"]) == [0, 1, 2, *range(5, 22)]


def test_search_of_nothing(spark):
    nothing = documents(spark, [])
    assert lexical_search.search(nothing, item_table(spark, [(1, "word")])).collect() == []
    some = documents(spark, ["word", None])
    assert lexical_search.search(some, item_table(spark, [])).collect() == []
    assert lexical_search.search(some, item_table(spark, [(1, None), (2, "-")])).collect() == []
    assert lexical_search.search(documents(spark, [None, ""]), item_table(spark, [(1, "word")])).collect() == []
