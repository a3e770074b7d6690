"""Text quality by an interpolated modified Kneser-Ney model of characters.

The model counts all four-character strings of its trusted texts (all those labelled quality 1), each text
preceded by three start marks. Lower orders count the different characters
before a string. Each order takes one of three discounts off a count (of 1, 2 or more), estimated
from the counts of counts, and gives what was taken to the order below; under the lowest order
every character is equally likely.

To score the corpus, all of its strings are counted, and the distinct ones are joined with the
model's counts, both sharded by string, for each fold. The most frequent strings (``SENT`` at most, found by a
histogram of their counts) are sent to every task with their log-probabilities. The others,
none of which is frequent, leave each text as a list of strings, are joined with their
log-probabilities by a shuffle, and are added up again for each text. So texts are never shuffled,
and no string is hot in a join.

No text is judged by a model that has seen it: texts are dealt into ``FOLDS`` folds by a hash of the
text (so exact copies share one), and each fold is scored by the model of the trusted texts of the other
folds. Trusted and other clean texts thus have the same distribution at every size.

A text is measured by how far its mean negative log-probability is from the median of its language
and fold, drawn towards that median as if by ``PRIOR`` more characters, since short texts vary much.
It is accepted if it lies in its language's band around the median of the trusted texts: ``WIDTH``
times as far as their quantile 1 - ``OUTER`` above it, and twice ``WIDTH`` times as far as their
quantile ``OUTER`` below it, since repeated words make a text too likely and noise makes it too unlikely.
A language's quantiles are drawn towards those of all trusted texts, as if by ``SHRINK`` texts that
have these, and those of all likewise towards the corpus (its quartiles, widened to the same quantiles
of a normal distribution). So few trusted texts of a language do not make a narrow band. If some fold
has no trusted text, one model scores all and the corpus alone gives the band; without any trusted
text all are accepted.

Null texts count as empty; empty texts have the perplexity of their language's median and are
accepted. A null language is one of its own. Repeated rows are each scored; extra columns are
ignored. Characters beyond the basic plane are folded into it.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, small_batches, tidy

#: Strings that are sent to every task at most (16 bytes each).
SENT = 1 << 20
#: Trusted ids up to which they are sent to the tasks; more are joined as Spark sees fit.
TRUSTED = 1 << 20
#: Rejected rows up to which their ids are sent to the tasks; beyond, rows are dropped by a shuffled join.
REJECTED_SENT = 1 << 18
PRIOR = 100
OUTER = 0.1
WIDTH = 4.0
FOLDS = 2
SHRINK = 20
#: How much further from the median than the quartiles the quantiles of a normal distribution are.
_WIDEN = NormalDist().inv_cdf(1 - OUTER) / NormalDist().inv_cdf(0.75)
_START = 2
_PIECE = 2_000_000


def _strings(text: str) -> np.ndarray:
    """The four-character strings of a text, as 64-bit integers of 16 bits a character."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype("u8")
    points = np.where(points > 0xFFFF, 0xE000 + points % 0x1800, points)
    points = np.concatenate([np.full(3, _START, "u8"), points])
    n = len(points) - 3
    key = points[:n] << np.uint64(48)
    key |= points[1 : n + 1] << np.uint64(32)
    key |= points[2 : n + 2] << np.uint64(16)
    return (key | points[3 : n + 3]).view("i8")


class _Counts:
    """Different strings of the texts added and their counts, in bounded memory besides these."""

    def __init__(self) -> None:
        self.keys, self.counts = np.zeros(0, "i8"), np.zeros(0, "i8")
        self._held: list[np.ndarray] = []
        self._size = 0

    def add(self, text: str) -> None:
        own = _strings(text)
        self._held.append(own)
        self._size += len(own)
        if self._size >= _PIECE:
            self.merge()

    def merge(self) -> None:
        if not self._held:
            return
        new, number = np.unique(np.concatenate(self._held), return_counts=True)
        both, place = np.unique(np.concatenate([self.keys, new]), return_inverse=True)
        self.counts = np.bincount(place, np.concatenate([self.counts, number]), len(both)).astype("i8")
        self.keys, self._held, self._size = both, [], 0


def _low(column: str, characters: int) -> Column:
    """The last characters of a string."""
    return F.col(column).bitwiseAND(F.lit((1 << (16 * characters)) - 1))


def _fold(folds: int) -> Column:
    return F.pmod(F.xxhash64("text"), F.lit(folds)).cast("int")


def counts_of(docs: DataFrame, folds: int = 1) -> DataFrame:
    """``fold``, ``g`` and ``c``: all four-character strings of each fold's texts; each task adds up its
    own first."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = [_Counts() for _ in range(folds)]
        for batch in batches:
            for fold, text in zip(batch["fold"], batch["text"]):
                counts[fold].add(text)
        for fold, own in enumerate(counts):
            own.merge()
            yield pd.DataFrame({"fold": fold, "g": own.keys, "c": own.counts})

    rows = docs.select(_fold(folds).alias("fold"), F.coalesce("text", F.lit("")).alias("text"))
    counted = rows.mapInPandas(tidy(run), "fold int, g long, c long")
    return counted.groupBy("fold", "g").agg(F.sum("c").alias("c"))


class KneserNey:
    """Tables of the folds' models, from the counts of their strings; ``fold`` is a key in all of them."""

    def __init__(self, counts: DataFrame, folds: int = 1):
        tables = {4: saved(counts, "ngrams-4")}
        for order in (3, 2, 1):  # continuation counts: different characters before the string
            longer = tables[order + 1]
            shorter = longer.groupBy("fold", _low("g", order).alias("g")).agg(F.count("*").alias("c"))
            tables[order] = saved(shorter, f"ngrams-{order}")
        self.tables = tables
        self.by_fold = {n: self._discounts(t, folds) for n, t in tables.items()}
        # what precedes the last character of one is nothing: a number for each fold, not a join
        alone = {r["fold"]: r for r in self._contexts(1).collect()}
        self.alone = [(r["total"], r["given"]) if (r := alone.get(f)) else (None, None) for f in range(folds)]
        known = {r["fold"]: r["n"] for r in tables[1].groupBy("fold").agg(F.count("*").alias("n")).collect()}
        self.characters = [known.get(fold, 0) + 1 for fold in range(folds)]

    @property
    def discounts(self) -> dict[int, tuple[float, float, float]]:
        """Those of the first fold, by order."""
        return {order: found[0] for order, found in self.by_fold.items()}

    @staticmethod
    def _discounts(table: DataFrame, folds: int) -> list[tuple[float, float, float]]:
        numbers = [F.sum((F.col("c") == i).cast("long")).alias(f"n{i}") for i in range(1, 5)]
        found = {r["fold"]: r for r in table.groupBy("fold").agg(*numbers).collect()}
        discounts = []
        for fold in range(folds):
            n1, n2, n3, n4 = (float(found[fold][f"n{i}"]) if fold in found else 0.0 for i in range(1, 5))
            if n1 and n2 and n3 and n4:
                y = n1 / (n1 + 2 * n2)
                estimates = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
                discounts.append(tuple(min(max(d, 0.1), i - 0.05) for i, d in enumerate(estimates, 1)))
            else:
                discounts.append((0.5, 0.75, 0.9))  # too few counts of counts to estimate from
        return discounts

    def _discount(self, order: int) -> Column:
        d1, d2, d3 = (_by_fold([d[i] for d in self.by_fold[order]]) for i in range(3))
        return F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)

    def _contexts(self, order: int) -> DataFrame:
        """Of what precedes the last character: the sum of counts and the mass given below."""
        before = [F.shiftright("g", 16).alias("h")] if order > 1 else []
        return self.tables[order].groupBy("fold", *before).agg(
            F.sum("c").cast("double").alias("total"), F.sum(self._discount(order)).alias("given")
        )

    def log_probabilities(self, strings: DataFrame) -> DataFrame:
        """Adds ``logp`` to distinct four-character strings ``g`` of each ``fold`` (the first, if not given): one join by string and one by
        context for each order, from the lowest to the highest. Each order is written before the next is planned, so that no
        plan holds more than two joins."""
        if "fold" not in strings.columns:
            strings = strings.withColumn("fold", F.lit(0))
        frame = strings.select("fold", "g", _by_fold([1.0 / n for n in self.characters]).alias("p"))
        for order in (1, 2, 3, 4):
            table = self.tables[order].select(
                "fold", F.col("g").alias("own"), (F.col("c") - self._discount(order)).alias("kept")
            )
            own = _low("g", order) if order < 4 else F.col("g")
            frame = frame.withColumn("own", own).join(table, ["fold", "own"], "left")
            if order == 1:
                totals = {name: _by_fold([a[i] for a in self.alone]) for i, name in enumerate(("total", "given"))}
                frame = frame.withColumns(totals)
            else:
                frame = frame.withColumn("h", F.shiftright("own", 16)).join(
                    self._contexts(order), ["fold", "h"], "left"
                )
            p = F.when(F.col("total").isNull(), F.col("p")).otherwise(
                (F.coalesce("kept", F.lit(0.0)) + F.col("given") * F.col("p")) / F.col("total")
            )
            frame = saved(frame.select("fold", "g", p.alias("p")), f"string-logs-{order}")
        return frame.select("fold", "g", F.log("p").alias("logp"))


def _by_fold(values: list[float | None]) -> Column:
    """One number for each fold."""
    return F.get(F.array(*[F.lit(v).cast("double") for v in values]), F.col("fold"))


def _trusted_ids(labels: DataFrame) -> DataFrame:
    """All ids labelled quality 1, each once; marked to be sent to the tasks where there are few."""
    ids = labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return F.broadcast(ids) if ids.count() <= TRUSTED else ids


def _least_sent(counts: DataFrame) -> int:
    """The count from which on strings are sent: by steps of a quarter of a power of two, as low as
    leaves ``SENT`` strings or fewer."""
    step = F.floor(4 * F.log2("c")).cast("int")
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("n"), F.min("c").alias("least"))
    least, room = 1 << 62, SENT
    for row in steps.orderBy(F.desc("step")).collect():  # some 250 rows at most
        room -= row["n"]
        if room < 0:
            break
        least = row["least"]
    return least


def score(docs: DataFrame, labels: DataFrame, folds: int = 1) -> DataFrame:
    """``doc_id, lang, tie`` (a hash of the text), ``fold``, ``n`` characters and ``nats`` (their negative
    log-probability) of every row, written to the shared folder. With several folds, the model of the
    trusted texts of the other folds gives the probabilities; if a fold has none, there is one fold only."""
    spark = docs.sparkSession
    small_batches(spark)
    trusted = docs.select("doc_id", "text").join(_trusted_ids(labels), "doc_id", "left_semi")
    own = saved(counts_of(trusted, folds), "trusted-strings")
    if own.select("fold").distinct().count() < folds:
        folds = 1
    counts = saved(counts_of(docs, folds), "corpus-strings")

    # each fold's model has seen the trusted texts of all others
    others = [F.array(*[F.lit(f) for f in range(folds) if f != fold or folds == 1]) for fold in range(folds)]
    dealt = own.select(F.explode(F.get(F.array(*others), F.col("fold"))).alias("fold"), "g", "c")
    model = KneserNey(dealt.groupBy("fold", "g").agg(F.sum("c").alias("c")), folds)
    known = saved(model.log_probabilities(counts).join(counts, ["fold", "g"]), "string-logs")
    # as Arrow: rows of Python's objects would be some twenty times as large on the driver
    sent = known.filter(F.col("c") >= _least_sent(counts)).select("fold", "g", "logp").toArrow()
    folded, keys, logs = (sent.column(name).to_numpy() for name in ("fold", "g", "logp"))
    del sent
    frequent = []
    for fold in range(folds):
        own_keys, own_logs = keys[folded == fold], logs[folded == fold]
        order = np.argsort(own_keys)
        frequent.append((own_keys[order], own_logs[order]))
    shared = spark.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sent_of = [(np.append(k, np.iinfo("i8").max), np.append(logs, 0.0)) for k, logs in shared.value]
        for batch in batches:
            n, nats, rare, times = [], [], [], []
            for fold, text in zip(batch["fold"], batch["text"]):
                keys, logs = sent_of[fold]
                own, number = np.unique(_strings(text), return_counts=True)
                place = np.searchsorted(keys[:-1], own)
                sent = (keys[place] == own) & (place < len(keys) - 1)
                n.append(int(number.sum()))
                nats.append(-float((logs[place] * number)[sent].sum()))
                rare.append(own[~sent])
                times.append(number[~sent])
            yield batch[["doc_id", "lang", "tie", "fold"]].assign(n=n, nats=nats, rare=rare, times=times)

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(
        "doc_id",
        "lang",
        F.coalesce("text", F.lit("")).alias("text"),
        F.xxhash64("text").alias("tie"),
        _fold(folds).alias("fold"),
    )
    partly = rows.mapInPandas(
        tidy(run),
        f"doc_id {kind}, lang string, tie long, fold int, n long, nats double, rare array<long>, times array<long>",
    )
    partly = saved(partly.withColumn("row", F.struct("doc_id", "tie")), "part-scores")
    listed = (
        partly.filter(F.size("rare") > 0)
        .dropDuplicates(["row"])
        .select("row", "fold", F.explode(F.arrays_zip("rare", "times")).alias("x"))
        .select("row", "fold", F.col("x.rare").alias("g"), F.col("x.times").alias("times"))
    )
    rest = listed.join(known, ["fold", "g"]).groupBy("row").agg(F.sum(F.col("times") * F.col("logp")).alias("rest"))
    result = partly.join(rest, "row", "left").withColumn("nats", F.col("nats") - F.coalesce("rest", F.lit(0.0)))
    return saved(result.select("doc_id", "lang", "tie", "fold", "n", "nats"), "scores")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, lang, tie, perplexity, accepted`` of every row."""
    scores = score(docs, labels, FOLDS)
    ids = _trusted_ids(labels)
    # one row for each language and fold; a language is compared as a struct, so that null equals null
    group = F.struct("lang", "fold").alias("group")
    own = F.percentile_approx(F.col("nats") / F.col("n"), 0.5, 10_000)
    centres = scores.filter(F.col("n") > 0).groupBy(group).agg(own.alias("centre"))
    rows = (
        scores.withColumn("group", group)
        .join(centres, "group", "left")
        .withColumn("centre", F.coalesce("centre", F.lit(0.0)))
        .withColumn("off", (F.col("nats") - F.col("n") * F.col("centre")) / (F.col("n") + PRIOR))
        .withColumn("of", F.struct("lang"))
    )

    def quantiles(outer: float) -> Column:
        return F.percentile_approx("off", F.array(*map(F.lit, (outer, 0.5, 1 - outer))), 10_000)

    trusted = rows.filter(F.col("n") > 0).join(ids, "doc_id", "left_semi")
    found = trusted.limit(1).count()
    # texts that a model has been trained on say nothing about those it has not
    held_out = scores.filter(F.col("fold") > 0).limit(1).count()
    trusted = trusted.filter(F.lit(held_out > 0))
    bands = trusted.groupBy("of").agg(F.count("*").alias("known"), quantiles(OUTER).alias("band"))
    whole = None
    if found:
        corpus = rows.filter(F.col("n") > 0).agg(quantiles(0.25).alias("band")).first()["band"]
        corpus = [corpus[1] + _WIDEN * (q - corpus[1]) for q in corpus]
        every = trusted.agg(F.count("*").alias("known"), quantiles(OUTER).alias("band")).first()
        k, own_band = every["known"], every["band"] or corpus
        whole = [(k * q + SHRINK * c) / (k + SHRINK) for q, c in zip(own_band, corpus)]
    rows = rows.join(bands, "of", "left")
    known = F.coalesce("known", F.lit(0))

    def drawn(i: int) -> Column:
        towards = F.lit(whole[i] if whole else None).cast("double")
        return (known * F.coalesce(F.get("band", i), F.lit(0.0)) + SHRINK * towards) / (known + SHRINK)

    low, middle, high = map(drawn, range(3))
    inside = F.col("off").between(middle - 2 * WIDTH * (middle - low), middle + WIDTH * (high - middle))
    return rows.select(
        "doc_id",
        "lang",
        "tie",
        F.exp(F.col("centre") + F.col("off")).alias("perplexity"),
        (F.coalesce(inside, F.lit(True)) | (F.col("n") == 0)).alias("accepted"),
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are accepted, all columns kept."""
    rejected = classify(docs, labels).filter(~F.col("accepted")).select(
        F.struct("doc_id", "lang", "tie").alias("row")
    )
    rejected = saved(rejected.distinct(), "rejected")
    if rejected.count() <= REJECTED_SENT:
        rejected = F.broadcast(rejected)
    own = F.struct("doc_id", "lang", F.xxhash64("text").alias("tie"))
    keyed = docs.select(own.alias("row"), F.struct("*").alias("kept"))
    return keyed.join(rejected, "row", "left_anti").select("kept.*")
