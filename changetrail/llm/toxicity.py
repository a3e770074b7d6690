"""Toxic severity by cumulative-link ordinal regression on sparse text features.

Features are the distinct words of a text and the first letters of its words (so that inflected
forms count together). One weight vector serves all thresholds: the probability of a grade of at
most k is the logistic of threshold k minus the text's score. The result is the expected grade.

The labels say only whether a text is toxic. ``graded`` makes grades of them: 0 for texts that are
not, 1 or 2 for toxic ones with fewer or more telling features than their median. Telling are those
whose z is at least ``TELLING`` times the largest possible with as many labels, or 4 where that is less.

The fit is on a bounded sample (``SAMPLE`` labelled texts, half of them toxic, chosen by a hash),
with the features that tell toxic texts from others best: ``PER_LABEL`` for each label of the rarer
kind, ``FEATURES`` at most, and none is left out for being weak, as the fit's ridge shrinks those that
are. Every text is judged whole. Null texts count as empty; without labels of both kinds all severities are 0. Repeated rows
are each judged; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

SAMPLE = 8000
FEATURES = 2000
PER_LABEL = 2
TELLING = 0.6
PREFIXES = (4, 5)

_WORD = re.compile(r"[^\W\d_]+").findall


def features(text: str | None) -> set[str]:
    """Distinct lower-case words, and their beginnings marked by a star."""
    words = set(_WORD((text or "").lower()))
    starts = {w[:n] + "*" for n in PREFIXES for w in words if len(w) > n}
    return words | starts


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def severity(self, text: str | None) -> float:
        known = self.weights.keys() & features(text)
        # summed in a fixed order, so that equal texts have equal severities
        score = sum(self.weights[f] for f in sorted(known))
        return float(sum(1 / (1 + np.exp(np.clip(t - score, -50, 50))) for t in self.thresholds))


def fit_ordinal(
    rows: np.ndarray, cols: np.ndarray, grades: np.ndarray, n_features: int, ridge: float = 0.3, steps: int = 400
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and rising thresholds of the sparse 0/1 matrix with ones at (rows, cols).

    Thresholds are a first one and positive steps from each to the next; Adam on the mean
    negative log-likelihood plus a ridge on the weights.
    """
    top = int(grades.max())
    n = len(grades)
    counts = np.bincount(grades, minlength=top + 1) + 1.0
    below = np.cumsum(counts)[:-1] / counts.sum()
    start = np.log(below / (1 - below))
    params = np.concatenate([np.zeros(n_features), start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
    first, second = np.zeros_like(params), np.zeros_like(params)
    logistic = lambda x: 1 / (1 + np.exp(-np.clip(x, -50, 50)))
    for step in range(1, steps + 1):
        weights, gaps = params[:n_features], np.exp(params[n_features + 1 :])
        limits = params[n_features] + np.concatenate([[0.0], np.cumsum(gaps)])
        score = np.bincount(rows, weights[cols], n)
        above = np.where(grades < top, logistic(limits[np.minimum(grades, top - 1)] - score), 1.0)
        under = np.where(grades > 0, logistic(limits[np.maximum(grades - 1, 0)] - score), 0.0)
        chance = np.maximum(above - under, 1e-9)
        slope_above, slope_under = above * (1 - above) / chance, under * (1 - under) / chance
        by_score = (slope_above - slope_under) / n
        by_limit = np.zeros(top)
        np.add.at(by_limit, np.minimum(grades, top - 1), np.where(grades < top, -slope_above, 0) / n)
        np.add.at(by_limit, np.maximum(grades - 1, 0), np.where(grades > 0, slope_under, 0) / n)
        grad = np.empty_like(params)
        grad[:n_features] = np.bincount(cols, by_score[rows], n_features) + ridge / n * weights
        grad[n_features] = by_limit.sum()
        grad[n_features + 1 :] = np.cumsum(by_limit[::-1])[::-1][1:] * gaps
        first += 0.1 * (grad - first)
        second += 0.001 * (grad * grad - second)
        params -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-10)
    gaps = np.exp(params[n_features + 1 :])
    return params[:n_features], params[n_features] + np.concatenate([[0.0], np.cumsum(gaps)])


def graded(toxic: np.ndarray, telling: np.ndarray) -> np.ndarray:
    """Grades from 0/1 labels and the number of telling features in each text."""
    grades = (toxic > 0).astype(int)
    if grades.any():
        grades[(grades == 1) & (telling > np.median(telling[grades == 1]))] = 2
    return grades


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    labelled = labels.select("doc_id", "toxic").filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    ticket = F.xxhash64("doc_id")
    halves = [
        labelled.filter(F.col("toxic") == kind).distinct().orderBy(ticket, "doc_id").limit(SAMPLE // 2) for kind in (1, 0)
    ]
    chosen = halves[0].unionByName(halves[1]).toPandas().drop_duplicates("doc_id")
    if chosen["toxic"].nunique() < 2:
        return None
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    # at most SAMPLE ids: small enough to send to every task
    sample = docs.select("doc_id", "text").join(
        F.broadcast(spark.createDataFrame(chosen, f"doc_id {kind}, toxic int")), "doc_id"
    )
    small_batches(spark)

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for doc_id, toxic, text in zip(batch["doc_id"], batch["toxic"], batch["text"]):
                own = sorted(features(text))
                yield pd.DataFrame({"doc_id": [doc_id] * len(own), "toxic": [toxic] * len(own), "feature": own})

    rows = sample.mapInPandas(expand, f"doc_id {kind}, toxic int, feature string")
    n_toxic, n_clean = int((chosen["toxic"] == 1).sum()), int((chosen["toxic"] == 0).sum())
    share_toxic = F.sum("toxic") / n_toxic
    share_clean = (F.count("*") - F.sum("toxic")) / n_clean
    apart = (share_toxic - share_clean) / F.sqrt((share_toxic + share_clean) / 2 * (1.0 / n_toxic + 1.0 / n_clean))
    best = (
        rows.groupBy("feature")
        .agg(apart.alias("z"), F.count("*").alias("n"))
        .orderBy(F.desc(F.abs("z")), F.desc("n"), "feature")
        .limit(min(FEATURES, PER_LABEL * min(n_toxic, n_clean)))
        .toPandas()
    )
    if best.empty:
        return None
    place = {f: i for i, f in enumerate(best["feature"])}
    least = min(4.0, TELLING * (2 * n_toxic * n_clean / (n_toxic + n_clean)) ** 0.5)
    telling = {f for f, z in zip(best["feature"], best["z"]) if z >= least}

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [sorted(place[f] for f in features(text) & place.keys()) for text in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "toxic": batch["toxic"], "found": found})

    known = sample.mapInPandas(look, f"doc_id {kind}, toxic int, found array<int>").limit(2 * SAMPLE).toPandas()
    known = known.sort_values("doc_id", kind="stable").reset_index(drop=True)
    cols = np.array([c for found in known["found"] for c in found], dtype=int)
    at = np.repeat(np.arange(len(known)), known["found"].map(len))
    names = list(best["feature"])
    number = np.array([sum(names[c] in telling for c in found) for found in known["found"]])
    grades = graded(known["toxic"].to_numpy(), number)
    weights, limits = fit_ordinal(at, cols, grades, len(place))
    return Model({f: float(w) for f, w in zip(names, weights) if abs(w) > 1e-6}, tuple(map(float, limits)))


def judge(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``severity`` (expected grade) and ``toxic`` (severity of a half or more) of every row."""
    rows = docs.select("doc_id", "text")
    if model is None:
        return rows.select("doc_id", F.lit(0.0).alias("severity"), F.lit(False).alias("toxic"))
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            severity = [model.severity(text) for text in batch["text"]]
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "severity": severity, "toxic": [s >= 0.5 for s in severity]}
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(run, f"doc_id {kind}, severity double, toxic boolean")
