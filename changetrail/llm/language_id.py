"""Language of a text by a byte convolutional network, trained in numpy.

The network reads fixed windows of bytes: filters of several widths over one-hot bytes, the
maximum of each filter over the window, softmax. As inputs are one-hot, a filter is a sum of one
table entry per byte; for prediction, the tables of two neighbouring bytes are added up in
advance. A text's prediction is the mean over all its windows, weighted by their bytes.

Nothing but the text is an input of a prediction. Null texts and texts without a letter are
``und`` with score 0; without any labelled text to learn from, all are. Repeated rows are each
predicted; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches

UNDETERMINED = "und"


@dataclass(frozen=True)
class Settings:
    """The training sample is bounded by ``sample_docs`` texts, in equal parts of the languages."""

    window: int = 128
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 16
    sample_docs: int = 1600
    windows_per_doc: int = 8
    epochs: int = 8
    batch: int = 64
    rate: float = 0.01
    seed: int = 7


@dataclass
class Network:
    """``tables[i][j]`` scores the byte at offset j of the filters of the i-th width."""

    settings: Settings
    languages: list[str]
    tables: list[np.ndarray] = field(default_factory=list)
    bias: np.ndarray | None = None
    dense: np.ndarray | None = None
    base: np.ndarray | None = None

    def start(self) -> None:
        random = np.random.default_rng(self.settings.seed)
        f, n = self.settings.filters, len(self.settings.widths) * self.settings.filters
        self.tables = [random.normal(0, 0.3, (w, 256, f)).astype("f4") for w in self.settings.widths]
        self.bias = np.zeros(n, "f4")
        self.dense = random.normal(0, 0.2, (n, len(self.languages))).astype("f4")
        self.base = np.zeros(len(self.languages), "f4")

    def fit(self, windows: np.ndarray, classes: np.ndarray) -> None:
        """Adam on the cross entropy; only the places that win the maximum pass a gradient."""
        self.start()
        s, random = self.settings, np.random.default_rng(self.settings.seed)
        params = [*self.tables, self.bias, self.dense, self.base]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        step = 0
        for _ in range(s.epochs):
            order = random.permutation(len(windows))
            for at in range(0, len(order), s.batch):
                step += 1
                part = order[at : at + s.batch]
                grads = self._gradients(windows[part], classes[part])
                for p, g, m, v in zip(params, grads, first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= s.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def _gradients(self, windows: np.ndarray, classes: np.ndarray) -> list[np.ndarray]:
        s, n = self.settings, len(windows)
        pooled, winners = [], []
        for w, table in zip(s.widths, self.tables):
            span = s.window - w + 1
            scores = sum(table[j][windows[:, j : j + span]] for j in range(w))
            top = scores.argmax(axis=1)
            winners.append(top)
            pooled.append(np.take_along_axis(scores, top[:, None, :], 1)[:, 0])
        hidden = np.concatenate(pooled, axis=1) + self.bias
        active = np.maximum(hidden, 0)
        error = _softmax(active @ self.dense + self.base)
        error[np.arange(n), classes] -= 1
        error /= n
        back = (error @ self.dense.T) * (hidden > 0)
        grads, rows, cols = [], np.arange(n)[:, None], np.arange(s.filters)[None, :]
        for i, (w, table) in enumerate(zip(s.widths, self.tables)):
            grad, own = np.zeros_like(table), back[:, i * s.filters : (i + 1) * s.filters]
            for j in range(w):
                np.add.at(grad[j], (windows[rows, winners[i] + j], cols), own)
            grads.append(grad)
        return [*grads, back.sum(0), active.T @ error, error.sum(0)]

    def predictor(self):
        """A function from windows to probabilities, with pairs of neighbouring bytes looked up at once."""
        s = self.settings
        plans = []
        for w, table in zip(s.widths, self.tables):
            steps = []
            for j in range(0, w - 1, 2):
                pair = (table[j][:, None, :] + table[j + 1][None, :, :]).reshape(65536, s.filters)
                steps.append((j, True, pair))
            if w % 2:
                steps.append((w - 1, False, table[w - 1]))
            plans.append((s.window - w + 1, steps))

        def predict(windows: np.ndarray) -> np.ndarray:
            pairs = windows[:, :-1].astype("i4") * 256 + windows[:, 1:]
            pooled = []
            for span, steps in plans:
                scores = None
                for j, paired, table in steps:
                    part = np.take(table, (pairs if paired else windows)[:, j : j + span], axis=0)
                    scores = part if scores is None else np.add(scores, part, out=scores)
                pooled.append(scores.max(axis=1))
            active = np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0)
            return _softmax(active @ self.dense + self.base)

        return predict


def _softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scores / scores.sum(axis=1, keepdims=True)


def _bytes(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace")


def held_out(doc_id: Column) -> Column:
    """Documents that are never learnt from: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, settings: Settings = Settings()) -> Network | None:
    """Fit on a bounded sample, chosen by hash, of labelled texts that are not held out."""
    labelled = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))
    )
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return None
    languages = sorted(counts)
    share = max(2, settings.sample_docs // len(languages))
    # a little more than the share is asked for, as hashing gives it only on average
    odds = F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(min(1.0, 1.5 * share / counts[k])))])
    ticket = F.xxhash64("doc_id", "text")
    chosen = labelled.withColumn("ticket", ticket).filter(
        F.pmod(ticket, F.lit(1_000_003)) < odds[F.col("lang")] * 1_000_003
    )
    size, number = settings.window, settings.windows_per_doc

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                {
                    "lang": batch["lang"],
                    "ticket": batch["ticket"],
                    "windows": [_spread(_bytes(text), size, number) for text in batch["text"]],
                }
            )

    kept = chosen.select("lang", "ticket", "text").mapInPandas(cut, "lang string, ticket long, windows binary")
    sample = kept.limit(4 * share * len(languages)).toPandas()
    sample = sample.sort_values(["lang", "ticket"]).groupby("lang").head(share)
    windows = [np.frombuffer(x, "u1").reshape(-1, size) for x in sample["windows"]]
    classes = [np.full(len(w), languages.index(k)) for w, k in zip(windows, sample["lang"])]
    network = Network(settings, languages)
    network.fit(np.concatenate(windows), np.concatenate(classes))
    return network


def _spread(data: bytes, size: int, number: int) -> bytes:
    """Up to ``number`` windows, evenly spread over the data, the last padded with zeros."""
    if len(data) <= size:
        return data.ljust(size, b"\0")
    starts = np.unique(np.linspace(0, len(data) - size, number).astype(int))
    return b"".join(data[i : i + size] for i in starts)


def predict(docs: DataFrame, network: Network | None) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` for every row, from all windows of its text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text")
    if network is None:
        return rows.select("doc_id", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    small_batches(docs.sparkSession)
    size, languages = network.settings.window, np.array(network.languages, dtype=object)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        probabilities = network.predictor()
        for batch in batches:
            means = np.zeros((len(batch), len(languages)))
            for i, text in enumerate(batch["text"]):
                data = _bytes(text or "")
                for at in range(0, len(data), size * 256):  # windows of one text, in bounded parts
                    part = data[at : at + size * 256]
                    weights = np.full(-(-len(part) // size), size)
                    weights[-1] = len(part) - size * (len(weights) - 1)
                    windows = np.frombuffer(part.ljust(len(weights) * size, b"\0"), "u1").reshape(-1, size)
                    means[i] += weights @ probabilities(windows)
                means[i] /= max(1, len(data))
            best = means.argmax(axis=1)
            known = batch["letters"].to_numpy()
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "lang_pred": np.where(known, languages[best], UNDETERMINED),
                    "score": np.where(known, np.clip(means[np.arange(len(best)), best], 0, 1), 0.0),
                }
            )

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters")
    return rows.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), letters).mapInPandas(
        run, f"doc_id {kind}, lang_pred string, score double"
    )
