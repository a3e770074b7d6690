"""Batches of the log: what a reader may see, and how a load becomes visible as a whole.

A load writes its rows into a folder of its own, ``<table>/batch=<id>``. Parquet folders know no
transactions, so nothing in there counts until a marker ``<table>/_published/<number>.<id>.<kind>``
exists, whose creation is one step of the file system. A load that ends before it leaves a folder
that no reader looks at; running it again writes another one. Numbers put a table's batches in
order. Before it publishes number n + 1, a load that began after n claims that number; of two loads of one table
that ran side by side, the second to claim fails and nothing of it is seen.

Kinds: ``load`` also wrote new versions of the state it touched, ``full<buckets>`` wrote all of the
state, ``plain`` wrote none, ``whole`` holds the rows of earlier batches that it replaces (compaction).
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

from . import storage

LOAD, FULL, PLAIN, WHOLE = "load", "full", "plain", "whole"
LOGGED, HELD = "log", "held"
PUBLISHED = "_published"
_MARKER = re.compile(r"(\d{8})\.(\w+)\.(load|full\d+|plain|whole)")


class ConcurrentLoad(RuntimeError):
    """Another load of the same table was published first; this one has changed nothing."""


def new_id() -> str:
    return uuid.uuid4().hex


@dataclass(frozen=True)
class Batch:
    number: int
    id: str
    kind: str


@dataclass(frozen=True)
class Published:
    """A table's published batches in order, those that a later one replaces, and the newest number claimed."""

    batches: tuple[Batch, ...] = ()
    replaced: frozenset[str] = frozenset()
    newest: int = 0

    @property
    def live(self) -> list[Batch]:
        return [b for b in self.batches if b.id not in self.replaced]

    @property
    def state(self) -> list[Batch]:
        """Batches that hold the current state: the newest full one and loads since; none if rows without state
        were added since."""
        full = [i for i, b in enumerate(self.batches) if b.kind.startswith(FULL)]
        if not full or any(b.kind == PLAIN for b in self.batches[full[-1] :]):
            return []
        return [b for b in self.batches[full[-1] :] if b.kind != WHOLE]

    @property
    def buckets(self) -> int:
        """Number of buckets that the current state is dealt into."""
        return int(self.state[0].kind.removeprefix(FULL))


def published(spark: SparkSession, folder: str) -> Published:
    """What is published in a table's folder. Lists one folder, reads the short lists of replaced batches."""
    found, replaced, newest = [], set(), 0
    names = set(storage.names(spark, f"{folder}/{PUBLISHED}"))
    for name in names:
        if name[:8].isdigit():
            newest = max(newest, int(name[:8]))
        if parts := _MARKER.fullmatch(name):
            found.append(Batch(int(parts[1]), parts[2], parts[3]))
    for batch in found:
        if f"{batch.id}.replaces" in names:
            replaced.update(storage.read_text(spark, f"{folder}/{PUBLISHED}/{batch.id}.replaces").split())
    return Published(tuple(sorted(found, key=lambda b: b.number)), frozenset(replaced), newest)


def publish(
    spark: SparkSession, folder: str, since: Published, batch: str, kind: str, replaces: tuple[str, ...] = ()
) -> None:
    """Make a batch visible, if no other has been since ``since``."""
    number = f"{since.newest + 1:08d}"
    if not storage.create(spark, f"{folder}/{PUBLISHED}/{number}.claimed"):
        raise ConcurrentLoad(f"{folder}: another load has been published")
    if replaces:
        storage.write_text(spark, f"{folder}/{PUBLISHED}/{batch}.replaces", "\n".join(replaces))
    storage.create(spark, f"{folder}/{PUBLISHED}/{number}.{batch}.{kind}")
    # says that the table's first load has been completed
    storage.create(spark, f"{folder}/_SUCCESS")
