"""Byte-level BPE encoding and decoding by longest matches and compatible neighbours.

The bytes of each pre-token become Latin-1 text, in which an Aho-Corasick automaton of the
whole vocabulary finds the longest token that starts at each place. The encoder walks from left
to right, takes the longest token that may follow the one before, tries shorter ones where it
may not, and steps back where none is left, remembering dead ends. Two tokens may stand side by
side if merging the bytes of both would give just these two; that is decided from the order in
which each came to be, and remembered. So the result is that of the merges by rank, in time
linear in the text.

Nulls are encoded as empty texts, which have no ids. Repeated rows are encoded each on their
own. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, tidy

_NEVER = 1 << 62
#: Pre-tokens and pairs that are new in a worker's memory at most (some 200 bytes each), and as many older ones.
_PIECES, _PAIRS = 1 << 18, 1 << 17
_LONGEST_REMEMBERED = 64


class _Memory(dict):
    """Results by what they were computed from, those asked for lately.

    Once it holds ``most``, these become the older ones, of which only what is asked for again is kept: so frequent
    ones stay, and there are never more than twice as many.
    """

    def __init__(self, compute: Callable, most: int):
        super().__init__()
        self.compute, self.most, self.older = compute, most, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class _Pieces(_Memory):
    """Pre-token -> its ids as little-endian 32-bit integers; very long ones are not remembered."""

    def __missing__(self, piece: str) -> bytes:
        return super().__missing__(piece) if len(piece) <= _LONGEST_REMEMBERED else self.compute(piece)


class Coder:
    """Encoder and decoder of one vocabulary; ``ranks`` maps a token's bytes to its id."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {i: token for token, i in ranks.items()}
        self.sizes = {i: len(token) for token, i in ranks.items()}
        self.split = regex.compile(pattern).findall
        # gives back the ids' own objects, not a new integer for each match, which the memory of pairs would keep
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        for token, i in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.pieces = _Pieces(self._packed, _PIECES)
        self.pairs = _Memory(self._stay_apart, _PAIRS)
        self.edges: dict[int, tuple[list, list] | None] = {}
        self.shorter: dict[int, int | None] = {}

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.pieces.__getitem__, self.split(text or "")))

    def decode(self, ids: bytes | None) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))

    def _packed(self, piece: str) -> bytes:
        found = self.encode_bytes(piece.encode("utf-8", "surrogatepass"))
        return struct.pack(f"<{len(found)}I", *found)

    def encode_bytes(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if not piece:
            return []
        latin = piece.decode("latin-1")
        from_left = list(self.automaton.iter_long(latin))
        found = [token for _, token in from_left]
        stay_apart = self.pairs.__getitem__
        fitting = 1  # of the longest matches, as many as may stand side by side
        for pair in zip(found, found[1:]):
            if not stay_apart(pair):
                break
            fitting += 1
        else:
            return found
        sizes, shorter, end_of_piece = self.sizes, self.shorter, len(piece)
        longest = {last - sizes[token] + 1: token for last, token in from_left}
        dead = set()
        at, token = from_left[fitting - 1][0] + 1, found[fitting]
        del found[fitting:]
        while True:
            end = at + sizes[token]
            if end not in dead and (not found or stay_apart((found[-1], token))):
                found.append(token)
                if end == end_of_piece:
                    return found
                at = end
                token = longest.get(at)
                if token is None:
                    token = longest[at] = next(self.automaton.iter_long(latin, at))[1]
                continue
            prefix = shorter[token] if token in shorter else self._shorter(token)
            if prefix is None:
                dead.add(at)
                token = found.pop()
                at -= sizes[token]
            else:
                token = prefix

    def _shorter(self, token: int) -> int | None:
        """The longest token that is a proper prefix of this one."""
        if token not in self.shorter:
            own = self.tokens[token]
            ends = range(len(own) - 1, 0, -1)
            self.shorter[token] = next((self.ranks[own[:n]] for n in ends if own[:n] in self.ranks), None)
        return self.shorter[token]

    def _stay_apart(self, pair: tuple[int, int]) -> bool:
        """Do the merges of both tokens' bytes side by side end with just these two?

        Each entry of an edge is a part that stands at the border from the merge of rank
        ``born`` up to the merge of rank ``gone``. Parts that meet merge across the border if
        that merge comes before what takes either of them; of equal ranks the left one is first.
        """
        edge_l, edge_r = map(self._edges, pair)
        if edge_l is None or edge_r is None:
            return False
        for part_l, born_l, gone_l in edge_l[1]:
            for part_r, born_r, gone_r in edge_r[0]:
                if born_l < gone_r and born_r < gone_l:
                    across = self.ranks.get(part_l + part_r)
                    if across is not None and across < gone_l and across <= gone_r:
                        return False
        return True

    def _edges(self, token: int) -> tuple[list, list] | None:
        """The parts at a token's left and right border while it is merged; None if it never is."""
        if token in self.edges:
            return self.edges[token]
        parts = [self.tokens[token][i : i + 1] for i in range(self.sizes[token])]
        left, right = [[parts[0], -1, _NEVER]], [[parts[-1], -1, _NEVER]]
        while len(parts) > 1:
            ranks = [self.ranks.get(a + b, _NEVER) for a, b in zip(parts, parts[1:])]
            rank = min(ranks)
            if rank == _NEVER:
                break
            at = ranks.index(rank)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            if at == 0:
                left[-1][2] = rank
                left.append([parts[0], rank, _NEVER])
            if at == len(parts) - 1:
                right[-1][2] = rank
                right.append([parts[-1], rank, _NEVER])
        self.edges[token] = (left, right) if len(parts) == 1 else None
        return self.edges[token]


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Ranks from a file of lines ``base64(token) rank``."""
    pairs = (line.split() for line in lines.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


_CODERS: dict[tuple[int, str], Coder] = {}


def _coder(lines: bytes, pattern: str) -> Coder:
    """One coder per Python worker and vocabulary."""
    key = (hash(lines), pattern)
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = Coder(read_ranks(lines), pattern)
    return _CODERS[key]


def _vocabulary(docs: DataFrame, path: str):
    with open(path, "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit integers) per row.

    ``path`` is the rank file on the driver; its content, some 1 MB, is broadcast. No shuffle.
    """
    small_batches(docs.sparkSession)
    lines = _vocabulary(docs, path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = _coder(lines.value, pattern)
        for batch in batches:
            ids = [coder.encode(text) for text in batch["text"]]
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "n_tokens": [len(x) // 4 for x in ids], "ids": ids}
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInPandas(
        tidy(run), f"doc_id {kind}, n_tokens long, ids binary"
    )


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Adds ``decoded``, the bytes that the ids of ``encode`` stand for."""
    lines = _vocabulary(encoded, path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # no automaton is needed for this, so none is built in the worker
        token = {i: token for token, i in read_ranks(lines.value).items()}.__getitem__
        for batch in batches:
            ids = (np.frombuffer(own or b"", "<u4").tolist() for own in batch["ids"])
            yield batch.assign(decoded=[b"".join(map(token, own)) for own in ids])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "n_tokens", "ids").mapInPandas(
        tidy(run), f"doc_id {kind}, n_tokens long, ids binary, decoded binary"
    )
