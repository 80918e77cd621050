"""Harmonic packing of token ids into sequences of a fixed capacity.

Class j holds the lengths in (capacity / (j + 1), capacity / j], and a sequence of class j takes just j pieces.  A document whose length
would leave more than ``waste`` of its place empty is cut: its first piece has the largest length of the next class, the rest is cut in
the same way, so that a document has a few pieces and each fills its place but for ``waste``.  Every task fills the sequences of
its own documents, so nothing is shuffled; it holds fewer than j pieces of each class, a bounded number of ids.  What a task has left
at its end is one stream, cut at the capacity; its last part is cut into powers of two, lengths that are not padded.

A sequence's number is its task's and a count within the task; a task that runs again packs the same documents again.

Defined results: null is the empty text and has the end id only; rows with a null or repeated ``doc_id`` are packed each on its own;
very long texts are encoded whole and cut; an empty table gives an empty table; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_pairs import rank_encoder

CAPACITY, WASTE = 2048, 0.01
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, sequence_tokens long"
NAMES = SCHEMA.replace(",", "").split()[::2]


def cut(length: int, capacity: int = CAPACITY, waste: float = WASTE) -> list[int]:
    """Lengths of a document's pieces: each is the largest of its class, but for ``waste``."""
    out, rest = [capacity] * (length // capacity), length % capacity
    while rest:
        j = capacity // rest
        piece = rest if rest >= (1 - waste) * (capacity // j) else capacity // (j + 1)
        out.append(piece)
        rest -= piece
    return out


def last_lengths(total: int, capacity: int = CAPACITY, waste: float = WASTE) -> list[int]:
    """Lengths of the sequences that a stream of ``total`` ids is cut into: whole ones, then powers of two."""
    out, rest = [capacity] * (total // capacity), total % capacity
    while rest:
        out.append(rest if rest >= (1 - waste) * capacity else 1 << (rest.bit_length() - 1))
        rest -= out[-1]
    return out


class Bins:
    """The open sequences of a task: at most j - 1 pieces (doc_id, start, doc_tokens, ids) of each class j."""

    def __init__(self, capacity: int, waste: float, first: int):
        self.capacity, self.waste, self.next = capacity, waste, first
        self.open: dict[int, list[tuple]] = {}
        self.done, self.size = [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        start = 0
        for n in cut(len(ids), self.capacity, self.waste):
            j = self.capacity // n
            held = self.open.setdefault(j, [])
            # What waits is copied: a view would keep the whole document in memory.
            held.append((doc_id, start, len(ids), ids[start : start + n] if j == 1 else ids[start : start + n].copy()))
            start += n
            if len(held) == j:
                self.close(self.open.pop(j))

    def close(self, pieces: list[tuple]) -> None:
        """A sequence of these pieces."""
        offset, total = 0, sum(len(p[3]) for p in pieces)
        for doc_id, start, doc_tokens, ids in pieces:
            self.done.append((doc_id, start, len(ids), ids.tobytes(), doc_tokens, self.next, offset, total))
            offset += len(ids)
        self.next += 1
        self.size += total

    def finish(self) -> None:
        left = deque(p for j in sorted(self.open) for p in self.open[j])
        self.open = {}
        for room in last_lengths(sum(len(p[3]) for p in left), self.capacity, self.waste):
            pieces = []
            while room:
                doc_id, start, doc_tokens, ids = left.popleft()
                n = min(room, len(ids))
                pieces.append((doc_id, start, doc_tokens, ids[:n]))
                room -= n
                if n < len(ids):
                    left.appendleft((doc_id, start + n, doc_tokens, ids[n:]))
            self.close(pieces)

    def taken(self) -> pa.RecordBatch:
        types = [pa.int64() if n != "ids" else pa.binary() for n in NAMES]
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*self.done), types)], NAMES)
        self.done, self.size = [], 0
        return out


def _pack(path: str, end_id: int, capacity: int, waste: float, flush: int = 1 << 20):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = rank_encoder(path), np.array([end_id], "<u4")
        bins = Bins(capacity, waste, TaskContext.get().partitionId() << 33)
        for b in batches:
            for d, text in zip(b.column(0), b.column(1)):
                bins.add(d.as_py(), np.concatenate([encoder.encode(text.as_py()), end]))
                if bins.size >= flush:
                    yield bins.taken()
        bins.finish()
        if bins.done:
            yield bins.taken()

    return run


def pack(docs: DataFrame, path: str, end_id: int = 1, capacity: int = CAPACITY, waste: float = WASTE) -> DataFrame:
    """A row for each piece: its document's id and number of tokens, where it starts there, its ids (little-endian unsigned 32-bit), its
    sequence, its place there, and how many ids the sequence has."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(_pack(path, end_id, capacity, waste), SCHEMA)


def padding(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: sequences, ids in them, and the padding that all sequences need whose length isn't a power of two."""
    n = F.col("sequence_tokens")
    once = pieces.where("offset = 0").select(n, F.when(n.bitwiseAND(n - 1) == 0, 0).otherwise(capacity - n).alias("pad"))
    return once.agg(F.count("*").alias("sequences"), F.coalesce(F.sum("sequence_tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("pad"), F.lit(0)).alias("padding"))
