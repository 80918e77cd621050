"""Corpus-wide counts of 64-bit keys, exchanged as packed sorted arrays instead of rows.

Texts become token blocks (one row for some million tokens).  Each block asks for the counts of its own distinct
keys: the sorted keys are cut into shards by value, delta-coded and shuffled; a shard's task merges the requests of
all blocks and answers each one in the order it asked; the answers go back to the blocks.  A key that fills
the corpus is one entry for a block, so no key is hot, and no task sees more than its shard or its block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_TOKENS = 2_000_000
SHARD_KEYS = 1_500_000
#: Texts of a block at most, however few words they have.
BLOCK_TEXTS = 200_000
BLOCKS = "block long, part int, n long, doc_ids array<long>, lens array<int>, vocab binary, ids binary"


def pack(a: np.ndarray) -> bytes:
    """Unsigned integers as byte planes, low first; planes that are all zero are left out."""
    a = np.ascontiguousarray(a, "<u8")
    k = max(1, (int(a.max()).bit_length() + 7) // 8) if len(a) else 1
    return bytes([k]) + a.view("u1").reshape(-1, 8)[:, :k].T.tobytes()


def unpack(b: bytes) -> np.ndarray:
    k = b[0]
    m = np.frombuffer(b, "u1", offset=1).reshape(k, -1)
    out = np.zeros((m.shape[1], 8), "u1")
    out[:, :k] = m.T
    return out.view("<u8").ravel()


def pack_sorted(a: np.ndarray) -> bytes:
    return pack(np.diff(a, prepend=a[:1])) + (a[:1].astype("<u8").tobytes() if len(a) else b"\0" * 8)


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b[:-8]), dtype="u8") + np.frombuffer(b[-8:], "<u8")


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that sums of hashes spread over all bits again."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)


class _Open:
    """A block that is being filled."""

    def __init__(self):
        self.ids, self.lens, self.hashes, self.n = [], [], [], 0

    def add(self, doc_id: int | None, words: list[bytes]) -> None:
        self.ids.append(doc_id)
        self.lens.append(len(words))
        self.hashes.append(np.fromiter(map(xxhash.xxh64_intdigest, words), "u8", len(words)))
        self.n += len(words)

    def row(self, block: int, part: int) -> pa.RecordBatch:
        vocab, local = np.unique(np.concatenate(self.hashes), return_inverse=True)
        row = [[block], [part], [self.n], [self.ids], [self.lens], [pack_sorted(vocab)], [pack(local)]]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, kinds)], ["block", "part", "n", "doc_ids", "lens", "vocab", "ids"])


def _blocks(max_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts = TaskContext.get().partitionId() << 24, {}
        for b in batches:
            for i, t, part in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), b.column(2).to_pylist()):
                one = parts.setdefault(part, _Open())
                one.add(i, t.lower().split() if t else [])
                if one.n >= max_tokens or len(one.ids) >= BLOCK_TEXTS:
                    yield parts.pop(part).row(2 * block + part, part)
                    block += 1
        for part, one in parts.items():
            yield one.row(2 * block + part, part)
            block += 1

    return run


def token_blocks(docs: DataFrame, max_tokens: int = BLOCK_TOKENS, part: Column | None = None) -> DataFrame:
    """Blocks of whole texts: A-Z lower-cased, words between white space (0x20, 0x09-0x0D), as hashes.  A block has texts of one ``part`` (0 or 1) only, which is also the last bit of its number."""
    part = (F.lit(0) if part is None else part).cast("int").alias("part")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), part).mapInArrow(_blocks(max_tokens), BLOCKS)


def block_arrays(row: dict) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    """ids of the documents, their lengths, the sorted vocabulary, and each token's place in it."""
    return row["doc_ids"], np.asarray(row["lens"], "i8"), unpack_sorted(row["vocab"]), unpack(row["ids"]).astype("i8")


def ask(blocks: DataFrame, keys_of: Callable[[dict], dict[str, tuple[np.ndarray, list[np.ndarray]]]], shards: int) -> DataFrame:
    """A row for each block, kind of key and shard: the sorted keys, and one or more arrays of counts beside them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.array([(s << 64) // shards for s in range(1, shards)], "u8")
        for b in batches:
            for row in b.to_pylist():
                for kind, (keys, counts) in keys_of(row).items():
                    cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
                    out = [(s, lo, hi) for s, (lo, hi) in enumerate(zip(cuts, cuts[1:])) if hi > lo]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([s for s, _, _ in out], pa.int32()),
                            pa.array([row["block"]] * len(out), pa.int64()),
                            pa.array([kind] * len(out), pa.string()),
                            pa.array([pack_sorted(keys[lo:hi]) for _, lo, hi in out], pa.binary()),
                            pa.array([[pack(c[lo:hi]) for c in counts] for _, lo, hi in out], pa.list_(pa.binary())),
                        ],
                        ["shard", "block", "kind", "keys", "counts"],
                    )

    return blocks.mapInArrow(run, "shard int, block long, kind string, keys binary, counts array<binary>")


def _answer(t: pa.Table) -> pa.Table:
    blocks, keys, counts = t["block"].to_pylist(), [unpack_sorted(x) for x in t["keys"].to_pylist()], t["counts"].to_pylist()
    all_keys, at = np.unique(np.concatenate(keys), return_inverse=True)
    ends = np.cumsum([len(k) for k in keys])[:-1]
    sums = [np.bincount(at, np.concatenate([unpack(c[i]) for c in counts]).astype("f8"), len(all_keys)).astype("u8") for i in range(len(counts[0]))]
    places = np.split(at, ends)
    n = len(blocks)
    return pa.table(
        {
            "block": pa.array(blocks, pa.int64()),
            "kind": t["kind"].cast(pa.string()),
            "shard": t["shard"].cast(pa.int32()),
            "counts": pa.array([[pack(s[p]) for s in sums] for p in places], pa.list_(pa.binary())),
            "distinct": pa.array([int((sums[0] > 0).sum())] + [0] * (n - 1), pa.int64()),
        }
    )


def answers(requests: DataFrame) -> DataFrame:
    """For each request the corpus-wide sums of its keys' counts, in its own order; ``distinct`` adds up to the keys whose first count isn't 0."""
    return requests.groupBy("shard", "kind").applyInArrow(_answer, "block long, kind string, shard int, counts array<binary>, distinct long")


class Answers:
    """A block's answers, its shards put together again."""

    def __init__(self, t: pa.Table):
        order = np.argsort(t["shard"].to_numpy(), kind="stable").tolist()
        kinds, counts = t["kind"].to_pylist(), t["counts"].combine_chunks()
        self.of: dict[str, list] = {}
        for i in order:
            self.of.setdefault(kinds[i], []).append(counts[i].as_py())

    def counts(self, kind: str, arrays: int) -> list[np.ndarray]:
        rows = self.of.get(kind, [])
        return [np.concatenate([unpack(r[i]) for r in rows]) if rows else np.zeros(0, "u8") for i in range(arrays)]


def shards_for(n_keys: int) -> int:
    return max(1, -(-n_keys // SHARD_KEYS))
