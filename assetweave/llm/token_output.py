"""Token ids as Arrow files of fixed-size lists.

Documents are dealt by ranges of doc_id and encoded; their ids, each document's end id behind it, are one stream that is cut into
sequences of ``seq_len``.  A shard is one Arrow file (random-access form) of record batches with the columns ids
(fixed_size_list<uint16 or uint32>), mask (fixed_size_list<bool>, false on the padding of a shard's last sequence), doc_ids and
ends (the documents that end in the sequence, and where).  Buffers are not compressed, so that a reader that maps the file
gets any sequence without a copy.  A file is written under a temporary name and moved, so a task that runs again does no harm.

Defined results: null is the empty text and has the end id only; a null ``doc_id`` comes first; rows that repeat a ``doc_id`` are
ordered by a hash of their text; very long texts are encoded whole and cross sequences; an empty table gives a folder without shards
and an empty table; other columns are not read, whatever their names.
"""

from __future__ import annotations

import io
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .byte_pairs import rank_encoder
from .common import make_folder, materialise, new_path
from .token_counts import load

INNER = re.compile(r"(?<=\S) (?=\S)")
#: Fixed value: white space other than the space and the line feed.
ODD_SPACE = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
CACHED = 800_000


class ByteLevelEncoder:
    """Ids as the library gives them; parts between single spaces and line ends are looked up in the worker's cache."""

    def __init__(self, path: str):
        self.t = load(path)
        size = self.t.get_vocab_size(with_added_tokens=True)
        self.type = "<u2" if size <= 1 << 16 else "<u4"
        self.code = "H" if size <= 1 << 16 else "I"
        self.added = [a.content for a in self.t.get_added_tokens_decoder().values()]
        self.after: dict[str, bytes] = {}  # parts behind a space
        self.first: dict[str, bytes] = {}  # parts at the start of a line
        self.line = self._ids("\n")

    def _ids(self, text: str) -> bytes:
        return np.array(self.t.encode(text, add_special_tokens=False).ids, self.type).tobytes()

    def plain(self, text: str) -> bool:
        """White space is single spaces and line ends, each between other characters."""
        if not text or text[0] in " \n" or text[-1] in " \n" or "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
            return False
        return not any(c in text for c in ODD_SPACE) and not any(a in text for a in self.added)

    def learn(self, parts: list[str]) -> list[bytes]:
        return [array(self.code, e.ids).tobytes() for e in self.t.encode_batch_fast(parts, add_special_tokens=False)]

    def fill(self, cache: dict[str, bytes], new: set[str], lead: str) -> None:
        """Add the ids of new parts; punctuation behind a letter is a pre-token of its own, so such a part is its stem's ids and its tail's."""
        stems = {}
        for p in new:
            stem = p.rstrip(punctuation)
            if stem and len(stem) < len(p) and stem[-1] < "\u0250" and stem[-1].isalpha():
                stems[p] = stem
        whole = list(new.difference(stems).union(set(stems.values()).difference(cache)))
        cache.update(zip(whole, self.learn([lead + x for x in whole])))
        tails = list({p[len(stem) :] for p, stem in stems.items()})
        ids = dict(zip(tails, self.learn(tails)))
        cache.update((p, cache[stem] + ids[p[len(stem) :]]) for p, stem in stems.items())

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [self.plain(x) for x in texts]
        lines = [[p.split(" ") for p in x.split("\n")] if ok else None for x, ok in zip(texts, plain)]
        for name in ("after", "first"):
            cache = getattr(self, name)
            if len(cache) > CACHED:
                # What was met first is what is frequent: that half stays.
                setattr(self, name, dict(islice(cache.items(), CACHED // 2)))
        heads, tails = set(), set()
        for doc in lines:
            for p in doc or ():
                heads.add(p[0])
                tails.update(p[1:])
        self.fill(self.first, heads.difference(self.first), "")
        self.fill(self.after, tails.difference(self.after), " ")
        first, after, out = self.first, self.after, []
        for text, doc in zip(texts, lines):
            if doc is None:
                out.append(self.slow(text))
                continue
            parts = []
            for p in doc:
                parts.append(first[p[0]])
                parts.extend(map(after.__getitem__, p[1:]))
                parts.append(self.line)
            out.append(b"".join(parts[:-1]))
        return out

    def slow(self, text: str) -> bytes:
        if not text:
            return b""
        if any(a in text for a in self.added):
            return self._ids(text)
        parts = INNER.split(text)
        new = [parts[0], *(" " + p for p in parts[1:])]
        return b"".join(self.learn(new))


class FileEncoder:
    """Ids by ranks, as bytes; texts that the rank library might cut differently go to the file's own library, in parts."""

    def __init__(self, path: str):
        self.ranks, self.parts = rank_encoder(path), ByteLevelEncoder(path)
        self.type = self.parts.type

    def encode(self, texts: list[str]) -> list[bytes]:
        by_rank = self.ranks.by_rank
        doubtful = [i for i, t in enumerate(texts) if by_rank is None or self.ranks.is_doubtful(t)]
        out = dict(zip(doubtful, self.parts.encode([texts[i] for i in doubtful])))
        return [out[i] if i in out else by_rank.encode_to_numpy(t, disallowed_special=()).astype(self.type).tobytes() for i, t in enumerate(texts)]


@lru_cache(maxsize=2)
def encoder_of(path: str) -> FileEncoder:
    """The worker's encoder: its bounded caches serve all tasks of that worker."""
    return FileEncoder(path)


class ShardWriter:
    """One Arrow file of sequences; holds a document and a batch at a time."""

    def __init__(self, sink, seq_len: int, dtype: str, rows: int = 256):
        self.n, self.type, self.rows = seq_len, np.dtype(dtype), rows
        kind = pa.uint16() if self.type.itemsize == 2 else pa.uint32()
        self.kind = kind
        self.schema = pa.schema([("ids", pa.list_(kind, seq_len)), ("mask", pa.list_(pa.bool_(), seq_len)), ("doc_ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int32()))])
        self.file = pa.ipc.new_file(sink, self.schema)
        self.held, self.size, self.docs = [], 0, []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.held.append(ids)
        self.size += len(ids) // self.type.itemsize
        self.docs.append((doc_id, self.size))
        if self.size >= self.n * self.rows:
            self.flush()

    def flush(self, last: bool = False) -> None:
        """Write what is held as batches of just ``rows`` sequences (only a file's last may be shorter), so that a sequence's batch is known from its number."""
        flat, step = np.frombuffer(b"".join(self.held), self.type), self.n * self.rows
        stop, k = len(flat) if last else len(flat) // step * step, 0
        for lo in range(0, stop, step):
            used = min(step, len(flat) - lo)
            n = -(-used // self.n)
            ids = np.zeros(n * self.n, self.type)
            ids[:used] = flat[lo : lo + used]
            at = [[] for _ in range(n)]
            while k < len(self.docs) and self.docs[k][1] <= lo + used:
                d, end = self.docs[k]
                at[(end - lo - 1) // self.n].append((d, (end - lo - 1) % self.n + 1))
                k += 1
            self.file.write_batch(
                pa.record_batch(
                    [
                        pa.FixedSizeListArray.from_arrays(pa.array(ids, self.kind), self.n),
                        pa.FixedSizeListArray.from_arrays(pa.array(np.arange(len(ids)) < used), self.n),
                        pa.array([[d for d, _ in x] for x in at], pa.list_(pa.int64())),
                        pa.array([[e for _, e in x] for x in at], pa.list_(pa.int32())),
                    ],
                    schema=self.schema,
                )
            )
        self.held, self.size, self.docs = [flat[stop:].tobytes()], len(flat) - stop, [(d, e - stop) for d, e in self.docs[k:]]

    def close(self) -> None:
        self.flush(last=True)
        self.file.close()


def documents_of(source) -> Iterator[tuple[int | None, np.ndarray]]:
    """The documents of a shard, in order: id, and all its ids with the end id.  Holds a batch and a document at a time."""
    f = pa.ipc.open_file(source)
    open_part = []
    for i in range(f.num_record_batches):
        b = f.get_batch(i)
        n = b.schema.field("ids").type.list_size
        ids = b.column("ids").flatten().to_numpy(zero_copy_only=True).reshape(-1, n)
        mask = b.column("mask").flatten().to_numpy(zero_copy_only=False).reshape(-1, n)
        for row, m, docs, ends in zip(ids, mask, b.column("doc_ids").to_pylist(), b.column("ends").to_pylist()):
            at = 0
            for d, e in zip(docs, ends):
                yield d, np.concatenate([*open_part, row[at:e]])
                open_part, at = [], e
            left = row[at : int(m.sum())]
            if len(left):
                open_part.append(left)


def sequence_at(source, i: int, rows: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Sequence ``i`` of a file and its mask; with a memory-mapped source its ids are a view into the file."""
    f = pa.ipc.open_file(source)
    b = f.get_batch(i // rows)
    n = b.schema.field("ids").type.list_size
    k = i % rows
    return b.column("ids").flatten().to_numpy(zero_copy_only=True)[k * n : (k + 1) * n], b.column("mask").flatten().slice(k * n, n).to_numpy(zero_copy_only=False)


def _write_shards(folder: str, path: str, end_id: int, seq_len: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, encoder, writer, totals = TaskContext.get().partitionId(), None, None, [0, 0]
        fs, at = pyarrow.fs.FileSystem.from_uri(folder)
        name, work = f"{at}/shard-{shard:06d}.arrow", f"{at}/.{shard:06d}-{uuid.uuid4().hex}"
        for b in batches:
            if not b.num_rows:
                continue
            if writer is None:
                encoder = encoder_of(path)
                end = np.array([end_id], encoder.type).tobytes()
                fs.create_dir(at, recursive=True)
                sink = fs.open_output_stream(work)
                writer = ShardWriter(sink, seq_len, encoder.type)
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                for d, ids in zip(part.column(0).to_pylist(), encoder.encode([t or "" for t in part.column(1).to_pylist()])):
                    writer.add(d, ids + end)
                    totals[0] += 1
                    totals[1] += len(ids) // len(end) + 1
        if writer is not None:
            writer.close()
            sink.close()
            fs.move(work, name)
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([totals[0]], pa.int64()), pa.array([totals[1]], pa.int64())], ["shard", "n_docs", "n_ids"])

    return run


def write_token_files(docs: DataFrame, path: str, end_id: int = 0, seq_len: int = 2048, folder: str | None = None) -> tuple[str, DataFrame]:
    """Write the files; returns their folder and the manifest (shard, n_docs, n_ids, start: ids in the shards before)."""
    spark = docs.sparkSession
    folder = folder or new_path(spark, "token-files")
    make_folder(spark, folder)  # a table without rows has no files, but a folder to read
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    order = ["doc_id", F.xxhash64("text")]
    ranged = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    manifest = materialise(ranged.mapInArrow(_write_shards(folder, path, end_id, seq_len), "shard int, n_docs long, n_ids long"), "token-manifest")
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    return folder, manifest.withColumn("start", F.coalesce(before, F.lit(0)))


def _read_shards(folder: str, rows: int = 4096):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        fs, at = pyarrow.fs.FileSystem.from_uri(folder)
        for b in batches:
            for shard, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with fs.open_input_file(f"{at}/shard-{shard:06d}.arrow") as source:
                    docs = documents_of(source)
                    while part := list(islice(docs, rows)):
                        out = []
                        for d, ids in part:
                            out.append((d, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                            start += len(ids)
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)

    return run


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and crc32 of its ids (as 32-bit integers), from the files.

    Tasks open the shards that the manifest names and read them batch by batch, so a shard may be larger than memory.
    """
    shards = manifest.select("shard", "start")
    dealt = shards.repartition(max(shards.count(), 1))
    return dealt.mapInArrow(_read_shards(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")
