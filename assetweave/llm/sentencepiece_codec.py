"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies, with a score-ordered agenda of symbol pairs.

A text is cut where a space follows another character: no piece of such a vocabulary crosses that place (checked when
the vocabulary is read), so segments can be encoded once and kept in a worker's cache.  New segments of an Arrow
batch go through the agenda together: each round takes from every segment's agenda its best pair (highest score, then
leftmost), merges it, and puts the pairs with the new neighbours in its place.  Long segments use a heap for the same agenda.
All new segments are checked against the library's own result; should one differ, the library's stands and is counted.

Defined results: null is the empty text: no ids, and it decodes to the empty text.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
SEGMENT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+$")
CACHED, LONG, CHUNK = 400_000, 64, 20_000


class Vocabulary:
    """Pieces, scores and the table of merges, read from the model file."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.piece = {}
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(n)]
        for i in range(n):
            if not special[i]:
                self.piece[sp.id_to_piece(i)] = i
        if any(MARK in p.lstrip(MARK) for p in self.piece):
            raise ValueError("a piece holds a space after another character; segments can't be encoded on their own")
        self.score = np.array([sp.get_score(i) for i in range(n)], "f8")
        self.unknown = sp.unk_id()
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.fallback = all(sp.is_byte(i) for i in self.bytes)
        # Characters that only occur inside longer pieces still are symbols: they get numbers after the pieces.
        chars = {c for p in self.piece for c in p}
        self.symbol = {p: i for p, i in self.piece.items() if len(p) == 1}
        for c in sorted(chars - self.symbol.keys()):
            self.symbol[c] = n + len(self.symbol)
        self.other = max([n, *self.symbol.values()]) + 1
        self.of_char = np.full(0x110000, self.other, "i4")
        for c, i in self.symbol.items():
            self.of_char[ord(c)] = i
        #: Neighbours inside some piece; between any others a segment can be cut again.
        self.joined = {p[k : k + 2] for p in self.piece for k in range(len(p) - 1)}
        self.base = self.other + 1
        known = self.piece | self.symbol
        pairs = {known[p[:k]] * self.base + known[p[k:]]: i for p, i in self.piece.items() for k in range(1, len(p)) if p[:k] in known and p[k:] in known}
        self.merge = pairs
        self.keys = np.array(sorted(pairs), "i8")
        self.into = np.array([pairs[k] for k in self.keys.tolist()], "i4")

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What pairs of symbols merge into and with which score; -inf where they don't."""
        k = left.astype("i8") * self.base + right
        at = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
        ok = (self.keys[at] == k) & (left >= 0) & (right >= 0)
        into = np.where(ok, self.into[at], -1)
        return into, np.where(ok, self.score[into], -np.inf)

    def out(self, char: str) -> list[int]:
        """The ids of a character that is no piece."""
        return [self.bytes[b] for b in char.encode()] if self.fallback else [self.unknown]

    def agenda(self, segment: str) -> list[int]:
        """One segment by a heap of (score, place) of adjacent pairs."""
        sym = [self.symbol.get(c, self.other) for c in segment]
        n = len(sym)
        after, before, heap = list(range(1, n + 1)), list(range(-1, n - 1)), []

        def push(i: int) -> None:
            if i >= 0 and after[i] < n and (m := self.merge.get(sym[i] * self.base + sym[after[i]])) is not None:
                heapq.heappush(heap, (-self.score[m], i, sym[i], sym[after[i]], m))

        for i in range(n - 1):
            push(i)
        while heap:
            _, i, a, b, m = heapq.heappop(heap)
            j = after[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue
            sym[i], sym[j], after[i] = m, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            push(before[i])
            push(i)
        return [x for i, s in enumerate(sym) if s >= 0 for x in ([s] if s < len(self.score) else self.out(segment[i]))]

    def cut(self, segment: str) -> list[str]:
        """Parts that no merge can join: no piece holds the two characters around a cut."""
        joined, parts, at = self.joined, [], 0
        for i in range(1, len(segment)):
            if segment[i - 1 : i + 1] not in joined:
                parts.append(segment[at:i])
                at = i
        parts.append(segment[at:])
        return parts

    def agendas(self, segments: list[str]) -> list[bytes]:
        """Many segments of about the same length, a round of all agendas at a time; ids as little-endian integers."""
        n, width = len(segments), max(map(len, segments))
        sym = np.full((n, width + 1), -1, "i4")
        lens = np.fromiter(map(len, segments), "i8", n)
        inside = np.arange(width + 1) < lens[:, None]
        sym[inside] = self.of_char[np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), "<u4")]
        after = np.tile(np.arange(1, width + 2), (n, 1))
        before = np.tile(np.arange(-1, width), (n, 1))
        into = np.full((n, width + 1), -1, "i4")
        score = np.full((n, width + 1), -np.inf)
        into[:, :-1], score[:, :-1] = self.look_up(sym[:, :-1], sym[:, 1:])
        rows = np.arange(n)
        while len(rows):
            best = score[rows].argmax(axis=1)
            live = score[rows, best] > -np.inf
            rows, i = rows[live], best[live]
            if not len(rows):
                break
            j = after[rows, i]
            k = after[rows, j]
            sym[rows, i] = into[rows, i]
            sym[rows, j] = -2
            score[rows, j] = -np.inf
            after[rows, i] = k
            k = np.minimum(k, width)
            before[rows, k] = i
            into[rows, i], score[rows, i] = self.look_up(sym[rows, i], np.where(k < lens[rows], sym[rows, k], -1))
            h = before[rows, i]
            there = h >= 0
            r, h, i = rows[there], h[there], i[there]
            into[r, h], score[r, h] = self.look_up(sym[r, h], sym[r, i])
        keep = sym >= 0
        raw = sym[keep].astype("<i4").tobytes()
        ends = (np.cumsum(keep.sum(axis=1)) * 4).tolist()
        out = [raw[lo:hi] for lo, hi in zip([0, *ends], ends)]
        plain = len(self.score)
        for r in np.unique(np.nonzero(sym >= plain)[0]).tolist():
            ids = [x for i in np.flatnonzero(keep[r]).tolist() for x in ([int(sym[r, i])] if sym[r, i] < plain else self.out(segments[r][i]))]
            out[r] = np.array(ids, "<i4").tobytes()
        return out


class Encoder:
    """A worker's encoder: cache of segments, agendas for what is new, and the check against the library."""

    def __init__(self, path: str):
        self.vocabulary, self.cache, self.parts, self.differ = Vocabulary(path), {}, {}, 0

    def segments(self, text: str) -> list[str]:
        """Segments without their first mark: the library puts that one before a text by itself."""
        if "  " not in text and MARK not in text and not text.startswith(" "):
            return text.split(" ")
        return [s[1:] for s in SEGMENT.findall(MARK + text.replace(" ", MARK))]

    def learn(self, new: list[str]) -> None:
        """Encode new segments by their parts, check them all against the library, and keep them."""
        v = self.vocabulary
        parts = [v.cut(MARK + s) for s in new]
        fresh = set()
        for p in parts:
            fresh.update(p)
        fresh.difference_update(self.parts)
        fresh = sorted(fresh, key=len)
        short = [s for s in fresh if len(s) < LONG]
        for at in range(0, len(short), CHUNK):
            some = short[at : at + CHUNK]
            self.parts.update(zip(some, v.agendas(some)))
        for s in fresh[len(short) :]:
            self.parts[s] = np.array(v.agenda(s), "<i4").tobytes()
        mine = [b"".join(map(self.parts.__getitem__, p)) for p in parts]
        theirs = v.library.encode([s.replace(MARK, " ") for s in new], num_threads=1)
        same = np.array_equal(np.frombuffer(b"".join(mine), "<i4"), np.fromiter(chain.from_iterable(theirs), "<i4")) and all(len(m) == 4 * len(t) for m, t in zip(mine, theirs))
        if not same:
            for i, (s, t) in enumerate(zip(new, theirs)):
                # The empty segment is a lone space, which the library gives no ids on its own.
                if s and mine[i] != (t := np.array(t, "<i4").tobytes()):
                    self.differ += 1
                    mine[i] = t
        self.cache.update(zip(new, mine))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        parts = [self.segments(t) if t else [] for t in texts]
        if len(self.cache) > CACHED:
            self.cache.clear()
        if len(self.parts) > CACHED:
            self.parts.clear()
        new = set()
        for p in parts:
            new.update(p)
        new.difference_update(self.cache)
        if new:
            self.learn(list(new))
        return [np.frombuffer(b"".join(map(self.cache.__getitem__, p)), "<i4") for p in parts]


def codec(path: str, decode: bool = True):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = Encoder(path)
        for b in batches:
            at = b.schema.names.index("_text")
            rest = [i for i in range(b.num_columns) if i != at]
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                ids = e.encode([t or "" for t in part.column(at).to_pylist()])
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype("i4")
                out = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids) if len(ids) else np.zeros(0, "i4"), pa.int32()))]
                if decode:
                    out.append(pa.array(e.vocabulary.library.decode([x.tolist() for x in ids], num_threads=1), pa.string()))
                yield pa.RecordBatch.from_arrays([part.column(i) for i in rest] + out, [b.schema.names[i] for i in rest] + ["ids", "decoded"][: 1 + decode])

    return run


def encode(docs: DataFrame, path: str, keep: list[str] | None = None, decode: bool = True) -> DataFrame:
    """Columns ``keep`` of ``docs`` (doc_id if not given), ``ids`` and, with ``decode``, the text that they decode to."""
    keep = ["doc_id"] if keep is None else keep
    rows = docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    schema = [f"`{n}` {t}" for n, t in rows.dtypes if n != "_text"] + ["ids array<int>"] + ["decoded string"] * decode
    return rows.mapInArrow(codec(path, decode), ", ".join(schema))


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and hex digests of the ids (decimal, comma between) and of the decoded text."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Encode whole texts, decode them again, and return the digests of both."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    return digests(encode(docs, path))
