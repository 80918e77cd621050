"""Telephony audio columns: mu-law, A-law and IMA ADPCM in WAV, expanded with numpy, resampled, and stored as PCM.

mu-law and A-law expand by 256-entry tables.  ADPCM blocks of a file are decoded together: one step handles the same
nibble of all blocks.  ``store_payload`` keeps any bytes losslessly as 8-bit mu-law samples; ``store_pcm`` writes the resampled
16-bit PCM of an audio column.

Defined results: null is empty; a null audio cell gives nulls; bytes that are no WAV of these kinds give null samples.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

# WAV format tags and the step rule of IMA ADPCM.
PCM, ALAW, MULAW, IMA_ADPCM = 1, 6, 7, 17
INDEX_STEP = np.array([-1, -1, -1, -1, 2, 4, 6, 8] * 2)


#: The 89 step sizes of the published standard.
STEP = np.array(
    [
        int(x)
        for x in (
            "7 8 9 10 11 12 13 14 16 17 19 21 23 25 28 31 34 37 41 45 50 55 60 66 73 80 88 97 107 118 130 143 157 173 190 209 230 253 279 307 337 371 408 449 494 544 598 658 724 796 876 963 "
            "1060 1166 1282 1411 1552 1707 1878 2066 2272 2499 2749 3024 3327 3660 4026 4428 4871 5358 5894 6484 7132 7845 8630 9493 10442 11487 12635 13899 15289 16818 18500 20350 22385 24623 27086 29794 32767"
        ).split()
    ]
)


def mulaw_table() -> np.ndarray:
    """PCM of each mu-law code, from the code's sign, exponent and mantissa."""
    c = ~np.arange(256) & 0xFF
    size = ((((c & 0x0F) << 3) + 0x84) << ((c >> 4) & 7)) - 0x84
    return np.where(c & 0x80, -size, size).astype("<i2")


def alaw_table() -> np.ndarray:
    c = np.arange(256) ^ 0x55
    exp, low = (c >> 4) & 7, ((c & 0x0F) << 4) + 8
    size = np.where(exp == 0, low, (low + 0x100) << np.maximum(exp - 1, 0))
    return np.where(c & 0x80, size, -size).astype("<i2")


MULAW_PCM, ALAW_PCM = mulaw_table(), alaw_table()


def decode_adpcm(data: np.ndarray, block: int) -> np.ndarray:
    """Mono IMA ADPCM: all whole blocks at once; within a block samples depend on each other, blocks do not.

    A short last block gives the samples of its header and of the bytes that are there; less than a header holds none.
    """
    n = len(data) // block
    whole, rest = data[: n * block].reshape(n, block), data[n * block :]
    parts = [_adpcm_blocks(b) for b in (whole, rest.reshape(1, -1)) if len(b) and b.shape[1] >= 4]
    return np.concatenate(parts) if parts else np.zeros(0, "<i2")


def _adpcm_blocks(b: np.ndarray) -> np.ndarray:
    n = len(b)
    value = b[:, :2].copy().view("<i2").ravel().astype("i4")
    index = np.clip(b[:, 2].astype("i4"), 0, 88)
    codes = np.empty((n, 2 * (b.shape[1] - 4)), "u1")
    codes[:, 0::2], codes[:, 1::2] = b[:, 4:] & 15, b[:, 4:] >> 4
    out = np.empty((n, codes.shape[1] + 1), "<i2")
    out[:, 0] = value
    for k in range(codes.shape[1]):
        c = codes[:, k].astype("i4")
        step = STEP[index]
        diff = (step >> 3) + np.where(c & 1, step >> 2, 0) + np.where(c & 2, step >> 1, 0) + np.where(c & 4, step, 0)
        value = np.clip(np.where(c & 8, value - diff, value + diff), -32768, 32767)
        index = np.clip(index + INDEX_STEP[c], 0, 88)
        out[:, k + 1] = value
    return out.ravel()


def wav(data: bytes, tag: int, rate: int = 8000, bits: int = 8, block: int = 1, count: int | None = None) -> bytes:
    """A mono RIFF file around ``count`` encoded samples (default: all that ``data`` has room for), padded to an even length as the format asks."""
    samples = len(data) * 8 // bits if count is None else count
    fmt = struct.pack("<HHIIHHH", tag, 1, rate, rate * bits // 8, block, bits, 0)
    body = b"WAVE" + b"fmt " + struct.pack("<I", len(fmt)) + fmt + b"fact" + struct.pack("<II", 4, samples) + b"data" + struct.pack("<I", len(data)) + data + b"\0" * (len(data) % 2)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def chunks(media: bytes) -> dict[bytes, memoryview]:
    """The chunks of a RIFF WAVE file by their names; empty if it is none."""
    found: dict[bytes, memoryview] = {}
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        return found
    view, at = memoryview(media), 12
    while at + 8 <= len(media):
        name, n = bytes(view[at : at + 4]), struct.unpack_from("<I", media, at + 4)[0]
        found.setdefault(name, view[at + 8 : at + 8 + n])
        at += 8 + n + n % 2
    return found


def samples(media: bytes | None) -> tuple[int, np.ndarray] | None:
    """Sample rate and 16-bit samples of a mono WAV in one of the four codings, else None."""
    c = chunks(media or b"")
    if b"fmt " not in c or b"data" not in c or len(c[b"fmt "]) < 16:
        return None
    tag, channels, rate, _, block, bits = struct.unpack_from("<HHIIHH", c[b"fmt "])
    data = np.frombuffer(c[b"data"], "u1")
    if channels != 1 or not rate:
        return None
    if tag == MULAW and bits == 8:
        return rate, MULAW_PCM[data]
    if tag == ALAW and bits == 8:
        return rate, ALAW_PCM[data]
    if tag == IMA_ADPCM and bits == 4 and block > 4:
        # The last block may be padded; how many samples were recorded is in the fact chunk, if its writer came to fill it in.
        most = struct.unpack_from("<I", c[b"fact"])[0] if len(c.get(b"fact", b"")) >= 4 else 0
        return rate, decode_adpcm(data, block)[: most or None]
    if tag == PCM and bits == 16:
        return rate, data[: len(data) // 2 * 2].view("<i2")
    return None


def resample(pcm: np.ndarray, rate: int, to: int) -> np.ndarray:
    """Linear interpolation onto the new rate's places, in integers, so that equal input gives equal output anywhere."""
    if rate == to or not len(pcm):
        return pcm.astype("<i2")
    n = len(pcm) * to // rate
    if to == 2 * rate:
        out = np.empty(n, "<i2")
        out[0::2] = pcm
        wide = pcm.astype("i4")
        out[1:-1:2] = (wide[:-1] + wide[1:]) >> 1
        out[-1] = pcm[-1]
        return out
    place = np.arange(n, dtype="i8") * rate
    i, part = place // to, place % to
    j = np.minimum(i + 1, len(pcm) - 1)
    x = pcm.astype("i8")
    return ((x[i] * (to - part) + x[j] * part) // to).astype("<i2")


def store_payload(df: DataFrame, column: str, unit: int = 192) -> DataFrame:
    """``df`` with ``media``: the column's UTF-8 bytes, spaces appended up to a positive multiple of ``unit``, as mu-law WAV; and ``n_bytes``, their length before."""
    at, names = df.columns.index(column), df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                raw = [x or b"" for x in part.column(at).cast(pa.binary()).to_pylist()]
                media = [wav(x + b" " * (-len(x) % unit if x else unit), MULAW) for x in raw]
                rest = [c for i, c in enumerate(part.columns) if i != at]
                yield pa.RecordBatch.from_arrays([*rest, pa.array([len(x) for x in raw], pa.int64()), pa.array(media, pa.binary())], [n for n in names if n != column] + ["n_bytes", "media"])

    schema = ", ".join([f"`{n}` {t}" for n, t in df.dtypes if n != column] + ["n_bytes long", "media binary"])
    return df.mapInArrow(run, schema)


def store_pcm(df: DataFrame, column: str, rate: int = 16_000) -> DataFrame:
    """``df`` with ``column`` turned into 16-bit PCM WAV at ``rate``; null where there is no such audio."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                out = []
                for m in part.column(column).to_pylist():
                    x = samples(m)
                    out.append(None if x is None else wav(resample(x[1], x[0], rate).tobytes(), PCM, rate, 16, 2))
                i = part.schema.names.index(column)
                yield part.set_column(i, column, pa.array(out, pa.binary()))

    return df.mapInArrow(run, df.schema)


def describe(media: bytes) -> tuple:
    """What the stored bytes say when they are read back: payload, its digests, and features of the resampled sound."""
    payload = bytes(chunks(media)[b"data"])
    rate, pcm = samples(media)
    wide = pcm.astype("i4")
    high = resample(pcm, rate, 16_000)
    energy = int((wide.astype("i8") ** 2).sum())
    crossings = int(np.count_nonzero((wide[1:] < 0) != (wide[:-1] < 0)))
    feature = f"samples={len(pcm)};rms={int((energy / len(pcm)) ** 0.5)};peak={int(np.abs(wide).max())};crossings={crossings};pcm16k={zlib.crc32(high.tobytes()):08x}"
    return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature


def read_back(stored: DataFrame) -> DataFrame:
    """doc_id, n_bytes and the description of each row's ``media``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                cols = list(zip(*map(describe, part.column(2).to_pylist())))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array(c, k) for c, k in zip(cols, kinds))], names)

    kind = dict(stored.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return stored.select("doc_id", "n_bytes", "media").mapInArrow(run, schema)


def media_round_trip(docs: DataFrame) -> DataFrame:
    """Store every text as audio in a table, read the table, and describe what it holds."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return read_back(materialise(store_payload(rows, "text"), "media"))
