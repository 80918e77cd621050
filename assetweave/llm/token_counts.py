"""Token counts by a two-tier lookup on the map side, without any shuffle of pre-tokens.

Tier 1 is a compact table of frequent pre-tokens and their lengths in tokens, fitted on a bounded sample and broadcast.  Tier 2
is each worker's cache, which serves all its tasks; what neither tier holds is encoded by the library, once for each distinct pre-token of a batch.
Texts are cut at spaces and line ends, which the vocabulary's pre-tokenizer always drops, so the lengths of the parts add up.

Defined results: null is the empty text: 0 bytes, 0 tokens.  Strings of special tokens inside texts count as the library
takes them by default (one token).  Very long texts are counted whole; each row is counted by itself, so ties, repeated rows and repeated
ids change nothing; an empty table gives an empty table; other columns are not read, whatever their names.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bounds of a worker's cache: entries, and characters of an entry; longer parts are encoded anew in each batch.
CACHED, LONGEST = 1_000_000, 128


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def drops_spaces(path: str) -> bool:
    """Whether the file's normaliser and pre-tokenizer make white space a cut and nothing else: then texts may be cut there."""
    with open(path, encoding="utf-8") as f:
        j = json.load(f)
    steps = (j["pre_tokenizer"] or {}).get("pretokenizers", [j["pre_tokenizer"] or {}])
    return any(s.get("type") == "Split" and s.get("behavior") == "Removed" and s.get("invert") and "\\s" in s["pattern"].get("Regex", "") for s in steps)


def frequent_lengths(docs: DataFrame, path: str, entries: int = 50_000, sample_rows: int = 20_000) -> tuple[str, bytes]:
    """Tier 1: up to ``entries`` of the most frequent parts of about ``sample_rows`` texts, and their lengths.

    Both numbers bound the table (under 1 MB); it only saves work, so the sample can't change a count.
    """
    rows = docs.count()
    share = min(1.0, sample_rows / max(rows, 1))
    some = docs.where(F.pmod(F.xxhash64(F.lit(4), F.coalesce(F.col("text").cast("string"), F.lit(""))), F.lit(1 << 20)) < int(share * (1 << 20)))
    part = some.select(F.explode(F.split(F.translate(F.col("text").cast("string"), "\n", " "), " ")).alias("part"))
    top = part.where((F.col("part") != "") & (F.char_length("part") <= 64)).groupBy("part").count().orderBy(F.desc("count"), "part").limit(entries)
    words = [r["part"] for r in top.collect()]
    lens = [len(e.ids) for e in load(path).encode_batch(words, add_special_tokens=False)]
    return " ".join(words), bytes(min(n, 255) for n in lens)


class WorkerLengths:
    """What a worker holds for all its tasks: the library, tier 1, and tier 2, the lengths of what it had to encode."""

    def __init__(self, path: str, frequent: tuple[str, bytes]):
        self.t, self.whole = load(path), not drops_spaces(path)
        self.tier1 = {w: n for w, n in zip(frequent[0].split(" "), frequent[1]) if n < 255}
        self.tier1[""] = 0
        self.cache = dict(self.tier1)

    def encoded(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.t.encode_batch(texts, add_special_tokens=False)]

    def count(self, texts: list[str]) -> list[int]:
        if self.whole:
            return self.encoded(texts)
        parts = [x.replace("\n", " ").split(" ") for x in texts]
        if len(self.cache) > CACHED:
            self.cache = dict(self.tier1)
        new = list(set().union(*parts).difference(self.cache))
        lengths = dict(zip(new, self.encoded(new)))
        self.cache.update(lengths)
        out = [sum(map(self.cache.__getitem__, p)) for p in parts]
        for w in lengths:
            if len(w) > LONGEST:
                del self.cache[w]
        return out


@lru_cache(maxsize=2)
def worker_lengths(path: str, frequent: Broadcast) -> WorkerLengths:
    return WorkerLengths(path, frequent.value)


def counter(path: str, frequent: Broadcast):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held = worker_lengths(path, frequent)
        for s in batches:
            texts, out = [x or "" for x in s], []
            for lo in range(0, len(texts), 1024):
                out += held.count(texts[lo : lo + 1024])
            yield pd.Series(out, dtype="int64")

    return run


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, frequent: tuple[str, bytes] | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every whole text."""
    frequent = frequent_lengths(docs, path) if frequent is None else frequent
    lengths = F.pandas_udf(_typed(counter(path, docs.sparkSession.sparkContext.broadcast(frequent))), "long")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    out = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), lengths(text).alias("n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def _typed(f):
    """``f`` with the annotations that tell Spark its kind of UDF."""

    def lengths(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        return f(batches)

    return lengths
