"""LM scoring by deleted interpolation.

The probability of a token w after its context mixes maximum-likelihood estimates of all orders,

    p(w | h) = l_n(b) f(w | h_n) + ... + l_1(b) f(w) + l_0(b) / (V + 1),

with weights l(b) that depend on the bucket b of the longest context that was seen: its order, and how often (powers of two).
Orders whose context was never seen have no weight there, so that the mixture always sums to one over the vocabulary and one unknown
token.  The weights are learned by expectation-maximisation on a deleted part of the training texts: there the counts of
everything but that part give the estimates.  The final model uses the counts of all training texts.

All counts are corpus-wide: blocks of texts ask for the counts of their own distinct n-grams (see ``keycount``), so what is gathered
grows with the corpus and a frequent n-gram is one entry for a block.  A context's count is that of the n-gram one shorter before the
token, as every word is followed by one token.  Blocks lie in buckets and the answers come to them.  Nothing but the weights and a few
totals reaches the driver.

Words are 64-bit hashes; longer n-grams are cut to 17 bits more than their number needs (at most 64), so that about one in a hundred
thousand meets another.

Tokens: A-Z lower-cased; words between white space (0x20, 0x09-0x0D); one end token for each text.

Defined results: null and empty texts are the end token alone; very long texts are scored whole; repeated rows count and are
scored each; a null ``doc_id`` counts as the id '' (training side or not by the same rule); with no training texts the scores are those
of the uniform share; an empty table gives an empty table; only ``doc_id`` and ``text`` are looked at, whatever other columns are called.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import keycount as K
from .common import Bucketed, crc_mod, drop_tables, materialise

END, BEGIN = np.uint64(0x1D0C5E11F00DFEED), np.uint64(0x5EA7B0A4C0FFEE11)
#: Powers of two for each order.
BUCKETS = 48
#: Texts whose remainder is this are the deleted part.
DELETED = 1
#: Tokens of a block; bounds a task's arrays.
BLOCK_TOKENS = 500_000
ORDER = 3


def remainder(doc_id: int | None) -> int:
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 10


@dataclass
class Totals:
    """What the whole corpus says besides its n-grams' counts: tokens and texts of the training side, and of its deleted part."""

    tokens: int
    texts: int
    deleted_tokens: int
    deleted_texts: int
    types: int


class Block:
    """The token stream of a block: texts with their end tokens, and its n-grams as keys."""

    def __init__(self, row: dict, orders: list[int], bits: int):
        self.doc_ids, lens, vocab, ids = K.block_arrays(row)
        self.lens = lens + 1
        ends = np.cumsum(self.lens)
        self.doc = np.repeat(np.arange(len(lens)), self.lens)
        token = np.empty(int(self.lens.sum()), "u8")
        is_end = np.zeros(len(token), bool)
        is_end[ends - 1] = True
        token[is_end] = END
        token[~is_end] = vocab[ids] if len(ids) else np.zeros(0, "u8")
        self.part = np.array([remainder(d) for d in self.doc_ids])
        self.first = np.concatenate([[True], is_end[:-1]]) if len(token) else is_end
        self.grams = {1: token}
        context, before, start, cut = np.zeros(len(token), "u8"), token, self.first, np.uint64(64 - bits)
        for k in range(2, max(orders) + 1):
            before = np.where(start, BEGIN, np.concatenate([[BEGIN], before[:-1]]))
            context = K.mix(context * np.uint64(3) + before)
            start = start | np.concatenate([[True], start[:-1]])
            self.grams[k] = K.mix(context ^ (token * np.uint64(0x9E3779B97F4A7C15))) >> cut << cut
        self.grams = {k: self.grams[k] for k in orders}

    def keys(self) -> dict[str, tuple[np.ndarray, list[np.ndarray]]]:
        out, trains, deleted = {}, (self.part != 0)[self.doc], (self.part == DELETED)[self.doc]
        for k, grams in self.grams.items():
            keys, at = np.unique(grams, return_inverse=True)
            out[str(k)] = (keys, [np.bincount(at, w, len(keys)).astype("u8") for w in (trains, deleted)])
        return out

    def counts(self, told: K.Answers, without_deleted: bool) -> dict[int, np.ndarray]:
        """For every token: the count of each of its n-grams in the training texts, or in those without the deleted part."""
        out = {}
        for k, grams in self.grams.items():
            _, at = np.unique(grams, return_inverse=True)
            every, deleted = told.counts(str(k), 2)
            out[k] = (every - deleted if without_deleted else every)[at].astype("i8")
        return out


def estimates(c: dict[int, np.ndarray], first: np.ndarray, tokens: int, texts: int, types: int) -> tuple[np.ndarray, np.ndarray]:
    """Each token's bucket, and a column of estimates for each order from 0 up; orders without a seen context have none."""
    n = len(first)
    cols, order, seen = [np.full(n, 1 / (types + 1)), c[1] / max(tokens, 1)], np.full(n, int(tokens > 0)), np.zeros(n, "i8")
    for k in range(2, len(c) + 1):
        context = np.where(first, texts, np.concatenate([[0], c[k - 1][:-1]]))
        cols.append(c[k] / np.maximum(context, 1))
        order, seen = np.where(context > 0, k, order), np.where(context > 0, context, seen)
    power = np.where(seen > 0, np.minimum(np.log2(np.maximum(seen, 1)).astype("i8"), BUCKETS - 1), 0)
    return order * BUCKETS + power, np.column_stack(cols)


def start_weights(order: int) -> np.ndarray:
    """Equal shares of the orders that a bucket has."""
    w = np.array([[float(k <= j) for k in range(order + 1)] for j in range(order + 1) for _ in range(BUCKETS)])
    return w / w.sum(axis=1, keepdims=True)


def next_weights(used: np.ndarray, order: int) -> np.ndarray:
    """The M-step: shares of expected use.  One token's worth of the mean over the buckets of an order keeps those without deleted tokens usable."""
    prior = start_weights(order)
    for j in range(order + 1):
        rows = slice(j * BUCKETS, (j + 1) * BUCKETS)
        mean = used[rows].sum(axis=0) + 1e-6 * prior[rows][0]
        prior[rows] = mean / mean.sum()
    new = used + prior
    return new / new.sum(axis=1, keepdims=True)


def _held(order: int, bits: int, t: Totals):
    """For the blocks of the deleted part: their tokens' buckets and estimates from the counts of everything else."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out, told = [], K.Answers(right)
        for row in left.to_pylist():
            b = Block(row, list(range(1, order + 1)), bits)
            which, f = estimates(b.counts(told, True), b.first, t.tokens - t.deleted_tokens, t.texts - t.deleted_texts, t.types)
            out.append(pa.table({"which": pa.array(which, pa.int32()), **{f"f{k}": pa.array(f[:, k]) for k in range(order + 1)}}))
        return pa.concat_tables(out) if out else pa.table({"which": pa.array([], pa.int32()), **{f"f{k}": pa.array([], pa.float64()) for k in range(order + 1)}})

    return run


def _expected(order: int, weights: np.ndarray):
    """One E-step over a task's share of the deleted part: for each bucket the expected use of each order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros_like(weights)
        for b in batches:
            which, n = b.column(0).to_numpy(), b.column(order + 2).to_numpy()
            mixed = np.column_stack([b.column(k + 1).to_numpy() for k in range(order + 1)]) * weights[which]
            mixed *= (n / mixed.sum(axis=1))[:, None]
            for k in range(order + 1):
                sums[:, k] += np.bincount(which, mixed[:, k], len(sums))
        full = np.flatnonzero(sums.sum(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(sums[full].tolist(), pa.list_(pa.float64()))], ["which", "used"])

    return run


def fit_weights(held: DataFrame, order: int, rounds: int) -> np.ndarray:
    """Expectation-maximisation over the deleted part, of which equal (bucket, estimates) are one row with their number."""
    weights = start_weights(order)
    for _ in range(rounds):
        used = held.mapInArrow(_expected(order, weights), "which int, used array<double>")
        sums = used.groupBy("which").agg(*[F.sum(F.col("used")[k]).alias(f"u{k}") for k in range(order + 1)]).collect()
        total = np.zeros_like(weights)
        for r in sums:
            total[r["which"]] = [r[f"u{k}"] for k in range(order + 1)]
        new = next_weights(total, order)
        done = np.abs(new - weights).max() < 1e-3
        weights = new
        if done:
            break
    return weights


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _scores(order: int, bits: int, t: Totals, weights: np.ndarray):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out, told = [], K.Answers(right)
        for row in left.to_pylist():
            b = Block(row, list(range(1, order + 1)), bits)
            c = b.counts(told, False)
            which, f = estimates(c, b.first, t.tokens, t.texts, t.types)
            add = lambda x: np.bincount(b.doc, x, len(b.lens))
            score = add(np.log10((f * weights[which]).sum(axis=1)))
            base = add(np.log10((c[1] + 0.1) / (t.tokens + 0.1 * (t.types + 1))))
            columns = [pa.array(b.doc_ids, pa.int64()), pa.array(b.part == 0), pa.array(b.lens, pa.int64()), pa.array(add(c[1] > 0).astype("i8")), pa.array(base), pa.array(score)]
            out.append(pa.table(columns, ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]))
        return pa.concat_tables(out)

    return run


def score_texts(docs: DataFrame, order: int = ORDER, rounds: int = 12) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score (smoothed unigrams) and score (log10 probability) of every text.

    Texts whose crc32(doc_id) mod 10 is 0 are held out from all learning; remainder 1 is the deleted part for the weights.
    """
    deleted = (crc_mod(F.col("doc_id").cast("long"), 10) == DELETED).cast("int")
    blocks = Bucketed(K.token_blocks(docs, BLOCK_TOKENS, deleted), "lm-blocks", "block")
    try:
        return _score_blocks(blocks.rows(), order, rounds)
    finally:
        blocks.drop()


def _score_blocks(blocks: DataFrame, order: int, rounds: int) -> DataFrame:
    total = (blocks.agg(F.sum(F.col("n") + F.size("lens"))).first()[0] or 0)
    bits = min(64, max(40, int(total).bit_length() + 17))
    # Each exchange on its own, so that no two of them lie on disk at once.
    told = []
    for orders in [[k] for k in range(1, order + 1)]:
        asked = K.ask(blocks, lambda row, orders=orders: Block(row, orders, bits).keys(), K.shards_for(total * len(orders)))
        told.append(materialise(K.answers(asked), "lm-answers"))
        drop_tables()
    types = told[0].where("kind = '1'").agg(F.sum("distinct")).first()[0] or 0
    t = Totals(*_totals(blocks), types)
    answers = told[0]
    for more in told[1:]:
        answers = answers.union(more)

    of_deleted = "block % 2 = 1"
    held = blocks.where(of_deleted).groupBy("block").cogroup(answers.where(of_deleted).groupBy("block"))
    fs = [f"f{k}" for k in range(order + 1)]
    held = held.applyInArrow(_held(order, bits, t), "which int, " + ", ".join(f"{f} double" for f in fs))
    held = materialise(held.groupBy("which", *fs).count(), "lm-held")
    weights = fit_weights(held, order, rounds)

    scores = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_scores(order, bits, t, weights), SCORES)
    scores = materialise(scores, "lm-scores")
    drop_tables(held, *told)
    return scores.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(t.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def _totals(blocks: DataFrame) -> tuple[int, int, int, int]:
    """Training tokens and texts, and those of the deleted part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, lens in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                part, n = np.array([remainder(d) for d in ids]), np.array(lens) + 1
                found = [n[part != 0].sum(), (part != 0).sum(), n[part == DELETED].sum(), (part == DELETED).sum()]
                yield pa.RecordBatch.from_arrays([pa.array([int(x)]) for x in found], ["tokens", "texts", "deleted_tokens", "deleted_texts"])

    names = ["tokens", "texts", "deleted_tokens", "deleted_texts"]
    r = blocks.select("doc_ids", "lens").mapInArrow(run, ", ".join(f"{n} long" for n in names)).agg(*[F.sum(n) for n in names]).first()
    return tuple(x or 0 for x in r)


def perplexity(score: float, n_tokens: int) -> float:
    return math.pow(10, -score / max(n_tokens, 1))
