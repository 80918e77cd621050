"""Toxicity by a weighted finite-state pattern grammar.

A lexical transducer reads a text's words and writes class symbols: insult, suspect word, threat, target, negation,
reported speech, clause break.  Small weighted pattern transducers, one for each class of symbol, are
composed into one automaton that reads the symbols of a clause and ends in a state that says which pattern
the clause matches; what counts is the matched clause, not the word.  Insult words and stems are learned from
labelled rows, with log-odds as arc weights; the weights of the patterns come from a logistic regression.

Defined results: a null or empty text has no clause and gets the model's base rate; a null ``doc_id`` counts as
training side (never read for labels, as labels join on ``doc_id``); repeated labels of one document count once,
as toxic if any says so, and so do copies of one text; with no usable label the grammar falls back on its seed lists and prior weights.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, drop_tables, fresh, materialise

# The grammar's closed word classes, in English, French, German and Spanish.
TARGET_WORDS = (
    "you your yours yourself he she they them him her his their "
    "tu toi vous votre ton ta il ils elles "
    "du dich dir ihr euch sie ihn ihm "
    "tú usted ustedes vosotros ellos ellas él ella"
).split()
NEGATION_WORDS = (
    "not no never neither nor isn't aren't wasn't don't doesn't "
    "ne pas jamais non "
    "nicht kein keine keinen nie niemals "
    "ni nunca jamás tampoco"
).split()
REPORT_WORDS = (
    "said says say told wrote writes called calls claimed claims quoted reported reports alleged "
    "dit disait écrit appelé prétend "
    "sagte sagt schrieb nannte behauptet "
    "dijo dice escribió llamó afirma"
).split()
THREAT_WORDS = (
    "kill killed murder hurt destroy strangle stab shoot beat die "
    "tuer frapper détruire mourir "
    "töten umbringen schlagen sterben "
    "matar golpear destruir morir"
).split()
INSULT_SEEDS = (
    "idiot idiots moron morons imbecile stupid loser losers scum worthless pathetic disgusting bastard jerk coward "
    "imbécile crétin connard salaud minable "
    "dummkopf trottel arschloch abschaum versager "
    "estúpido imbécil cabrón inútil escoria"
).split()

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, SUSPECT = range(7)
SYMBOLS = 7
#: What a clause can match; the order of the features.
PATTERNS = ("insult", "insult_target", "insult_negated", "insult_reported", "threat", "threat_target", "suspect", "suspect_target")
PRIOR = np.array([3.0, 4.0, 1.5, 1.5, 1.0, 3.0, 0.3, 0.3])
PRIOR_BIAS = -2.5
WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[.!?;\n]+")
BREAKS = frozenset(".!?;\n")
STEMS = (4, 5, 6)


def flag_transducer(symbol: int) -> dict[tuple[int, int], int]:
    """A two-state transducer: state 1 once ``symbol`` was read in this clause."""
    return {(s, c): 1 if s or c == symbol else 0 for s in (0, 1) for c in range(SYMBOLS)}


def scope_transducer(cue: int, head: int) -> dict[tuple[int, int], int]:
    """0: nothing; 1: cue read, head open; 2: head read without a cue before it; 3: head in the cue's scope."""
    arcs = {(s, c): s for s in range(4) for c in range(SYMBOLS)}
    arcs |= {(0, cue): 1, (0, head): 2, (1, head): 3}
    return arcs


def compose(parts: list[tuple[int, dict]]) -> tuple[np.ndarray, list[tuple[int, ...]]]:
    """The product of deterministic transducers over the same symbols: a dense arc table and its states."""
    states = list(product(*(range(n) for n, _ in parts)))
    at = {s: i for i, s in enumerate(states)}
    table = np.array([[at[tuple(arcs[s[k], c] for k, (_, arcs) in enumerate(parts))] for c in range(SYMBOLS)] for s in states])
    return table, states


def grammar() -> tuple[list[list[int]], list[tuple[int, ...]]]:
    """The composed automaton, and for each state the patterns that a clause ending there matches."""
    table, states = compose(
        [(2, flag_transducer(INSULT)), (2, flag_transducer(THREAT)), (2, flag_transducer(TARGET)), (4, scope_transducer(NEGATION, INSULT)), (4, scope_transducer(REPORT, INSULT)), (2, flag_transducer(SUSPECT))]
    )
    out = []
    for insult, threat, target, negation, report, suspect in states:
        found = []
        if insult:
            found.append(3 if report == 3 else 2 if negation == 3 else 1 if target else 0)
        if threat:
            found.append(5 if target else 4)
        if suspect and not insult:
            found.append(7 if target else 6)
        out.append(tuple(found))
    return table.tolist(), out


ARCS, MATCHES = grammar()


@dataclass
class Grammar:
    """A fitted model: bounded, so it travels with the task."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    suspects: dict[str, float] = field(default_factory=dict)
    suspect_stems: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: PRIOR.copy())
    bias: float = PRIOR_BIAS
    rows: int = 0

    def lexicon(self) -> dict[str, tuple[int, float]]:
        lex = {w: (INSULT, 2.0) for w in INSULT_SEEDS}
        lex |= {w: (THREAT, 2.0) for w in THREAT_WORDS}
        lex |= {w: (SUSPECT, x) for w, x in self.suspects.items()}
        lex |= {w: (INSULT, x) for w, x in self.words.items()}
        for words, kind in ((TARGET_WORDS, TARGET), (NEGATION_WORDS, NEGATION), (REPORT_WORDS, REPORT)):
            lex |= {w: (kind, 0.0) for w in words if w not in self.words}
        return lex


class Matcher:
    """The lexical transducer with its cache of words, feeding the composed automaton clause by clause."""

    def __init__(self, model: Grammar, cache: int = 300_000):
        self.model, self.lex, self.cache, self.most = model, model.lexicon(), {}, cache

    def symbol(self, word: str) -> tuple[int, float]:
        if word[0] in BREAKS:
            return (-1, 0.0)
        if word in self.lex:
            return self.lex[word]
        for kind, stems in ((INSULT, self.model.stems), (SUSPECT, self.model.suspect_stems)):
            for n in STEMS:
                if len(word) >= n and word[:n] in stems:
                    return (kind, stems[word[:n]])
        return (OTHER, 0.0)

    def features(self, text: str | None) -> np.ndarray:
        out = np.zeros(len(PATTERNS))
        if not text:
            return out
        words = WORD.findall(text.lower())
        cache = self.cache
        if len(cache) > self.most:
            cache.clear()
        for w in set(words).difference(cache):
            cache[w] = None if (s := self.symbol(w))[0] == OTHER else s
        state, weight = 0, 0.0
        for symbol in filter(None, map(cache.__getitem__, words)):
            kind, x = symbol
            if kind < 0:
                if state:
                    for k in MATCHES[state]:
                        out[k] += max(weight, 0.5)
                state, weight = 0, 0.0
            else:
                state, weight = ARCS[state][kind], max(weight, x)
        for k in MATCHES[state]:
            out[k] += max(weight, 0.5)
        return np.log1p(out)

    def score(self, text: str | None) -> float:
        z = self.model.bias + float(self.features(text) @ self.model.weights)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, rounds: int = 40) -> tuple[np.ndarray, float]:
    """Newton steps for a logistic regression whose weights are drawn to the grammar's prior, not to zero."""
    a = np.column_stack([x, np.ones(len(x))])
    prior = np.append(PRIOR, PRIOR_BIAS)
    w = prior.copy()
    pull = np.append(np.full(len(PRIOR), ridge), 0.01)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (p - y) + pull * (w - prior)
        h = (a * (p * (1 - p))[:, None]).T @ a + np.diag(pull)
        step = np.linalg.solve(h, g)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return np.append(np.maximum(w[:-1], 0.0), w[-1])[:-1], float(w[-1])


def training_rows(docs: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """Labelled texts outside the held-out third; about ``bound`` of them, chosen by a hash of the id, if there are more.

    Copies of a text are one row, toxic if any of them is, wherever they lie: what is learned does not depend on partitions.
    """
    y = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (crc_mod(F.col("doc_id"), 3) != 1)).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    there = y.count()
    if there > bound:
        y = y.where(F.pmod(F.xxhash64(F.lit(17), "doc_id"), F.lit(1 << 30)) < int((1 << 30) * bound / there))
    # The labels are bounded, so they go to the texts; only the labelled texts are exchanged.
    rows = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull()).join(F.broadcast(y), "doc_id")
    return rows.groupBy(F.md5(F.col("text").cast("binary")).alias("_h")).agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic")


def _document_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either label that hold a word or a stem, summed over the task."""
    pos, neg, rows = Counter(), Counter(), [0, 0]
    for b in batches:
        for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if not text:
                continue
            words = {w for w in WORD.findall(text.lower()) if w[0] not in BREAKS}
            rows[1 if toxic else 0] += 1
            keys = set(words)
            for n in STEMS:
                keys.update(w[:n] + "*" for w in words if len(w) >= n)
            (pos if toxic else neg).update(keys)
    pos[""], neg[""] = rows[1], rows[0]
    keys = list(pos.keys() | neg.keys())
    for i in range(0, len(keys), 50_000):
        part = keys[i : i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([pos[k] for k in part], pa.int64()), pa.array([neg[k] for k in part], pa.int64())], ["feature", "pos", "neg"])


def _contexts(candidates: frozenset[str]):
    """Distinct (feature, word before it, word itself) in toxic texts: copies of a text bring no new context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[str, str, str]] = set()
        for b in batches:
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not toxic or not text:
                    continue
                before = ""
                for w in WORD.findall(text.lower()):
                    for k in (w, w[:4] + "*", w[:5] + "*", w[:6] + "*"):
                        if k in candidates:
                            seen.add((k, before, w))
                    before = w
        rows = list(seen)
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(3)], ["feature", "before", "word"])

    return run


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, max_lexicon: int = 20_000, min_gain: float = 25.0, min_contexts: int = 4, strong: float = 3.5) -> Grammar:
    """Fit lexicon and pattern weights on at most about ``max_rows`` labelled rows (the documented bound).

    A word or stem joins the lexicon if its log-likelihood gain over the base rate is at least ``min_gain``, it is
    at least e^2 times as likely in toxic texts, and it has ``min_contexts`` distinct words before it (so that a passage
    copied between toxic texts teaches nothing), a quarter as many as texts; a stem also needs three different words.  With log-odds of
    ``strong`` it is an insult, else a suspect, whose weight the regression finds.  ``max_lexicon`` bounds the model.
    """
    rows = materialise(training_rows(docs, labels, max_rows), "labelled")
    counts = rows.mapInArrow(_document_features, "feature string, pos long, neg long").groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    counts = counts.where((F.col("pos") >= 3) | (F.col("feature") == ""))
    total = counts.where(F.col("feature") == "").first()
    p_all, n_all = (total["pos"], total["neg"]) if total else (0, 0)
    model = Grammar(rows=p_all + n_all)
    if not p_all or not n_all:
        return model
    odds = F.log((F.col("pos") + 0.5) / (p_all + 1.0)) - F.log((F.col("neg") + 0.5) / (n_all + 1.0))
    n, q = F.col("pos") + F.col("neg"), p_all / (p_all + n_all)
    xlog = lambda k, e: F.when(k > 0, k * F.log(k / (n * e))).otherwise(0.0)
    gain = 2 * (xlog(F.col("pos"), q) + xlog(F.col("neg"), 1 - q))
    picked = counts.where(F.col("feature") != "").withColumn("odds", odds).withColumn("gain", gain).where((F.col("odds") >= 2.0) & (F.col("gain") >= min_gain))
    found = {r["feature"]: (r["odds"], r["pos"]) for r in picked.orderBy(F.desc("gain"), "feature").limit(max_lexicon).collect()}
    if found:
        seen = rows.where("toxic = 1").mapInArrow(_contexts(frozenset(found)), "feature string, before string, word string")
        wide = seen.groupBy("feature").agg(F.countDistinct("before").alias("contexts"), F.countDistinct("word").alias("words"))
        for r in wide.collect():
            k = r["feature"]
            odds, texts = found[k]
            if r["contexts"] < max(min_contexts, texts / 4):
                continue
            if not k.endswith("*"):
                (model.words if odds >= strong else model.suspects)[k] = min(odds, 6.0)
            elif r["words"] >= 3:
                (model.stems if odds >= strong else model.suspect_stems)[k[:-1]] = min(odds, 6.0)
    m = Matcher(model)
    sample = rows.mapInArrow(_features_of(m.model), "x array<double>, toxic int").groupBy("x", "toxic").count().collect()
    sample.sort(key=lambda r: (r["x"], r["toxic"]))  # sums of floats in one order
    x = np.array([r["x"] for r in sample])
    y = np.array([float(r["toxic"]) for r in sample])
    c = np.array([r["count"] for r in sample])
    model.weights, model.bias = logistic(np.repeat(x, c, axis=0), np.repeat(y, c))
    drop_tables(rows)
    return model


def _features_of(model: Grammar):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Matcher(model)
        for b in batches:
            x = [np.round(m.features(t), 6).tolist() for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), b.column(1).cast(pa.int32())], ["x", "toxic"])

    return run


def score(docs: DataFrame, model: Grammar, text: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with a column ``out`` (0 to 1): one pass, no shuffle."""

    @F.pandas_udf("double")
    def grammar_score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = Matcher(model)
        for s in batches:
            yield pd.Series([m.score(t) for t in s], dtype="float64")

    return docs.withColumn(out, grammar_score(F.col(text)))


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Documents whose score is under ``threshold``, with their own columns."""
    model = fit(docs, labels)
    (out,) = fresh(docs, "_toxicity")
    return score(docs, model, out=out).where(F.col(out) < threshold).select(*docs.columns)
