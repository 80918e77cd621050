"""Benchmark decontamination by winnowing, in DataFrame expressions only.

Both sides keep the smallest k-gram hash of every sliding window of ``w`` k-grams.  With k + w - 1 = 13 words, two texts that
share 13 words in a row share a kept fingerprint, so the join of training and test fingerprints finds every document
with a shared span.  Hits are extended from where they lie: only the 13-word windows of the document around a k-gram whose
fingerprint was found are compared with the benchmark's windows, and the words they cover are counted.

Items of fewer than 13 words are one window as a whole; for each such length the document's grams of that length are its
fingerprints.

Defined results: null texts have no words; items without words never occur; a null ``item_id`` is skipped; a document
without words is clean; very long texts are taken whole; repeated rows are judged each, and rows that repeat a ``doc_id`` with
different texts each on its own; of equal smallest hashes either stands for both; an empty benchmark leaves every document clean and an
empty table gives an empty table; other columns are kept as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, drop_tables, fresh, materialise, small

SPAN, KGRAM = 13, 5
DELIMITERS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def with_words(df: DataFrame) -> DataFrame:
    """``df`` with its text's words as the array ``_w``; each step is a projection of its own, so that none is computed twice."""
    parts = df.withColumn("_p", F.split(ascii_lower(F.coalesce(F.col("text").cast("string"), F.lit(""))), DELIMITERS, -1))
    lead = F.when(F.get("_p", F.lit(0)) == "", 1).otherwise(0)
    tail = F.when((F.size("_p") > 1) & (F.element_at("_p", -1) == ""), 1).otherwise(0)
    return parts.withColumn("_w", F.slice("_p", lead + 1, F.greatest(F.size("_p") - lead - tail, F.lit(0)))).drop("_p")


def gram_hashes(hashes: Column, n: int) -> Column:
    """Hashes of the n-grams of an array of word hashes; empty if there are fewer words."""
    at = lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(n)])
    return F.when(F.size(hashes) >= n, F.transform(F.sequence(F.lit(0), F.size(hashes) - n), at)).otherwise(F.array().cast("array<bigint>"))


def sliding_min(grams: str, w: int) -> Column:
    """SQL for the minimum of every ``w`` neighbours of an array column; a shorter array has one window."""
    least = ", ".join(f"get({grams}, i + {k})" for k in range(w))
    return F.expr(f"CASE WHEN size({grams}) = 0 THEN {grams} WHEN size({grams}) < {w} THEN array(array_min({grams})) ELSE transform(sequence(0, size({grams}) - {w}), i -> least({least})) END")


def fingerprints(words: DataFrame, keep: list[str], k: int = KGRAM, span: int = SPAN) -> DataFrame:
    """Distinct winnowed fingerprints: ``keep`` and ``fp``."""
    h = words.withColumn("_h", F.transform("_w", lambda x: F.xxhash64(x)))
    g = h.withColumn("_g", gram_hashes(F.col("_h"), k))
    return g.select(*keep, F.explode(F.array_distinct(sliding_min("_g", span - k + 1))).alias("fp"))


def _window_hashes(words: DataFrame, n: int | Column, keep: list[str]) -> DataFrame:
    """A row for each window of ``n`` words: its first word's place and a 128-bit hash."""
    h = _word_hashes(words, keep)
    at = F.posexplode(F.arrays_zip(gram_hashes(F.col("_h"), n).alias("w1"), gram_hashes(F.col("_h2"), n).alias("w2")))
    return h.where(F.size("_h") >= n).select(*keep, at.alias("at", "_z")).select(*keep, "at", F.col("_z.w1").alias("w1"), F.col("_z.w2").alias("w2"))


def _word_hashes(words: DataFrame, keep: list[str]) -> DataFrame:
    return words.select(*keep, F.transform("_w", lambda x: F.xxhash64(x)).alias("_h"), F.transform("_w", lambda x: F.xxhash64(F.lit("w"), x)).alias("_h2"))


def _windows_near(words: DataFrame, span: int, k: int) -> DataFrame:
    """The windows of ``span`` words that hold a k-gram whose hash is among the row's ``fps``: place of the first word and a 128-bit hash.

    ``words`` is a written table of word hashes.
    """
    h = words.where(F.size("_h") >= span).withColumn("_g", gram_hashes(F.col("_h"), k))
    hits = F.filter(F.sequence(F.lit(0), F.size("_g") - 1), lambda i: F.array_contains("fps", F.get("_g", i)))
    around = lambda p: F.sequence(F.greatest(p - (span - k), F.lit(0)), F.greatest(F.least(p, F.size("_h") - span), F.lit(0)))
    starts = h.withColumn("_s", hits).withColumn("_s", F.array_distinct(F.flatten(F.transform("_s", around))))
    at = lambda hashes, i: F.xxhash64(*[F.get(hashes, i + j) for j in range(span)])
    # Hashed before they are exploded, so that no row carries the arrays of its whole text.
    hashed = starts.select("doc_id", "th", F.transform("_s", lambda i: F.struct(i.alias("at"), at("_h", i).alias("w1"), at("_h2", i).alias("w2"))).alias("_z"))
    # Outer: else Spark filters on the array's size below, and works all of it out there once for each use.
    return hashed.select("doc_id", "th", F.inline_outer("_z")).where(F.col("at").isNotNull())


def find_overlaps(docs: DataFrame, items: DataFrame, span: int = SPAN, k: int = KGRAM) -> DataFrame:
    """For each row of ``docs``: n_words, n_hit (words inside an occurrence of a benchmark window) and items (sorted ids of the items that occur)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select("doc_id", text.alias("text")).withColumn("th", F.xxhash64("text"))
    items = items.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("string").alias("item_id"), "text")
    items = materialise(with_words(items).drop("text").where(F.size("_w") > 0), "items")
    lengths = [r[0] for r in items.select(F.least(F.size("_w"), F.lit(span)).alias("n")).distinct().collect()]  # at most ``span`` numbers
    words = with_words(docs).drop("text")
    sizes = words.select("doc_id", "th", F.size("_w").cast("long").alias("n_words"))

    found, working = None, [items]
    for n in sorted(lengths):
        these = items.where((F.size("_w") >= span) if n == span else (F.size("_w") == n))
        windows = materialise(_window_hashes(these, n, ["item_id"]).select("item_id", "w1", "w2").distinct(), "windows")
        if n == span:
            marks = materialise(fingerprints(these, [], k, span).distinct(), "fingerprints")
            hit = fingerprints(words, ["doc_id", "th"], k, span).join(small(marks), "fp", "left_semi")
            suspects = materialise(hit.groupBy("doc_id", "th").agg(F.collect_set("fp").alias("fps")), "suspects")
            near = docs.join(small(suspects).select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), "fps"), docs["doc_id"].eqNullSafe(F.col("_d")) & (docs["th"] == F.col("_t"))).drop("_d", "_t")
            # Written first: else the filters on the words move below the join, and all documents are cut into words again.
            texts = materialise(near.dropDuplicates(["doc_id", "th"]), "suspect-texts")
            near = materialise(_word_hashes(with_words(texts), ["doc_id", "th", "fps"]), "suspect-words")
            drop_tables(texts)
            spans = _windows_near(near, span, k)
            working += [marks, suspects, near]
        else:
            spans = _window_hashes(words, n, ["doc_id", "th"])
        spans = spans.join(small(windows).select("w1", "w2").distinct(), ["w1", "w2"], "left_semi").select("doc_id", "th", "at", F.lit(n).alias("n"), "w1", "w2")
        spans = materialise(spans, "spans")
        part = spans.join(small(windows), ["w1", "w2"]).groupBy("doc_id", "th").agg(F.collect_set("item_id").alias("items"))
        cover = spans.groupBy("doc_id", "th").agg(F.collect_set(F.struct("at", "n")).alias("spans"))
        both = cover.join(part, cover["doc_id"].eqNullSafe(part["doc_id"]) & (cover["th"] == part["th"])).select(cover["doc_id"], cover["th"], "spans", "items")
        found = both if found is None else found.unionByName(both)
        working += [windows, spans]
    if found is None:
        return sizes.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"), "th")
    found = found.groupBy("doc_id", "th").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    # Words covered by the sorted spans: each adds what lies beyond the end of those before.
    covered = F.aggregate(
        F.array_sort("spans"),
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("hit")),
        lambda s, x: F.struct(F.greatest(s["end"], x["at"] + x["n"]).alias("end"), (s["hit"] + F.greatest(x["at"] + x["n"] - F.greatest(s["end"], x["at"]), F.lit(0))).alias("hit")),
        lambda s: s["hit"].cast("long"),
    )
    found = materialise(found.select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), covered.alias("n_hit"), "items"), "overlaps")
    drop_tables(*working)
    out = sizes.join(small(found), sizes["doc_id"].eqNullSafe(F.col("_d")) & (sizes["th"] == F.col("_t")), "left")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), "th")


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """At least a twentieth of the words lie in benchmark windows."""
    return (n_hit > 0) & (n_hit * 20 >= n_words)


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without contaminated documents, with its own columns."""
    key, d, t = fresh(docs, "_key", "_d", "_t")
    bad = find_overlaps(docs.select("doc_id", "text"), items).where(contaminated(F.col("n_hit"), F.col("n_words"))).select(F.col("doc_id").alias(d), F.col("th").alias(t))
    bad = small(materialise(bad, "contaminated"))
    keyed = docs.withColumn(key, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    return keyed.join(bad, keyed["doc_id"].eqNullSafe(F.col(d)) & (keyed[key] == F.col(t)), "left_anti").select(*docs.columns)
