"""Line dedup over levelled sorted runs of line hashes.

The index is a list of levels; a level holds sorted runs of 128-bit line hashes, each a bucketed and sorted table.  A new
batch of documents is reduced to its distinct line hashes, merge-anti-joined with every run (sorted buckets
meet without a shuffle of the runs), and what is new becomes a run of level 0.  A level that has ``fanout`` runs is compacted
into one run of the next.

Rule: a line's key is the line stripped of white space with A-Z lower-cased.  A key of at least ``min_chars``
code points that occurs in two documents keeps its lines in the first document only: first by batch, then by doc_id.

Defined results: null and empty texts are one empty line; very long texts and lines are taken whole; a null ``doc_id`` comes
after all others, so it never owns a shared line that another document has; rows that repeat a ``doc_id`` are one document (their shared
lines stay in each of them); a line that repeats inside its owner stays there every time; an empty table gives an empty table; other
columns are kept as they are, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, discard, fresh, materialise, new_path

SPACE = " \t\n\x0b\f\r"
LAST = (1 << 63) - 1
KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """A row for each line that counts: the document, the line's place and its 128-bit key."""
    one = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"),
        F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("pos", "line"),
    )
    key = one.select("doc", "th", "pos", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= min_chars)
    return key.select("doc", "th", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), F.col("key")).alias("h2"))


class LineRuns:
    """The index; lives in the shared folder, in tables of this session's catalog."""

    def __init__(self, spark: SparkSession, fanout: int = 4, min_chars: int = 10):
        self.spark, self.fanout, self.min_chars = spark, fanout, min_chars
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[str, str]]] = [[]]

    def _save(self, df: DataFrame) -> tuple[str, str]:
        name, path = f"line_run_{uuid.uuid4().hex}", new_path(self.spark, "line-run")
        df.write.format("parquet").option("path", path).option("compression", "zstd").bucketBy(self.buckets, *KEY).sortBy(*KEY).saveAsTable(name)
        return name, path

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name).where("fresh").select(*KEY) for level in self.levels for name, _ in level]

    def add(self, docs: DataFrame) -> DataFrame:
        """Add a batch; returns (doc, th, dropped: places of the lines that go) for its documents that lose lines."""
        lines = _lines(docs, self.min_chars)
        keys = lines.groupBy(*KEY).agg(F.min("doc").alias("owner"), F.max("doc").alias("latest"))
        known = F.lit(False)
        for i, run in enumerate(self.runs()):
            keys = keys.join(run.withColumn(f"in{i}", F.lit(True)).hint("merge"), KEY, "left")
            known = known | F.col(f"in{i}").isNotNull()
        merged = keys.select(*KEY, (~known).alias("fresh"), F.when(~known, F.col("owner")).alias("owner"), (known | (F.col("owner") < F.col("latest"))).alias("shared"))
        name, path = self._save(merged)
        self.levels[0].append((name, path))
        owners = self.spark.read.schema(merged.schema).parquet(path).where("shared").select(*KEY, "owner")
        gone = lines.join(owners, KEY).where(F.col("owner").isNull() | (F.col("doc") != F.col("owner")))
        out = materialise(gone.groupBy("doc", "th").agg(F.collect_set("pos").alias("dropped")), "line-drops")
        self._compact()
        return out

    def _compact(self) -> None:
        k = 0
        while k < len(self.levels):
            if len(self.levels[k]) >= self.fanout:
                tables = [self.spark.table(name).where("fresh") for name, _ in self.levels[k]]
                df = tables[0]
                for t in tables[1:]:
                    df = df.union(t)
                run = self._save(df.repartition(self.buckets, *KEY))
                for name, path in self.levels[k]:
                    self.spark.sql(f"DROP TABLE {name}")
                    discard(self.spark, path)
                self.levels[k] = []
                if k + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[k + 1].append(run)
            k += 1

    def close(self) -> None:
        for level in self.levels:
            for name, path in level:
                self.spark.sql(f"DROP TABLE {name}")
                discard(self.spark, path)
        self.levels = [[]]


def in_batches(docs: DataFrame, batches: int) -> list[DataFrame]:
    """``docs`` cut into ranges of doc_id of about equal numbers of rows, in order."""
    cuts = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), [i / batches for i in range(1, batches)], 1000)).first()[0] or []
    cuts = sorted(set(cuts))
    d = F.col("doc_id").cast("long")
    if not cuts:
        return [docs]
    parts = [docs.where(d <= cuts[0])] + [docs.where((d > a) & (d <= b)) for a, b in zip(cuts, cuts[1:])]
    return parts + [docs.where((d > cuts[-1]) | d.isNull())]


def dedup_lines(docs: DataFrame, min_chars: int = 10, batches: int = 3, fanout: int = 2) -> DataFrame:
    """``docs`` with columns line_total, line_dropped and line_kept (the text without its dropped lines)."""
    index = LineRuns(docs.sparkSession, fanout, min_chars)
    drops = None
    try:
        for part in in_batches(docs, batches):
            d = index.add(part)
            drops = d if drops is None else drops.unionByName(d)
    finally:
        index.close()
    doc, th, dropped, lines = (fresh(docs, "_doc", "_th", "_dropped", "_lines"))
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.withColumn(doc, F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))).withColumn(th, F.xxhash64(text))
    drops = drops.select(F.col("doc").alias(doc), F.col("th").alias(th), F.col("dropped").alias(dropped))
    # Merged at every size: the drops grow with the documents and their lists have no bound, so no estimate may broadcast them.
    both = keyed.join(drops.hint("merge"), [doc, th], "left").withColumn(lines, F.split(text, "\n", -1))
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(dropped))
    kept = F.when(F.col(dropped).isNull(), text).otherwise(F.array_join(F.transform(F.array_sort(places), lambda i: F.get(F.col(lines), i)), "\n"))
    return both.select(
        *[F.col(c) for c in docs.columns],
        F.size(lines).cast("long").alias("line_total"),
        F.coalesce(F.size(dropped), F.lit(0)).cast("long").alias("line_dropped"),
        kept.alias("line_kept"),
    )


def drop_repeated_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """``docs`` with its own columns, ``text`` without repeated lines and ``n_chars`` counted again."""
    (total, gone, kept), own = fresh(docs, "line_total", "line_dropped", "line_kept"), docs.columns
    out = dedup_lines(docs, min_chars).toDF(*own, total, gone, kept)
    new = {"text": F.col(kept), "n_chars": F.char_length(kept).cast("long")}
    return out.select(*[new.get(c, F.col(c)).alias(c) for c in own])
