"""A table of rows by key with upserts: buckets of Parquet, and numbered commits that say which version of each bucket holds.

An upsert rewrites only the buckets that its keys fall into; the new files are there before a commit names them, so a reader sees
the table before or after it and never less.  A commit is a file that is renamed to the next number, which fails if that is there: of
two writers that read the same state one starts again from the other's commit.  (Where a file system renames in one step, as HDFS does.)
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Conflict(Exception):
    """Another writer has committed the number that this one meant to."""


class KeyedStore:
    """Rows of ``schema`` under ``path``, at most one for each value of ``key``."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self.schema = spark.createDataFrame([], schema).schema
        self.fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _state(self) -> tuple[int, dict[str, str]]:
        """The newest commit's number and its version of each bucket."""
        folder = self._path("commits")
        if not self.fs.exists(folder):
            return 0, {}
        numbers = [int(n) for s in self.fs.listStatus(folder) if (n := s.getPath().getName().removesuffix(".json")).isdigit()]
        return (max(numbers), self._read(max(numbers))) if numbers else (0, {})

    def _read(self, number: int) -> dict[str, str]:
        stream = self.fs.open(self._path(f"commits/{number:012d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, number: int, state: dict[str, str]) -> None:
        work, name = self._path(f"commits/.{uuid.uuid4().hex}"), self._path(f"commits/{number:012d}.json")
        stream = self.fs.create(work, False)
        stream.write(bytearray(json.dumps(state).encode()))
        stream.close()
        jvm = self.spark._jvm
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.spark._jsc.hadoopConfiguration())
        never_over = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        never_over[0] = getattr(jvm.org.apache.hadoop.fs.Options.Rename, "NONE")
        try:
            files.rename(work, name, never_over)
        except Exception as e:
            self.fs.delete(work, False)
            raise Conflict(number) from e

    def _rows(self, state: dict[str, str], buckets: list[str] | None = None) -> DataFrame:
        paths = [f"{self.path}/data/{v}/bucket={b}" for b, v in state.items() if buckets is None or b in buckets]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def files(self) -> list[str]:
        """The folders that hold the newest commit's rows."""
        return [f"{self.path}/data/{v}/bucket={b}" for b, v in self._state()[1].items()]

    def read(self) -> DataFrame:
        return self._rows(self._state()[1])

    def upsert(self, rows: DataFrame, order: str | None = None, attempts: int = 5) -> int:
        """Put ``rows`` in the place of those with equal keys; of equal keys in ``rows`` the last by ``order`` wins.  Returns the commit's number."""
        names = self.schema.names
        bucket = F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int")
        new = rows.select(*names, *([order] if order and order not in names else []))
        by = F.col(order) if order else F.xxhash64(*names)
        new = new.groupBy(self.key).agg(*[F.max_by(n, by).alias(n) for n in names if n != self.key]).select(*names).withColumn("bucket", bucket)
        at = f"{self.path}/new/{uuid.uuid4().hex}"
        new.write.parquet(at)  # once, whatever follows
        new = self.spark.read.parquet(at)
        touched = [str(r[0]) for r in new.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
        try:
            for _ in range(attempts):
                number, state = self._state()
                old = self._rows(state, touched)
                kept = old.join(new.select(self.key), self.key, "left_anti").select(*names)
                version = uuid.uuid4().hex
                merged = kept.withColumn("bucket", bucket).unionByName(new)
                merged.repartition(max(len(touched), 1), "bucket").write.partitionBy("bucket").parquet(f"{self.path}/data/{version}")
                try:
                    self._commit(number + 1, state | dict.fromkeys(touched, version))
                    return number + 1
                except Conflict:
                    self.fs.delete(self._path(f"data/{version}"), True)
            raise Conflict(f"gave up after {attempts} attempts")
        finally:
            self.fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(at), True)

    def vacuum(self, keep: int = 2) -> None:
        """Delete versions that none of the last ``keep`` commits names; readers of older ones have to be done."""
        number, _ = self._state()
        live = {v for n in range(max(1, number - keep + 1), number + 1) for v in self._read(n).values()}
        if self.fs.exists(self._path("data")):
            for s in self.fs.listStatus(self._path("data")):
                if s.getPath().getName() not in live:
                    self.fs.delete(s.getPath(), True)


def manifest_store(spark: SparkSession, path: str, buckets: int = 64) -> KeyedStore:
    """Manifests by their key, as JSON text."""
    return KeyedStore(spark, path, "key string, body string", "key", buckets)
