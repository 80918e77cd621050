"""Existence markers and reference lists with a time to live, as keyed state of a stream."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from assetweave.operators.store import KeyedStore

from .triage import jobs, shared_dir

TTL_MS = 86_400_000
BUCKETS = 2048
STORE = "spark.sql.streaming.stateStore.providerClass"
OUTPUT = "entity_id long, hits long, probes long"
LISTS = "hash string, uris string, error string, hits long, misses long, state_errors long"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """The state store that keyed state with a time to live needs; the session's own setting comes back afterwards."""
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STORE)
        else:
            spark.conf.set(STORE, before)


def markers(stream: DataFrame, ttl_ms: int = TTL_MS) -> DataFrame:
    """A key whose marker is alive is a hit; any other is a probe, which sets the marker.  A hit does not lengthen a marker's life."""

    # Defined here, so that it travels by value: the state driver's worker needs no copy of the package.
    class HitMarkers(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.seen = handle.getValueState("seen", "at long", ttlDurationMs=ttl_ms)

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            n = sum(len(x) for x in rows)
            hit = self.seen.exists()
            if not hit:
                self.seen.update((1,))
            yield pd.DataFrame({"entity_id": [key[0]], "hits": [n if hit else n - 1], "probes": [0 if hit else 1]})

        def close(self) -> None:
            pass

    return stream.groupBy("entity_id").transformWithStateInPandas(statefulProcessor=HitMarkers(), outputStructType=OUTPUT, outputMode="Append", timeMode="ProcessingTime")


def uri_lists(stream: DataFrame, ttl_ms: int = TTL_MS, known: DataFrame | None = None, buckets: int = BUCKETS) -> DataFrame:
    """References of containers (hash, content, ext), kept by hash as long as they live: hash, uris (JSON), error, hits, misses, state_errors.

    A hash that isn't there is a miss and is parsed; what can't be parsed is not kept, so it is a miss each time.  A kept value that is no list
    of texts counts as a miss and as a state error, and so does one that can't be read.  ``known`` (hash, uris) is what a new stream starts with.
    Hashes share ``buckets`` keys of state, whose entries live and end one by one: asking the state, and making a frame, for each hash takes longer than parsing it.
    A checkpoint keeps to its number of buckets.
    """

    class UriLists(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.kept = handle.getListState("uris", "hash string, uris string", ttlDurationMs=ttl_ms)

        def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
            self.kept.appendList([(e["hash"], e["uris"]) for entries in initialState["entries"] for e in entries])

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            import json

            from assetweave.sources.gltf import refs_of

            try:
                held, unread = dict(self.kept.get()), 0  # of equal hashes the last
            except Exception:
                held, unread = {}, 1
            found, new = {}, []
            for name, content, ext in (r for part in rows for r in zip(part["hash"], part["content"], part["ext"])):
                if name not in found:
                    text, wrong = held.get(name), unread
                    try:
                        if text is not None and not (isinstance(x := json.loads(text), list) and all(isinstance(u, str) for u in x)):
                            raise ValueError(text)
                    except Exception:
                        text, wrong = None, 1
                    found[name] = {"uris": text, "error": None, "hits": 0, "misses": 0, "state_errors": wrong}
                one = found[name]
                if one["uris"] is not None:
                    one["hits"] += 1
                    continue
                one["misses"] += 1
                refs = refs_of(content, ext)
                one["error"] = refs["error"]
                if refs["error"] is None:
                    one["uris"] = json.dumps(refs["uris"], ensure_ascii=False)
                    new.append((name, one["uris"]))
            try:
                if new:
                    self.kept.appendList(new)
            except Exception:
                for name, _ in new:
                    found[name]["state_errors"] += 1
            yield pd.DataFrame([{"hash": name} | one for name, one in found.items()])

        def close(self) -> None:
            pass

    bucket = F.pmod(F.xxhash64("hash"), F.lit(buckets)).alias("bucket")
    start = None if known is None else known.groupBy(bucket).agg(F.collect_list(F.struct("hash", "uris")).alias("entries")).groupBy("bucket")
    grouped = stream.select(bucket, "hash", "content", "ext").groupBy("bucket")
    return grouped.transformWithStateInPandas(statefulProcessor=UriLists(), outputStructType=LISTS, outputMode="Append", timeMode="ProcessingTime", initialState=start)


def uri_store(spark: SparkSession, path: str) -> KeyedStore:
    """Where a stream writes its lists through, so that another one starts with them."""
    return KeyedStore(spark, path, "hash string, uris string", "hash")


def serve_uris(stream: DataFrame, out: str, checkpoint: str, ttl_ms: int = TTL_MS) -> StreamingQuery:
    """The stream's results under ``out``/served, by batch; lists that were parsed go through to the store under ``out``/store."""
    spark = stream.sparkSession
    store = uri_store(spark, f"{out}/store")
    # A checkpoint has its own state; a new one starts with what the store holds.
    lists = uri_lists(stream, ttl_ms, spark.read.schema(store.schema).parquet(*paths) if (paths := store.files()) else None)

    def write(batch: DataFrame, n: int) -> None:
        path = f"{out}/served/batch={n}"
        batch.write.mode("overwrite").parquet(path)
        new = batch.sparkSession.read.parquet(path).where("misses > 0 and uris is not null")
        if not new.isEmpty():
            uri_store(batch.sparkSession, f"{out}/store").upsert(new)

    return lists.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(once=True).start()


def served(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(LISTS).parquet(f"{out}/served/*")


def run_lists(spark: SparkSession, containers: DataFrame, parts: int = 2) -> DataFrame:
    """Containers (hash, content, ext) that arrive in some parts: how often each was known, and how often it had to be parsed."""
    at = shared_dir(spark)
    with rocksdb(spark):
        for k in range(parts):
            containers.where(F.pmod(F.col("n"), F.lit(parts)) == k).select("hash", "content", "ext").write.mode("append").parquet(f"{at}/in")
            stream = spark.readStream.schema("hash string, content binary, ext string").parquet(f"{at}/in")
            serve_uris(stream, at, f"{at}/checkpoint").awaitTermination()
    return served(spark, at).groupBy("hash").agg(F.sum("hits").alias("hits"), F.sum("misses").alias("misses"), F.max("uris").alias("uris"), F.max("error").alias("error"))


def run_once(v) -> DataFrame:
    """For every entity of the job stream: how often its marker was alive, and how often the store had to be asked."""
    spark = v.spark
    at = shared_dir(spark)
    rows = v.v_jobs.withColumn("ts", F.col("ts").cast("timestamp"))
    # The jobs arrive in two parts, so that the second meets markers of the first.  State with a time to live always asks for
    # another batch, so a run over what is available has to be a single one.
    with rocksdb(spark):
        even = F.coalesce(F.col("job_id") % 2 == 0, F.lit(False))
        for part in (even, ~even):
            rows.where(part).repartition(4).write.mode("append").parquet(f"{at}/jobs")
            out = markers(jobs(spark, f"{at}/jobs")).writeStream.format("parquet").option("path", f"{at}/out")
            out.option("checkpointLocation", f"{at}/checkpoint").trigger(once=True).start().awaitTermination()
    return spark.read.parquet(f"{at}/out").groupBy("entity_id").agg(F.sum("hits").alias("hits"), F.sum("probes").alias("probes"))
