"""The feed of deployments as a stream: the two newest deployments of each base are kept, so that the previous one is known as events arrive.

A batch is reduced to its two newest per base before it meets what is kept, by aggregates that combine before the shuffle; so a base with a large
share of all events is no task of its own.  Merging a batch twice changes nothing, which makes a batch that is made again harmless.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from assetweave.operators.store import KeyedStore

RESPONSE = "deltas ARRAY<STRUCT<entityId: STRING, entityType: STRING, localTimestamp: BIGINT, metadata: STRUCT<scene: STRUCT<base: STRING>>>>"
CHANGES = "entity_id string, base string, ts long"
NEWEST = "base string, top struct<ts: bigint, entity_id: string>, second struct<ts: bigint, entity_id: string>"


def changes(responses: DataFrame, entity_type: str = "scene") -> DataFrame:
    """entity_id, base, ts of each delta of the feed's responses; an empty base is none."""
    d = responses.select(F.explode("deltas").alias("d")).where((F.col("d.entityType") == entity_type) & F.col("d.entityId").isNotNull())
    return d.select(F.col("d.entityId").alias("entity_id"), F.nullif(F.col("d.metadata.scene.base"), F.lit("")).alias("base"), F.col("d.localTimestamp").alias("ts"))


def newest_first(rows: DataFrame) -> DataFrame:
    """The feed's order: by time, newest first, and of equal times the larger id first; a delta that came twice is there once."""
    return rows.distinct().orderBy(F.col("ts").desc_nulls_last(), F.col("entity_id").desc(), F.col("base").desc_nulls_last())


def two_newest(rows: DataFrame) -> DataFrame:
    """For each base its newest deployment and the newest one of another entity."""
    rows, newest = rows.where(F.col("base").isNotNull()), F.max(F.struct("ts", "entity_id"))
    top = rows.groupBy("base").agg(newest.alias("top"))
    others = rows.join(top, "base").where(F.col("entity_id") != F.col("top.entity_id"))
    return top.join(others.groupBy("base").agg(newest.alias("second")), "base", "left")


def kept_rows(kept: DataFrame) -> DataFrame:
    """What is kept as rows of deployments again."""
    return kept.select("base", F.explode(F.array_compact(F.array("top", "second"))).alias("d")).select("d.entity_id", "base", "d.ts")


def previous(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """``rows`` with ``previous``: the newest deployment of the same base by another entity, null without one."""
    other = F.when(F.col("top.entity_id") == F.col("entity_id"), F.col("second.entity_id")).otherwise(F.col("top.entity_id"))
    return rows.join(kept, "base", "left").select(*rows.columns, other.alias("previous"))


def newest_store(spark: SparkSession, path: str) -> KeyedStore:
    return KeyedStore(spark, path, NEWEST, "base")


def follow(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Follows the feed (``changes``): what is kept in the store under ``out``/newest, each delta with its previous deployment under ``out``/answered.

    An answer is that of the feed as it is when the delta's batch has come.
    """

    def write(batch: DataFrame, n: int) -> None:
        spark, path = batch.sparkSession, f"{out}/arrived/batch={n}"
        batch.write.mode("overwrite").parquet(path)
        rows, store = spark.read.schema(CHANGES).parquet(path), newest_store(spark, f"{out}/newest")
        # Written: the reduced batch is read twice, and the union below is of tables then, whatever joins and shuffles they came from.
        two_newest(rows).write.mode("overwrite").parquet(f"{out}/reduced/batch={n}")
        new = spark.read.schema(NEWEST).parquet(f"{out}/reduced/batch={n}")
        old = kept_rows(store.read().join(new.select("base"), "base", "left_semi"))
        store.upsert(two_newest(old.unionByName(kept_rows(new))))
        previous(rows, store.read()).write.mode("overwrite").parquet(f"{out}/answered/batch={n}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_changes(spark: SparkSession, deployments: DataFrame, late: Column, at: str) -> DataFrame:
    """Deployments (entity_id, type, base, ts) as a feed that comes in two parts: each with the previous one when it arrived and at the end."""
    of = lambda c: F.col(c).cast("string")
    delta = F.struct(of("entity_id").alias("entityId"), F.col("type").alias("entityType"), F.unix_millis(F.col("ts").cast("timestamp")).alias("localTimestamp"), F.struct(F.struct(of("base").alias("base")).alias("scene")).alias("metadata"))
    for part in (~late, late):
        deployments.where(part).select(F.to_json(F.struct(F.array(delta).alias("deltas"))).alias("value")).repartition(4).write.mode("append").text(f"{at}/feed")
        follow(changes(spark.readStream.schema(RESPONSE).json(f"{at}/feed")), at, f"{at}/checkpoint").awaitTermination()
    answered = spark.read.schema(f"{CHANGES}, previous string").parquet(f"{at}/answered/*").withColumnRenamed("previous", "at_arrival")
    return previous(answered, newest_store(spark, f"{at}/newest").read())
