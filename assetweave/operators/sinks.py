"""Sinks: upserts by key, missing-only appends, ordered publication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetweave.functions import names as N

from .store import manifest_store

VARIANTS = ("", ".br")


def latest_by_key(old: DataFrame | None, new: DataFrame, key: str) -> DataFrame:
    """``new`` rows replace ``old`` rows of the same key."""
    return new if old is None else old.join(new.select(key), key, "left_anti").unionByName(new)


def write_manifests(df: DataFrame, path: str, order: str | None = None) -> int:
    """Manifests (entity_id, target and the manifest's fields) into the store under ``path``: each replaces the one of its entity and target only.

    Null fields stay in the JSON; of several of one entity and target the last by ``order`` wins.  Returns the commit's number.
    """
    fields = [c for c in df.columns if c not in ("entity_id", "target", order)]
    body = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    rows = df.select(N.manifest_key(F.col("entity_id").cast("string"), F.col("target")).alias("key"), body.alias("body"), *([order] if order else []))
    return manifest_store(df.sparkSession, path).upsert(rows, order)


def missing_only(files: DataFrame, there: DataFrame, key: str, force: bool = False) -> DataFrame:
    """What has to be uploaded: each file raw and compressed, with its content type.

    A bundle's manifest always is, any other file unless its key is there already; all with ``force``.
    """
    manifest = F.col(key).endswith(".manifest")
    kind = F.when(manifest, "text/cache-manifest").otherwise("application/wasm")
    both = files.withColumn("content_type", kind).withColumn("_always", manifest | F.lit(force)).withColumn("variant", F.explode(F.array(*map(F.lit, VARIANTS)))).withColumn(key, F.concat(F.col(key), F.col("variant")))
    known = there.select(key).distinct().withColumn("_there", F.lit(True))
    return both.join(known, key, "left").where(F.col("_always") | F.col("_there").isNull()).drop("_always", "_there")


def lod_uploads(files: DataFrame, there: DataFrame, key: str) -> DataFrame:
    """Level-of-detail files under LOD/<level>/, raw and compressed: one rule for all, of one type, and what is there is left out."""
    placed = files.withColumn("variant", F.explode(F.array(*map(F.lit, VARIANTS)))).withColumn(key, F.concat(F.lit("LOD/"), F.col("level").cast("string"), F.lit("/"), F.col(key), F.col("variant")))
    return placed.withColumn("content_type", F.lit("application/wasm")).join(there.select(key).distinct(), key, "left_anti")


def failed_sentinels(failures: DataFrame) -> DataFrame:
    """(key, body) of the mark that a failed conversion leaves: entity_id, target, server, version, error or log, date; missing fields are left out."""
    body = F.to_json(F.struct(F.col("entity_id").cast("string").alias("entityId"), F.col("server").alias("contentServerUrl"), "version", "error", "log", "date"))
    key = F.concat(F.lit("manifest/"), F.col("entity_id").cast("string"), F.coalesce(F.concat(F.lit("_"), F.col("target")), F.lit("")), F.lit("_failed.json"))
    return failures.select(key.alias("key"), body.alias("body"))


def queue_messages(jobs: DataFrame, job: Column, prioritize: Column, queue: str, priority_queue: str | None = None) -> DataFrame:
    """(queue, body) of jobs: the job as JSON inside a JSON envelope; the priority lane only if there is one."""
    lane = F.when(F.coalesce(prioritize, F.lit(False)) & F.lit(bool(priority_queue)), F.lit(priority_queue)).otherwise(F.lit(queue))
    return jobs.select(lane.alias("queue"), F.to_json(F.struct(F.to_json(job).alias("Message"))).alias("body"))


def scene_sources(content: DataFrame, mains: DataFrame) -> DataFrame:
    """The up to three source files of each scene: main.crdt, scene.json and its main script (first match each)."""
    wanted = mains.select("entity_id", F.explode(F.array_compact(F.array(F.lit("main.crdt"), F.lit("scene.json"), F.col("main")))).alias("file")).distinct()
    return content.join(wanted, ["entity_id", "file"]).groupBy("entity_id", "file").agg(F.min_by("hash", "pos").alias("hash"))


def copies(plan: DataFrame, version: str) -> DataFrame:
    """Source key (encoded, but for '/') to target key of a server-side copy, for rows that were decided to be copied; a ``variant`` column is kept at the end of the name."""
    name = F.concat(F.col("target_name"), F.coalesce("variant", F.lit(""))) if "variant" in plan.columns else F.col("target_name")
    return plan.where(F.col("action") == "copied").select(N.url_encoded_key(F.col("source_key")).alias("source_key"), N.canonical_key(F.lit(version), name).alias("target_key"))


def publish(contents: DataFrame, manifests: DataFrame, path: str, batch: int) -> None:
    """Contents first, manifests last: a reader that sees a manifest finds all that it names.  A batch that is tried again replaces itself."""
    for name, df in (("contents", contents), ("manifests", manifests)):
        df.write.mode("overwrite").parquet(f"{path}/{name}/batch={batch}")
