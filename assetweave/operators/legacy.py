"""Reuse of a scene's previous deployment: the gate, the comparison, and copies in order that stop at the first failure."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assetweave.functions import names as N

from .assets import hashes_in_manifest


def attempted_copies(files: DataFrame, stored: DataFrame) -> DataFrame:
    """``files`` (entity_id, pos, name) up to and with the first of each entity that ``stored`` (entity_id, name) lacks, in order of ``pos``; ``ok``: it is there."""
    there = stored.select("entity_id", "name").distinct().withColumn("_there", F.lit(True))
    w = Window.partitionBy("entity_id")
    marked = files.join(there, ["entity_id", "name"], "left").withColumn("ok", F.col("_there").isNotNull()).drop("_there")
    first = F.min(F.when(~F.col("ok"), F.col("pos"))).over(w)
    return marked.withColumn("_first", first).where(F.col("_first").isNull() | (F.col("pos") <= F.col("_first"))).drop("_first")


def reuse_previous(entities: DataFrame, content: DataFrame, manifest_names: DataFrame, stored: DataFrame, target: str, version: str) -> tuple[DataFrame, DataFrame]:
    """For each entity what came of reusing its previous deployment, and the files that are copied.

    ``entities``: entity_id, kind, force, iss, reuse (the newer way is on), previous (its entity, or null) and previous_version (null: it has no
    manifest).  ``content``: entity_id, pos, file, hash; ``manifest_names`` and ``stored``: entity_id, name: what the previous deployment's
    manifest lists and what can be fetched of it.  First: entity_id, outcome (not-asked, no-previous, no-manifest, other-version,
    content-changed, copy-failed, copied) and attempted.  Second: entity_id, name; copies of an entity whose copying failed are staged only
    and thrown away, so either all of an entity's files are there or none.
    """
    no = F.lit(False)
    asked = ~F.coalesce("force", no) & ~F.coalesce("iss", no) & ~F.coalesce("reuse", no) & F.coalesce(F.col("kind") == "scene", no)
    early = F.when(~asked, "not-asked").when(F.col("previous").isNull(), "no-previous").when(F.col("previous_version").isNull(), "no-manifest").when(F.col("previous_version") != version, "other-version")
    gated = entities.select("entity_id", early.alias("early"))
    open_ = gated.where(F.col("early").isNull()).select("entity_id")
    held = open_.join(content.select("entity_id", "pos", "file", "hash"), "entity_id", "left")
    same = hashes_in_manifest(manifest_names.join(open_, "entity_id", "left_semi"), held, ["entity_id"])
    files = held.where(N.has_valid_extension(F.col("file"))).join(same.where("unchanged"), "entity_id", "left_semi")
    tried = attempted_copies(files.select("entity_id", "pos", F.concat("hash", F.lit(f"_{target}")).alias("name")), stored)
    ended = tried.groupBy("entity_id").agg(F.count("*").alias("attempted"), F.bool_and("ok").alias("whole"))
    judged = gated.join(same, "entity_id", "left").join(ended, "entity_id", "left")
    outcome = F.coalesce("early", F.when(~F.col("unchanged"), "content-changed").when(F.coalesce("whole", F.lit(True)), "copied").otherwise("copy-failed"))
    outcomes = judged.select("entity_id", outcome.alias("outcome"), F.coalesce("attempted", F.lit(0)).alias("attempted"))
    copied = tried.join(ended.where("whole"), "entity_id", "left_semi").select("entity_id", "name")
    return outcomes, copied
