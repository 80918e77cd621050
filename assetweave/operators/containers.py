"""From container bytes to digests: references of parsed containers, resolved against every entity that holds them.

A container's references depend on its bytes only, so each content is parsed once; what they mean depends on the entity and on the
container's path there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetweave.functions import names as N
from assetweave.sources.gltf import resolve_uri

from .assets import last_wins


def references(content: DataFrame, parsed: DataFrame) -> DataFrame:
    """A row for each reference of each container of an entity, in their order; a container without any has one row with a null uri.

    ``content``: entity_id, pos, file, hash; ``parsed``: hash, uris, error (of ``parse_once``).  Columns: entity_id, pos, file, hash, error,
    n, uri, resolved, broken (code of the rule that the reference breaks).
    """
    containers = content.where(N.is_gltf(F.col("file"))).select("entity_id", "pos", "file", "hash")
    # What a reference means depends on the container's bytes and path, which many entities share: it is worked out once for both.
    paths = containers.select("hash", "file").distinct().join(parsed.select("hash", "uris", "error"), "hash", "left")
    error = F.when(F.col("uris").isNull() & F.col("error").isNull(), "unread").otherwise(F.col("error"))
    refs = F.transform("uris", lambda uri: F.struct(uri.alias("uri"), resolve_uri(uri, F.col("file")).alias("target")))
    known = paths.select("hash", "file", error.alias("error"), refs.alias("refs"))
    rows = containers.join(known, ["hash", "file"]).select("entity_id", "pos", "file", "hash", "error", F.posexplode_outer("refs").alias("n", "ref"))
    return rows.select("entity_id", "pos", "file", "hash", "error", "n", F.col("ref.uri").alias("uri"), F.col("ref.target.resolved").alias("resolved"), F.col("ref.target.error").alias("broken"))


def resolved_references(refs: DataFrame, content: DataFrame) -> DataFrame:
    """``refs`` with ``dep``, the hash that the entity has at the resolved path, letter case aside; of equal paths the last wins."""
    # Hardly any paths of an entity are equal, so combining them before the shuffle would only sort all of them twice.
    keyed = content.select("entity_id", F.lower("file").alias("key"), "pos", "hash").repartition("entity_id", "key")
    table = last_wins(keyed, ["entity_id", "key"], F.col("pos"), "hash").withColumnRenamed("hash", "dep")
    return refs.withColumn("key", F.lower("resolved")).join(table, ["entity_id", "key"], "left").drop("key")


def container_digests(content: DataFrame, parsed: DataFrame) -> DataFrame:
    """For each entity and container hash: digest (null if it is skipped), skipped, and the skip's file, reason and detail.

    A container is skipped as ``unparseable`` (its bytes, or a reference, break a rule) or for ``missing-deps`` (a reference names nothing of the
    entity); the first reference in order decides.  A hash that is there under several paths has the digest and the skip of the last of
    them that has one.  Containers that were not read are ``unread``; reading them again may help.
    """
    found = resolved_references(references(content, parsed), content)
    named, empty = F.col("uri").isNotNull(), F.coalesce("dep", F.lit("")) == ""
    quoted = F.concat(F.lit('"'), F.col("uri"), F.lit('"'))
    because = lambda n, reason, detail: F.struct(n.alias("n"), F.lit(reason).alias("reason"), detail.alias("detail"))
    whole, n = F.lit(-1), F.col("n")
    fault = (
        F.when(F.col("error") == "unread", because(whole, "unread", F.lit("")))
        .when(F.col("error").isNotNull(), because(whole, "unparseable", F.col("error")))
        .when(F.col("broken").isNotNull(), because(n, "unparseable", F.concat("broken", F.lit(": "), quoted)))
        .when(named & empty, because(n, "missing-deps", F.concat(quoted, F.lit(' -> "'), "resolved", F.lit('"'))))
    )
    pair = F.when(named & ~empty & N.is_dependency(F.col("resolved")), F.struct(F.col("resolved").alias("file"), F.col("dep").alias("hash")))
    # One shuffle for both groupings, which have these keys in common.
    found = found.repartition("entity_id", "hash")
    each = found.groupBy("entity_id", "pos", "file", "hash").agg(F.min(fault).alias("fault"), F.collect_set(pair).alias("pairs"))
    each = each.withColumn("digest", F.when(F.col("fault").isNull(), N.json_digest(F.col("pairs"))))
    good, bad = F.when(F.col("fault").isNull(), F.col("pos")), F.when(F.col("fault").isNotNull(), F.col("pos"))
    last = each.groupBy("entity_id", "hash").agg(F.max_by("digest", good).alias("digest"), F.max_by(F.struct("file", "fault.reason", N.skip_detail(F.col("fault.detail")).alias("detail")), bad).alias("skip"))
    return last.select("entity_id", "hash", "digest", F.col("skip").isNotNull().alias("skipped"), F.col("skip.file").alias("file"), F.col("skip.reason").alias("reason"), F.col("skip.detail").alias("detail"))


def metadata_only(content: DataFrame, thumbnails: DataFrame) -> DataFrame:
    """(entity_id, hash, by_metadata, by_name) of files that are read as raw bytes only: thumbnails by their name, and the file that the entity's
    metadata names (``thumbnails``: entity_id, thumb), letter case aside; of equal paths the last wins."""
    thumbs = thumbnails.where(F.col("thumb").isNotNull()).select("entity_id", F.lower("thumb").alias("key"))
    # Only the files that a thumbnail names compete for its path.
    asked = content.select("entity_id", F.lower("file").alias("key"), "pos", "hash").join(thumbs, ["entity_id", "key"], "left_semi")
    named = last_wins(asked, ["entity_id", "key"], F.col("pos"), "hash")
    by_name = content.where(N.is_metadata_only(F.col("file")))
    rows = named.select("entity_id", "hash", F.lit(True).alias("m"), F.lit(False).alias("f")).unionByName(by_name.select("entity_id", "hash", F.lit(False).alias("m"), F.lit(True).alias("f")))
    return rows.groupBy("entity_id", "hash").agg(F.bool_or("m").alias("by_metadata"), F.bool_or("f").alias("by_name"))
