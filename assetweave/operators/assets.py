"""Content, digests, probes, manifests and bundles.

Every operator takes and gives DataFrames.  Sets that the inputs bound nowhere (inventories, manifests) are joined, never collected;
dedup rules with a winner are aggregates (min_by, max_by), so they combine before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assetweave.functions import names as N


def flatten_content(entities: DataFrame) -> DataFrame:
    """A row for each content entry: entity_id, pos, file, hash."""
    return entities.select(F.col("id").alias("entity_id"), F.posexplode("content").alias("pos", "entry")).select("entity_id", "pos", "entry.file", "entry.hash")


def flatten_wearables(collection: DataFrame, column: str) -> DataFrame:
    """Three levels of nesting flattened; entries without an address go; the hash is the address's last part."""
    one = collection.select(F.explode(column).alias("w"))
    two = one.select(F.col("w.id").alias("id"), F.explode("w.representations").alias("r"))
    three = two.select("id", F.explode("r.contents").alias("c")).select("id", "c.file", "c.url")
    return three.where(F.coalesce("url", F.lit("")) != "").withColumn("hash", F.element_at(F.split("url", "/"), -1))


def first_wins(df: DataFrame, keys: list[str], order: Column, *values: str) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.min_by(v, order).alias(v) for v in values])


def last_wins(df: DataFrame, keys: list[str], order: Column, *values: str) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.max_by(v, order).alias(v) for v in values])


def set_digest(content: DataFrame, keys: list[str]) -> DataFrame:
    """The digest of each group's dependency files; an empty set has the digest of []."""
    pair = F.when(N.is_dependency(F.col("file")), F.struct("file", "hash"))
    return content.groupBy(*keys).agg(N.json_digest(F.collect_list(pair)).alias("digest"))


def probe_rows(content: DataFrame, order: Column, digests: DataFrame, version: str, target: str, metadata_only: DataFrame | None = None) -> DataFrame:
    """What is probed of each entity, each hash once (the first wins): file, digest, skippable, canonical and object_key.

    ``digests``: entity_id, hash, digest of glTF files; one without a digest is broken and isn't probed.  A hash that any file uses as
    metadata only is not probed either: by its name, or because ``metadata_only`` (entity_id, hash) has it.
    """
    if metadata_only is not None:
        content = content.join(metadata_only.select("entity_id", "hash"), ["entity_id", "hash"], "left_anti")
    gltf = N.is_gltf(F.col("file"))
    rows = content.join(digests.select("entity_id", "hash", "digest"), ["entity_id", "hash"], "left")
    probed = N.is_probed(F.col("file")) & (~gltf | F.col("digest").isNotNull())
    entry = F.struct(F.col("file"), F.col("digest"))
    once = rows.groupBy("entity_id", "hash").agg(F.min_by(F.when(probed, entry), F.when(probed, order)).alias("entry"), F.bool_or(N.is_metadata_only(F.col("file"))).alias("meta"))
    once = once.where(F.col("entry").isNotNull() & ~F.col("meta")).select("entity_id", "hash", "entry.file", "entry.digest")
    named = once.withColumn("skippable", N.is_skippable(F.col("file"))).withColumn("canonical", N.canonical_name(F.col("hash"), F.col("file"), F.col("digest"), F.lit(target)))
    return named.withColumn("object_key", N.canonical_key(F.lit(version), F.col("canonical")))


def probe(rows: DataFrame, inventory: DataFrame, cache: DataFrame | None = None, key: str = "hash") -> DataFrame:
    """``rows`` with cache_hit, in_store and cached; the store is asked only for what the cache misses."""
    have = inventory.select(key).distinct().withColumn("in_store", F.lit(True))
    out = rows
    if cache is not None:
        out = out.join(cache.select(key).distinct().withColumn("cache_hit", F.lit(True)), key, "left")
    else:
        out = out.withColumn("cache_hit", F.lit(None).cast("boolean"))
    out = out.join(have, key, "left")
    hit = F.coalesce("cache_hit", F.lit(False))
    return out.withColumn("cache_hit", hit).withColumn("in_store", ~hit & F.coalesce("in_store", F.lit(False))).withColumn("cached", F.col("cache_hit") | F.col("in_store"))


def probe_summary(probed: DataFrame) -> DataFrame:
    """For each entity: probes, cached, missing, skippable and cached, store requests, and whether all is there."""
    n = F.count("*")
    return probed.groupBy("entity_id").agg(
        n.alias("probes"),
        F.count_if("cached").alias("n_cached"),
        F.count_if(~F.col("cached")).alias("n_missing"),
        F.count_if(F.col("cached") & F.col("skippable")).alias("n_skippable"),
        (n - F.count_if("cache_hit")).alias("n_head"),
    ).withColumn("full_hit", (F.col("probes") > 0) & (F.col("n_missing") == 0))


def drop_set(skipped: DataFrame, metadata_only: DataFrame, keys: list[str]) -> DataFrame:
    return skipped.select(*keys).union(metadata_only.select(*keys)).distinct()


def engine_input(content: DataFrame, dropped: DataFrame, cached: DataFrame, keys: list[str]) -> DataFrame:
    """What the converter has to load: not dropped, and not cached unless it is a texture."""
    left = content.join(dropped, keys, "left_anti")
    return left.join(cached.select(*keys).distinct().withColumn("_c", F.lit(True)), keys, "left").where(F.col("_c").isNull() | (N.extension_class(F.col("file")) == "texture")).drop("_c")


def merge_manifest(built: DataFrame, cached: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Built names, then cached names that are not among them."""
    more = cached.select(*keys, name).distinct().join(built.select(*keys, name).distinct(), [*keys, name], "left_anti")
    return built.select(*keys, name, F.lit("built").alias("origin")).union(more.select(*keys, name, F.lit("cached").alias("origin")))


def purge(built: DataFrame, cached: DataFrame, name: str, hash_: str = "hash") -> DataFrame:
    """Built files that the cache already has: by their leading hash, or by their name if they have none."""
    key = F.coalesce(N.leading_hash(F.col(name)), F.col(name))
    return built.withColumn("_k", key).join(cached.select(F.col(hash_).alias("_k")).distinct(), "_k", "left_semi").drop("_k")


def already_converted(manifests: DataFrame, version: str) -> DataFrame:
    """Lenient: a missing exit code counts as success."""
    return manifests.where((F.coalesce("exit_code", F.lit(0)) == 0) & (F.col("version") == version))


def migratable(manifests: DataFrame, version: str) -> DataFrame:
    """Strict: a missing exit code doesn't."""
    return manifests.where((F.col("exit_code") == 0) & (F.col("version") == version))


def hashes_in_manifest(manifest_files: DataFrame, content: DataFrame, keys: list[str]) -> DataFrame:
    """Whether each hash of an entity's files (of a known extension) begins some name of its manifest; true for an entity without any.

    ``content``: keys, file, hash; a row with a null file only names the entity.  Most hashes are the part before the first '_' of a
    name, which is an equal join; only the others are compared by prefix, within their own entity.
    """
    wanted = content.where(N.has_valid_extension(F.col("file"))).select(*keys, "hash").distinct()
    listed = manifest_files.select(*keys, "name")
    rest = wanted.join(listed.select(*keys, N.leading_hash(F.col("name")).alias("hash")), [*keys, "hash"], "left_anti")
    a, b = rest.alias("a"), listed.alias("b")
    same = F.col("b.name").startswith(F.col("a.hash"))
    for k in keys:
        same = same & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    lost = a.join(b, same, "left_anti").select(*keys).distinct().withColumn("_lost", F.lit(True))
    return content.select(*keys).distinct().join(lost, keys, "left").select(*keys, F.col("_lost").isNull().alias("unchanged"))


def can_copy_previous(previous_files: DataFrame, content: DataFrame, keys: list[str], target: str) -> DataFrame:
    """Whether every bundle of an unchanged entity can be copied from its previous deployment: all or none."""
    need = content.where(N.has_valid_extension(F.col("file"))).select(*keys, F.concat("hash", F.lit(f"_{target}")).alias("name")).distinct()
    lost = need.join(previous_files.select(*keys, "name"), [*keys, "name"], "left_anti").select(*keys).distinct().withColumn("_lost", F.lit(True))
    return content.select(*keys).distinct().join(lost, keys, "left").select(*keys, F.col("_lost").isNull().alias("copied"))


def cdn_names(bundles: DataFrame, originals: DataFrame) -> DataFrame:
    """Lower-case bundle names with their hash in its original case again, but for Mac bundles; of equal originals the first wins.

    ``originals``: lower, original, pos.
    """
    first = first_wins(originals, ["lower"], F.col("pos"), "original")
    lower = F.coalesce(N.leading_hash(F.col("bundle")), F.col("bundle"))
    joined = bundles.withColumn("lower", lower).join(first, "lower", "left")
    fixed = F.when(F.col("original").isNull() | F.col("bundle").endswith("_mac"), F.col("bundle")).otherwise(F.concat("original", F.expr("substring(bundle, length(lower) + 1)")))
    return joined.withColumn("cdn_name", fixed)


def bundle_metadata(bundles: DataFrame, edges: DataFrame, known: DataFrame, originals: DataFrame | None = None) -> DataFrame:
    """For each bundle its direct dependencies: null if none is listed, [] if all are left out.

    Names with _IGNORE and names without a canonical name are left out.  ``edges``: bundle, dep; ``known``: dep.  With ``originals``
    (see ``cdn_names``) the dependencies are named as they ship, and ``known`` holds such names.
    """
    if originals is not None:
        edges = cdn_names(edges.select(F.col("bundle").alias("_of"), F.col("dep").alias("bundle")), originals).select(F.col("_of").alias("bundle"), F.col("cdn_name").alias("dep"))
    named = edges.join(known.select("dep").distinct().withColumn("_known", F.lit(True)), "dep", "left")
    good = F.col("_known") & ~F.col("dep").contains("_IGNORE")
    grouped = named.groupBy("bundle").agg(F.array_sort(F.collect_set(F.when(good, F.col("dep")))).alias("dependencies"))
    return bundles.join(grouped, "bundle", "left")


def metadata_json(bundles: DataFrame, ticks: Column | None = None) -> DataFrame:
    """``ticks``: when the bundles were built, as 100 ns since year 1; -1 if it isn't known."""
    fields = F.struct(F.coalesce(F.lit(-1) if ticks is None else ticks, F.lit(-1)).cast("long").alias("timestamp"), F.lit("1.0").alias("version"), F.col("dependencies"), F.coalesce("main_asset", F.lit("")).alias("mainAsset"))
    return bundles.withColumn("json", F.to_json(fields, {"ignoreNullFields": "false"}))


def consolidate_static(edges: DataFrame, static_assets: DataFrame, scene: str, platform: str, ignored: str = "scene_ignore") -> DataFrame:
    """Static assets and their dependencies go into one bundle; shader dependencies stay out."""
    name = f"staticScene_{scene}_{platform}"
    mine = edges.join(static_assets.select(F.col("hash").alias("bundle")), "bundle", "left_semi").where(~F.col("dep").contains(ignored))
    members = static_assets.select("hash").union(mine.select("dep")).distinct()
    return members.select(F.lit(name).alias("bundle"), "hash")


def short_names(bundles: DataFrame, bundle: str, file: str) -> DataFrame:
    """Base names within a bundle, or the whole path where base names are equal, letter case aside."""
    base = F.element_at(F.split(F.col(file), "/"), -1)
    keyed = bundles.withColumn("base", base).withColumn("_l", F.lower(base))
    repeated = keyed.groupBy(bundle, "_l").count().where("count > 1").select(bundle, "_l", F.lit(True).alias("_r"))
    return keyed.join(repeated, [bundle, "_l"], "left").withColumn("short_name", F.when(F.coalesce("_r", F.lit(False)), F.col(file)).otherwise(F.col("base"))).drop("_l", "_r", "base")


def usage_flags(usages: DataFrame) -> DataFrame:
    """Per texture the union of its usage flags, and whether every usage is as a normal map."""
    return usages.groupBy("texture").agg(F.bit_or("flag").alias("flags"), F.bool_and("is_normal").alias("only_normal"))


def directory_sizes(files: DataFrame, depth: int = 2) -> DataFrame:
    """Bytes and files under each folder down to ``depth``: (path, size) to (folder, bytes, files)."""
    parts = F.split("path", "/")
    folders = F.transform(F.sequence(F.lit(1), F.least(F.size(parts) - 1, F.lit(depth))), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    some = F.when(F.size(parts) > 1, F.concat(F.array(F.lit("")), folders)).otherwise(F.array(F.lit("")))
    return files.select(F.explode(some).alias("folder"), "size").groupBy("folder").agg(F.sum("size").alias("bytes"), F.count("*").alias("files"))


def with_suffixes(content: DataFrame, suffixes: list[str]) -> DataFrame:
    """Entries whose file ends with one of ``suffixes``; each (hash, file) once."""
    return content.where(N.ends_with_any(F.col("file"), suffixes)).dropDuplicates(["hash", "file"])


def build_input(gltf: DataFrame, buffers: DataFrame, textures: DataFrame) -> DataFrame:
    """All that is loaded, duplicates kept."""
    return gltf.unionByName(buffers).unionByName(textures)


def not_built(wanted: DataFrame, built: DataFrame, keys: list[str]) -> DataFrame:
    """What has no finished bundle yet."""
    return wanted.join(built.select(*keys), keys, "left_anti")


def build_decision(wanted: DataFrame, built: DataFrame, keys: list[str], by: str) -> DataFrame:
    """For each ``by``: total, skipped (built before) and whether there is anything to do; an input without glTF files has work left unless all was built."""
    marked = wanted.join(built.select(*keys).distinct().withColumn("_built", F.lit(True)), keys, "left")
    return marked.groupBy(by).agg(F.count("*").alias("total"), F.count("_built").alias("skipped")).withColumn("to_do", F.col("total") > F.col("skipped"))


def mark_imported(wanted: DataFrame, imported: DataFrame, keys: list[str]) -> DataFrame:
    """All of ``wanted``, with ``is_imported``: those are marked for their bundle but not imported again."""
    there = imported.select(*keys).distinct().withColumn("_i", F.lit(True))
    return wanted.join(there, keys, "left").withColumn("is_imported", F.col("_i").isNotNull()).drop("_i")


def skip_counts(skips: DataFrame, labels: list[str]) -> DataFrame:
    return skips.groupBy(*labels).count().withColumnRenamed("count", "skipped")


def skip_samples(skips: DataFrame, by: str, order: str, n: int = 5) -> DataFrame:
    """For each ``by`` the first ``n`` skips in their order, and how many there are."""
    w = Window.partitionBy(by).orderBy(order)
    first = skips.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n)
    detail = F.array_sort(F.collect_list(F.struct("_n", "hash", "file", "reason", N.skip_detail(F.col("detail")).alias("detail"))))
    samples = first.groupBy(by).agg(F.transform(detail, lambda x: x.dropFields("_n")).alias("samples"))
    return samples.join(skips.groupBy(by).count(), by)


def static_members(paths: DataFrame, descriptor: DataFrame, scene: str, platform: str) -> DataFrame:
    """Where each path is bundled: the first path of a hash that the descriptor lists, unless an emote, goes to the scene's static bundle.

    ``paths``: pos, file, hash.  Buffers and further paths of a hash that is static are left out.
    """
    listed = descriptor.select("hash").distinct().withColumn("_static", F.lit(True))
    rows = paths.where(~F.col("file").endswith(".bin")).join(listed, "hash", "left")
    static = F.coalesce("_static", F.lit(False)) & ~N.is_emote_file(F.element_at(F.split("file", "/"), -1))
    rows = rows.withColumn("is_static", static)
    first = rows.groupBy("hash").agg(F.min(F.when(F.col("is_static"), F.col("pos"))).alias("_first"))
    kept = rows.join(first, "hash").where(F.col("_first").isNull() | (F.col("pos") <= F.col("_first")))
    name = F.when(F.col("is_static"), F.lit(f"staticScene_{scene}_{platform}")).otherwise(F.concat("hash", F.lit(f"_{platform}")))
    return kept.select("pos", "file", "hash", "is_static", name.alias("bundle"))


def place(assets: DataFrame, descriptor: DataFrame, listed_only: bool = False) -> DataFrame:
    """An instance for each transform that the descriptor has for an asset's hash; else one at the origin, or none with ``listed_only``.

    ``descriptor``: hash, position, rotation, scale.
    """
    placed = assets.join(descriptor, "hash", "inner" if listed_only else "left")
    at = lambda *x: F.array(*[F.lit(float(v)) for v in x])
    return placed.withColumns({"position": F.coalesce("position", at(0, 0, 0)), "rotation": F.coalesce("rotation", at(0, 0, 0, 1)), "scale": F.coalesce("scale", at(1, 1, 1))})


def grouped_descriptor(descriptor: DataFrame) -> DataFrame:
    """The descriptor with the transforms of a hash as one list; a hash's list is what one scene places of it."""
    return descriptor.groupBy("hash").agg(F.collect_list(F.struct("position", "rotation", "scale")).alias("transforms"))


def requested_content(requests: DataFrame, content: DataFrame) -> DataFrame:
    """Requests (entity_id, path) with the hash of the content entry they name; reading one that isn't there is an error."""
    table = last_wins(content.withColumn("key", N.content_table_key(F.col("file"))), ["entity_id", "key"], F.col("pos"), "hash")
    asked = requests.withColumn("key", F.lower(F.concat(F.lit("/"), F.regexp_replace(N.with_separator(F.col("path")), "^/", ""))))
    found = asked.join(table, ["entity_id", "key"], "left")
    missing = F.raise_error(F.concat(F.lit("no content for "), F.col("key"))).cast("string")
    return found.withColumn("hash", F.when(F.col("hash").isNull(), missing).otherwise(F.col("hash"))).drop("key")


def extracted_or_original(textures: DataFrame, extracted: DataFrame, name: str = "name") -> DataFrame:
    """Each texture's extracted copy of the same name, or itself."""
    copies = extracted.groupBy(name).agg(F.min("path").alias("_copy"))
    return textures.join(copies, name, "left").withColumn("path", F.coalesce("_copy", "path")).drop("_copy")


def paired_images(baseline: DataFrame, tested: DataFrame, name: str = "name") -> DataFrame:
    """Baseline and test image of the same name."""
    return baseline.select(name, F.col("path").alias("baseline")).join(tested.select(name, F.col("path").alias("tested")), name)


def cleaned_output(files: DataFrame, originals: DataFrame) -> DataFrame:
    """Finished files (bundle) under the names they ship under; per-bundle manifests and the build log go."""
    kept = files.where(~F.col("bundle").endswith(".manifest") & (F.col("bundle") != "buildlogtep.json"))
    return cdn_names(kept, originals)
