"""The queries: each operator over the projections of the test tables, beside its SQL twin for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assetweave.functions import geometry as G
from assetweave.functions import jobs as J
from assetweave.functions import names as N
from assetweave.operators import assets as A
from assetweave.operators import backfill as B
from assetweave.operators import containers as K
from assetweave.operators import control as C
from assetweave.operators import legacy as Y
from assetweave.operators import sinks as S
from assetweave.session import shared_folder, written
from assetweave.sources import gltf as G3

from .views import Views, duck

QUERIES: dict[str, Callable[[Views], DataFrame]] = {}
SQL: dict[str, str] = {}
WINDOWS = "windows"


def query(sql: str | None = None):
    def add(f: Callable[[Views], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = duck(sql)
        return f

    return add


EXT = r"lower(regexp_extract(file, '(\.[^.]*)$', 1))"
TEXTURES = "('.jpg','.png','.jpeg','.tga','.gif','.bmp','.psd','.tiff','.iff','.ktx')"
DEPS = "('.bin','.jpg','.png','.jpeg','.tga','.gif','.bmp','.psd','.tiff','.iff','.ktx')"
PROBES = "('.glb','.gltf','.jpg','.png','.jpeg','.tga','.gif','.bmp','.psd','.tiff','.iff','.ktx')"
DUCK_DIGEST = "sha256(cast(to_json(coalesce(list([{f}, {h}] order by {f}, {h}) filter (where {w}), [])) as varchar))[1:32]"
ENTITY_DIGEST = f"select entity_id, {DUCK_DIGEST.format(f='file', h='hash', w=EXT + ' in ' + DEPS)} digest from {{v_content}} group by entity_id"
#: References of the containers that can be read, resolved by plain text steps.
DUCK_REFS = """select c.entity_id, c.hash, r.uri, r.path, r.bad, t.hash dep from (select c.entity_id, c.hash, unnest(list_distinct(json_extract_string(g.doc, '$.*[*].uri'))) uri
    from {v_content} c join {v_containers} g on g.hash = c.hash where g.version = 2 and json_valid(g.doc) and g.doc <> 'null') c,
  lateral (select c.uri, case when regexp_matches(c.uri, '^[a-z]+:') then 'scheme' when regexp_matches(c.uri, '%([^0-9a-fA-F]|.[^0-9a-fA-F]|.?$)') then 'percent' when starts_with(c.uri, '../../') then 'escape' end bad,
    replace(case when starts_with(c.uri, '../') then substr(c.uri, 4) when starts_with(c.uri, './') then concat('models/', substr(c.uri, 3)) else concat('models/', c.uri) end, '%20', ' ') path) r
  left join (select entity_id, lower(file) key, arg_max(hash, pos) hash from {v_scene} group by 1, 2) t on t.entity_id = c.entity_id and t.key = lower(r.path) where not starts_with(c.uri, 'data:')"""
ASSET_DIGEST = f"""select c.entity_id, c.hash, case when coalesce(g.error, f.fault[1]) is null then coalesce(p.digest, sha256('[]')[1:32]) end digest,
  coalesce(g.error, f.fault[1]) is not null skipped, case when coalesce(g.error, f.fault[1]) is not null then c.file end file,
  case when g.error is not null then 'unparseable' else f.fault[2] end reason, coalesce(g.error, f.fault[3]) detail
  from (select * from {{v_content}} where pk % 4 = 0) c
  join (select hash, case when version <> 2 then 'version: 0x1' when not json_valid(doc) then 'json' when doc = 'null' then 'root: null' end error from {{v_containers}}) g on g.hash = c.hash
  left join (select entity_id, hash, min([uri, case when bad is not null then 'unparseable' else 'missing-deps' end, case when bad is not null then concat(bad, ': "', uri, '"') else concat('"', uri, '" -> "', path, '"') end])
    filter (where bad is not null or dep is null) fault from ({DUCK_REFS}) a group by 1, 2) f on f.entity_id = c.entity_id and f.hash = c.hash
  left join (select entity_id, hash, {DUCK_DIGEST.format(f='path', h='dep', w='true')} digest from (select distinct entity_id, hash, path, dep from ({DUCK_REFS}) b where bad is null and dep is not null) d group by 1, 2) p
    on p.entity_id = c.entity_id and p.hash = c.hash"""
METADATA_ONLY = """select t.entity_id, arg_max(s.hash, s.pos) hash from {v_thumbs} t join {v_scene} s on s.entity_id = t.entity_id and lower(s.file) = lower(t.thumb) group by t.entity_id, lower(s.file)"""
IS_GLTF = f"{EXT.replace('file', 'c.file')} in ('.glb', '.gltf')"
#: What is probed, by its object key: a glTF file's key holds the digest of what it refers to, one without a digest is left out, and so are thumbnails.
KEYED = f"""select c.entity_id, c.hash, c.file, {IS_GLTF} skippable, concat('v48/assets/', c.hash, case when {IS_GLTF} then concat('_', d.digest) else '' end, '_windows') object_key
  from (select entity_id, hash, arg_min(file, pos) file from {{v_scene}} where {EXT} in {PROBES} group by 1, 2) c
  left join ({ASSET_DIGEST}) d on d.entity_id = c.entity_id and d.hash = c.hash anti join ({METADATA_ONLY}) m on m.entity_id = c.entity_id and m.hash = c.hash where not {IS_GLTF} or d.digest is not null"""
#: Two entities of three were converted before: the store has their objects, and of one of them the cache knows it.  Textures that belong to containers are all there.
STORED = "(select hash from {v_inventory} union select hash from {v_scene} where hash like 't%')"
PROBED = f"""select c.*, k.object_key is not null cache_hit, k.object_key is null and i.object_key is not null in_store, k.object_key is not null or i.object_key is not null cached
  from ({KEYED}) c left join (select distinct n.object_key from ({KEYED}) n join {{v_cache}} h on h.hash = n.hash where n.entity_id % 3 = 1) k on k.object_key = c.object_key
  left join (select distinct n.object_key from ({KEYED}) n join {STORED} h on h.hash = n.hash where n.entity_id % 3 <> 0) i on i.object_key = c.object_key"""
SUMMARY = f"""select entity_id, count(*) probes, count(*) filter (where cached) n_cached, count(*) filter (where not cached) n_missing,
  count(*) filter (where cached and skippable) n_skippable, count(*) filter (where not cache_hit) n_head, count(*) filter (where not cached) = 0 full_hit from ({PROBED}) p group by entity_id"""
OUTCOME = f"""select e.entity_id, e.type kind, e.entity_id % 7 = 0 forced,
  case when e.entity_id % 97 = 0 then 'invalid-build-target'
  when e.entity_id % 7 <> 0 and coalesce(m.exit_code, 0) = 0 and m.version = 'v48' then 'already-converted'
  when e.entity_id % 89 = 0 then 'content-server-unreachable'
  when e.type <> 'scene' then 'no-asset-reuse'
  when e.entity_id % 83 = 0 then 'digest-failed'
  when e.entity_id % 7 = 0 then 'cache-probe-skipped'
  when e.entity_id % 79 = 0 then 'cache-probe-failed'
  when coalesce(s.probes, 0) > 0 and s.n_missing = 0 then 'full-hit' else 'partial-hit' end outcome
  from {{v_entities}} e left join {{v_manifests}} m on m.entity_id = e.entity_id left join ({SUMMARY}) s on s.entity_id = e.entity_id"""
RESULT_ROWS = ", ".join("(" + ", ".join("null" if x is None else f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in C.RESULTS)
RESULT_TABLE = f"(select * from (values {RESULT_ROWS}) t(outcome, triage, triage_exit, triage_metric, conversion_exit)) r"


def _parsed(v: Views) -> DataFrame:
    """The containers' bytes, each content parsed once."""
    c = v.v_containers.select("hash", G3.glb_content(F.col("doc"), F.col("version")).alias("content"), F.lit(".glb").alias("ext"))
    return G3.parse_once(c)


def _asset_digests(v: Views) -> DataFrame:
    return K.container_digests(v.stored("v_scene"), _parsed(v))


def _keyed(v: Views) -> DataFrame:
    scene = v.stored("v_scene")
    rows = A.probe_rows(scene, F.col("pos"), _asset_digests(v), "v48", WINDOWS, K.metadata_only(scene, v.v_thumbs))
    # Written: the rows are read three times, and nobody should parse and digest three times.
    return written(rows.select("entity_id", "hash", "skippable", "object_key"), "probe-rows")


def _probed(v: Views) -> DataFrame:
    rows, i = _keyed(v), F.col("entity_id")
    stored = v.v_inventory.select("hash").union(v.stored("v_scene").where(F.col("hash").startswith("t")).select("hash").distinct())
    store = rows.where(i % 3 != 0).join(stored, "hash", "left_semi")
    cache = rows.where(i % 3 == 1).join(v.v_cache, "hash", "left_semi")
    return A.probe(rows, store, cache, "object_key")


def _facts(v: Views) -> DataFrame:
    """For each entity, what a probe of it finds: one row by entity_id."""
    s = A.probe_summary(_probed(v)).select("entity_id", "probes", "n_missing")
    e = v.v_entities.select("entity_id", F.col("type").alias("kind")).join(v.v_manifests, "entity_id", "left").join(s, "entity_id", "left")
    i, no = F.col("entity_id"), F.lit(False)
    return e.select(
        "entity_id",
        "kind",
        F.when(i % 97 == 0, F.lit("linux")).otherwise(F.lit(WINDOWS)).alias("target"),
        F.coalesce((F.coalesce("exit_code", F.lit(0)) == 0) & (F.col("version") == "v48"), no).alias("converted"),
        (i % 89 != 0).alias("fetched"),
        (i % 83 != 0).alias("digest_ok"),
        (i % 79 != 0).alias("probe_ok"),
        "probes",
        "n_missing",
    )


def _outcomes(v: Views) -> DataFrame:
    forced = F.col("entity_id") % 7 == 0
    outcome = C.outcome_of_facts(forced, F.lit(False))
    return _facts(v).select("entity_id", "kind", forced.alias("forced"), outcome.alias("outcome"))


@query(f"select entity_id, file, hash, {EXT} ext from {{v_content}}")
def content_flatten(v):
    nested = v.v_content.groupBy(F.col("entity_id").alias("id")).agg(F.collect_list(F.struct("file", "hash")).alias("content"))
    return A.flatten_content(nested).select("entity_id", "file", "hash", N.extension(F.col("file")).alias("ext"))


@query(f"""select case when {EXT} in ('.glb', '.gltf') then 'gltf' when {EXT} in {TEXTURES} then 'texture' when {EXT} = '.bin' then 'buffer' else 'other' end kind,
  count(*) n, count(distinct hash) n_hashes from {{v_content}} group by 1""")
def ext_class_counts(v):
    return v.v_content.groupBy(N.extension_class(F.col("file")).alias("kind")).agg(F.count("*").alias("n"), F.countDistinct("hash").alias("n_hashes"))


@query(ENTITY_DIGEST)
def entity_digest(v):
    return A.set_digest(v.v_content, ["entity_id"])


@query(ASSET_DIGEST)
def asset_digest(v):
    return _asset_digests(v)


@query(f"""select c.entity_id, c.hash, case when c.pk % 4 = 0 then concat(c.hash, '_', d.digest, '_windows') else concat(c.hash, '_windows') end canonical,
  concat('v48/assets/', case when c.pk % 4 = 0 then concat(c.hash, '_', d.digest, '_windows') else concat(c.hash, '_windows') end) object_key
  from {{v_content}} c left join ({ASSET_DIGEST}) d on d.entity_id = c.entity_id and d.hash = c.hash where c.pk % 4 in (0, 1) and not coalesce(d.skipped, false)""")
def canonical_names(v):
    d = _asset_digests(v)
    c = v.v_content.where(N.is_probed(F.col("file"))).join(d.drop("file"), ["entity_id", "hash"], "left").where(~F.coalesce("skipped", F.lit(False)))
    name = N.canonical_name(F.col("hash"), F.col("file"), F.col("digest"), F.lit(WINDOWS))
    return c.select("entity_id", "hash", name.alias("canonical")).withColumn("object_key", N.canonical_key(F.lit("v48"), F.col("canonical")))


@query(f"select entity_id, hash, skippable, cached from ({PROBED}) p")
def probe_partition(v):
    return _probed(v).select("entity_id", "hash", "skippable", "cached")


@query(f"select cache_hit, in_store, count(*) n, count(distinct entity_id) n_entities from ({PROBED}) p group by 1, 2")
def probe_two_level(v):
    return _probed(v).groupBy("cache_hit", "in_store").agg(F.count("*").alias("n"), F.countDistinct("entity_id").alias("n_entities"))


@query(SUMMARY)
def full_hit(v):
    return A.probe_summary(_probed(v))


@query(OUTCOME)
def probe_outcome(v):
    return _outcomes(v)


@query(f"select case when forced then 'needs-unity' else triage end triage, case when forced then 'republished' else coalesce(triage_metric, 'none') end metric, kind, count(*) n from ({OUTCOME}) o join {RESULT_TABLE} on r.outcome = o.outcome group by 1, 2, 3")
def triage_outcomes(v):
    return C.triaged(_outcomes(v), F.col("forced"), F.lit(False)).groupBy("triage", F.coalesce("triage_metric", F.lit("none")).alias("metric"), "kind").agg(F.count("*").alias("n"))


@query(f"select o.outcome, coalesce(conversion_exit, -1) exit_code, count(*) n, min(entity_id) first_entity from ({OUTCOME}) o join {RESULT_TABLE} on r.outcome = o.outcome group by 1, 2")
def exit_codes(v):
    return C.with_results(_outcomes(v)).groupBy("outcome", F.coalesce("conversion_exit", F.lit(-1)).alias("exit_code")).agg(F.count("*").alias("n"), F.min("entity_id").alias("first_entity"))


@query(f"""select entity_id, hash, bool_or(m) by_metadata, bool_or(not m) by_name from (select entity_id, hash, true m from ({METADATA_ONLY}) a union all select entity_id, hash, false from {{v_content}} where pk % 50 = 1) b group by 1, 2""")
def metadata_only(v):
    meta = F.to_json(F.struct(F.struct(F.col("thumb").alias("navmapThumbnail")).alias("display")))
    thumbs = v.v_thumbs.select("entity_id", F.get_json_object(meta, "$.display.navmapThumbnail").alias("thumb"))
    shown = v.v_content.where("pk % 50 = 1").select("entity_id", F.lit(4_000_000_000).alias("pos"), F.lit("x/Autogenerated-Thumbnail.png").alias("file"), "hash")
    return K.metadata_only(v.v_scene.unionByName(shown), thumbs)


@query(f"select entity_id, hash from ({ASSET_DIGEST}) d where skipped union select entity_id, hash from {{v_content}} where pk % 50 = 1")
def drop_set(v):
    skipped = _asset_digests(v).where("skipped")
    return A.drop_set(skipped, v.v_content.where("pk % 50 = 1"), ["entity_id", "hash"])


@query("""select entity_id, hash, file from {v_content} c where not (pk % 20 = 0 or pk % 50 = 1)
  and (pk % 4 = 1 or hash not in (select hash from {v_cache}))""")
def engine_input(v):
    dropped = v.v_content.where("pk % 20 = 0 or pk % 50 = 1")
    cached = v.v_content.join(v.v_cache, "hash", "left_semi")
    return A.engine_input(v.v_content.select("entity_id", "hash", "file"), dropped.select("entity_id", "hash"), cached, ["entity_id", "hash"])


MERGE_BUILT = "(select entity_id, concat(hash, '_windows') name from {v_content} where pk % 2 = 0)"


@query(f"""select entity_id, name, 'built' origin from {MERGE_BUILT} b union all select k.entity_id, k.name, 'cached' from
  (select distinct c.entity_id, concat(c.hash, '_windows') name from {{v_content}} c join {{v_cache}} x on x.hash = c.hash) k anti join {MERGE_BUILT} b on b.entity_id = k.entity_id and b.name = k.name""")
def manifest_merge(v):
    named = v.v_content.withColumn("name", F.concat("hash", F.lit("_windows")))
    return A.merge_manifest(named.where("pk % 2 = 0"), named.join(v.v_cache, "hash", "left_semi"), ["entity_id"], "name")


@query("select bundle, p_brand from {v_bundles} b where regexp_extract(bundle, '^([^_.]+)[_.]', 1) in (select hash from {v_cache})")
def purge_set(v):
    return A.purge(v.v_bundles.select("bundle", "p_brand"), v.v_cache, "bundle")


@query("select entity_id, version from {v_manifests} where coalesce(exit_code, 0) = 0 and version = 'v48'")
def already_converted(v):
    return A.already_converted(v.v_manifests, "v48").select("entity_id", "version")


@query("select entity_id, version from {v_manifests} where exit_code = 0 and version = 'v48'")
def migratable(v):
    return A.migratable(v.v_manifests, "v48").select("entity_id", "version")


@query("""select e.entity_id, e.base, (case when n.entity_id = e.entity_id then s.entity_id else n.entity_id end) previous from {v_entities} e
  left join (select *, row_number() over (partition by base order by ts desc, entity_id desc) k from {v_entities}) n on n.base = e.base and n.k = 1
  left join (select *, row_number() over (partition by base order by ts desc, entity_id desc) k from {v_entities}) s on s.base = e.base and s.k = 2""")
def previous_deployment(v):
    return C.previous_deployment(v.v_entities)


NAMES = """select c.entity_id, case c.pk % 3 when 0 then concat(c.hash, '7_windows') when 1 then concat(c.hash, '_windows') else concat(c.hash, '.br') end name
  from {v_content} c join {v_inventory} i on i.hash = c.hash"""


@query(f"""select e.entity_id, not exists (select 1 from {{v_content}} c where c.entity_id = e.entity_id and {EXT} in ('.glb', '.gltf', '.bin', {TEXTURES[1:-1]})
  and not exists (select 1 from ({NAMES}) n where n.entity_id = c.entity_id and starts_with(n.name, c.hash))) unchanged from {{v_entities}} e""")
def content_changed(v):
    content = v.v_entities.select("entity_id").join(v.v_content.select("entity_id", "file", "hash"), "entity_id", "left")
    return A.hashes_in_manifest(v.sql(NAMES), content, ["entity_id"])


@query(f"""select e.entity_id, not exists (select 1 from {{v_content}} c where c.entity_id = e.entity_id and {EXT} in ('.glb', '.gltf', '.bin', {TEXTURES[1:-1]})
  and not exists (select 1 from ({NAMES}) n where n.entity_id = c.entity_id and n.name = concat(c.hash, '_windows'))) copied from {{v_entities}} e""")
def previous_copy(v):
    content = v.v_entities.select("entity_id").join(v.v_content.select("entity_id", "file", "hash"), "entity_id", "left")
    return A.can_copy_previous(v.sql(NAMES), content, ["entity_id"], WINDOWS)


#: Entities with what is known of their previous deployment; its manifest lists all but one of 23 files, its store has all but one of 17.
LEGACY = """select e.entity_id, e.type kind, e.entity_id % 7 = 0 force, e.entity_id % 11 = 0 iss, e.entity_id % 13 = 0 reuse, case when e.entity_id % 17 <> 0 then e.entity_id - 1 end previous,
  case when e.entity_id % 19 <> 0 then m.version end previous_version from {v_entities} e left join {v_manifests} m on m.entity_id = e.entity_id"""
LEGACY_FILES = f"select entity_id, pk, hash, {EXT} in ('.glb', '.gltf', '.bin', {TEXTURES[1:-1]}) valid from {{v_content}}"


@query(f"""select l.entity_id, case when force or iss or reuse or kind <> 'scene' then 'not-asked' when previous is null then 'no-previous' when previous_version is null then 'no-manifest' when previous_version <> 'v48' then 'other-version'
  when f.changed then 'content-changed' when f.first_lost is null then 'copied' else 'copy-failed' end outcome,
  case when not (force or iss or reuse) and kind = 'scene' and previous is not null and previous_version = 'v48' and not coalesce(f.changed, false) then (select count(*) from ({LEGACY_FILES}) c where c.entity_id = l.entity_id and valid and (f.first_lost is null or pk <= f.first_lost)) else 0 end attempted
  from ({LEGACY}) l left join (select entity_id, bool_or(not listed) changed, min(pk) filter (where pk % 17 = 0) first_lost from (select *, exists (select 1 from {{v_content}} n
    where n.entity_id = v.entity_id and n.pk % 23 <> 0 and starts_with(n.hash, v.hash)) listed from ({LEGACY_FILES}) v where valid) x group by 1) f on f.entity_id = l.entity_id""")
def legacy_reuse(v):
    named = v.v_content.select("entity_id", "pk", F.concat("hash", F.lit("_windows")).alias("name"))
    content = v.v_content.select("entity_id", F.col("pk").alias("pos"), "file", "hash")
    return Y.reuse_previous(v.sql(LEGACY), content, named.where("pk % 23 <> 0"), named.where("pk % 17 <> 0"), WINDOWS, "v48")[0]


@query("""select entity_id, count(*) total, count(*) filter (where built) skipped, count(*) > count(*) filter (where built) to_do from
  (select c.entity_id, i.hash is not null built from {v_content} c left join {v_inventory} i on i.hash = c.hash where c.pk % 4 = 0) t group by 1""")
def build_decision(v):
    return A.build_decision(v.v_content.where(N.is_gltf(F.col("file"))), v.v_inventory, ["hash"], "entity_id")


SKIPS = f"select entity_id, hash, file, reason, detail from ({ASSET_DIGEST}) a where skipped"


def _skips(v: Views) -> DataFrame:
    return _asset_digests(v).where("skipped").select("entity_id", "hash", "file", "reason", "detail")


@query(f"select reason, count(*) skipped from ({SKIPS}) s group by 1")
def skip_counts(v):
    return A.skip_counts(_skips(v), ["reason"])


@query(f"""select base, count(*) n, string_agg(case when k <= 5 then concat(hash, ':', reason, ':', detail) end, ',' order by k) samples from
  (select s.*, e.base, row_number() over (partition by e.base order by concat(cast(s.entity_id as varchar), '/', s.hash)) k from ({SKIPS}) s join {{v_entities}} e on e.entity_id = s.entity_id) t group by 1""")
def skip_samples(v):
    rows = _skips(v).join(v.v_entities.select("entity_id", "base"), "entity_id").withColumn("place", F.concat(F.col("entity_id").cast("string"), F.lit("/"), F.col("hash")))
    out = A.skip_samples(rows, "base", "place")
    return out.select("base", F.col("count").alias("n"), F.array_join(F.transform("samples", lambda x: F.concat(x["hash"], F.lit(":"), x["reason"], F.lit(":"), x["detail"])), ",").alias("samples"))


@query("""select p.pk, p.p_brand, case when p.p_size > 40 then false else true end listed, coalesce(s.s_suppkey * 1.0, 0) x from
  (select p_partkey pk, p_brand, p_size from {part}) p left join {supplier} s on s.s_suppkey = p.pk and p.p_size <= 40""")
def static_placement(v):
    at = lambda *x: F.array(*[F.lit(float(i)) for i in x])
    d = v.supplier.select(F.concat(F.lit("h"), F.col("s_suppkey").cast("string")).alias("hash"), F.array(F.col("s_suppkey") * F.lit(1.0), F.lit(0.0), F.lit(0.0)).alias("position"), at(0, 0, 0, 1).alias("rotation"), at(1, 1, 1).alias("scale"))
    a = v.part.select(F.col("p_partkey").alias("pk"), "p_brand", F.when(F.col("p_size") <= 40, F.concat(F.lit("h"), F.col("p_partkey").cast("string"))).otherwise(F.concat(F.lit("none"), F.col("p_partkey").cast("string"))).alias("hash"))
    return A.place(a, d).select("pk", "p_brand", (~F.col("hash").startswith("none")).alias("listed"), F.col("position")[0].alias("x"))


@query("""select pk, file, hash, is_static, case when is_static then 'staticScene_s1_windows' else concat(hash, '_windows') end bundle from (
  select *, min(case when is_static then pk end) over (partition by hash) first from (
    select c.*, c.pk % 5 <> 0 and i.hash is not null is_static from (select p_partkey pk, concat('h', cast(p_size as varchar)) hash,
      concat('m/', cast(p_partkey as varchar), case when p_partkey % 7 = 0 then '.bin' when p_partkey % 5 = 0 then '_emote.glb' else '.glb' end) file from {part}) c
    left join (select distinct concat('h', cast(p_size as varchar)) hash from {part} where p_size % 2 = 0) i on i.hash = c.hash where c.pk % 7 <> 0) a) b where first is null or pk <= first""")
def static_members(v):
    i = F.col("p_partkey")
    ending = F.when(i % 7 == 0, ".bin").when(i % 5 == 0, "_emote.glb").otherwise(".glb")
    rows = v.part.select(i.alias("pos"), F.concat(F.lit("m/"), i.cast("string"), ending).alias("file"), F.concat(F.lit("h"), F.col("p_size").cast("string")).alias("hash"))
    listed = v.part.where(F.col("p_size") % 2 == 0).select(F.concat(F.lit("h"), F.col("p_size").cast("string")).alias("hash"))
    return A.static_members(rows, listed, "s1", WINDOWS).withColumnRenamed("pos", "pk")


PLAN = f"""select c.entity_id, c.hash, case when not skipped then case when is_gltf then concat(c.hash, '_', digest, '_windows') else concat(c.hash, '_windows') end end target_name,
  case when skipped then 'skipped' when i.hash is not null then 'canonical' when c.pk % 11 = 0 then 'missing-source' else 'copied' end action, is_gltf
  from (select c.*, c.pk % 4 = 0 is_gltf, d.digest, coalesce(d.skipped, false) skipped from {{v_content}} c left join ({ASSET_DIGEST}) d on d.entity_id = c.entity_id and d.hash = c.hash where c.pk % 4 in (0, 1)) c
  join (select entity_id from {{v_manifests}} where exit_code = 0 and version = 'v48') m on m.entity_id = c.entity_id left join {{v_inventory}} i on i.hash = c.hash"""


def _fates(v: Views) -> DataFrame:
    return C.manifest_fates(v.v_manifests, "v48", v.v_entities)


def _plan(v: Views) -> DataFrame:
    d = _asset_digests(v).select("entity_id", "hash", "digest", "skipped")
    files = v.v_content.where(N.is_probed(F.col("file"))).join(d, ["entity_id", "hash"], "left").withColumn("skipped", F.coalesce("skipped", F.lit(False)))
    files = files.withColumn("is_gltf", N.is_gltf(F.col("file"))).withColumn("source_key", F.when(F.col("pk") % 11 != 0, F.concat(F.lit("v48/"), F.col("entity_id").cast("string"), F.lit("/"), "hash")))
    return C.migration(files, _fates(v), v.v_inventory)


@query(f"select entity_id, hash, target_name, action from ({PLAN}) p")
def migration_plan(v):
    return _plan(v).select("entity_id", "hash", "target_name", "action")


@query(f"""select s.*, 0::bigint manifests_missing_content_server, 0::bigint manifests_entity_fetch_failed, 0::bigint manifests_digest_failed, p.*, 0::bigint errors from
  (select count(*) manifests_scanned, count(*) filter (where exit_code = 0 and version = 'v48') manifests_kept, count(*) filter (where not coalesce(exit_code = 0 and version = 'v48', false)) manifests_skipped from {{v_manifests}}) s,
  (select count(*) filter (where action <> 'skipped') bundles_probed, count(*) filter (where action = 'canonical') bundles_already_canonical, count(*) filter (where action = 'copied') bundles_copied,
   count(*) filter (where action = 'copied' and is_gltf) glb_renamed, count(*) filter (where action = 'missing-source') bundles_missing_source, count(*) filter (where action = 'skipped') glb_skipped from ({PLAN}) q) p""")
def migration_stats(v):
    return C.migration_stats(_fates(v), _plan(v))


#: Entities that are gone have no content, those with a container that can't be read no digest; the sources of every ninth part are missing.
BACKFILL_FATE = """select b.entity_id, case when kind in ('sentinel', 'mac', 'version', 'exit', 'nolist') then 'skipped' when kind = 'broken' then 'error' when kind = 'noserver' then 'no-server' when kind = 'gone' or c.entity_id is null then 'no-entity'
  when u.entity_id is not null then 'digest-failed' else 'kept' end fate from {v_backfill} b left join (select distinct entity_id from {v_content}) c on c.entity_id = b.entity_id left join (select distinct entity_id from {v_content} where pk % 60 = 0) u on u.entity_id = b.entity_id"""
BACKFILL = f"""select entity_id, file, target_name, case when skipped then 'skipped' when there then 'canonical' when place = first then 'copied' when place > first then 'canonical' else 'missing-source' end action, coalesce(target_name <> file, false) is_gltf
  from (select *, min(case when not there and source then place end) over (partition by target_name) as first from (
    select l.entity_id, l.file, coalesce(d.skipped, false) skipped, [concat('manifest/', cast(l.entity_id as varchar), '_windows.json'), l.file] place, i.hash is not null there,
      coalesce(try_cast(regexp_extract(l.file, '([0-9]+)', 1) as bigint) % 9 <> 0, false) source, case when not coalesce(d.skipped, false) then case when d.digest is not null then replace(l.file, '_windows', concat('_', d.digest, '_windows')) else l.file end end target_name
    from {{v_listed}} l join ({BACKFILL_FATE}) f on f.entity_id = l.entity_id and f.fate = 'kept'
    left join ({ASSET_DIGEST}) d on d.entity_id = l.entity_id and d.hash = nullif(regexp_extract(l.file, '^([^_]+)_windows(\\.br)?$', 1), '')
    left join {{v_inventory}} i on l.file = concat(i.hash, '_windows') and d.digest is null where l.file like '%\\_windows%' escape '\\') p) q"""


def _backfill(v: Views) -> tuple[DataFrame, DataFrame]:
    """Manifests written as files, and the backfill of them; bytes are not copied, as the bundles have none here."""
    bucket, at, kind = shared_folder(v.spark, "bucket"), shared_folder(v.spark, "backfill"), F.col("kind")
    # Only entities with a manifest are asked for content and digests.
    of = v.of(v.stored("v_backfill"))
    of.made["v_backfill"] = v.stored("v_backfill")
    of.made["v_content"] = of.stored("v_content")
    of.made["v_listed"] = of.stored("v_listed")
    name = F.concat(F.col("entity_id").cast("string"), F.when(kind == "mac", "_mac.json").when(kind == "sentinel", "_windows_failed.json").otherwise("_windows.json"))
    fields = (F.when(kind == "version", "v47").otherwise("v48").alias("version"), F.when(kind == "exit", 12).otherwise(0).alias("exitCode"), F.when(kind != "noserver", "https://peer.example.org/content").alias("contentServerUrl"), F.when(kind != "nolist", F.col("files")).alias("files"))
    body = F.when(kind == "broken", '{"version": "v48", "files": [').otherwise(F.to_json(F.struct(*fields)))
    listed = of.v_listed.groupBy("entity_id").agg(F.sort_array(F.collect_list("file")).alias("files"))
    files = of.v_backfill.join(listed, "entity_id", "left").select(name.alias("name"), body.cast("binary").alias("content"))
    scene = of.stored("v_scene").join(of.v_backfill.where(kind == "gone").select("entity_id"), "entity_id", "left_anti")
    # Written: fates and plan read them, the plan twice.
    digests = written(K.container_digests(scene, _parsed(v).where(F.substring("hash", 2, 20).cast("bigint") % 60 != 0)), "digests")
    number = F.try_to_number(F.regexp_extract("file", "([0-9]+)", 1), F.lit("9" * 18))
    sources = of.v_listed.where(number % 9 != 0).select(F.concat(F.lit("v48/"), F.col("entity_id").cast("string"), F.lit("/"), "file").alias("key"))
    objects = v.v_inventory.select(N.canonical_key(F.lit("v48"), F.concat("hash", F.lit("_windows"))).alias("key")).union(sources)
    return B.backfill(v.spark, bucket, at, "v48", WINDOWS, scene, digests, objects, reading=lambda: B.read_in_pieces(files, bucket, at))


@query(f"select entity_id, file, target_name, action from ({BACKFILL}) b")
def backfill_plan(v):
    return _backfill(v)[1].select(F.col("entity_id").cast("long").alias("entity_id"), "file", "target_name", "action")


@query(f"""select s.*, p.* exclude (bundle_errors), s2.e + p.bundle_errors errors from (select count(*) manifests_scanned, count(*) filter (where fate = 'kept') manifests_kept, count(*) filter (where fate = 'skipped') manifests_skipped,
  count(*) filter (where fate = 'no-server') manifests_missing_content_server, count(*) filter (where fate = 'no-entity') manifests_entity_fetch_failed, count(*) filter (where fate = 'digest-failed') manifests_digest_failed from ({BACKFILL_FATE}) f) s,
  (select count(*) filter (where fate = 'error') e from ({BACKFILL_FATE}) g) s2,
  (select count(*) filter (where action <> 'skipped') bundles_probed, count(*) filter (where action = 'canonical') bundles_already_canonical, count(*) filter (where action = 'copied') bundles_copied,
   count(*) filter (where action = 'copied' and is_gltf) glb_renamed, count(*) filter (where action = 'missing-source') bundles_missing_source, count(*) filter (where action = 'skipped') glb_skipped, count(*) filter (where action = 'error') bundle_errors from ({BACKFILL}) q) p""")
def backfill_stats(v):
    return C.migration_stats(*_backfill(v))


MANIFEST_BODY = """case when o_orderkey % 5 = 0 then to_json(struct_pack(version := 'v49', exitCode := case when o_orderkey % 10 = 0 then 12 end)) else to_json(struct_pack(version := 'v48', exitCode := 0)) end"""


@query(f"""select concat('manifest/', cast(o_orderkey as varchar), case when o_orderkey % 3 = 0 then '_mac' else '_windows' end, '.json') key, cast({MANIFEST_BODY} as varchar) body from {{orders}}
  where o_orderkey % 7 <> 0 or o_orderkey % 5 = 0""")
def manifest_upserts(v):
    """Manifests written, some of them written again and new ones with them, and read."""
    target = F.when(F.col("o_orderkey") % 3 == 0, "mac").otherwise("windows")
    of = lambda version, code: v.orders.select(F.col("o_orderkey").alias("entity_id"), target.alias("target"), F.lit(version).alias("version"), code.alias("exitCode"))
    at = shared_folder(v.spark, "manifests")
    S.write_manifests(of("v48", F.lit(0)).where("entity_id % 7 <> 0"), at)
    S.write_manifests(of("v49", F.when(F.col("o_orderkey") % 10 == 0, 12)).where("entity_id % 5 = 0"), at)
    return S.manifest_store(v.spark, at).read()


KEYS = "select concat('manifest/', p_brand, '_', cast(p_partkey as string), case p_size % 4 when 0 then '_windows' when 1 then '_mac' when 2 then '_failed' else '' end, '.json') key from {part}"


@query(rf"""select key, nullif(regexp_extract(key, '^manifest/(.+)_(windows|mac)\.json$', 1), '') entity_id, nullif(regexp_extract(key, '^manifest/(.+)_(windows|mac)\.json$', 2), '') target from ({KEYS}) k""")
def manifest_keys(v):
    p = N.parse_manifest_key(F.col("key"))
    return v.sql(KEYS).select("key", p["entity_id"].alias("entity_id"), p["target"].alias("target"))


@query(r"""select bundle, nullif(regexp_extract(bundle, '^([^_]+)_windows(\.br|\.manifest|\.manifest\.br)?$', 1), '') hash,
  case when regexp_matches(bundle, '^([^_]+)_windows(\.br|\.manifest|\.manifest\.br)?$') then regexp_extract(bundle, '^([^_]+)_windows(\.br|\.manifest|\.manifest\.br)?$', 2) end variant from {v_bundles}""")
def bundle_split(v):
    s = N.split_bundle(F.col("bundle"), "windows")
    return v.v_bundles.select("bundle", s["hash"].alias("hash"), s["variant"].alias("variant"))


@query("select bundle, nullif(regexp_extract(bundle, '^([^_.]+)[_.]', 1), '') hash from {v_bundles}")
def bundle_hash(v):
    return v.v_bundles.select("bundle", N.leading_hash(F.col("bundle")).alias("hash"))


@query("""select lower(concat(cid, case p_size % 2 when 0 then '_windows' else '_mac' end)) bundle,
  case p_size % 2 when 0 then concat(cid, '_windows') else lower(concat(cid, '_mac')) end cdn_name from {v_bundles}""")
def cdn_names(v):
    names = v.v_bundles.select(F.lower(F.concat("cid", F.when(F.col("p_size") % 2 == 0, "_windows").otherwise("_mac"))).alias("bundle"))
    originals = v.v_bundles.select(F.lower("cid").alias("lower"), F.col("cid").alias("original"), F.col("pk").alias("pos"))
    return A.cdn_names(names, originals).select("bundle", "cdn_name")


@query("""select concat('h', cast(p_partkey as varchar)) bundle, case when e.n is null then -1 when e.good is null then 0 else len(e.good) end n_dependencies, array_to_string(e.good, ',') dependencies from {part} p
  left join (select entity_id, hash, count(*) n, list(distinct dep order by dep) filter (where dep_pk % 9 <> 0 and dep_pk % 10 <> 0) good from
    (select a.pk entity_id, a.hash, concat('h', cast(b.pk as varchar), case when b.pk % 9 = 0 then '_IGNORE' else '' end) dep, b.pk dep_pk from
      (select distinct pk, hash, entity_id e from {v_content} where pk % 4 = 0) a join {v_content} b on b.entity_id = a.e and b.pk % 4 = 1) x group by 1, 2) e on e.hash = concat('h', cast(p_partkey as varchar))""")
def bundle_metadata(v):
    c = v.v_content
    glb = c.where("pk % 4 = 0").select("entity_id", F.col("hash").alias("bundle"))
    tex = c.where("pk % 4 = 1").select("entity_id", F.concat("hash", F.when(F.col("pk") % 9 == 0, "_IGNORE").otherwise("")).alias("dep"))
    known = v.part.where("p_partkey % 10 <> 0").select(F.concat(F.lit("h"), F.col("p_partkey").cast("string")).alias("dep"))
    bundles = v.part.select(F.concat(F.lit("h"), F.col("p_partkey").cast("string")).alias("bundle"))
    out = A.bundle_metadata(bundles, glb.join(tex, "entity_id").select("bundle", "dep"), known)
    deps = F.when(F.size("dependencies") > 0, F.array_join("dependencies", ","))
    return out.select("bundle", F.coalesce(F.size("dependencies"), F.lit(-1)).cast("long").alias("n_dependencies"), deps.alias("dependencies"))


FILES = "select p_brand bundle, concat(p_type, '/', case when p_partkey % 3 = 0 then 'Model' else 'model' end, cast(p_partkey % 40 as string), '.glb') file, p_partkey pk from {part}"


@query(f"""select bundle, pk, case when count(*) over (partition by bundle, lower(base)) > 1 then file else base end short_name from (select *, regexp_extract(file, '([^/]*)$', 1) base from ({FILES}) f) g""")
def short_names(v):
    return A.short_names(v.sql(FILES), "bundle", "file").select("bundle", "pk", "short_name")


HOSTS = "peer.example.org, https://Shop3.example.com/x, ,news.example.net"
URLS = "select page_id, url from {pages}"
HOST_SQL = "nullif(lower(regexp_extract({u}, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)', 1)), '')"


@query(f"""select page_id, {HOST_SQL.format(u='url')} host, lower(regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*)://', 1)) scheme from {{pages}}""")
def url_host(v):
    return v.pages.select("page_id", J.url_host(F.col("url")).alias("host"), J.url_scheme(F.col("url")).alias("scheme"))


GUARD = """select page_id, case page_id % 8 when 0 then url when 1 then concat('https://10.0.0.', cast(page_id % 256 as string), '/x') when 2 then 'https://localhost/a' when 3 then 'https://db.internal/' when 4 then 'http://example.org/'
  when 5 then 'https://example.org/a?b' when 6 then (case page_id % 3 when 0 then 'https://[2001:db8::1]/z' when 1 then 'https://0x7f000001/' else 'https://user@127.1:8443/' end)
  else (case page_id % 3 when 0 then 'https://2130706433/' when 1 then 'https://1password.example/' else 'not a url' end) end u from {pages}"""


@query(f"""select page_id, u, case when regexp_matches(u, '^https://') and not regexp_matches(u, '^https://([^/?#@]*@)?(localhost|([^/?#:]*[.])?([0-9]+|0x[0-9a-f]*)[.]?|\\[[^]]*\\]|[^/]*\\.(localhost|local|internal|corp|home|arpa|onion))([/:?#]|$)') then true else false end safe from ({GUARD}) g""")
def url_guard(v):
    return v.sql(GUARD).select("page_id", "u", J.is_safe_url(F.col("u")).alias("safe"))


JOBS = """select page_id, case when page_id % 13 = 0 then null when page_id % 11 = 0 then 'bad_id!' else concat('bafy', cast(page_id as string)) end id,
  case when page_id % 5 = 0 then 1 else 0 end lod, case page_id % 7 when 0 then null when 1 then 'https://evil.test/' else 'https://peer.example.org/content' end server,
  case page_id % 3 when 0 then 'https://lods.example.com/a.fbx' else 'https://192.168.0.1/a.fbx' end lod_url from {pages}"""


@query(f"""select page_id, case when id is null then 'no-entity' when id = 'bad_id!' then 'bad-entity-id' when lod = 0 and server is null then 'no-url'
  when server = 'https://evil.test/' then 'url-not-allowed' when lod = 1 and lod_url like '%192%' then 'unsafe-lod-url' end reason from ({JOBS}) j""")
def job_validation(v):
    urls = F.when(F.col("server").isNull(), F.array().cast("array<string>")).otherwise(F.array("server"))
    lods = F.when(F.col("lod") == 1, F.array("lod_url"))
    return v.sql(JOBS).select("page_id", J.reject_reason(F.col("id"), urls, lods, J.allowed_hosts(F.lit(HOSTS))).alias("reason"))


@query("""select page_id, case when url like '%/' then (case when url like '%contents/' then url else concat(url, 'contents/') end) else concat(url, '/contents/') end base from {pages}""")
def contents_url(v):
    return v.pages.select("page_id", J.contents_url(F.col("url")).alias("base"))


@query("""select job_id, case when iss then 'v2004' when lods then 'v48' when e.type in ('wearable', 'emote') then 'w7' else 'v48' end version from {v_jobs} j left join {v_entities} e on e.entity_id = j.entity_id""")
def job_version(v):
    e = v.v_entities.select("entity_id", "type")
    return v.v_jobs.join(e, "entity_id", "left").select("job_id", J.job_version(F.col("iss"), F.col("lods"), F.col("type"), F.lit("v48"), F.lit("w7")).alias("version"))


@query("""select job_id, concat(cast(j.entity_id as varchar), '-windows') event_key, epoch_us(ts) // 1000 ts_ms, lods is_lods, j.entity_id % 3 = 0 is_world, case when force then 0 else 13 end status from {v_jobs} j""")
def finished_events(v):
    server = F.when(F.col("entity_id") % 3 == 0, "https://worlds-content-server.example.org/").otherwise("https://peer.example.org/")
    e = C.finished_event(F.lit(WINDOWS), F.col("entity_id").cast("string"), F.col("lods"), J.is_world(server), F.when(F.col("force"), 0).otherwise(13), F.lit("v48"), F.unix_millis(F.col("ts").cast("timestamp")))
    return v.v_jobs.select("job_id", e.alias("e")).select("job_id", F.col("e.key").alias("event_key"), F.col("e.timestamp").alias("ts_ms"), F.col("e.metadata.isLods").alias("is_lods"), F.col("e.metadata.isWorld").alias("is_world"), F.col("e.metadata.statusCode").alias("status"))


BUCKETS = (1, 10, 100, 200, 300, 400, 500, 600, 700, 1000, 1200, 1600, 1800, 3600)


@query("select event_type queue, le, count(*) filter (where value * 10 <= le_value) value from {events}, (values " + ", ".join(f"('{b}', {b}.0)" for b in BUCKETS) + ", ('+Inf', 1e18)) b(le, le_value) group by 1, 2")
def job_histogram(v):
    jobs = v.events.select(F.col("event_type").alias("queue"), (F.col("value") * 10).alias("seconds"))
    return C.histogram(jobs, "seconds", ["queue"])


STEPS = "select event_id, ts, user_id % 10 worker, case when event_type in ('click', 'view') then 1 else -1 end delta from {events}"


@query(f"select event_id, worker, sum(delta) over (partition by worker order by ts, event_id rows between unbounded preceding and current row) running from ({STEPS}) s")
def running_gauge(v):
    return C.running_gauge(v.sql(STEPS), ["worker"], "ts", "event_id").select("event_id", "worker", "running")


@query("select event_type metric, case when force then 'force' when iss then 'iss' else 'normal' end lane, count(*) value from {v_jobs} group by 1, 2")
def metric_counters(v):
    lane = F.when(F.col("force"), "force").when(F.col("iss"), "iss").otherwise("normal")
    return v.v_jobs.groupBy(F.col("event_type").alias("metric"), lane.alias("lane")).agg(F.count("*").alias("value"))


FLAGS = "select event_id, case event_id % 9 when 0 then 'true' when 1 then ' YES ' when 2 then '0' when 3 then 'off' when 4 then '' when 5 then 'maybe' when 6 then null when 7 then 'On' else ' ' end setting from {events}"


@query(f"""select event_id, case event_id % 9 when 0 then true when 1 then true when 2 then false when 3 then false when 7 then true else true end flag, event_id % 9 in (5, 8) unknown from ({FLAGS}) f""")
def flags(v):
    return v.sql(FLAGS).select("event_id", J.flag(F.col("setting"), True).alias("flag"), J.flag_is_unknown(F.col("setting")).alias("unknown"))


RETRY = "select event_id, case event_id % 8 when 0 then '5' when 1 then '120' when 2 then '120abc' when 3 then '-1' when 4 then '1.5' when 5 then '' when 6 then null else 'Wed, 21 Oct 2026 07:28:00 GMT' end h, 400 + event_id % 120 status from {events}"


@query(f"select event_id, case event_id % 8 when 0 then 5000 when 1 then 30000 when 7 then 10000 end wait_ms, status in (408, 429) or status >= 500 retryable from ({RETRY}) r")
def retry_policy(v):
    now = F.lit("2026-10-21 07:27:50").cast("timestamp")
    return v.sql(RETRY).select("event_id", J.retry_after_ms(F.col("h"), now).alias("wait_ms"), J.is_retryable(F.col("status")).alias("retryable"))


@query(r"select doc_id, case when length(d) > 256 then concat(substring(d, 1, 256), '…') else d end detail from (select doc_id, regexp_replace(text, '[\x00-\x1f\x7f]', ' ', 'g') d from {documents}) t")
def skip_details(v):
    return v.documents.select("doc_id", N.skip_detail(F.col("text")).alias("detail"))


@query("select sha256(text) digest, min(doc_id) first_id, count(*) copies from {documents} group by 1")
def doc_dedup(v):
    return v.documents.groupBy(F.sha2(F.col("text").cast("binary"), 256).alias("digest")).agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"))


@query("select p_partkey, md5(p_name) guid from {part}")
def asset_guid(v):
    return v.part.select("p_partkey", N.asset_guid(F.col("p_name")).alias("guid"))


@query(r"""select p_partkey, case when regexp_replace(p_type || ': ' || p_name, '["<>|:*?\\/ .¿]', '_', 'g') = '' then 'unnamed' else regexp_replace(p_type || ': ' || p_name, '["<>|:*?\\/ .¿]', '_', 'g') end name from {part}""")
def nicify(v):
    return v.part.select("p_partkey", N.nicify(F.concat("p_type", F.lit(": "), "p_name")).alias("name"))


@query("""select c_nationkey scene, round(cast(min(x) * 16 - 0.05 as double), 6) min_x, round(cast(max(x) * 16 + 16 + 0.05 as double), 6) max_x, round(cast(min(y) * 16 - 0.05 as double), 6) min_z, round(cast(max(y) * 16 + 16 + 0.05 as double), 6) max_z
  from (select c_nationkey, c_custkey % 300 - 150 x, c_custkey * 7 % 300 - 150 y from {customer}) c group by 1""")
def scene_planes(v):
    p = G.parcel(F.concat((F.col("c_custkey") % 300 - 150).cast("string"), F.lit(","), (F.col("c_custkey") * 7 % 300 - 150).cast("string")))
    out = v.customer.select(F.col("c_nationkey").alias("scene"), p.alias("p")).groupBy("scene").agg(*G.scene_plane(F.col("p.x"), F.col("p.y")))
    return out.select("scene", *[F.round(c, 6).alias(c) for c in ("min_x", "max_x", "min_z", "max_z")])


@query("select o_custkey scene, count(*) parcels, round(log2(count(*) + 1.0) * 20, 6) height from {orders} group by 1")
def scene_height(v):
    return v.orders.groupBy(F.col("o_custkey").alias("scene")).agg(F.count("*").alias("parcels")).withColumn("height", F.round(G.scene_height(F.col("parcels")), 6))


#: Pairs of a task, and the longest lists of parts and suppliers that are placed together.
PAIRS, PARTS, SUPPLIERS = 1 << 26, 512, 256


@query("""select p_partkey, s_suppkey, coalesce(round(cast(s_nationkey + p_size * 2.0 as double), 6), 0) x, coalesce(round(cast(0.0 - p_size as double), 6), 0) y, coalesce(round(cast(1.0 * s_nationkey * 3 as double), 6), 1) sx from {part} p left join {supplier} s on s_suppkey % 50 = p_partkey % 60""")
def placement(v):
    vec = lambda x, y, z: F.struct(x.alias("x"), y.alias("y"), z.alias("z"))
    zero, one = F.lit(0.0), F.lit(1.0)
    lists = lambda c, most: F.transform(F.sequence(F.lit(0), F.floor((F.size(c) - 1) / most).cast("int")), lambda i: F.slice(c, i * most + 1, most))
    k_s, k_p = (F.col("s_suppkey") % 50).alias("k"), (F.col("p_partkey") % 60).alias("k")
    # Suppliers of one nation place parts of one size alike: a list of each is placed at once, and a pair costs no more than its row.
    s = v.supplier.groupBy(k_s, "s_nationkey").agg(F.sort_array(F.collect_list("s_suppkey")).alias("all")).select("k", "s_nationkey", F.explode(lists("all", SUPPLIERS)).alias("suppliers"))
    s = s.groupBy("k").agg(F.sort_array(F.collect_list(F.struct("s_nationkey", "suppliers"))).alias("nations"))
    p = v.part.groupBy(k_p, "p_size").agg(F.sort_array(F.collect_list(F.struct("p_partkey"))).alias("all")).select("k", "p_size", F.posexplode(lists("all", PARTS)).alias("n", "parts"))
    # Tasks grow with the pairs, which are the square of the input.  Each has its own few keys, and lists one after the other: the same suppliers again and again, which files hold as next to nothing.
    pairs = v.part.groupBy(k_p).agg(F.count("*").alias("a")).join(v.supplier.groupBy(k_s).agg(F.count("*").alias("b")), "k").agg(F.sum(F.col("a") * F.col("b"))).first()[0] or 0
    n_parts = max(int(v.spark.conf.get("spark.sql.shuffle.partitions")), 64, -(-pairs // PAIRS))
    # A stage holds all rows that come of one of its own before it hands them on, so each of the three steps is one, which coalesce() without effect sees to.
    step = lambda df: df.coalesce(n_parts)
    j = p.repartitionByRange(n_parts, "k", "p_size", "n").join(F.broadcast(s), "k", "left").select("parts", "p_size", F.explode_outer("nations").alias("n")).select("parts", "p_size", "n.s_nationkey", "n.suppliers")
    quarter = F.struct(zero.alias("x"), zero.alias("y"), F.lit(-(0.5**0.5)).alias("z"), F.lit(0.5**0.5).alias("w"))
    rest = F.struct(zero.alias("x"), zero.alias("y"), zero.alias("z"), one.alias("w"))
    n = F.col("s_nationkey").cast("double")
    t = G.place(vec(n, zero, zero), quarter, vec(n, n, n), vec(F.col("p_size").cast("double"), F.col("p_size") * 2.0, zero), rest, vec(F.lit(3.0), one, one))
    placed = step(j).select("parts", "suppliers", t.alias("t")).select("suppliers", F.explode("parts").alias("part"), *[F.coalesce(F.round(c, 6), F.lit(d)).alias(n) for c, d, n in (("t.position.x", 0.0, "x"), ("t.position.y", 0.0, "y"), ("t.scale.x", 1.0, "sx"))])
    return step(placed).select("part.p_partkey", F.explode_outer("suppliers").alias("s_suppkey"), "x", "y", "sx")


PIXELS = "select vec_id image, label, embedding from {embeddings}"


@query("""with px as (select vec_id, label, unnest(range(1, len(embedding) + 1)) pos, embedding from {embeddings}), p as (select vec_id, label, pos, cast(floor(embedding[pos] * 127 + 128) as bigint) g from px)
  select a.vec_id image, count(*) n, (count(*) - count(*) filter (where abs(a.g - b.g) >= 9)) * 100 // count(*) affinity, (count(*) - count(*) filter (where abs(a.g - b.g) >= 9)) * 100 // count(*) >= 95 valid
  from p a join p b on b.pos = a.pos and b.vec_id = a.vec_id - a.vec_id % 10 group by 1""")
def image_affinity(v):
    # In single precision, as the components are: in double precision a value just below a whole number would stay below it.
    single = lambda n: F.lit(n).cast("float")
    px = v.embeddings.select("vec_id", F.posexplode("embedding").alias("pos", "x")).select("vec_id", "pos", F.floor(F.col("x") * single(127) + single(128)).alias("g"))
    gray = F.struct(F.col("g").alias("r"), F.col("g").alias("g"), F.col("g").alias("b"))
    a = px.select("vec_id", "pos", (F.col("vec_id") - F.col("vec_id") % 10).alias("base"), gray.alias("a"))
    b = px.where(F.col("vec_id") % 10 == 0).select(F.col("vec_id").alias("base"), "pos", gray.alias("b"))
    out = a.join(b, ["base", "pos"]).groupBy(F.col("vec_id").alias("image")).agg(F.count("*").alias("n"), F.count_if(~G.same_pixel(F.col("a"), F.col("b"))).alias("d"))
    return out.select("image", "n", G.affinity(F.col("n"), F.col("d")).alias("affinity")).withColumn("valid", F.col("affinity") >= 95)


@query("""select source texture, bit_or(case when quality = 1 then 1 else 0 end | case when toxic = 1 then 2 else 0 end | case when d.doc_id % 5 = 0 then 4 else 0 end) flags, bool_and(quality = 1) only_normal
  from {labels} l join {documents} d on d.doc_id = l.doc_id group by 1""")
def usage_flags(v):
    bit = lambda c, n: F.when(c, n).otherwise(0)
    flag = bit(F.col("quality") == 1, 1).bitwiseOR(bit(F.col("toxic") == 1, 2)).bitwiseOR(bit(F.col("doc_id") % 5 == 0, 4))
    rows = v.labels.join(v.documents.select("doc_id", "source"), "doc_id").select(F.col("source").alias("texture"), flag.alias("flag"), (F.col("quality") == 1).alias("is_normal"))
    return A.usage_flags(rows)


@query("""select o_custkey customer, count(*) total, count(*) filter (where o_orderstatus = 'F') failed, count(*) filter (where o_orderstatus = 'F') <= round_even(cast(count(*) * 0.25 as double), 0) ok from {orders} group by 1""")
def tolerance(v):
    g = v.orders.groupBy(F.col("o_custkey").alias("customer")).agg(F.count("*").alias("total"), F.count_if(F.col("o_orderstatus") == "F").alias("failed"))
    return g.withColumn("ok", C.tolerated(F.col("total"), F.col("failed"), 0.25))


@query("""with c as (select o_custkey, o_orderkey, case o_orderstatus when 'F' then 0 when 'O' then 12 else 5 end code from {orders}),
  r as (select o_custkey, code, row_number() over (partition by o_custkey order by o_orderkey desc) back from c), z as (select o_custkey, min(back) back from r where code <> 0 group by 1)
  select c.o_custkey customer, max(case when z.back is null then 0 when r.code = 12 then 12 when z.back = 1 then r.code else 0 end) code from (select distinct o_custkey from c) c left join z on z.o_custkey = c.o_custkey left join r on r.o_custkey = z.o_custkey and r.back = z.back group by 1""")
def sticky_error(v):
    code = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 12).otherwise(5)
    g = v.orders.groupBy(F.col("o_custkey").alias("customer")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", code.alias("code")))).alias("codes"))
    return g.select("customer", C.sticky_code(F.transform("codes", lambda x: x["code"])).alias("code"))


@query("select conv_id, turn, role, regexp_extract(text, '([^/]*)$', 1) last_part from {conversations} where coalesce(text, '') <> ''")
def nested_flatten(v):
    c = v.conversations
    nested = c.groupBy("conv_id", "turn").agg(F.collect_list(F.struct(F.col("role").alias("file"), F.col("text").alias("url"))).alias("contents"))
    nested = nested.groupBy("conv_id").agg(F.collect_list(F.struct("turn", "contents")).alias("representations"))
    w = nested.select(F.array(F.struct(F.col("conv_id").alias("id"), F.col("representations"))).alias("wearables"))
    flat = w.select(F.explode("wearables").alias("w")).select(F.col("w.id").alias("conv_id"), F.explode("w.representations").alias("r")).select("conv_id", "r.turn", F.explode("r.contents").alias("c"))
    return flat.where(F.coalesce("c.url", F.lit("")) != "").select("conv_id", "turn", F.col("c.file").alias("role"), F.element_at(F.split("c.url", "/"), -1).alias("last_part"))


PATHS = "select regexp_replace(url, '^[a-z]+://', '') path, length(html) size from {pages}"


@query(f"""with p as (select string_split(path, '/') parts, size from ({PATHS}) x), f as (select unnest(case when len(parts) > 1 then list_concat([''], list_transform(range(1, least(len(parts) - 1, 2) + 1), lambda n: array_to_string(parts[1:n], '/'))) else [''] end) folder, size from p)
  select folder, sum(size)::bigint bytes, count(*) files from f group by 1""")
def dir_sizes(v):
    return A.directory_sizes(v.sql(PATHS))


#: (reference, path or null, error or null), of the container dir/<n>/m.glb; @ stands for n.
URI_CASES = (
    ("a%20b.png", "dir/@/a b.png", None),
    ("./tex/c.png", "dir/@/tex/c.png", None),
    ("../t.png", "dir/t.png", None),
    ("x//y/../z.png", "dir/@/x/z.png", None),
    ("a+b.png", "dir/@/a+b.png", None),
    ("%C3%A9/", "dir/@/é/", None),
    ("../..", ".", None),
    ("", None, "empty"),
    ("https://x.org/a.png", None, "scheme"),
    ("//x.org/a.png", None, "protocol"),
    ("/abs.png", None, "absolute"),
    ("q.png?x=1", None, "query"),
    ("q.png#x", None, "query"),
    ("a%2.png", None, "percent"),
    ("%FF.png", None, "percent"),
    ("../../../a.png", None, "escape"),
)
URI_ROWS = ", ".join(f"({i}, {'null' if p is None else repr(p)}, {'null' if e is None else repr(e)})" for i, (_, p, e) in enumerate(URI_CASES))


@query(f"select page_id, replace(path, '@', cast(page_id % 5 as varchar)) resolved, error from {{pages}} join (values {URI_ROWS}) c(i, path, error) on c.i = page_id % {len(URI_CASES)}")
def uri_resolve(v):
    uri = F.get(F.array(*[F.lit(u) for u, _, _ in URI_CASES]), (F.col("page_id") % len(URI_CASES)).cast("int"))
    glb = F.concat(F.lit("dir/"), (F.col("page_id") % 5).cast("string"), F.lit("/m.glb"))
    r = G3.resolve_uri(uri, glb)
    return v.pages.select("page_id", r["resolved"].alias("resolved"), r["error"].alias("error"))


@query("""select pk, case when version = 2 and json_valid(doc) and doc <> 'null' then array_to_string(list_sort(list_distinct(list_filter(coalesce(json_extract_string(doc, '$.*[*].uri'), []), lambda u: not starts_with(u, 'data:')))), '|') end uris,
  case when version <> 2 then 'version: 0x1' when not json_valid(doc) then 'json' when doc = 'null' then 'root: null' end error from {v_containers}""")
def gltf_parse(v):
    return _parsed(v).join(v.v_containers.select("hash", "pk"), "hash").select("pk", F.array_join("uris", "|").alias("uris"), "error")


@query("""select concat('h', cast(pk as varchar), '.glb') name, 20 + strlen(doc) bytes_read, 20 + strlen(doc) + 8 + 4096 length,
  len(list_distinct(list_filter(coalesce(json_extract_string(doc, '$.*[*].uri'), []), lambda u: not starts_with(u, 'data:')))) n_uris from {v_containers} where version = 2 and json_valid(doc) and doc <> 'null' and pk % 8 = 4""")
def glb_prefix_scan(v):
    """Containers written as files with a long binary chunk, and read again up to the end of their JSON."""
    folder = shared_folder(v.spark, "containers")
    body = F.repeat(F.lit("x"), 4096).cast("binary")
    files = v.v_containers.where("pk % 8 = 4").select(F.concat("hash", F.lit(".glb")).alias("name"), G3.glb_content(F.col("doc"), F.col("version"), body).alias("content"))
    G3.write_files(files, folder)
    found = G3.glb_prefixes(v.spark, folder).where(F.col("length") > 4096)
    refs = G3.parse_refs(F.col("prefix"), F.lit(".glb"))
    out = found.select(F.element_at(F.split("path", "/"), -1).alias("name"), "bytes_read", "length", refs.alias("r"))
    return out.where(F.col("r.error").isNull()).select("name", "bytes_read", "length", F.size("r.uris").cast("long").alias("n_uris"))


#: What a probe says of a job that is neither forced nor ISS.
UNFORCED = OUTCOME.replace("e.entity_id % 7 <> 0", "true").replace("e.entity_id % 7 = 0", "false")


@query(f"""select lane, route, count(*) n, min(job_id) first_job from (select job_id, case when force then 'priority' else 'standard' end lane, case when j.entity_id is null or (job_id % 101 = 0 and not lods) or (job_id % 101 <> 0 and job_id % 103 = 0) then 'dropped'
  when lods or force or iss or coalesce(r.triage, 'needs-unity') = 'needs-unity' then 'conversion' when r.triage = 'failed' then 'failed' else 'fast_path' end route
  from {{v_jobs}} j left join ({UNFORCED}) o on o.entity_id = j.entity_id left join {RESULT_TABLE} on r.outcome = o.outcome) t group by 1, 2""")
def stream_triage(v):
    from assetweave.streaming.triage import run_once

    return run_once(v, _facts(v))


@query("""select lane, late, count(*) jobs, case when lane = 'priority' then 1 + late::bigint else 3 + late::bigint end place
  from (select case when force then 'priority' else 'standard' end lane, job_id % 3 = 0 late from {v_jobs}) j group by 1, 2""")
def stream_lanes(v):
    """Jobs as messages of two queues: late ones of the priority queue pass the standard work that was there before."""
    from assetweave.streaming.lanes import run_lanes

    return run_lanes(v.spark, v.v_jobs.withColumn("ts", F.col("ts").cast("timestamp")), F.col("job_id") % 3 == 0)


ROUTED = f"""select job_id, coalesce(lods, false) lods, case when force then 'priority' else 'standard' end lane, o.outcome, r.triage_exit, case when j.entity_id is null or (job_id % 101 = 0 and not lods) or (job_id % 101 <> 0 and job_id % 103 = 0) then 'dropped'
  when lods or force or iss or coalesce(r.triage, 'needs-unity') = 'needs-unity' then 'conversion' when r.triage = 'failed' then 'failed' else 'fast_path' end route
  from {{v_jobs}} j left join ({UNFORCED}) o on o.entity_id = j.entity_id left join {RESULT_TABLE} on r.outcome = o.outcome"""


@query(f"""select * from (with t as ({ROUTED}), m as (select 'job_queue_enqueue_total' metric, 'triage' label, count(*) value from t
  union all select 'job_queue_enqueue_total', 'conversion', count(*) from t where route = 'conversion'
  union all select 'ab_converter_conversion_queue_publish_total', lane, count(*) from t where route = 'conversion' group by lane
  union all select 'ab_converter_triage_outcomes_total', case when route = 'failed' then 'failed' when route = 'conversion' then 'republished' when outcome = 'full-hit' then 'fast_path' else 'already_converted' end, count(*) from t where route <> 'dropped' and not lods group by 2
  union all select 'ab_converter_asset_reuse_short_circuit_total', 'windows', count(*) from t where route = 'fast_path' and outcome = 'full-hit'
  union all select 'ab_converter_exit_codes', '0', count(*) from t where route = 'fast_path' and outcome = 'full-hit'
  union all select 'ab_converter_exit_codes', 'FAIL', count(*) from t where route = 'failed') select * from m where value > 0) w""")
def stream_metrics(v):
    """Counters collected while all jobs go through triage and conversion."""
    from assetweave.streaming.lanes import run_metrics
    from assetweave.streaming.triage import addressed

    return run_metrics(v.spark, addressed(v.v_jobs.withColumn("ts", F.col("ts").cast("timestamp"))), _facts(v))


@query("""select e.entity_id, e.base, case when e.entity_id % 3 = 0 then a.p else f.p end at_arrival, a.p previous from {v_entities} e
  left join (select x.entity_id, arg_max(y.entity_id, [epoch_ms(y.ts::timestamp)::varchar, y.entity_id::varchar]) p from {v_entities} x join {v_entities} y on x.base = y.base and x.entity_id <> y.entity_id and y.type = 'scene' group by 1) a on a.entity_id = e.entity_id
  left join (select x.entity_id, arg_max(y.entity_id, [epoch_ms(y.ts::timestamp)::varchar, y.entity_id::varchar]) p from {v_entities} x join {v_entities} y on x.base = y.base and x.entity_id <> y.entity_id and y.type = 'scene' and y.entity_id % 3 <> 0 group by 1) f on f.entity_id = e.entity_id
  where e.type = 'scene'""")
def stream_changes(v):
    """The deployments as a feed in two parts: each one's previous deployment when it arrived and at the end."""
    from assetweave.streaming.changes import run_changes

    number = lambda c: F.col(c).cast("long").alias(c)
    out = run_changes(v.spark, v.v_entities, F.col("entity_id") % 3 == 0, shared_folder(v.spark, "changes"))
    return out.select(number("entity_id"), number("base"), number("at_arrival"), number("previous"))


@query("select entity_id, count(*) - 1 hits, 1 probes from {v_jobs} group by 1")
def stream_ttl(v):
    from assetweave.streaming.ttl import run_once

    return run_once(v)


@query("""select c.hash, case when e.error is null then count(*) - 1 else 0 end hits, case when e.error is null then 1 else count(*) end misses,
  case when e.error is null then array_to_string(list_sort(list_distinct(list_filter(coalesce(json_extract_string(any_value(e.doc), '$.*[*].uri'), []), lambda u: not starts_with(u, 'data:')))), '|') end uris, e.error
  from {v_content} c join (select hash, doc, case when version <> 2 then 'version: 0x1' when not json_valid(doc) then 'json' when doc = 'null' then 'root: null' end error from {v_containers}) e on e.hash = c.hash group by c.hash, e.error""")
def stream_uri_lists(v):
    """Every entity's containers as they arrive: known ones are not parsed again."""
    from assetweave.streaming.ttl import run_lists

    bytes_ = v.v_containers.select("hash", G3.glb_content(F.col("doc"), F.col("version")).alias("content"), F.lit(".glb").alias("ext"))
    arrived = v.v_content.select(F.col("entity_id").alias("n"), "hash").join(bytes_, "hash")
    out = run_lists(v.spark, arrived)
    return out.withColumn("uris", F.array_join(F.from_json("uris", "array<string>"), "|"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda f: lambda spark, folder: f(Views(spark, folder)))(f) for name, f in QUERIES.items()}
