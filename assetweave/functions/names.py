"""Extensions, classes and content-addressed names, as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The extension classes.
BUFFER_EXT = (".bin",)
GLTF_EXT = (".glb", ".gltf")
TEXTURE_EXT = (".jpg", ".png", ".jpeg", ".tga", ".gif", ".bmp", ".psd", ".tiff", ".iff", ".ktx")
PROBE_EXT = GLTF_EXT + TEXTURE_EXT
DEP_EXT = BUFFER_EXT + TEXTURE_EXT
THUMBNAIL = r"(?i)(?:^|/)autogenerated-thumbnail\.png$"
TARGETS = ("windows", "mac")
# Texture slots with their flags, texture properties of a material, compressed formats.
SLOT_FLAGS = {"_MainTex": 1, "_BaseMap": 2, "_BumpMap": 4, "_MetallicGlossMap": 8, "_ParallaxMap": 16, "_OcclusionMap": 32, "_EmissionMap": 64, "_SpecGlossMap": 128}
BASE_PROPERTIES, NORMAL_PROPERTIES, METALLIC_PROPERTIES = ("_BaseMap", "baseColorTexture"), ("_BumpMap", "normalTexture"), ("_MetallicGlossMap", "metallicRoughnessTexture")
COMPRESSED_FORMATS = ("DXT1", "DXT5", "BC7", "ETC_RGB4", "ETC2_RGB", "ETC2_RGBA8", "ASTC_4x4", "ASTC_5x5", "ASTC_6x6", "ASTC_8x8", "ASTC_10x10", "ASTC_12x12")
DIGEST_CHARS = 32
MAX_DETAIL = 256


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def extension(file: Column) -> Column:
    """Lower-case text from the last dot of the whole path, '' without one."""
    # Not a pattern: this is asked of every file, several times.
    return F.when(file.contains("."), F.lower(F.concat(F.lit("."), F.substring_index(file, ".", -1)))).when(file.isNotNull(), F.lit(""))


def extension_class(file: Column) -> Column:
    e = extension(file)
    return F.when(e.isin(*GLTF_EXT), "gltf").when(e.isin(*TEXTURE_EXT), "texture").when(e.isin(*BUFFER_EXT), "buffer").otherwise("other")


def has_valid_extension(file: Column) -> Column:
    return extension(file).isin(*GLTF_EXT, *TEXTURE_EXT, *BUFFER_EXT)


def is_gltf(file: Column) -> Column:
    return extension(file).isin(*GLTF_EXT)


def is_probed(file: Column) -> Column:
    return extension(file).isin(*PROBE_EXT)


def is_skippable(file: Column) -> Column:
    return is_gltf(file)


def is_dependency(file: Column) -> Column:
    return extension(file).isin(*DEP_EXT)


def ends_with_any(file: Column, suffixes: list[str]) -> Column:
    """Suffix semantics: not only what follows the last dot."""
    return F.exists(F.array(*[F.lit(s) for s in suffixes]), lambda s: F.lower(file).endswith(s))


def is_metadata_only(file: Column) -> Column:
    # Few files get as far as the pattern.
    return F.lower(file).contains("autogenerated-thumbnail.png") & file.rlike(THUMBNAIL)


def json_digest(pairs: Column) -> Column:
    """32 hex digits of the SHA-256 of ``[[file,hash],...]`` over an array of structs (file, hash), sorted: order of arrival doesn't matter.

    The order is that of UTF-16 code units, and control characters are escaped in lower-case hex, both as in JavaScript.
    """
    units = lambda c: F.hex(F.encode(c, "UTF-16BE"))
    keyed = F.transform(pairs, lambda e: F.struct(units(e["file"]).alias("f"), units(e["hash"]).alias("h"), e["file"].alias("file"), e["hash"].alias("hash")))
    # Plain ASCII, as nearly all is, needs no pattern.
    beyond = lambda c: (F.octet_length(c) > F.char_length(c)) & c.rlike(r"[\x{10000}-\x{10FFFF}]")
    # Without characters beyond the basic plane the order of UTF-8 is that of UTF-16.
    odd = F.exists(pairs, lambda e: beyond(e["file"]) | beyond(e["hash"]))
    tuples = lambda rows: F.transform(F.sort_array(rows), lambda e: F.array(e["file"], e["hash"]))

    def escaped(text: Column) -> Column:
        low = text
        for big in "ABCDEF":
            # Behind an even number of backslashes only: else it is a backslash and plain text.
            low = F.regexp_replace(low, rf"(?<!\\)((?:\\\\)*)\\u00([01]){big}", rf"$1\\u00$2{big.lower()}")
        return F.when(text.contains("\\u00"), low).otherwise(text)

    text = bound(F.to_json(F.when(odd, tuples(keyed)).otherwise(tuples(pairs))), escaped)
    return F.substring(F.sha2(text, 256), 1, DIGEST_CHARS)


def canonical_name(hash_: Column, file: Column, digest: Column, target: Column) -> Column:
    """hash_digest_target for glTF (an error without a digest), hash_target for all else."""
    missing = F.raise_error(F.concat(F.lit("no digest for "), hash_))
    with_digest = F.when(digest.isNull(), missing.cast("string")).otherwise(F.concat(hash_, F.lit("_"), digest, F.lit("_"), target))
    return F.when(is_gltf(file), with_digest).otherwise(F.concat(hash_, F.lit("_"), target))


def canonical_key(version: Column, name: Column) -> Column:
    return F.concat(version, F.lit("/assets/"), name)


def manifest_key(entity: Column, target: Column) -> Column:
    return F.when(target.isNull(), F.concat(F.lit("manifest/"), entity, F.lit(".json"))).otherwise(F.concat(F.lit("manifest/"), entity, F.lit("_"), target, F.lit(".json")))


def null_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def parse_manifest_key(key: Column) -> Column:
    """(entity_id, target) of manifest/<id>_<target>.json; null for sentinels and others; ids may hold '_'."""
    pattern = r"^manifest/(.+)_(windows|mac)\.json$"
    return F.when(key.rlike(pattern), F.struct(F.regexp_extract(key, pattern, 1).alias("entity_id"), F.regexp_extract(key, pattern, 2).alias("target")))


def split_bundle(name: Column, target: str) -> Column:
    """(hash, variant) of a bundle of ``target``; null for composite names."""
    pattern = rf"^([^_]+)_{target}(\.br|\.manifest|\.manifest\.br)?$"
    return F.when(name.rlike(pattern), F.struct(F.regexp_extract(name, pattern, 1).alias("hash"), F.regexp_extract(name, pattern, 2).alias("variant")))


def is_bundle(name: Column, target: str) -> Column:
    return name.rlike(rf"^[^/]+_{target}(\.br|\.manifest|\.manifest\.br)?$")


def leading_hash(name: Column) -> Column:
    """Text before the first '_' or '.'; null without one or if it is empty."""
    return null_if_empty(F.regexp_extract(name, r"^([^_.]+)[_.]", 1))


def asset_path(hash_: Column, file: Column, base: str = "Assets/_Downloaded/", sep: str = "/") -> Column:
    """Derived paths of a content entry: its file name and folder, its place beside its siblings under its hash, and its place in a folder of its own."""
    file = F.replace(file, F.lit("\\"), F.lit("/"))
    name = F.element_at(F.split(file, "/"), -1)
    folder = F.concat(F.substring(file, F.lit(1), F.greatest(F.char_length(file) - F.char_length(name) - 1, F.lit(0))), F.lit("/"))
    dotted = F.regexp_extract(name, r"(\.[^.]*)$", 1)
    dotted = F.when(dotted == ".", "").otherwise(dotted)
    own = F.concat(F.lit(base), hash_, F.lit(sep))
    return F.struct(
        name.alias("file_name"),
        folder.alias("file_root_path"),
        F.concat(folder, hash_, F.lit("."), F.element_at(F.split(name, r"\."), -1)).alias("hash_path"),
        F.concat(own, hash_, dotted).alias("final_path"),
        own.alias("asset_folder"),
        F.concat(own, hash_, F.lit(".meta")).alias("final_meta_path"),
    )


def content_table_key(path: Column) -> Column:
    return F.lower(F.concat(F.lit("/"), path))


def platform_suffix(target: Column) -> Column:
    return F.concat(F.lit("_"), target)


def without_platform(name: Column) -> Column:
    """Every occurrence of a platform suffix goes."""
    return F.replace(F.replace(name, F.lit("_windows"), F.lit("")), F.lit("_mac"), F.lit(""))


def lod_bundle_name(file: Column, target: Column) -> Column:
    stem = F.regexp_replace(F.element_at(F.split(file, "/"), -1), r"\.[^.]*$", "")
    return F.concat(F.lower(stem), F.lit("_"), target)


def lod_level(file: Column) -> Column:
    return F.try_to_number(null_if_empty(F.regexp_extract(file, r"[^_]+_(\d+)_[^_]+", 1)), F.lit("999999")).cast("int")


def lod_hash(file: Column) -> Column:
    return F.substring_index(file, "_", 1)


def asset_guid(cid: Column) -> Column:
    return F.md5(cid.cast("binary"))


def rewrite_guid(meta: Column, cid: Column) -> Column:
    return F.regexp_replace(meta, F.lit(r"guid: \w+"), F.concat(F.lit("guid: "), asset_guid(cid)))


def nicify(name: Column) -> Column:
    """Characters that paths and bundles can't hold become '_'; an empty name is 'unnamed'."""
    clean = F.regexp_replace(name, r'[\x00-\x1f"<>|:*?\\/ .¿]', "_")
    return F.when(F.coalesce(clean, F.lit("")) == "", "unnamed").otherwise(clean)


def patch_file_name(name: Column) -> Column:
    return F.translate(name, ":|", "__")


def without_space(c: Column) -> Column:
    return F.regexp_replace(c, r"\s+", "")


def mime_type(file: Column) -> Column:
    """By the end of the name, letter case kept."""
    return F.when(file.endswith(".js"), "application/javascript").when(file.endswith(".json"), "application/json").otherwise("application/octet-stream")


def skip_detail(text: Column, most: int = MAX_DETAIL) -> Column:
    """Control characters become spaces; longer text is cut and marked."""
    clean = F.regexp_replace(text, r"[\x00-\x1f\x7f]", " ")
    return F.when(F.char_length(clean) > most, F.concat(F.substring(clean, 1, most), F.lit("…"))).otherwise(clean)


def url_encoded_key(key: Column) -> Column:
    """Percent-encoded but for '/' and the marks that a URI component keeps."""
    out = F.replace(F.url_encode(key), F.lit("+"), F.lit("%20"))
    for mark in "/!'()~":
        out = F.replace(out, F.lit(f"%{ord(mark):02X}"), F.lit(mark))
    return out


def is_glb(content: Column) -> Column:
    """Empty bytes count as GLB, else the magic number decides."""
    return (F.octet_length(content) == 0) | (F.hex(F.substring(content, 1, 4)) == "676C5446")


def name_from_url(url: Column, stamp: Column) -> Column:
    """Base name of a URL's path, a stamped name if blank, with '.glb' unless it is glTF."""
    base = F.element_at(F.split(F.regexp_replace(url, r"[?#].*$", ""), "/"), -1)
    named = F.when(F.trim(base) == "", F.concat(F.lit("asset_"), stamp)).otherwise(base)
    return F.when(is_gltf(named), named).otherwise(F.concat(named, F.lit(".glb")))


def is_emote_file(file: Column) -> Column:
    return file.endswith("_emote.glb")


def same_name(a: Column, b: Column) -> Column:
    """Equal, letter case aside."""
    return F.lower(a) == F.lower(b)


def is_ignored_lod(bundle: Column) -> Column:
    return bundle.contains("_ignore")


def slot_flag(slot: Column) -> Column:
    """The flag of a texture slot, 0 for an unknown one."""
    table = F.create_map(*[F.lit(x) for kv in SLOT_FLAGS.items() for x in kv])
    return F.coalesce(F.try_element_at(table, slot), F.lit(0))


def property_class(name: Column) -> Column:
    return F.when(name.isin(*BASE_PROPERTIES), "base").when(name.isin(*NORMAL_PROPERTIES), "normal").when(name.isin(*METALLIC_PROPERTIES), "metallic")


def is_compressed(texture_format: Column) -> Column:
    return texture_format.isin(*COMPRESSED_FORMATS)


def rebuilt_path(url: Column, hash_: Column, root: Column) -> Column:
    """Where a container's dependency lies: its folder, and what follows the container's hash and one more character in the request."""
    rest = F.substring(url, F.position(hash_, url) + F.char_length(hash_) + 1, F.char_length(url))
    return F.replace(F.concat(root, rest), F.lit("\\"), F.lit("/"))


def with_separator(path: Column, sep: str = "/") -> Column:
    return F.translate(path, "/\\", sep * 2)


def project_path(full: Column) -> Column:
    """From the first folder Assets on; the whole path if there is none."""
    path = with_separator(full)
    found = F.regexp_extract(path, r"^.*?/(Assets/.*)$", 1)
    return F.when(found == "", path).otherwise(found)


def full_path(asset: Column, data: Column) -> Column:
    return F.concat(F.replace(with_separator(data), F.lit("/Assets"), F.lit("")), F.lit("/"), with_separator(asset))
