"""Entity, manifest and event sources: JSON documents as typed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assetweave import model as M


def entities(spark: SparkSession, path: str) -> DataFrame:
    """Entity documents; extra fields are ignored, a missing id is the file's name."""
    df = spark.read.schema(M.ENTITY).json(path)
    name = F.regexp_replace(F.element_at(F.split(F.col("_metadata.file_name"), "/"), -1), r"\.json$", "")
    return df.withColumn("id", F.coalesce("id", name))


def by_id(table: DataFrame, entity_id: str) -> DataFrame:
    """Point lookup; ids that are not alphanumeric are refused."""
    if not entity_id.isalnum() or not entity_id.isascii():
        raise ValueError(f"bad entity id {entity_id!r}")
    return table.where(F.col("id") == entity_id)


def by_pointers(table: DataFrame, pointers: DataFrame) -> DataFrame:
    """Entities that hold any of the pointers."""
    wanted = table.select("id", F.explode("pointers").alias("pointer")).join(pointers.select("pointer").distinct(), "pointer", "left_semi")
    return table.join(wanted.select("id").distinct(), "id", "left_semi")


def mapping_of(body: Column, entity_id: Column) -> Column:
    """The content of a fetched document: itself one binary file if it is a glTF container, else its content list."""
    one = F.array(F.struct(F.concat(entity_id, F.lit(".glb")).alias("file"), entity_id.alias("hash")))
    return F.when(body.startswith("glTF"), one).otherwise(F.from_json(F.get_json_object(body, "$.content"), M.CONTENT))


def empty_scenes(mapping: DataFrame, column: str) -> DataFrame:
    """map<scene, pairs> flattened to pairs."""
    return mapping.select(F.explode(column).alias("scene", "pairs")).select("scene", F.explode("pairs").alias("p")).select("scene", "p.file", "p.hash")


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """Manifests by key; a file that can't be parsed is a row of nulls and counts as not converted."""
    df = spark.read.schema(M.MANIFEST + ", _corrupt_record STRING").option("columnNameOfCorruptRecord", "_corrupt_record").option("multiLine", "true").json(path)
    return df.withColumn("key", F.regexp_extract(F.col("_metadata.file_path"), r"(manifest/[^/]+\.json)$", 1))


def list_keys(spark: SparkSession, folder: str, glob: str = "*.json") -> DataFrame:
    """Keys and lengths under a folder, without reading contents."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder).select("path", "length", "modificationTime")


def whole_files(spark: SparkSession, folder: str, glob: str, most: int = 256 << 20) -> DataFrame:
    """Contents of files up to a size; larger ones come as null with their length.  Spark's reader lists no empty files."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder)
    # Both filters reach the source, which doesn't open what is larger.
    larger = df.where(F.col("length") > most).select("path", "length", F.lit(None).cast("binary").alias("content"))
    return df.where(F.col("length") <= most).select("path", "length", "content").unionByName(larger)


def lod_urls(setting: Column) -> Column:
    return F.filter(F.transform(F.split(setting, ";"), lambda x: F.trim(x)), lambda u: u != "")


def digest_sidecar(text: Column) -> Column:
    """hash to digest; malformed text is an error, not an empty map."""
    return F.from_json(text, "map<string,string>", {"mode": "FAILFAST"})


def descriptor(text: Column) -> Column:
    """Static scene descriptor, or null where it is missing, malformed or empty: then the feature is off."""
    d = F.from_json(text, M.DESCRIPTOR)
    return F.when(F.size(d["assets"]) > 0, d)
