"""The record types of the engine as Spark schemas."""

from __future__ import annotations

CONTENT = "ARRAY<STRUCT<file: STRING, hash: STRING>>"
ENTITY = f"id STRING, version STRING, type STRING, pointers ARRAY<STRING>, timestamp BIGINT, content {CONTENT}, metadata STRING"
MANIFEST = "version STRING, files ARRAY<STRING>, exitCode INT, contentServerUrl STRING, date STRING"
JOB = "entity STRUCT<entityId: STRING>, contentServerUrls ARRAY<STRING>, lods ARRAY<STRING>, force BOOLEAN, doISS BOOLEAN, animation STRING, prioritize BOOLEAN, type STRING, subType STRING"
FINISHED_EVENT = "type STRING, subType STRING, key STRING, timestamp BIGINT, metadata STRUCT<platform: STRING, entityId: STRING, isLods: BOOLEAN, isWorld: BOOLEAN, statusCode: INT, version: STRING>"
GLTF_REFS = "STRUCT<uris: ARRAY<STRING>, error: STRING>"
WEARABLES = "ARRAY<STRUCT<id: STRING, representations: ARRAY<STRUCT<contents: ARRAY<STRUCT<file: STRING, url: STRING>>>>>>"
DESCRIPTOR = "sceneId STRING, assets ARRAY<STRUCT<hash: STRING, position: STRUCT<x: DOUBLE, y: DOUBLE, z: DOUBLE>, rotation: STRUCT<x: DOUBLE, y: DOUBLE, z: DOUBLE, w: DOUBLE>, scale: STRUCT<x: DOUBLE, y: DOUBLE, z: DOUBLE>>>"

# Exit codes of a conversion, by their number.
ERROR_NAMES = (
    "SUCCESS UNDEFINED SCENE_LIST_NULL ASSET_BUNDLE_BUILD_FAIL VISUAL_TEST_FAILED UNEXPECTED_ERROR GLTFAST_CRITICAL_ERROR GLTF_IMPORTER_NOT_FOUND "
    "EMBED_MATERIAL_FAILURE DOWNLOAD_FAILED INVALID_PLATFORM GLTF_PROCESS_MISMATCH CONVERSION_ERRORS_TOLERATED ALREADY_CONVERTED"
).split()
OK, LIST_EMPTY, UNEXPECTED, TOLERATED, ALREADY = 0, 2, 5, 12, 13

#: Job seconds; the last bucket of the histogram is open.
HISTOGRAM_BUCKETS = (1, 10, 100, 200, 300, 400, 500, 600, 700, 1000, 1200, 1600, 1800, 3600)
