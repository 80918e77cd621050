"""Column functions and small operators on literal cases."""

import pytest
from pyspark.sql import functions as F

from assetweave.functions import geometry as G
from assetweave.functions import jobs as J
from assetweave.functions import names as N
from assetweave.operators import assets as A
from assetweave.operators import control as C
from assetweave.operators import sinks as S
from assetweave.sources import records as R

L = F.lit


def null():
    return F.lit(None).cast("string")


def then():
    return F.to_timestamp(F.lit("2024-01-01 00:00:00"))


def words(*x):
    return F.array(*[F.lit(v) for v in x])


def xyz(x, y, z):
    return F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"), F.lit(float(z)).alias("z"))


CASES = {
    "extension": (lambda: N.extension(L("a.b/C.PNG")), ".png"),
    "extension of a dotted folder": (lambda: N.extension(L("a.b/c")), ".b/c"),
    "no extension": (lambda: N.extension(L("abc")), ""),
    "valid extension": (lambda: N.has_valid_extension(L("x.KTX")), True),
    "other extension": (lambda: N.has_valid_extension(L("x.json")), False),
    "suffixes": (lambda: N.ends_with_any(L("a_EMOTE.glb"), ["_emote.glb"]), True),
    "metadata only": (lambda: N.is_metadata_only(L("x/AutoGenerated-thumbnail.png")), True),
    "not metadata only": (lambda: N.is_metadata_only(L("xautogenerated-thumbnail.png")), False),
    "manifest key": (lambda: N.manifest_key(L("e"), L("mac")), "manifest/e_mac.json"),
    "manifest key without target": (lambda: N.manifest_key(L("e"), null()), "manifest/e.json"),
    "parsed key": (lambda: N.parse_manifest_key(L("manifest/a_b_windows.json"))["entity_id"], "a_b"),
    "failed sentinel's key": (lambda: N.parse_manifest_key(L("manifest/a_windows_failed.json")), None),
    "bundle": (lambda: N.split_bundle(L("h_windows.manifest.br"), "windows")["variant"], ".manifest.br"),
    "composite bundle": (lambda: N.split_bundle(L("h_d_windows"), "windows"), None),
    "is a bundle": (lambda: N.is_bundle(L("h_d_windows.br"), "windows"), True),
    "is no bundle": (lambda: N.is_bundle(L("h_mac"), "windows"), False),
    "leading hash": (lambda: N.leading_hash(L("abc.def_x")), "abc"),
    "no leading hash": (lambda: N.leading_hash(L("_x")), None),
    "asset path": (lambda: F.to_json(N.asset_path(L("H"), L("models\\a/My.Tex.PNG"), "D/")), None),
    "content table key": (lambda: N.content_table_key(L("A/B.png")), "/a/b.png"),
    "platform": (lambda: N.without_platform(L("a_windows_b_windows_mac")), "a_b"),
    "lod bundle": (lambda: N.lod_bundle_name(L("x/Abc_1.fbx"), L("mac")), "abc_1_mac"),
    "lod level": (lambda: N.lod_level(L("hash_2_lod")), 2),
    "no lod level": (lambda: N.lod_level(L("hash")), None),
    "lod hash": (lambda: N.lod_hash(L("hash_2_lod")), "hash"),
    "guid": (lambda: N.asset_guid(L("")), "d41d8cd98f00b204e9800998ecf8427e"),
    "new guid": (lambda: N.rewrite_guid(L("a: 1\nguid: 00ff\nb: 2"), L("")), "a: 1\nguid: d41d8cd98f00b204e9800998ecf8427e\nb: 2"),
    "nicify": (lambda: N.nicify(L("a b:c")), "a_b_c"),
    "nicify nothing": (lambda: N.nicify(L("")), "unnamed"),
    "patched name": (lambda: N.patch_file_name(L("a:b|c")), "a_b_c"),
    "no space": (lambda: N.without_space(L(" a\tb ")), "ab"),
    "script": (lambda: N.mime_type(L("bin/a.js")), "application/javascript"),
    "json": (lambda: N.mime_type(L("scene.json")), "application/json"),
    "upper case is another type": (lambda: N.mime_type(L("scene.JSON")), "application/octet-stream"),
    "crdt": (lambda: N.mime_type(L("main.crdt")), "application/octet-stream"),
    "detail": (lambda: N.skip_detail(L("a\tb")), "a b"),
    "long detail": (lambda: F.char_length(N.skip_detail(F.repeat(L("x"), 300))), 257),
    "encoded key": (lambda: N.url_encoded_key(L("a b/c+d")), "a%20b/c%2Bd"),
    "marks of a key": (lambda: N.url_encoded_key(L("v1/a!'()*~%é")), "v1/a!'()*~%25%C3%A9"),
    "is glb": (lambda: N.is_glb(L(b"glTFx")), True),
    "empty is glb": (lambda: N.is_glb(L(b"")), True),
    "is not glb": (lambda: N.is_glb(L(b"{}")), False),
    "name from url": (lambda: N.name_from_url(L("https://a.b/c/d.x?q=1"), L("9")), "d.x.glb"),
    "gltf from url": (lambda: N.name_from_url(L("https://a.b/c/d.gltf#x"), L("9")), "d.gltf"),
    "nameless url": (lambda: N.name_from_url(L("https://a.b/"), L("9")), "asset_9.glb"),
    "emote": (lambda: N.is_emote_file(L("dance_emote.glb")), True),
    "same name": (lambda: N.same_name(L("ABC"), L("abc")), True),
    "ignored lod": (lambda: N.is_ignored_lod(L("shader_ignore_x")), True),
    "kept lod": (lambda: N.is_ignored_lod(L("shader_IGNORE")), False),
    "slot": (lambda: N.slot_flag(L("_BumpMap")), 4),
    "unknown slot": (lambda: N.slot_flag(L("_Other")), 0),
    "base property": (lambda: N.property_class(L("baseColorTexture")), "base"),
    "unknown property": (lambda: N.property_class(L("x")), None),
    "compressed": (lambda: N.is_compressed(L("BC7")), True),
    "not compressed": (lambda: N.is_compressed(L("RGBA32")), False),
    "rebuilt path": (lambda: N.rebuilt_path(L("D/hh/tex\\a.png"), L("hh"), L("models/")), "models/tex/a.png"),
    "project path": (lambda: N.project_path(L("/home/x\\Assets\\a/b.png")), "Assets/a/b.png"),
    "no project path": (lambda: N.project_path(L("/home/b.png")), "/home/b.png"),
    "full path": (lambda: N.full_path(L("Assets/a.png"), L("/p/Assets")), "/p/Assets/a.png"),
    "host": (lambda: J.url_host(L("https://u:p@Ex.org:8443/a")), "ex.org"),
    "no host": (lambda: J.url_host(L("nonsense")), None),
    "safe": (lambda: J.is_safe_url(L("https://lods.example.com/a")), True),
    "plain http": (lambda: J.is_safe_url(L("http://lods.example.com/a")), False),
    "decimal address": (lambda: J.is_safe_url(L("https://2130706433/")), False),
    "hex address": (lambda: J.is_safe_url(L("https://0x7f000001/")), False),
    "short address": (lambda: J.is_safe_url(L("https://127.1/")), False),
    "octal address": (lambda: J.is_safe_url(L("https://0177.0.0.01/")), False),
    "address of six": (lambda: J.is_safe_url(L("https://[::1]/")), False),
    "internal": (lambda: J.is_safe_url(L("https://db.internal/")), False),
    "digits in a name": (lambda: J.is_safe_url(L("https://1password.com/")), True),
    "allowed hosts": (lambda: J.allowed_hosts(L(" A.org, https://b.org/x,,a.org")), ["a.org", "b.org"]),
    "allowed": (lambda: J.is_allowed(L("https://a.org/x"), words("a.org")), True),
    "not allowed": (lambda: J.is_allowed(L("https://x.a.org/x"), words("a.org")), False),
    "contents": (lambda: J.contents_url(L("https://a.org/content")), "https://a.org/content/contents/"),
    "contents already": (lambda: J.contents_url(L("https://a.org/contents")), "https://a.org/contents/"),
    "exempt": (lambda: J.contents_url(L("https://a.org/ipfs"), ("https://a.org/ipfs/",)), "https://a.org/ipfs/"),
    "not exempt": (lambda: J.contents_url(L("https://b.org/ipfs/"), ("https://a.org/ipfs/",)), "https://b.org/ipfs/contents/"),
    "flag": (lambda: J.flag(L(" YES "), False), True),
    "flag off": (lambda: J.flag(L("no"), True), False),
    "flag unset": (lambda: J.flag(null(), True), True),
    "unknown flag": (lambda: J.flag_is_unknown(L("  ")), True),
    "empty flag": (lambda: J.flag_is_unknown(L("")), False),
    "retry after": (lambda: J.retry_after_ms(L("7"), then()), 7000),
    "long retry": (lambda: J.retry_after_ms(L("3600"), then()), 30000),
    "bad retry": (lambda: J.retry_after_ms(L("120abc"), then()), None),
    "fraction": (lambda: J.retry_after_ms(L("1.5"), then()), None),
    "date": (lambda: J.retry_after_ms(L("Mon, 01 Jan 2024 00:00:05 GMT"), then()), 5000),
    "past date": (lambda: J.retry_after_ms(L("Sun, 31 Dec 2023 00:00:00 GMT"), then()), 0),
    "backoff": (lambda: J.backoff_ms(L(2), L(0.5)), 1125),
    "length": (lambda: J.content_length(L("12")), 12),
    "no length": (lambda: J.content_length(null()), -1),
    "fetched": (lambda: J.fetch_outcome(L(200), L(10), L(10)), "ok"),
    "cut off": (lambda: J.fetch_outcome(L(200), L(10), L(9)), "retryable"),
    "longer than declared": (lambda: J.fetch_outcome(L(200), L(10), L(11)), "ok"),
    "undeclared": (lambda: J.fetch_outcome(L(200), L(-1), L(9)), "ok"),
    "server error": (lambda: J.fetch_outcome(L(503), L(-1), L(0)), "retryable"),
    "not found": (lambda: J.fetch_outcome(L(404), L(-1), L(0)), "fatal"),
    "too large": (lambda: J.fetch_outcome(L(200), L(1 << 30), L(0)), "fatal"),
    "retry param": (lambda: J.with_retry_param(L("https://a/b?x=1&_retry=1"), L(2)), "https://a/b?x=1&_retry=2"),
    "retry before a fragment": (lambda: J.with_retry_param(L("https://a/b?x=1#f"), L(3)), "https://a/b?x=1&_retry=3#f"),
    "retry keeps its place": (lambda: J.with_retry_param(L("https://a/b?_retry=1&x=1&_retry=2&y=3"), L(3)), "https://a/b?_retry=3&x=1&y=3"),
    "retry of a like name": (lambda: J.with_retry_param(L("https://a/b?my_retry=1"), L(3)), "https://a/b?my_retry=1&_retry=3"),
    "first retry": (lambda: J.with_retry_param(L("https://a/b"), L(1)), "https://a/b?_retry=1"),
    "static version": (lambda: J.job_version(L(True), L(False), L("scene"), L("v48"), L("w7")), "v2004"),
    "wearable version": (lambda: J.job_version(L(False), L(False), L("emote"), L("v48"), L("w7")), "w7"),
    "failed look-up": (lambda: J.job_version(L(False), L(False), null(), L("v48"), L("w7")), "v48"),
    "animation": (lambda: J.animation_method(L("emote"), L("x")), "Mecanim"),
    "no entity": (lambda: J.animation_method(null(), L("x")), "Legacy"),
    "wearable": (lambda: J.animation_method(L("wearable"), L("x")), "None"),
    "target": (lambda: J.build_target(L("StandaloneWindows64")), "windows"),
    "no target": (lambda: J.build_target(L("linux")), None),
    "unknown": (lambda: J.default_unknown(L("")), "unknown"),
    "list": (lambda: J.split_list(L(" a;; b ")), ["a", "b"]),
    "hash list": (lambda: J.join_hashes(words("a1", "b2")), "a1;b2"),
    "option": (lambda: J.option_values(words("-x", "1", "2"), "-x", 2), ["1", "2"]),
    "short option": (lambda: J.option_values(words("-x", "1"), "-x", 2), None),
    "ticks": (lambda: J.net_ticks(F.to_timestamp(L("1970-01-01 00:00:01"))), 621355968010000000),
    "at least": (lambda: J.at_least(L(10), 1000), 1000),
    "default at least": (lambda: J.at_least(F.lit(None).cast("int"), 1, 50), 50),
    "clamp": (lambda: J.clamp(L(1200), 1, 1000), 1000),
    "low disk": (lambda: J.disk_is_low(L(999_999_999)), True),
    "just enough disk": (lambda: J.disk_is_low(L(1_000_000_000)), False),
    "megabytes": (lambda: J.megabytes(L(3 * (1 << 20) - 1)), 2),
    "per asset": (lambda: J.per_asset_seconds(L(9.0), L(3)), 3.0),
    "no asset": (lambda: J.per_asset_seconds(L(9.0), L(0)), None),
    "empty lod run": (lambda: J.lod_exit_code(L(0), L(0)), 5),
    "lod run": (lambda: J.lod_exit_code(L(2), L(0)), 0),
    "peer": (lambda: J.content_server(L("zone"), L(False), "example"), "https://peer.example.zone/content"),
    "worlds": (lambda: J.content_server(L("x"), L(True), "example"), "https://worlds-content-server.example.org"),
    "parcel": (lambda: G.parcel(L("-3,7"))["x"], -3),
    "corner": (lambda: G.corner(L(-2)), -32),
    "box": (lambda: G.scene_box(L(0.0), L(16.0), L(0.0), L(16.0), L(20.0), L(0))["size"]["x"], 16.5),
    "box of level 1": (lambda: G.scene_box(L(0.0), L(16.0), L(0.0), L(16.0), L(20.0), L(1))["size"]["z"], 18.0),
    "corners inside": (lambda: G.contains_corners(F.array(xyz(1, 1, 1), xyz(-1, 0, 0)), xyz(0, 0, 0), xyz(2, 2, 2)), True),
    "corner outside": (lambda: G.contains_corners(F.array(xyz(1, 1, 1.5)), xyz(0, 0, 0), xyz(2, 2, 2)), False),
    "far bounds": (lambda: G.safe_bounds(L(20000.0), L(0.0), L(0.0))["x"], 0.0),
    "scaled": (lambda: G.scaled_side(L(1000), L(2048), L(1000)), 500),
    "small stays": (lambda: G.scaled_side(L(1000), L(1024), L(1000)), 1000),
    "offset": (lambda: G.parcel_offset(L(-1), L(2))["x"], -16),
    "escaped text in a digest": (lambda: N.json_digest(F.array(F.struct(L("a\\u001A.png").alias("file"), L("h").alias("hash")))), "9b"),
    "mapping of a container": (lambda: R.mapping_of(L("glTF\x02"), L("e"))[0]["file"], "e.glb"),
    "lod list": (lambda: R.lod_urls(L("a; ;b")), ["a", "b"]),
    "sidecar": (lambda: F.map_keys(R.digest_sidecar(L('{"h":"d"}'))), ["h"]),
    "bad descriptor": (lambda: R.descriptor(L("nonsense")), None),
}


def expected():
    import hashlib
    import json

    want = {k: v for k, (_, v) in CASES.items()}
    text = json.dumps([["a\\u001A.png", "h"]], separators=(",", ":"))
    want["escaped text in a digest"] = hashlib.sha256(text.encode()).hexdigest()[:32]
    want["asset path"] = json.dumps({"file_name": "My.Tex.PNG", "file_root_path": "models/a/", "hash_path": "models/a/H.PNG", "final_path": "D/H/H.PNG", "asset_folder": "D/H/", "final_meta_path": "D/H/H.meta"}, separators=(",", ":"))
    return want


def test_functions(spark):
    names = list(CASES)
    got = spark.range(1).select(*[CASES[k][0]().alias(f"c{i}") for i, k in enumerate(names)]).first()
    want = expected()
    wrong = {k: (got[i], want[k]) for i, k in enumerate(names) if got[i] != want[k]}
    assert not wrong


def test_bad_values_are_errors(spark):
    for column in (J.join_hashes(words("a;b")), R.digest_sidecar(L("{")), N.canonical_name(L("h"), L("a.glb"), null(), L("mac"))):
        with pytest.raises(Exception):  # noqa: B017
            spark.range(1).select(column).collect()
    with pytest.raises(ValueError):
        R.by_id(spark.range(1), "a/b")


def test_digest_order_is_that_of_utf16(spark):
    pairs = F.array(F.struct(L("\uff5e.png").alias("file"), L("a").alias("hash")), F.struct(L("\U0001f600.png").alias("file"), L("b").alias("hash")))
    import hashlib
    import json

    text = json.dumps([["\U0001f600.png", "b"], ["\uff5e.png", "a"]], separators=(",", ":"), ensure_ascii=False)
    assert spark.range(1).select(N.json_digest(pairs)).first()[0] == hashlib.sha256(text.encode()).hexdigest()[:32]


def test_probe_rows(spark):
    content = spark.createDataFrame(
        [(1, 0, "a.glb", "g1"), (1, 1, "b.GLTF", "g2"), (1, 2, "t.png", "t"), (1, 3, "u.png", "t"), (1, 4, "b.bin", "b"), (1, 5, "x/autogenerated-thumbnail.png", "m"), (1, 6, "copy.png", "m"), (2, 0, "a.glb", "g1")],
        "entity_id long, pos int, file string, hash string",
    )
    digests = spark.createDataFrame([(1, "g1", "d1"), (1, "g2", None), (2, "g1", "d2")], "entity_id long, hash string, digest string")
    rows = {(r["entity_id"], r["hash"]): (r["file"], r["skippable"], r["object_key"]) for r in A.probe_rows(content, F.col("pos"), digests, "v1", "mac").collect()}
    assert rows == {(1, "g1"): ("a.glb", True, "v1/assets/g1_d1_mac"), (1, "t"): ("t.png", False, "v1/assets/t_mac"), (2, "g1"): ("a.glb", True, "v1/assets/g1_d2_mac")}


def test_manifest_prefixes(spark):
    files = spark.createDataFrame([(1, "hash1_windows"), (2, "x_windows")], "e long, name string")
    content = spark.createDataFrame([(1, "a.glb", "hash"), (1, "b.json", "zz"), (2, "a.png", "hash"), (3, "a.json", "q"), (4, None, None)], "e long, file string, hash string")
    assert {r["e"]: r["unchanged"] for r in A.hashes_in_manifest(files, content, ["e"]).collect()} == {1: True, 2: False, 3: True, 4: True}
    assert {r["e"]: r["copied"] for r in A.can_copy_previous(files, content.where("e > 1"), ["e"], "windows").collect()} == {2: False, 3: True, 4: True}


def test_newest_other_deployment(spark):
    rows = [(1, "b", 10), (2, "b", 20), (3, "b", 30), (4, "c", 5), (5, None, 1), (6, None, 2)]
    got = C.previous_deployment(spark.createDataFrame(rows, "entity_id long, base string, ts long")).collect()
    assert {r["entity_id"]: r["previous"] for r in got} == {1: 3, 2: 3, 3: 2, 4: None, 5: None, 6: None}


def test_small_joins(spark):
    content = spark.createDataFrame([("e", 0, "A/T.png", "h1"), ("e", 1, "a/t.PNG", "h2")], "entity_id string, pos int, file string, hash string")
    ask = lambda path: spark.createDataFrame([("e", path)], "entity_id string, path string")
    assert A.requested_content(ask("a\\t.png"), content).first()["hash"] == "h2"
    with pytest.raises(Exception):  # noqa: B017
        A.requested_content(ask("none.png"), content).collect()
    textures = spark.createDataFrame([("a", "old/a"), ("b", "old/b")], "name string, path string")
    extracted = spark.createDataFrame([("a", "new/a")], "name string, path string")
    assert {r["name"]: r["path"] for r in A.extracted_or_original(textures, extracted).collect()} == {"a": "new/a", "b": "old/b"}
    assert [tuple(r) for r in A.paired_images(textures, extracted).collect()] == [("a", "old/a", "new/a")]
    assert A.build_input(textures, textures, extracted).count() == 5
    assert A.not_built(textures, extracted, ["name"]).count() == 1
    assert {r["name"]: r["is_imported"] for r in A.mark_imported(textures, extracted, ["name"]).collect()} == {"a": True, "b": False}
    twice = spark.createDataFrame([("h", "x_EMOTE.glb"), ("h", "x_EMOTE.glb"), ("h", "y.glb")], "hash string, file string")
    assert A.with_suffixes(twice, ["_emote.glb"]).count() == 1
    files = spark.createDataFrame([("qmab_windows",), ("qmab_mac",), ("x.manifest",), ("other_windows",)], "bundle string")
    originals = spark.createDataFrame([("qmab", "QmAb", 0), ("qmab", "QMAB", 1)], "lower string, original string, pos int")
    assert sorted(r["cdn_name"] for r in A.cleaned_output(files, originals).collect()) == ["QmAb_windows", "other_windows", "qmab_mac"]
    edges = spark.createDataFrame([("b", "qmab_windows"), ("b", "s_IGNORE"), ("c", "none")], "bundle string, dep string")
    known = spark.createDataFrame([("QmAb_windows",)], "dep string")
    bundles = spark.createDataFrame([("b",), ("c",), ("d",)], "bundle string")
    assert {r["bundle"]: r["dependencies"] for r in A.bundle_metadata(bundles, edges, known, originals).collect()} == {"b": ["QmAb_windows"], "c": [], "d": None}


def test_placement_and_bounds(spark):
    d = spark.createDataFrame([("h", [1.0, 2.0, 3.0], [0.0, 0.0, 0.0, 1.0], [1.0, 1.0, 1.0]), ("h", [4.0, 0.0, 0.0], [0.0, 0.0, 0.0, 1.0], [2.0, 2.0, 2.0])], "hash string, position array<double>, rotation array<double>, scale array<double>")
    a = spark.createDataFrame([("h",), ("x",)], "hash string")
    assert sorted((r["hash"], r["position"][0]) for r in A.place(a, d).collect()) == [("h", 1.0), ("h", 4.0), ("x", 0.0)]
    assert A.place(a, d, listed_only=True).count() == 2
    assert A.grouped_descriptor(d).select(F.size("transforms")).first()[0] == 2
    box = lambda *x: f"named_struct('x', {x[0]}D, 'y', {x[1]}D, 'z', {x[2]}D)"
    boxes = spark.sql(f"select {box(0, 0, 0)} lo, {box(1, 1, 1)} hi union all select {box(-2, 0, 0)}, {box(-1, 5, 0)} union all select null, null")
    got = boxes.select(G.merged_bounds(F.col("lo"), F.col("hi")).alias("b")).first()["b"].asDict()
    assert got == {"min_x": -2.0, "min_y": 0.0, "min_z": 0.0, "max_x": 1.0, "max_y": 5.0, "max_z": 1.0}


def test_sinks(spark, tmp_path):
    files = spark.createDataFrame([("a",), ("b",), ("b.manifest",)], "key string")
    there = spark.createDataFrame([("a",), ("b.br",), ("b.manifest",)], "key string")
    up = {r["key"]: r["content_type"] for r in S.missing_only(files, there, "key").collect()}
    assert up == {"a.br": "application/wasm", "b": "application/wasm", "b.manifest": "text/cache-manifest", "b.manifest.br": "text/cache-manifest"}
    assert S.missing_only(files, there, "key", force=True).count() == 6
    lods = spark.createDataFrame([("x_1_lod_mac", 1)], "key string, level int")
    assert sorted(r["key"] for r in S.lod_uploads(lods, there, "key").collect()) == ["LOD/1/x_1_lod_mac", "LOD/1/x_1_lod_mac.br"]
    lods = spark.createDataFrame([("x.manifest", 1), ("y", 0)], "key string, level int")
    there = spark.createDataFrame([("LOD/1/x.manifest",), ("LOD/0/y.br",)], "key string")
    assert sorted((r["key"], r["content_type"]) for r in S.lod_uploads(lods, there, "key").collect()) == [("LOD/0/y", "application/wasm"), ("LOD/1/x.manifest.br", "application/wasm")]
    failed = spark.createDataFrame([("e", "mac", "https://a", "v1", "boom", None, "2024")], "entity_id string, target string, server string, version string, error string, log string, date string")
    assert tuple(S.failed_sentinels(failed).first()) == ("manifest/e_mac_failed.json", '{"entityId":"e","contentServerUrl":"https://a","version":"v1","error":"boom","date":"2024"}')
    jobs = spark.createDataFrame([("e", True), ("f", None)], "id string, first boolean")
    sent = lambda *x: [tuple(r) for r in S.queue_messages(jobs, F.struct("id"), F.col("first"), *x).collect()]
    assert sent("q", "p") == [("p", '{"Message":"{\\"id\\":\\"e\\"}"}'), ("q", '{"Message":"{\\"id\\":\\"f\\"}"}')]
    assert [q for q, _ in sent("q")] == ["q", "q"]
    plan = spark.createDataFrame([("v1/e/a b", "h_mac", ".br", "copied"), ("v1/e/c", "i_mac", "", "canonical")], "source_key string, target_name string, variant string, action string")
    assert [tuple(r) for r in S.copies(plan, "v1").collect()] == [("v1/e/a%20b", "v1/assets/h_mac.br")]
    old = spark.createDataFrame([("a", 1), ("b", 1)], "key string, n int")
    assert sorted(map(tuple, S.latest_by_key(old, spark.createDataFrame([("b", 2), ("c", 2)], "key string, n int"), "key").collect())) == [("a", 1), ("b", 2), ("c", 2)]
    for _ in range(2):  # a batch that is tried again
        S.publish(files, there, f"file://{tmp_path}/out", 7)
    assert spark.read.parquet(f"file://{tmp_path}/out/contents").count() == 3


def test_records(spark, tmp_path):
    (tmp_path / "manifest").mkdir()
    (tmp_path / "manifest" / "e_mac.json").write_text('{"version": "v1", "files": ["a"], "exitCode": 0}')
    (tmp_path / "manifest" / "f_mac.json").write_text("{nonsense")
    got = {r["key"]: r for r in R.manifests(spark, f"file://{tmp_path}/manifest").collect()}
    assert got["manifest/e_mac.json"]["version"] == "v1" and got["manifest/f_mac.json"]["version"] is None
    assert R.list_keys(spark, f"file://{tmp_path}").count() == 2
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "abc.json").write_text('{"type": "scene", "pointers": ["0,0"], "extra": 1, "content": [{"file": "a", "hash": "h"}]}')
    table = R.entities(spark, f"file://{tmp_path}/e")
    assert R.by_id(table, "abc").count() == 1
    pointers = spark.createDataFrame([("0,0",), ("1,1",)], "pointer string")
    assert R.by_pointers(table, pointers).count() == 1
    empty = spark.sql("select map('s', array(named_struct('file', 'a', 'hash', 'h'))) m")
    assert [tuple(r) for r in R.empty_scenes(empty, "m").collect()] == [("s", "a", "h")]
    nested = spark.sql("select array(named_struct('id', 'w', 'representations', array(named_struct('contents', array(named_struct('file', 'f', 'url', 'https://a/b/h'), named_struct('file', 'g', 'url', '')))))) c")
    assert [tuple(r) for r in A.flatten_wearables(nested, "c").collect()] == [("w", "f", "https://a/b/h", "h")]
    edges = spark.createDataFrame([("h", "d1"), ("h", "x/scene_ignore_1"), ("o", "d2")], "bundle string, dep string")
    static = spark.createDataFrame([("h",)], "hash string")
    assert sorted(r["hash"] for r in A.consolidate_static(edges, static, "s", "mac").collect()) == ["d1", "h"]
