"""Containers from bytes to digests, the prefix source, and the keyed store, on literal cases."""

import json
import struct
import threading

import pytest
from pyspark.sql import functions as F

from assetweave.operators import assets, containers, legacy, sinks
from assetweave.operators.store import Conflict, KeyedStore, manifest_store
from assetweave.sources import gltf


def glb(doc, magic=0x46546C67, version=2, kind=0x4E4F534A, size=None, tail=b""):
    body = doc if isinstance(doc, bytes) else json.dumps(doc).encode()
    return struct.pack("<5I", magic, version, 20 + len(body), len(body) if size is None else size, kind) + body + tail


# Cases: (bytes, extension, references or error).
PARSED = [
    (glb({"images": [{"uri": "b.png"}, {"uri": "a.png"}, {"uri": "b.png"}], "buffers": [{"uri": "c.bin"}]}), ".glb", ["a.png", "b.png", "c.bin"]),
    (glb({"images": [{"uri": "data:x"}, {"bufferView": 1}, None, 7, {"uri": 3}], "buffers": "no"}), ".glb", []),
    (glb({}), ".glb", []),
    (glb(b"{}\0\0 \n"), ".glb", []),
    (glb({"images": [{"uri": "a"}]}, tail=b"BIN"), ".glb", ["a"]),
    (json.dumps({"images": [{"uri": "x.png"}]}).encode(), ".gltf", ["x.png"]),
    (glb({"images": [{"uri": "\uff5e"}, {"uri": "\U0001f600"}]}), ".glb", ["\U0001f600", "\uff5e"]),
    (b"12345678", ".glb", "truncated: 8"),
    (b"", ".glb", "truncated: 0"),
    (glb({}, magic=1), ".glb", "magic: 0x1"),
    (glb({}, version=1), ".glb", "version: 0x1"),
    (glb({}, kind=0x4E4942), ".glb", "chunk: 0x4e4942"),
    (glb({}, size=99), ".glb", "overrun: 99"),
    (glb(b"{"), ".glb", "json"),
    (b"{'a': 1}", ".gltf", "json"),
    (b'{"a": NaN}', ".gltf", "json"),
    (b"null", ".gltf", "root: null"),
    (b"[]", ".gltf", "root: array"),
    (b"42", ".gltf", "root: scalar"),
]


def test_parsing(spark):
    df = spark.createDataFrame([(i, bytearray(b), e) for i, (b, e, _) in enumerate(PARSED)], "i int, content binary, ext string")
    got = {r["i"]: r["r"]["error"] if r["r"]["uris"] is None else r["r"]["uris"] for r in df.select("i", gltf.parse_refs(F.col("content"), F.col("ext")).alias("r")).collect()}
    assert got == {i: want for i, (_, _, want) in enumerate(PARSED)}


# Cases: (reference, container, path or null, error or null).
URIS = [
    ("t.png", "car.glb", "t.png", None),
    ("t.png", "models/car.glb", "models/t.png", None),
    ("../t.png", "models/car.glb", "t.png", None),
    ("a%20b.png", "models/car.glb", "models/a b.png", None),
    ("a+b.png", "car.glb", "a+b.png", None),
    ("./x/./y//z.png", "m/car.glb", "m/x/y/z.png", None),
    ("x/../../t.png", "m/n/car.glb", "m/t.png", None),
    ("..a.png", "car.glb", "..a.png", None),
    ("dir/", "m/car.glb", "m/dir/", None),
    ("..", "m/car.glb", ".", None),
    ("a%2Fb.png", "car.glb", "a/b.png", None),
    ("%2Fabs.png", "car.glb", "/abs.png", None),
    ("%2Fabs.png", "m/car.glb", "m/abs.png", None),
    ("%E2%82%AC.png", "car.glb", "€.png", None),
    ("�.png", "car.glb", "�.png", None),
    ("a\nb.png", "m/car.glb", "m/a\nb.png", None),
    ("", "m/car.glb", None, "empty"),
    (None, "m/car.glb", None, "empty"),
    ("http://x/t.png", "m/car.glb", None, "scheme"),
    ("C:/t.png", "m/car.glb", None, "scheme"),
    ("//x/t.png", "m/car.glb", None, "protocol"),
    ("/t.png", "m/car.glb", None, "absolute"),
    ("t.png?v=2", "m/car.glb", None, "query"),
    ("t.png#s", "m/car.glb", None, "query"),
    ("t%2.png", "m/car.glb", None, "percent"),
    ("t%", "m/car.glb", None, "percent"),
    ("t%FF.png", "m/car.glb", None, "percent"),
    ("../../etc", "m/car.glb", None, "escape"),
    ("%2e%2e/%2e%2e/x", "m/car.glb", None, "escape"),
    ("..", "car.glb", None, "escape"),
]


def test_references_resolve(spark):
    df = spark.createDataFrame([(i, u, g) for i, (u, g, _, _) in enumerate(URIS)], "i int, uri string, glb string")
    got = {r["i"]: tuple(r["r"]) for r in df.select("i", gltf.resolve_uri(F.col("uri"), F.col("glb")).alias("r")).collect()}
    assert got == {i: (path, error) for i, (_, _, path, error) in enumerate(URIS)}


def content_of(spark, rows):
    return spark.createDataFrame(rows, "entity_id long, pos long, file string, hash string")


def parsed_of(spark, rows):
    df = spark.createDataFrame([(h, bytearray(b), ".glb") for h, b in rows], "hash string, content binary, ext string")
    return gltf.parse_once(df)


def test_digests_from_bytes(spark):
    refs = lambda *uris: glb({"images": [{"uri": u} for u in uris]})
    bytes_ = [("same", refs("t.png", "./t.png", "note.txt")), ("none", glb({})), ("lost", refs("z.png", "q.png")), ("bad", refs("z.png", "a?b")), ("broken", b"x"), ("same", refs("t.png", "./t.png", "note.txt")), ("twice", refs("t.png"))]
    rows = [
        (1, 0, "m/a.glb", "same"), (1, 1, "m/T.PNG", "old"), (1, 2, "m/t.png", "new"), (1, 3, "m/note.txt", "txt"), (1, 4, "n.glb", "none"), (1, 5, "b.GLTF", "broken"), (1, 6, "l.glb", "lost"), (1, 7, "q.glb", "bad"), (1, 8, "u.glb", "absent"),
        (2, 0, "m/a.glb", "same"), (2, 1, "m/t.png", "other"), (2, 2, "m/note.txt", "txt"), (2, 3, "m/c.glb", "twice"), (2, 4, "x/c.glb", "twice"), (2, 5, "t.png", ""), (2, 6, "c.glb", "twice"),
    ]
    content = content_of(spark, rows)
    got = {(r["entity_id"], r["hash"]): r for r in containers.container_digests(content, parsed_of(spark, bytes_)).collect()}
    digest = lambda *pairs: assets.set_digest(spark.createDataFrame([(0, f, h) for f, h in pairs], "k int, file string, hash string"), ["k"]).first()["digest"]
    assert got[1, "same"]["digest"] == digest(("m/t.png", "new")) and not got[1, "same"]["skipped"]
    assert got[2, "same"]["digest"] == digest(("m/t.png", "other"))
    assert got[1, "none"]["digest"] == "4f53cda18c2baa0c0354bb5f9a3ecbe5"
    skip = lambda *k: (got[k]["digest"], got[k]["skipped"], got[k]["file"], got[k]["reason"], got[k]["detail"])
    assert skip(1, "lost") == (None, True, "l.glb", "missing-deps", '"q.png" -> "q.png"')
    assert skip(1, "bad") == (None, True, "q.glb", "unparseable", 'query: "a?b"')
    assert skip(1, "broken") == (None, True, "b.GLTF", "unparseable", "truncated: 1")
    assert skip(1, "absent") == (None, True, "u.glb", "unread", "")
    # Under one path it resolves, under two it does not: the digest of the first and the skip of the last of these.
    assert skip(2, "twice") == (digest(("m/t.png", "other")), True, "c.glb", "missing-deps", '"t.png" -> "t.png"')


def test_equal_contents_are_parsed_once(spark):
    df = spark.createDataFrame([("h", bytearray(glb({})), ".glb"), ("h", bytearray(glb({})), ".glb"), ("i", bytearray(b""), ".glb")], "hash string, content binary, ext string")
    assert sorted(map(tuple, gltf.parse_once(df).collect())) == [("h", [], None), ("i", None, "truncated: 0")]


def test_metadata_only_files_are_not_probed(spark):
    content = content_of(spark, [(1, 0, "a.PNG", "old"), (1, 1, "A.png", "thumb"), (1, 2, "b.png", "b"), (1, 3, "x/autogenerated-thumbnail.png", "auto"), (2, 0, "a.png", "thumb")])
    thumbs = spark.createDataFrame([(1, "a.png"), (2, None), (3, "a.png")], "entity_id long, thumb string")
    meta = containers.metadata_only(content, thumbs)
    assert sorted(map(tuple, meta.collect())) == [(1, "auto", False, True), (1, "thumb", True, False)]
    none = spark.createDataFrame([], "entity_id long, hash string, digest string")
    rows = assets.probe_rows(content, F.col("pos"), none, "v1", "mac", meta)
    assert sorted((r["entity_id"], r["hash"]) for r in rows.collect()) == [(1, "b"), (1, "old"), (2, "thumb")]


def test_prefix_source_reads_less_than_the_files(spark, tmp_path):
    doc = {"images": [{"uri": "a.png"}]}
    for i in range(6):
        (tmp_path / "sub").mkdir(exist_ok=True)
        (tmp_path / "sub" / f"f{i}.GLB").write_bytes(glb(doc, tail=b"x" * (100_000 + i)))
    (tmp_path / "short.glb").write_bytes(b"glTF")
    (tmp_path / "other.txt").write_bytes(b"no")
    all_ = gltf.glb_prefixes(spark, f"file://{tmp_path}")
    rows = {r["path"].split("/")[-1]: r for r in all_.collect()}
    assert len(rows) == 7 and rows["short.glb"]["bytes_read"] == 4
    want = 20 + len(json.dumps(doc))
    assert all(rows[f"f{i}.GLB"]["bytes_read"] == want and rows[f"f{i}.GLB"]["length"] == want + 100_000 + i for i in range(6))
    assert all_.where(F.col("length") > 1000).select(F.sum("bytes_read")).first()[0] < 0.01 * 600_000
    assert all_.where(F.col("length") == want + 100_003).count() == 1
    assert all_.where(F.col("path").startswith(f"{tmp_path}/sub/f1")).count() == 1
    assert gltf.glb_prefixes(spark, f"file://{tmp_path}", taskBytes="1", openBytes="1").rdd.getNumPartitions() == 7
    (tmp_path / "empty").mkdir()
    assert gltf.glb_prefixes(spark, f"file://{tmp_path}/empty").count() == 0


def test_prefix_source_meets_filters_from_the_listing(tmp_path):
    for i in range(4):
        (tmp_path / f"f{i}.glb").write_bytes(glb({}, tail=b"x" * i))
    reader = gltf.GlbReader(str(tmp_path), 1 << 20, 1)
    from pyspark.sql.datasource import GreaterThan, IsNotNull

    left = list(reader.pushFilters([GreaterThan(("length",), 23), GreaterThan(("bytes_read",), 5), IsNotNull(("path",))]))
    assert [type(f).__name__ for f in left] == ["GreaterThan", "IsNotNull"]
    assert [n for p in reader.partitions() for _, n in p.files] == [24, 25]


def test_upserts_keep_other_keys(spark, tmp_path):
    at = f"file://{tmp_path}/store"
    one = spark.createDataFrame([("e", "mac", 0, 1), ("f", None, None, 1)], "entity_id string, target string, exitCode int, n int")
    assert sinks.write_manifests(one, at) == 1
    assert sinks.write_manifests(spark.createDataFrame([("g", "mac", 0, 2), ("e", "mac", 12, 2), ("e", "mac", 5, 1)], one.schema), at, order="n") == 2
    store = manifest_store(spark, at)
    got = {r["key"]: json.loads(r["body"]) for r in store.read().collect()}
    assert got == {"manifest/e_mac.json": {"exitCode": 12}, "manifest/f.json": {"exitCode": None, "n": 1}, "manifest/g_mac.json": {"exitCode": 0}}
    store.upsert(store.read())
    store.vacuum(1)
    assert store.read().count() == 3


def test_readers_see_the_old_or_the_new_rows(spark, tmp_path):
    store = KeyedStore(spark, f"file://{tmp_path}/s", "k long, v long", "k", 4)
    assert store.read().count() == 0
    rows = lambda v: spark.range(40).select(F.col("id").alias("k"), F.lit(v).cast("long").alias("v"))
    store.upsert(rows(0))
    seen, done = [], threading.Event()

    def look():
        while not done.is_set():
            seen.append(tuple(store.read().agg(F.count("*"), F.min("v"), F.max("v")).first()))

    reader = threading.Thread(target=look)
    reader.start()
    for v in (1, 2):
        store.upsert(rows(v))
    done.set()
    reader.join()
    assert seen and all(n == 40 and lo == hi for n, lo, hi in seen)


def test_a_writer_that_comes_second_starts_again(spark, tmp_path, monkeypatch):
    store = KeyedStore(spark, f"file://{tmp_path}/s", "k long, v long", "k", 2)
    real, raced = KeyedStore._commit, []

    def slow(self, number, state):
        if not raced:
            raced.append(number)
            KeyedStore(spark, self.path, "k long, v long", "k", 2).upsert(spark.createDataFrame([(1, 10), (2, 20)], "k long, v long"))
        real(self, number, state)

    monkeypatch.setattr(KeyedStore, "_commit", slow)
    assert store.upsert(spark.createDataFrame([(2, 21), (3, 30)], "k long, v long")) == 2
    assert sorted(map(tuple, store.read().collect())) == [(1, 10), (2, 21), (3, 30)]
    monkeypatch.undo()
    with pytest.raises(Conflict):
        store._commit(2, {})


def test_copies_stop_at_the_first_failure_and_leave_nothing(spark):
    facts = "entity_id long, kind string, force boolean, iss boolean, reuse boolean, previous long, previous_version string"
    ok = ("scene", False, False, False, 9, "v1")
    rows = [(1, *ok), (2, *ok), (3, *ok), (4, "scene", True, False, False, 9, "v1"), (5, "scene", None, True, False, 9, "v1"), (6, "scene", False, False, True, 9, "v1"), (7, "wearable", False, False, False, 9, "v1"), (8, "scene", False, False, False, None, "v1"), (9, "scene", False, False, False, 9, None), (10, "scene", False, False, False, 9, "v0"), (11, *ok)]
    content = [(e, p, f"{p}.png", f"h{p}") for e in range(1, 11) for p in range(5)] + [(1, 5, "a.json", "j"), (1, 6, "again.png", "h0")]
    names = [(e, f"h{p}_mac") for e in range(1, 11) for p in range(5) if (e, p) != (3, 4)]
    stored = [(e, n) for e, n in names if (e, n) not in ((2, "h2_mac"), (2, "h4_mac"))]
    df = lambda x, s: spark.createDataFrame(x, s)
    outcomes, copied = legacy.reuse_previous(df(rows, facts), content_of(spark, content), df(names, "entity_id long, name string"), df(stored, "entity_id long, name string"), "mac", "v1")
    got = {r["entity_id"]: (r["outcome"], r["attempted"]) for r in outcomes.collect()}
    want = {1: ("copied", 6), 2: ("copy-failed", 3), 3: ("content-changed", 0), 4: ("not-asked", 0), 5: ("not-asked", 0), 6: ("not-asked", 0), 7: ("not-asked", 0), 8: ("no-previous", 0), 9: ("no-manifest", 0), 10: ("other-version", 0), 11: ("copied", 0)}
    assert got == want
    assert {r["entity_id"] for r in copied.collect()} == {1} and copied.count() == 6
