"""Every query beside its SQL twin, digests against known vectors, and the entry module on its own."""

import decimal
import os
import subprocess
import sys
import time

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from assetweave.operators import assets, control
from assetweave.plans import catalogue
from assetweave.plans.views import Views
from assetweave.sources import gltf, records
from assetweave.streaming import triage, ttl

SF = "/root/testdata/sf0.001"

# Fixed values: (name, content as file=hash, first 32 hex digits of the set's digest).
DIGESTS = [
    ("empty", [], "4f53cda18c2baa0c0354bb5f9a3ecbe5"),
    ("single", [("tex.png", "h1")], "e694ee215f7a8eec10fadc72585d9642"),
    ("sorted", [("b.png", "hB"), ("a.png", "hA")], "677cef1bdb040a547679096667d45dd2"),
    ("shared", [("alpha.png", "shared"), ("beta.png", "shared")], "e5f53eb03e94d2f9b2dc73ef34c3f860"),
    ("upper", [("TEX.PNG", "hU")], "e8d2094843331e676ad9e0e2a6950bcd"),
    ("tab", [("a\tb.png", "h1"), ("c.png", "h2")], "3706f4528a42efd38558a16feacf25f9"),
    ("others", [("scene.json", "h_scene"), ("game.js", "h_js"), ("model.glb", "h_glb"), ("tex.png", "h_tex"), ("buffer.bin", "h_bin")], "4905066b2b13ef4eb86ebbed960e9336"),
]


def plain(v):
    if isinstance(v, float | decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    return tuple(map(plain, v)) if isinstance(v, list | tuple) else v


def multiset(cols, rows):
    return sorted(repr([plain(r[c]) for c in sorted(cols)]) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", catalogue.queries())
def test_query(spark, duck, name):
    df = catalogue.queries()[name](spark, SF)
    rows = [r.asDict(True) for r in df.collect()]
    assert rows or name in ("migratable",)
    if name in catalogue.SQL:
        got = duck.execute(catalogue.SQL[name])
        cols = [d[0] for d in got.description]
        assert sorted(cols) == sorted(df.columns)
        assert multiset(cols, rows) == multiset(cols, [dict(zip(cols, r, strict=True)) for r in got.fetchall()])


def test_digest_vectors(spark):
    content = [(n, f, h) for n, c, _ in DIGESTS for f, h in c]
    got = {r[0]: r[1] for r in assets.set_digest(spark.createDataFrame(content, "entity_id string, file string, hash string"), ["entity_id"]).collect()}
    assert got == {n: d for n, c, d in DIGESTS if c}


def test_migration_leaves_out_manifests_that_cannot_be_read_resolved_or_digested(spark):
    rows = [(1, 0, "v48", "s", False, False), (2, 0, "v48", None, False, False), (3, 0, "v48", "s", False, False), (4, 0, "v48", "s", True, False), (5, None, None, None, False, True), (6, 12, "v48", None, True, False), (7, 0, "v48", None, True, False)]
    manifests = spark.createDataFrame(rows, "entity_id long, exit_code int, version string, server string, bad boolean, corrupt boolean")
    fates = control.manifest_fates(manifests, "v48", spark.createDataFrame([(i,) for i in (1, 2, 4, 5, 6)], "entity_id long"), F.col("corrupt"), F.col("server").isNull(), F.col("bad"))
    files = [(e, f"h{e}{i}", None if i == 3 else "k", i in (0, 1), "d" if i == 0 else None, False, i == 2) for e in range(1, 8) for i in range(6)]
    files = spark.createDataFrame(files, "entity_id long, hash string, source_key string, is_gltf boolean, digest string, skipped boolean, lost boolean")
    plan = control.migration(files, fates, spark.createDataFrame([("h14",), ("h24",)], "hash string"), failed=F.col("lost"))
    assert {r["hash"]: r["action"] for r in plan.collect()} == {"h10": "copied", "h11": "error", "h12": "error", "h13": "missing-source", "h14": "canonical", "h15": "copied"}
    got = control.migration_stats(fates, plan).first().asDict()
    want = {"manifests_scanned": 7, "manifests_kept": 1, "manifests_skipped": 1, "manifests_missing_content_server": 2, "manifests_entity_fetch_failed": 1, "manifests_digest_failed": 1}
    assert got == want | {"bundles_probed": 6, "bundles_already_canonical": 1, "bundles_copied": 2, "glb_renamed": 1, "bundles_missing_source": 1, "glb_skipped": 0, "errors": 3}
    dry = control.migration(files, fates, spark.createDataFrame([("h14",)], "hash string"), dry_run=True)
    assert {r["hash"]: r["action"] for r in dry.collect()}["h13"] == "would-copy"


FACTS = "entity_id long, kind string, target string, converted boolean, fetched boolean, digest_ok boolean, probe_ok boolean, probes long, n_missing long"


@pytest.mark.parametrize("queue", [True, False])
def test_triage_routes_by_probe_and_hands_over(spark, tmp_path, queue):
    ok = (True, True, True)
    facts = [(1, "scene", "windows", False, *ok, 3, 0), (2, "scene", "windows", False, *ok, 3, 1), (3, "scene", "windows", True, *ok, 3, 1), (4, "scene", "linux", True, *ok, 3, 0), (5, "scene", "windows", False, True, False, True, 3, 0), (6, "emote", "windows", False, *ok, 3, 0)]
    peer, lod = ["https://peer.example.org/content"], ["https://lods.example.com/a.fbx"]
    want, rows = {}, []
    cases = [(1, 0, 0, 0, peer, "fast_path"), (2, 0, 0, 0, peer, "conversion"), (3, 0, 0, 0, peer, "fast_path"), (3, 0, 1, 0, peer, "conversion"), (4, 0, 0, 0, peer, "failed"), (5, 0, 0, 0, peer, "failed"), (6, 0, 0, 0, peer, "conversion"), (7, 0, 0, 0, peer, "conversion")]
    # Forced and ISS jobs go to the engine, whatever a probe would say of their target, digest or earlier conversion.
    cases += [(e, 0, force, iss, peer, "conversion") for e in (1, 3, 4, 5, 7) for force, iss in ((1, 0), (0, 1), (1, 1))]
    cases += [(1, 1, 0, 0, peer, "conversion"), (1, 0, 0, 1, peer, "conversion"), (1, 0, 1, 0, peer, "conversion"), (None, 0, 0, 0, peer, "dropped"), (1, 0, 0, 0, [], "dropped"), (1, 0, 0, 0, ["https://evil.test/"], "dropped"), (1, None, None, None, peer, "fast_path")]
    for j, (e, lods, force, iss, servers, route) in enumerate(cases):
        rows.append((j, None, e, *(None if x is None else bool(x) for x in (lods, force, iss)), "x", float(j), servers, lod if lods else None))
        want[j] = route
    df = spark.createDataFrame(rows, triage.JOB_SCHEMA)

    def broken(rows, path):
        raise triage.PublishError(path)

    routed, converted = triage.run(spark, df, spark.createDataFrame(facts, FACTS), f"file://{tmp_path}/run", *([] if queue else [broken]))
    assert {r["job_id"]: r["route"] for r in routed.collect()} == want
    assert sorted(r["job_id"] for r in converted.collect()) == [j for j, x in want.items() if x == "conversion"]
    assert [f.startswith("queue") for f in os.listdir(tmp_path / "run" / "converted")].count(queue) >= 1


def test_streams_equal_their_batch_twins(spark):
    v = Views(spark, SF)
    batch = triage.triage(triage.addressed(v.v_jobs), catalogue._facts(v)).groupBy("lane", "route").agg(F.count("*").alias("n"), F.min("job_id").alias("first_job"))
    assert sorted(map(tuple, triage.run_once(v, catalogue._facts(v)).collect())) == sorted(map(tuple, batch.collect()))


def test_ttl_keeps_jobs_without_id(spark):
    v = Views(spark, SF)
    v.made["v_jobs"] = spark.createDataFrame([(i if i % 3 else None, 5) for i in range(9)], "job_id long, entity_id long").selectExpr("job_id", "timestamp'2024-01-01' ts", "entity_id", "false lods", "false force", "false iss", "'x' event_type", "1D value")
    assert [r["hits"] + r["probes"] for r in ttl.run_once(v).collect()] == [9]


def test_markers_expire_and_are_probed_again(spark, tmp_path):
    schema, got = "entity_id long", []
    with ttl.rocksdb(spark):
        for k, (wait, ids) in enumerate([(0, [1, 1, 2]), (0, [1]), (25, [1, 1])]):
            time.sleep(wait)
            spark.createDataFrame([(i,) for i in ids], schema).write.mode("append").parquet(f"file://{tmp_path}/in")
            out = ttl.markers(spark.readStream.schema(schema).parquet(f"file://{tmp_path}/in"), ttl_ms=22_000)
            out.writeStream.foreachBatch(lambda b, _: got.append(sorted(map(tuple, b.collect())))).option("checkpointLocation", f"file://{tmp_path}/c").trigger(once=True).start().awaitTermination()
    assert got == [[(1, 1, 1), (2, 0, 1)], [(1, 1, 0)], [(1, 1, 1)]]


def glb_rows(spark, *docs):
    df = spark.createDataFrame([(h, d) for h, d in docs], "hash string, doc string")
    return df.select("hash", gltf.glb_content(F.col("doc"), F.lit(2)).alias("content"), F.lit(".glb").alias("ext"))


def serve(spark, at, rows, checkpoint="c", **how):
    rows.write.mode("append").parquet(f"{at}/in-{checkpoint}")
    stream = spark.readStream.schema("hash string, content binary, ext string").parquet(f"{at}/in-{checkpoint}")
    before = ttl.served(spark, at).groupBy("hash").agg(F.sum("hits").alias("h"), F.sum("misses").alias("m"), F.sum("state_errors").alias("e")).collect() if os.path.exists(f"{at}/served".removeprefix("file://")) else []
    before = {r["hash"]: (r["h"], r["m"], r["e"]) for r in before}
    ttl.serve_uris(stream, at, f"{at}/{checkpoint}", **how).awaitTermination()
    after = ttl.served(spark, at).groupBy("hash").agg(F.sum("hits").alias("h"), F.sum("misses").alias("m"), F.sum("state_errors").alias("e")).collect()
    change = {r["hash"]: tuple(x - y for x, y in zip((r["h"], r["m"], r["e"]), before.get(r["hash"], (0, 0, 0)))) for r in after}
    return {h: x for h, x in change.items() if any(x)}


def test_reference_lists_live_for_their_time(spark, tmp_path):
    at, one, bad = f"file://{tmp_path}", '{"images":[{"uri":"a.png"}]}', "[]"
    with ttl.rocksdb(spark):
        rows = glb_rows(spark, ("a", one), ("a", one), ("b", bad), ("b", bad))
        assert serve(spark, at, rows, ttl_ms=6000) == {"a": (1, 1, 0), "b": (0, 2, 0)}
        time.sleep(8)
        assert serve(spark, at, glb_rows(spark, ("a", one), ("a", one)), ttl_ms=6000) == {"a": (1, 1, 0)}  # expired, and parsed again
        assert [tuple(r) for r in ttl.uri_store(spark, f"{at}/store").read().collect()] == [("a", '["a.png"]')]


def test_reference_lists_start_with_the_store_and_bad_ones_are_misses(spark, tmp_path):
    at, doc = f"file://{tmp_path}", '{"images":[{"uri":"x.png"}]}'
    ttl.uri_store(spark, f"{at}/store").upsert(spark.createDataFrame([("a", '["x.png"]'), ("b", "{not json"), ("c", '{"x": 1}')], "hash string, uris string"))
    with ttl.rocksdb(spark):
        rows = glb_rows(spark, ("a", doc), ("b", doc), ("b", doc), ("c", doc), ("d", doc))
        assert serve(spark, at, rows) == {"a": (1, 0, 0), "b": (1, 1, 1), "c": (0, 1, 1), "d": (0, 1, 0)}
        assert serve(spark, at, rows.where("hash <> 'a'")) == {"b": (2, 0, 0), "c": (1, 0, 0), "d": (1, 0, 0)}
    assert {tuple(r) for r in ttl.uri_store(spark, f"{at}/store").read().collect()} == {(h, '["x.png"]') for h in "abcd"}


@pytest.mark.parametrize("partitions", [1, 5])
def test_gauge_of_one_label_is_carried_over_ranges(spark, partitions):
    rows = [("hot" if i % 7 else None, i // 3, i, 1 if i % 3 else -1) for i in range(500)]
    df = spark.createDataFrame(rows, "worker string, ts long, id long, delta int").repartition(partitions)
    want, now = {}, {}
    for w, _, i, d in rows:
        now[w] = now.get(w, 0) + d
        want[i] = now[w]
    assert {r["id"]: r["running"] for r in control.running_gauge(df, ["worker"], "ts", "id").collect()} == want


def test_whole_files_keeps_larger_files_without_content(spark, tmp_path):
    for name, n in (("a.bin", 3), ("b.bin", 4), ("c.bin", 5), ("e.txt", 1)):
        (tmp_path / name).write_bytes(b"x" * n)
    got = {r["path"].split("/")[-1]: (r["length"], r["content"] and bytes(r["content"])) for r in records.whole_files(spark, f"file://{tmp_path}", "*.bin", 4).collect()}
    assert got == {"a.bin": (3, b"xxx"), "b.bin": (4, b"xxxx"), "c.bin": (5, None)}


def test_entry_module_needs_no_session():
    code = "import __spark_entry__ as e; assert e.queries() and set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(entry.__file__), timeout=120)
