"""What shows on larger tables only, on small ones that hold the case."""

import functools
import os
import pathlib
import re
import time

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from assetweave.functions import names
from assetweave.operators import backfill, containers, control
from assetweave.plans import catalogue
from assetweave.plans.views import Views
from assetweave.session import SHARE, SPLIT
from assetweave.sources import gltf
from assetweave.streaming import changes, lanes, triage, ttl


def folder_of(at, **tables):
    for name, columns in tables.items():
        pq.write_table(pa.table(columns), f"{at}/{name}.parquet")
    return str(at)


def twin(at, name, columns):
    """Rows of the query's SQL twin over the tables in ``at``."""
    con = duckdb.connect()
    for f in os.listdir(at):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{at}/{f}'")
    return sorted(con.execute(f"select {', '.join(columns)} from ({catalogue.SQL[name]}) q").fetchall(), key=repr)


def same_as_twin(spark, at, name):
    df = catalogue.queries()[name](spark, at)
    rows = sorted(map(tuple, df.collect()), key=repr)
    assert rows == twin(at, name, df.columns)
    return rows


def test_pixels_are_compared_in_single_precision(spark, tmp_path):
    # In single precision the second component is 139.0, nine from the first one's 130; in double precision it is 138.99...
    vectors = pa.array([[(130.5 - 128) / 127] * 4, [0.08661415427923203] * 4], pa.list_(pa.float32()))
    at = folder_of(tmp_path, embeddings={"vec_id": [0, 1], "label": [0, 0], "embedding": vectors})
    assert same_as_twin(spark, at, "image_affinity") == [(0, 4, 100, True), (1, 4, 0, False)]


@pytest.mark.parametrize("threshold", ["-1", "2000"])
def test_feed_whose_bases_are_joined_by_shuffles(spark, tmp_path, threshold):
    # Small tables are broadcast, and then the union of what is kept and what is new has no partitions of its own.
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        df = spark.range(3000).selectExpr("id entity_id", "'scene' type", "id % 900 base", "timestamp_seconds(id * 7 % 1000) ts")
        got = changes.run_changes(spark, df, F.col("entity_id") % 2 == 0, f"file://{tmp_path}").collect()
        want = {r["entity_id"]: r["previous"] for r in control.previous_deployment(df).collect()}
        assert {int(r["entity_id"]): r["previous"] and int(r["previous"]) for r in got} == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_placement_spreads_parts_and_places_a_part_once_a_nation(spark, tmp_path):
    ids = list(range(1, 121))
    at = folder_of(tmp_path, part={"p_partkey": ids, "p_size": [i % 7 + 1 for i in ids]}, supplier={"s_suppkey": ids, "s_nationkey": [i % 2 for i in ids]})
    assert any(r[1] is None for r in same_as_twin(spark, at, "placement"))
    assert catalogue.queries()["placement"](spark, at).rdd.getNumPartitions() >= 64


def test_placement_lists_the_same_suppliers_again_and_again(spark, tmp_path):
    parts, suppliers = range(6000), range(20_000)
    at = folder_of(tmp_path, part={"p_partkey": parts, "p_size": [i // 60 % 5 for i in parts]}, supplier={"s_suppkey": suppliers, "s_nationkey": [i // 50 % 5 for i in suppliers]})
    catalogue.queries()["placement"](spark, at).write.parquet(f"file://{at}/out")
    assert spark.read.parquet(f"file://{at}/out").count() == 2_001_000
    assert sum(f.stat().st_size for f in pathlib.Path(at, "out").glob("*.parquet")) < 1_000_000


def test_placement_of_lists_that_are_cut_and_of_missing_fields(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalogue, "PARTS", 2)
    monkeypatch.setattr(catalogue, "SUPPLIERS", 3)
    monkeypatch.setattr(catalogue, "PAIRS", 5)
    parts, suppliers = [1, 1, 61, 121, 181, 2, 55, None, None], [1, 1, 51, 101, 151, 201, 251, 2, 52, None]
    at = folder_of(tmp_path, part={"p_partkey": parts, "p_size": [4, 4, 4, 4, 4, None, 5, 4, None]}, supplier={"s_suppkey": suppliers, "s_nationkey": [3, 3, 3, 3, 3, 3, 0, None, 1, 2]})
    assert len(same_as_twin(spark, at, "placement")) == 5 * 7 + 2 + 3


def test_shuffles_and_splits_are_sized_by_the_table(spark, tmp_path):
    names = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = {n: spark.conf.get(n) for n in names}
    try:
        spark.conf.set(names[0], "4")
        spark.conf.unset(names[1])
        (tmp_path / "orders.parquet").mkdir()
        pq.write_table(pa.table({"x": pa.array(os.urandom(1 << 20) for _ in range(24))}), f"{tmp_path}/orders.parquet/a.parquet", compression="none")
        assert Views(spark, f"file://{tmp_path}").orders.rdd.getNumPartitions() >= 1
        assert int(spark.conf.get(names[0])) >= 6 and spark.conf.get(names[1]) == str(SPLIT)
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def test_a_task_reads_many_small_manifests(spark, tmp_path):
    settings = {"spark.sql.files.maxPartitionBytes": str(SPLIT), "spark.sql.files.openCostInBytes": str(4 << 20), "spark.sql.sources.parallelPartitionDiscovery.parallelism": "10000"}
    before = {n: spark.conf.get(n, None) for n in settings}
    for n, v in settings.items():
        spark.conf.set(n, v)
    try:
        (tmp_path / "manifest").mkdir()
        cores = spark.sparkContext.defaultParallelism
        for i in range(12 * cores):
            (tmp_path / "manifest" / f"e{i}_windows.json").write_text("{}")
        assert backfill.read_manifests(spark, f"file://{tmp_path}", f"file://{tmp_path}/run").count() == 12 * cores
        # Four files a task, with Spark's own price of a file, are three tasks a core; each writes a file.
        assert sum(f.endswith(".parquet") for f in os.listdir(tmp_path / "run" / "read")) <= cores + 1
        assert {n: spark.conf.get(n) for n in settings} == settings
    finally:
        for n, v in before.items():
            spark.conf.set(n, v) if v else spark.conf.unset(n)


@pytest.fixture
def deployments(tmp_path):
    """Tables of 40 bases with two deployments each, of which the second has a manifest."""
    ids = list(range(80))
    return folder_of(
        tmp_path,
        orders={"o_orderkey": ids, "o_custkey": [i % 40 for i in ids], "o_orderdate": ids, "o_orderstatus": ["F"] * 80},
        lineitem={"l_orderkey": [i // 6 for i in range(480)], "l_partkey": [i * 7 % 60 for i in range(480)]},
        part={"p_partkey": ids[:60], "p_size": [i % 50 for i in ids[:60]]},
    )


def test_backfill_stats_has_some_manifest_files_at_a_time(spark, deployments, monkeypatch, twelve):
    there, read, tasks, write = [], backfill.read_manifests, [], backfill.write_files

    def noted(files, *rest):
        tasks.append(files.rdd.getNumPartitions())
        write(files, *rest)

    monkeypatch.setattr(backfill, "write_files", noted)

    def counted(spark, bucket, *rest):
        made = pathlib.Path(bucket.removeprefix("file://")).parent
        there.append((len(list(made.glob("*/manifest/*_*.json"))), made))
        return read(spark, bucket, *rest)

    monkeypatch.setattr(backfill, "read_manifests", counted)
    monkeypatch.setattr(backfill, "read_in_pieces", functools.partial(backfill.read_in_pieces, piece=7, at_once=1))
    assert same_as_twin(spark, deployments, "backfill_stats")[0][0] == 40
    assert sum(n for n, _ in there) == 40 and max(n for n, _ in there) < 20
    assert not any(f.is_file() for _, made in there for f in made.rglob("*"))
    # A piece is as small in larger tables, whatever their shuffles are.
    assert max(tasks) <= spark.sparkContext.defaultParallelism < 12


def test_backfill_plan_digests_only_entities_with_a_manifest(spark, deployments, monkeypatch):
    asked, digests = [], containers.container_digests

    def noted(content, parsed):
        asked.append({r[0] for r in content.select("entity_id").distinct().collect()})
        return digests(content, parsed)

    monkeypatch.setattr(containers, "container_digests", noted)
    assert same_as_twin(spark, deployments, "backfill_plan")
    assert len(asked) == 1 and asked[0] and min(asked[0]) >= 40


def test_digests_group_by_entity_and_hash_after_one_shuffle(spark):
    scene = spark.createDataFrame([("e", 1, "m/a.glb", "a"), ("e", 2, "m/T.png", "t"), ("e", 3, "m/t.PNG", "u")], "entity_id string, pos long, file string, hash string")
    parsed = spark.createDataFrame([("a", ["t.png"], None)], "hash string, uris array<string>, error string")
    df = containers.container_digests(scene, parsed)
    assert [(r["digest"], r["skipped"]) for r in df.collect()] == [(control_digest(spark, "m/t.png", "u"), False)]
    # The finer grouping has no shuffle of its own.
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(entity_id" in plan and not re.search(r"hashpartitioning\(entity_id#\d+L?, pos#", plan)


def control_digest(spark, file, hash_):
    one = spark.createDataFrame([([(file, hash_)],)], "p array<struct<file string, hash string>>")
    return one.select(names.json_digest(F.col("p"))).first()[0]


def test_extension_without_a_pattern(spark):
    files = ["a.GLB", "x/y", "a.b/c", "a.", "", None, "..png", "a.b\n", "a\n.Png"]
    want = spark.createDataFrame([(f,) for f in files], "f string").select(names.extension(F.col("f")), F.lower(F.regexp_extract("f", r"(?s)(\.[^.]*)$", 1)))
    assert all(a == b for a, b in want.collect())


def test_only_files_that_a_thumbnail_names_compete_for_its_path(spark):
    content = spark.createDataFrame([("e", 1, "T.png", "a"), ("e", 2, "t.PNG", "b"), ("e", 3, "x/Autogenerated-Thumbnail.png", "c"), ("f", 1, "t.png", "d")], "entity_id string, pos long, file string, hash string")
    df = containers.metadata_only(content, spark.createDataFrame([("e", "T.PNG"), ("e", "t.png"), ("f", None)], "entity_id string, thumb string"))
    assert sorted(map(tuple, df.collect())) == [("e", "b", True, False), ("e", "c", False, True)]
    assert "LeftSemi" in df._jdf.queryExecution().optimizedPlan().toString()


def test_reference_lists_share_keys_of_state_and_end_one_by_one(spark, tmp_path):
    at, got, rows = f"file://{tmp_path}", [], []
    content = gltf.glb_content(F.lit('{"images":[{"uri":"a.png"}]}'), F.lit(2)).alias("content")

    def serve(wait, *hashes):
        time.sleep(wait)
        spark.createDataFrame([(h,) for h in hashes], "hash string").select("hash", content, F.lit(".glb").alias("ext")).write.mode("append").parquet(f"{at}/in")
        out = ttl.uri_lists(spark.readStream.schema("hash string, content binary, ext string").parquet(f"{at}/in"), ttl_ms=22_000, buckets=2)
        q = out.writeStream.foreachBatch(lambda b, _: got.append({r["hash"]: (r["hits"], r["misses"]) for r in b.collect()})).option("checkpointLocation", f"{at}/c").trigger(once=True).start()
        q.awaitTermination()
        rows.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])

    many = [f"h{i}" for i in range(200)]
    with ttl.rocksdb(spark):
        serve(0, *many, *many)
        serve(12, "new")
        serve(12, "new", "h7")
    assert got == [dict.fromkeys(many, (1, 1)), {"new": (0, 1)}, {"new": (1, 0), "h7": (0, 1)}]
    assert max(rows) < 100


def many_jobs(spark):
    cols = [F.col("id").alias("job_id"), F.lit(None).cast("timestamp").alias("ts"), (F.col("id") % 9).alias("entity_id"), F.lit(False).alias("lods"), (F.col("id") % 5 == 0).alias("force"), F.lit(False).alias("iss"), F.lit("x").alias("event_type"), F.lit(0.0).alias("value")]
    return triage.addressed(spark.range(3, 600).select(*cols)).where("size(servers) > 0")


FACTS = "entity_id long, kind string, target string, converted boolean, fetched boolean, digest_ok boolean, probe_ok boolean, probes long, n_missing long"


@pytest.fixture
def twelve(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    yield spark.createDataFrame([(i, "scene", "windows", False, True, True, True, 3, i % 2) for i in range(9)], FACTS)
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_jobs_are_dealt_by_the_shuffles_and_many_files_are_one_batch(spark, tmp_path, twelve):
    df = many_jobs(spark)
    routed, converted = triage.run(spark, df, twelve, f"file://{tmp_path}")
    assert routed.count() == df.count() and converted.count() == routed.where("route = 'conversion'").count() > 100
    parquet = lambda at: [f for f in os.listdir(tmp_path / at) if f.endswith(".parquet")]
    # Each batch is joined with all facts, so files must not make batches.
    assert len(parquet("jobs")) >= 12 and os.listdir(tmp_path / "routed") == ["batch=0"] and os.listdir(tmp_path / "converted") == ["queue-0"]


def test_messages_are_dealt_and_compressed_and_many_files_are_one_batch(spark, tmp_path, monkeypatch, twelve):
    monkeypatch.setattr(triage, "shared_dir", lambda _: f"file://{tmp_path}")
    df = many_jobs(spark)
    got = {(r["metric"], r["label"]): r["value"] for r in lanes.run_metrics(spark, df, twelve).collect()}
    assert got["job_queue_enqueue_total", "triage"] == df.count() == spark.read.parquet(f"file://{tmp_path}/routed/*").count()
    assert got["job_queue_enqueue_total", "conversion"] == spark.read.parquet(f"file://{tmp_path}/converted/*").count()
    files = [f for f in os.listdir(tmp_path / "queues/queue=standard/batch=all") if not f.startswith((".", "_"))]
    assert len(files) >= 12 and all(f.endswith(".txt.gz") for f in files)
    assert sorted(os.listdir(tmp_path / "routed")) == ["batch=priority-0", "batch=standard-0"]


@pytest.mark.parametrize("name", ["migration_stats", "drop_set", "migration_plan", "skip_counts", "manifest_merge"])
def test_tasks_keep_their_share_of_a_larger_table(spark, tmp_path, name):
    names = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = {n: spark.conf.get(n) for n in names}
    ids = list(range(60))
    at = folder_of(tmp_path, part={"p_partkey": ids, "p_size": [i % 50 for i in ids]})
    for t, columns in {
        "orders": {"o_orderkey": ids, "o_custkey": ids, "o_orderdate": ids, "o_orderstatus": ["F"] * 60},
        "lineitem": {"l_orderkey": [i // 6 for i in range(360)], "l_partkey": [i * 7 % 60 for i in range(360)]},
    }.items():
        (tmp_path / f"{t}.parquet").mkdir()
        pq.write_table(pa.table(columns), f"{at}/{t}.parquet/a.parquet")
    # Spark passes over this file, which makes the table as large as one that needs ten partitions.
    with open(f"{at}/lineitem.parquet/_more", "wb") as f:
        f.truncate(9 * SHARE)
    try:
        plan = catalogue.queries()[name](spark, f"file://{at}")._jdf.queryExecution().executedPlan().toString()
        assert set(re.findall(r"Exchange hashpartitioning\(.*, (\d+)\)", plan)) == {"10"}
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
