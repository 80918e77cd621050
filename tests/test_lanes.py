"""Two queues: who is taken first, what can't be opened, and runs that fail half way."""

import json

import pytest
from pyspark.sql import functions as F

from assetweave.streaming import lanes as Q
from assetweave.streaming import triage as T

FACTS = "entity_id long, kind string, target string, converted boolean, fetched boolean, digest_ok boolean, probe_ok boolean, probes long, n_missing long"
PEER = ["https://peer.example.org/content"]


def jobs_of(spark, *rows):
    """(job_id, entity_id, lods, force)"""
    return spark.createDataFrame([(j, None, e, lods, force, False, "x", 0.0, PEER, ["https://lods.example.com/a.fbx"] if lods else None) for j, e, lods, force in rows], T.JOB_SCHEMA)


def put(spark, at, lane, name, *ids, text=None):
    body = [text] if text is not None else [json.dumps({"Message": json.dumps({"job_id": i})}) for i in ids]
    spark.createDataFrame([(b,) for b in body], "value string").coalesce(1).write.mode("append").text(f"{at}/queue={lane}/batch={name}")


def ids(rows):
    return sorted(r["job_id"] for r in rows.where("not malformed").collect())


def test_a_late_priority_message_passes_the_standard_backlog(spark, tmp_path):
    at, got = f"file://{tmp_path}", []
    for k in range(3):
        put(spark, f"{at}/q", "standard", f"s{k}", k)
    put(spark, f"{at}/q", "priority", "p", 100, 101)

    def handle(rows, lane, batch):
        got.append((lane, ids(rows)))
        if len(got) == 2:
            put(spark, f"{at}/q", "priority", "late", 102)
            put(spark, f"{at}/q", "standard", "late", 9)

    assert Q.take_round(spark, f"{at}/q", f"{at}/c", handle, "job_id long", 1) == 5
    assert [lane for lane, _ in got] == ["priority", "standard", "priority", "standard", "standard"]
    assert got[0][1] == [100, 101] and got[2][1] == [102] and sorted(sum((i for lane, i in got if lane == "standard"), [])) == [0, 1, 2]
    assert Q.take_round(spark, f"{at}/q", f"{at}/c", handle, "job_id long", 1) == 1 and got[-1] == ("standard", [9])
    assert Q.take_round(spark, f"{at}/q", f"{at}/c", handle, "job_id long", 1) == 0


def test_without_a_priority_queue_all_go_to_the_other(spark, tmp_path):
    at, got = f"file://{tmp_path}", []
    sent = Q.publish(jobs_of(spark, (1, 1, False, True), (2, 1, False, False)), F.col("force"), f"{at}/q", "b", lanes=False)
    assert sent == {"published": 2, "prioritized": 0}
    put(spark, f"{at}/q", "priority", "p", 5)
    Q.take_round(spark, f"{at}/q", f"{at}/c", lambda rows, lane, _: got.extend((lane, i) for i in ids(rows)), lanes=False)
    assert sorted(got) == [("standard", 1), ("standard", 2)]


@pytest.mark.parametrize("text", ["", "{", "null", '{"Message": null}', '{"Message": "{"}', '{"Message": "[]"}', '{"Other": "{}"}'])
def test_messages_that_cannot_be_opened(spark, text):
    good = json.dumps({"Message": json.dumps({"job_id": None})})
    rows = Q.opened(spark.createDataFrame([(text,), (good,)], "value string"), "job_id long, x string").collect()
    assert [tuple(r) for r in rows] == [(None, None, True), (None, None, False)]


def test_a_round_that_fails_is_made_again(spark, tmp_path):
    at, failed = f"file://{tmp_path}", []
    Q.publish(jobs_of(spark, (1, 1, False, True), (2, 1, False, False), (3, 2, False, False), (4, 3, True, False)), F.col("force"), f"{at}/q", "b")
    put(spark, f"{at}/q", "standard", "bad", text="{")
    facts = spark.createDataFrame([(1, "scene", "windows", False, True, True, True, 3, 0), (2, "scene", "linux", False, True, True, True, 3, 0)], FACTS)
    whole = Q.triage_handler(facts, at)

    def handle(rows, lane, batch):
        whole(rows, lane, batch)
        if lane == "standard" and not failed:
            failed.append(batch)
            raise RuntimeError("after the work, before the commit")

    rounds = []

    def one_round():
        rounds.append(0)
        rounds[-1] = Q.take_round(spark, f"{at}/q", f"{at}/c", handle)
        return rounds[-1]

    Q.consume(one_round, lambda: len(rounds) == 3, 0.01)
    assert failed and rounds[0] == 0 and rounds[1] >= 1 and rounds[2] == 0
    routes = {r["job_id"]: (r["lane"], r["route"]) for r in spark.read.parquet(f"{at}/routed/*").collect()}
    assert routes == {1: ("priority", "conversion"), 2: ("standard", "fast_path"), 3: ("standard", "failed"), 4: ("standard", "conversion"), None: ("standard", "dropped")}
    got = {(r["metric"].removeprefix("ab_converter_"), r["label"]): r["value"] for r in Q.metrics(spark, at).collect()}
    assert got == {
        ("job_queue_failures_total", "triage"): 1,
        ("triage_outcomes_total", "fast_path"): 1,
        ("triage_outcomes_total", "failed"): 1,
        ("triage_outcomes_total", "republished"): 1,
        ("asset_reuse_short_circuit_total", "windows"): 1,
        ("exit_codes", "0"): 1,
        ("exit_codes", "FAIL"): 1,
        ("conversion_queue_publish_total", "priority"): 1,
        ("conversion_queue_publish_total", "standard"): 1,
        ("job_queue_enqueue_total", "conversion"): 2,
    }
    Q.take_round(spark, f"{at}/conversion", f"{at}/cc", Q.conversion_handler(facts, at))
    assert {r["job_id"]: r["lane"] for r in spark.read.parquet(f"{at}/converted/*").collect()} == {1: "priority", 4: "standard"}


def test_work_that_cannot_be_handed_over_is_done_and_counted(spark, tmp_path):
    at = f"file://{tmp_path}"

    def send(*_):
        raise T.PublishError("queue")

    facts = spark.createDataFrame([(1, "scene", "windows", False, True, True, True, 3, 1)], FACTS)
    Q.publish(jobs_of(spark, (1, 1, False, False), (2, 1, False, False)), F.col("force"), f"{at}/q", "b")
    Q.take_round(spark, f"{at}/q", f"{at}/c", Q.triage_handler(facts, at, send))
    got = {r["metric"]: r["value"] for r in Q.metrics(spark, at).collect()}
    assert got == {"ab_converter_triage_outcomes_total": 2, "ab_converter_conversion_queue_publish_errors_total": 2, "ab_converter_republish_fallback_inline_total": 2}
    assert sorted(r["job_id"] for r in spark.read.parquet(f"{at}/converted/*").collect()) == [1, 2]


def test_a_queue_that_cannot_be_written_is_a_publish_error(spark):
    with pytest.raises(T.PublishError):
        Q.hand_over(jobs_of(spark, (1, 1, False, False)), F.col("force"), "file:///proc/none", "b")
