"""The feed of deployments: its order, what is kept of it, and answers as deltas arrive."""

import json
import random

import pytest
from pyspark.sql import functions as F

from assetweave.operators import control
from assetweave.streaming import changes as W


def rows_of(spark, *rows):
    return spark.createDataFrame(list(rows), W.CHANGES)


def arrive(spark, at, *deltas):
    """(entity, type, ts, base) as one response of the feed."""
    body = json.dumps({"deltas": [{"entityId": e, "entityType": t, "localTimestamp": ts, "metadata": None if b is None else {"scene": {"base": b}}, "other": 1} for e, t, ts, b in deltas]})
    spark.createDataFrame([(body,)], "value string").coalesce(1).write.mode("append").text(f"{at}/feed")
    W.follow(W.changes(spark.readStream.schema(W.RESPONSE).json(f"{at}/feed")), at, f"{at}/c").awaitTermination()


def test_order_of_the_feed(spark):
    got = W.newest_first(rows_of(spark, ("a", "x", 1), ("b", "x", 3), ("c", "y", 3), ("d", None, None), ("a", "x", 1))).collect()
    assert [r["entity_id"] for r in got] == ["c", "b", "a", "d"]


def test_previous_as_deltas_arrive(spark, tmp_path):
    at = f"file://{tmp_path}"
    arrive(spark, at, ("a", "scene", 10, "0,0"), ("w", "wearable", 99, "0,0"), ("n", "scene", 5, None), ("m", "scene", 5, ""))
    arrive(spark, at, ("b", "scene", 20, "0,0"), ("c", "scene", 1, "9,9"))
    arrive(spark, at, ("b", "scene", 30, "0,0"), ("old", "scene", 2, "0,0"))  # b again, later; and one that is older than all
    got = {(r["entity_id"], r["ts"]): r["previous"] for r in spark.read.schema(W.CHANGES + ", previous string").parquet(f"{at}/answered/*").collect()}
    assert got == {("a", 10): None, ("n", 5): None, ("m", 5): None, ("b", 20): "a", ("c", 1): None, ("b", 30): "a", ("old", 2): "b"}
    kept = {r["base"]: (tuple(r["top"]), r["second"] and tuple(r["second"])) for r in W.newest_store(spark, f"{at}/newest").read().collect()}
    assert kept == {"0,0": ((30, "b"), (10, "a")), "9,9": ((1, "c"), None)}


@pytest.mark.parametrize("seed", [1, 2])
def test_what_is_kept_equals_the_whole_feed(spark, seed):
    r = random.Random(seed)
    rows = [(f"e{r.randrange(30):02d}", "hot" if r.random() < 0.4 else f"b{r.randrange(6)}", r.randrange(12)) for _ in range(120)]
    whole = W.two_newest(rows_of(spark, *rows))
    kept = W.two_newest(rows_of(spark, *rows[:50]))
    for _ in range(2):  # a batch that is made again
        kept = W.two_newest(W.kept_rows(kept).unionByName(rows_of(spark, *rows[50:])))
    assert sorted(map(str, whole.collect())) == sorted(map(str, kept.collect()))
    want = {}
    for e, b, _ in rows:
        others = [(t, x) for x, c, t in rows if c == b and x != e]
        want[e, b] = max(others)[1] if others else None
    assert {(x["entity_id"], x["base"]): x["previous"] for x in W.previous(rows_of(spark, *rows), kept).collect()} == want


def test_stream_equals_the_batch_query(spark, tmp_path):
    rows = [(i, "scene", i % 4 if i % 5 else None, i * 7 % 11) for i in range(10, 40)]
    df = spark.createDataFrame(rows, "entity_id long, type string, base long, n int").withColumn("ts", F.timestamp_seconds("n"))
    got = W.run_changes(spark, df, F.col("entity_id") % 2 == 0, f"file://{tmp_path}").collect()
    want = {r["entity_id"]: r["previous"] for r in control.previous_deployment(df).collect()}
    assert {int(r["entity_id"]): r["previous"] and int(r["previous"]) for r in got} == want
