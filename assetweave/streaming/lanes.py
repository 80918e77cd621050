"""Two queues of job messages as streams of their own: standard work is taken up only where the priority queue is empty, and what is done is counted meanwhile.

Each queue is a folder of message files with its own checkpoint.  Before each batch of the standard queue the priority queue is read until nothing
is left in it, so a message that comes late passes all standard work that has not begun.  Delivery is at least once: a batch that is made
again replaces its own files.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from assetweave.operators import control as C
from assetweave.operators.sinks import queue_messages
from assetweave.session import dealt
from assetweave.streaming import triage as T

STANDARD, PRIORITY = "standard", "priority"
METRICS = "metric string, label string, value long"
Handle = Callable[[DataFrame, str, str], None]


def publish(jobs: DataFrame, prioritize: Column, queues: str, batch: str, lanes: bool = True) -> dict[str, int]:
    """Jobs as messages into the folder ``queues``, in place of those of an equal ``batch``; returns what was counted on the way."""
    seen = Observation()
    rows = queue_messages(jobs, F.struct(*jobs.columns), prioritize, STANDARD, PRIORITY if lanes else None)
    rows = rows.observe(seen, F.count("*").alias("published"), F.count_if(F.col("queue") == PRIORITY).alias("prioritized"))
    out = rows.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    out.option("compression", "gzip").partitionBy("queue", "batch").text(queues)
    return seen.get


def hand_over(jobs: DataFrame, prioritize: Column, queues: str, batch: str) -> dict[str, int]:
    try:
        return publish(jobs, prioritize, queues, batch)
    except Exception as e:
        raise T.PublishError(queues) from e


def opened(messages: DataFrame, schema: str) -> DataFrame:
    """The jobs of messages; ``malformed`` ones are rows of nulls."""
    inner = F.get_json_object("value", "$.Message")
    parsed = F.when(F.schema_of_variant(F.try_parse_json(inner)).startswith("OBJECT"), F.from_json(inner, schema))
    return messages.select(parsed.alias("job")).select("job.*", F.col("job").isNull().alias("malformed"))


def take_round(spark: SparkSession, queues: str, checkpoint: str, handle: Handle, schema: str = T.JOB_SCHEMA, files_per_batch: int = 8, lanes: bool = True, batch_bytes: int | None = None) -> int:
    """All that is in the queues: first the priority queue, and it again before each batch of ``files_per_batch`` files of the standard one, or of ``batch_bytes``.

    ``handle`` gets the jobs of a batch (``opened``), its queue and a name that stays the same when the batch is made again.  Returns the number of batches.
    """
    done, limit = 0, ("maxBytesPerTrigger", batch_bytes) if batch_bytes else ("maxFilesPerTrigger", files_per_batch)
    for lane in (PRIORITY, STANDARD):
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{queues}/queue={lane}")
        p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)

    def drain(lane: str, before: Callable[[], None]) -> None:
        def write(batch: DataFrame, n: int) -> None:
            nonlocal done
            before()
            handle(opened(batch, schema), lane, f"{lane}-{n}")
            done += 1

        stream = spark.readStream.schema("value string, batch string").option(*limit).text(f"{queues}/queue={lane}")
        stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{checkpoint}/{lane}").trigger(availableNow=True).start().awaitTermination()

    first = (lambda: drain(PRIORITY, lambda: None)) if lanes else (lambda: None)
    first()
    drain(STANDARD, first)
    return done


def consume(one_round: Callable[[], int], stop: Callable[[], bool], pause: float = 1.0) -> None:
    """Rounds until ``stop``; a pause follows one that failed, which is then made again, and one that found nothing."""
    while not stop():
        try:
            idle = one_round() == 0
        except Exception:
            logging.getLogger(__name__).exception("a round over the queues failed")
            idle = True
        if idle and not stop():
            time.sleep(pause)


def _count(spark: SparkSession, out: str, batch: str, rows: list[tuple[str, str | None, int]]) -> None:
    """What a batch counted, in place of what it counted before."""
    spark.createDataFrame([r for r in rows if r[2]], METRICS).coalesce(1).write.mode("overwrite").parquet(f"{out}/metrics/batch={batch}")


def metrics(spark: SparkSession, out: str) -> DataFrame:
    """The counters under ``out``: metric, label, value."""
    return spark.read.schema(METRICS).parquet(f"{out}/metrics/*").groupBy("metric", "label").agg(F.sum("value").alias("value"))


def triage_handler(facts: DataFrame, out: str, send: Callable[[DataFrame, Column, str, str], dict[str, int]] = hand_over) -> Handle:
    """Triage of a batch: the routed jobs under ``out``/routed, work for the engine to the queues under ``out``/conversion, in its lane, counters beside them.

    Where the work can't be handed over it is converted here, so that none is lost.
    """

    def handle(jobs: DataFrame, lane: str, batch: str) -> None:
        # Counted where the rows are written, so that no stage that runs again counts twice.
        seen, of = Observation(), lambda r, *o: F.count_if((F.col("route") == r) & ~F.coalesce("lods", F.lit(False)) & (F.col("outcome").isin(*o) if o else F.lit(True)))
        path = f"{out}/routed/batch={batch}"
        routed = T.triage(jobs, facts).withColumn("lane", F.lit(lane))
        counts = {
            "malformed": F.count_if("malformed"),
            "already_converted": of("fast_path", "already-converted"),
            "fast_path": of("fast_path", "full-hit"),
            "failed": of("failed"),
            "republished": of("conversion"),
        }
        routed.observe(seen, *[c.alias(n) for n, c in counts.items()]).write.mode("overwrite").parquet(path)
        got, spark = seen.get, jobs.sparkSession
        # Names and labels of the counters.
        rows = [("job_queue_failures_total", "triage", got["malformed"])]
        rows += [("ab_converter_triage_outcomes_total", k, got[k]) for k in ("already_converted", "fast_path", "failed", "republished")]
        rows += [("ab_converter_asset_reuse_short_circuit_total", "windows", got["fast_path"])]
        rows += [("ab_converter_exit_codes", "0", got["fast_path"]), ("ab_converter_exit_codes", "FAIL", got["failed"])]
        work = spark.read.parquet(path).where("route = 'conversion'").select(*[c for c in jobs.columns if c != "malformed"])
        try:
            sent = send(work, F.lit(lane == PRIORITY), f"{out}/conversion", batch)["published"]
            rows += [("ab_converter_conversion_queue_publish_total", lane, sent), ("job_queue_enqueue_total", "conversion", sent)]
        except T.PublishError:
            inline = Observation()
            done = T.convert(work.withColumn("lane", F.lit(lane)), facts).observe(inline, F.count("*").alias("n"))
            done.write.mode("overwrite").parquet(f"{out}/converted/batch=inline-{batch}")
            rows += [(f"ab_converter_{k}_total", "windows", inline.get["n"]) for k in ("conversion_queue_publish_errors", "republish_fallback_inline")]
        _count(spark, out, batch, rows)

    return handle


def conversion_handler(facts: DataFrame, out: str) -> Handle:
    """The second stage: what was handed over is probed again and converted, the priority lane first."""

    def handle(jobs: DataFrame, lane: str, batch: str) -> None:
        rows = jobs.where("not malformed").drop("malformed").withColumn("lane", F.lit(lane))
        T.convert(rows, facts).write.mode("overwrite").parquet(f"{out}/converted/batch={batch}")

    return handle


def run_lanes(spark: SparkSession, jobs: DataFrame, late: Column) -> DataFrame:
    """Jobs (job_id, force and others) through both queues, those that are ``late`` once the first standard batch has come: how many came by queue and
    lateness, and in which place the last of them did."""
    at, order = T.shared_dir(spark), []
    publish(jobs.where(~late).repartition(4), F.col("force"), f"{at}/queues", "early")

    # What is in the standard queue now is taken in several batches, whatever comes later.
    def handle(rows: DataFrame, lane: str, batch: str) -> None:
        if lane == STANDARD and not any(b.startswith(STANDARD) for b in order):
            publish(jobs.where(late).repartition(4), F.col("force"), f"{at}/queues", "late")
        order.append(batch)
        rows.where("not malformed").withColumns({"lane": F.lit(lane), "turn": F.lit(len(order))}).write.mode("overwrite").parquet(f"{at}/taken/batch={batch}")

    for _ in range(2):
        take_round(spark, f"{at}/queues", f"{at}/checkpoint", handle, files_per_batch=1)
    taken = spark.read.parquet(f"{at}/taken/*")
    counted = taken.groupBy("lane", F.coalesce(late, F.lit(False)).alias("late")).agg(F.count("*").alias("jobs"), F.max("turn").alias("turn"))
    turns = sorted(r["turn"] for r in counted.select("turn").collect())  # at most four
    return counted.select("lane", "late", "jobs", F.array_position(F.array(*map(F.lit, turns)), F.col("turn")).alias("place"))


def run_metrics(spark: SparkSession, jobs: DataFrame, facts: DataFrame) -> DataFrame:
    """The counters of a run of all jobs through triage and conversion, collected while it goes on."""
    at = T.shared_dir(spark)
    facts.write.parquet(f"{at}/facts")
    found = spark.read.parquet(f"{at}/facts")
    sent, size = publish(dealt(jobs), F.col("force"), f"{at}/queues", "all"), T.batch_bytes(spark, f"{at}/facts")
    _count(spark, at, "published", [("job_queue_enqueue_total", "triage", sent["published"])])
    take_round(spark, f"{at}/queues", f"{at}/triage", triage_handler(found, at), batch_bytes=size)
    take_round(spark, f"{at}/conversion", f"{at}/converting", conversion_handler(found, at), batch_bytes=size)
    return metrics(spark, at)
