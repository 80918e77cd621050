"""The job stream: two lanes, triage, and the hand-over to conversion, as Structured Streaming queries.

Delivery is at least once with sinks keyed by batch, so a replayed batch replaces itself; jobs are not lost when a worker fails.
A job whose entity has no facts counts as one whose content server did not answer.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from assetweave.functions import jobs as J
from assetweave.functions import names as N
from assetweave.operators import control as C
from assetweave.session import dealt, shared_folder, size_of

SCHEMA = "job_id long, ts timestamp, entity_id long, lods boolean, force boolean, iss boolean, event_type string, value double"
JOB_SCHEMA = SCHEMA + ", servers array<string>, lod_urls array<string>"
HANDED = JOB_SCHEMA + ", lane string"
HOSTS = "peer.example.org"
#: Bytes of job files that a batch takes at least.
BATCH = 1 << 30


class PublishError(Exception):
    """The hand-over to conversion failed; the jobs are still here."""


def shared_dir(spark: SparkSession) -> str:
    return shared_folder(spark, "stream")


def batch_bytes(spark: SparkSession, facts: str) -> int:
    """Each batch is joined with all facts: where it is no smaller than they are, all batches together read no more of them than jobs."""
    return max(BATCH, size_of(spark, facts))


def jobs(spark: SparkSession, folder: str, schema: str = SCHEMA, batch: int = BATCH) -> DataFrame:
    return spark.readStream.schema(schema).option("maxBytesPerTrigger", batch).parquet(folder)


def _probed(df: DataFrame, facts: DataFrame) -> DataFrame:
    """Jobs with ``reason`` (null for a good one), ``is_lod`` and what a probe says of their entity."""
    no = F.lit(False)
    is_lod = F.coalesce("lods", no)
    lod_urls = F.when(is_lod, F.col("lod_urls"))
    # The setting is read once, not for each address of each job.
    hosts = F.lit(df.sparkSession.range(1).select(J.allowed_hosts(F.lit(HOSTS))).first()[0])
    reason = J.reject_reason(F.col("entity_id").cast("string"), F.col("servers"), lod_urls, hosts)
    x = df.withColumns({"reason": reason, "is_lod": is_lod}).join(facts, "entity_id", "left")
    x = x.withColumns({"target": F.coalesce("target", F.lit(N.TARGETS[0]))} | {c: F.coalesce(c, no) for c in ("converted", "fetched", "digest_ok", "probe_ok")})
    outcome = C.outcome_of_facts(F.coalesce("force", no), F.coalesce("iss", no))
    return C.triaged(x.withColumn("outcome", F.when(F.col("reason").isNull() & ~F.col("is_lod"), outcome)), F.col("force"), F.col("iss"))


def triage(df: DataFrame, facts: DataFrame) -> DataFrame:
    """Routing of jobs by a probe of their entities, ``facts``; the same expression serves batches and streams.

    Adds lane, reason, outcome, exit_code and route: dropped (not a job), conversion (level of detail, or needs the engine), fast_path, failed.
    """
    lane = F.when(F.col("force"), "priority").otherwise("standard")
    route = F.when(F.col("reason").isNotNull(), "dropped").when(F.col("is_lod") | (F.col("triage") == "needs-unity"), "conversion").when(F.col("triage") == "failed", "failed").otherwise("fast_path")
    return _probed(df, facts).select(*df.columns, lane.alias("lane"), "reason", "outcome", F.col("triage_exit").alias("exit_code"), route.alias("route"))


def convert(df: DataFrame, facts: DataFrame) -> DataFrame:
    """What the second stage does of jobs handed over: probes again; a null exit_code is work for the engine, which isn't here."""
    return _probed(df, facts).where(F.col("reason").isNull()).select("job_id", "ts", "entity_id", "lane", "outcome", F.col("conversion_exit").alias("exit_code"))


def hand_over(rows: DataFrame, path: str) -> None:
    try:
        rows.write.mode("overwrite").parquet(path)
    except Exception as e:
        raise PublishError(path) from e


def start_triage(stream: DataFrame, facts: DataFrame, out: str, checkpoint: str, publish: Callable[[DataFrame, str], None] = hand_over) -> StreamingQuery:
    """Routes jobs; in a batch the priority lane is written first.  A batch writes its own folders, so a replay replaces them.

    The conversion jobs are published to ``out``/queue; if that fails, they are converted here, so that none is lost.
    """

    def write(batch: DataFrame, n: int) -> None:
        path = f"{out}/routed/batch={n}"
        triage(batch, facts).sort(F.col("lane") == "standard", "ts", "job_id").write.mode("overwrite").parquet(path)
        routed = batch.sparkSession.read.parquet(path)
        work = routed.where("route = 'conversion'").select(*batch.columns, "lane").sort(F.col("lane") == "standard", "ts", "job_id")
        try:
            publish(work, f"{out}/queue/batch={n}")
        except PublishError:
            convert(work, facts).write.mode("overwrite").parquet(f"{out}/converted/inline-{n}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def start_conversion(spark: SparkSession, facts: DataFrame, out: str, checkpoint: str, batch: int = BATCH) -> StreamingQuery:
    """The second stream: reads the queue that triage writes."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/queue")
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)

    def write(batch: DataFrame, n: int) -> None:
        convert(batch.drop("batch"), facts).sort(F.col("lane") == "standard", "ts", "job_id").write.mode("overwrite").parquet(f"{out}/converted/queue-{n}")

    return jobs(spark, f"{out}/queue", HANDED + ", batch long", batch).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def addressed(df: DataFrame) -> DataFrame:
    """The test jobs with addresses: some have no server, some a foreign one."""
    i = F.col("job_id")
    server = F.when(i % 101 == 0, F.array().cast("array<string>")).when(i % 103 == 0, F.array(F.lit("https://evil.test/"))).otherwise(F.array(F.lit("https://peer.example.org/content")))
    return df.withColumns({"servers": server, "lod_urls": F.when(F.col("lods"), F.array(F.lit("https://lods.example.com/a.fbx")))})


def run(spark: SparkSession, rows: DataFrame, facts: DataFrame, at: str, publish: Callable[[DataFrame, str], None] = hand_over) -> tuple[DataFrame, DataFrame]:
    """Both streams over what is there: the routed jobs, and the converted ones."""
    facts.write.parquet(f"{at}/facts")
    found = spark.read.parquet(f"{at}/facts")
    dealt(rows).write.parquet(f"{at}/jobs")
    size = batch_bytes(spark, f"{at}/facts")
    start_triage(jobs(spark, f"{at}/jobs", JOB_SCHEMA, size), found, at, f"{at}/checkpoint-triage", publish).awaitTermination()
    start_conversion(spark, found, at, f"{at}/checkpoint-conversion", size).awaitTermination()
    done = spark.read.schema("job_id long, ts timestamp, entity_id long, lane string, outcome string, exit_code int").option("recursiveFileLookup", "true")
    return spark.read.option("basePath", f"{at}/routed").parquet(f"{at}/routed/*"), done.parquet(f"{at}/converted")


def run_once(v, facts: DataFrame) -> DataFrame:
    """The events as a job stream through triage and conversion; jobs are counted by lane and by where they ended."""
    routed, converted = run(v.spark, addressed(v.v_jobs.withColumn("ts", F.col("ts").cast("timestamp"))), facts, shared_dir(v.spark))
    ended = routed.where("route <> 'conversion'").select("job_id", "lane", "route").unionByName(converted.select("job_id", "lane", F.lit("conversion").alias("route")))
    return ended.groupBy("lane", "route").agg(F.count("*").alias("n"), F.min("job_id").alias("first_job"))
