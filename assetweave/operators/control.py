"""Decisions over jobs and entities: probe outcomes, their results, migration, metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assetweave import model as M
from assetweave.functions import names as N
from assetweave.session import written

# For each outcome of a probe, what triage answers (kind, exit code, metric) and what a conversion does (exit code; null: goes on).
RESULTS = (
    ("invalid-build-target", "failed", 5, None, 5),
    ("already-converted", "completed", 13, "already_converted", 13),
    ("content-server-unreachable", "needs-unity", None, "republished", None),
    ("no-asset-reuse", "needs-unity", None, "republished", None),
    ("digest-failed", "failed", 5, "failed", 5),
    ("cache-probe-skipped", "needs-unity", None, "republished", None),
    ("cache-probe-failed", "needs-unity", None, "republished", None),
    ("full-hit", "completed", 0, "fast_path", 0),
    ("partial-hit", "needs-unity", None, "republished", None),
)


def results(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(RESULTS), "outcome string, triage string, triage_exit int, triage_metric string, conversion_exit int")


def probe_outcome(
    *,
    target: Column,
    force: Column,
    iss: Column,
    converted: Column,
    fetched: Column,
    reuse: Column,
    kind: Column,
    digest_ok: Column,
    probe_ok: Column,
    probes: Column,
    missing: Column,
) -> Column:
    """The outcome of a probe: the first rule in order that holds."""
    return (
        F.when(~F.coalesce(target.isin(*N.TARGETS), F.lit(False)), "invalid-build-target")
        .when(~force & converted, "already-converted")
        .when(~fetched, "content-server-unreachable")
        .when(~reuse | iss | (kind != "scene"), "no-asset-reuse")
        .when(~digest_ok, "digest-failed")
        .when(force, "cache-probe-skipped")
        .when(~probe_ok, "cache-probe-failed")
        .when((F.coalesce(probes, F.lit(0)) > 0) & (missing == 0), "full-hit")
        .otherwise("partial-hit")
    )


def outcome_of_facts(force: Column, iss: Column) -> Column:
    """``probe_outcome`` over the columns kind, target, converted, fetched, digest_ok, probe_ok, probes, n_missing."""
    return probe_outcome(
        target=F.col("target"),
        force=force,
        iss=iss,
        converted=F.col("converted"),
        fetched=F.col("fetched"),
        reuse=F.lit(True),
        kind=F.col("kind"),
        digest_ok=F.col("digest_ok"),
        probe_ok=F.col("probe_ok"),
        probes=F.col("probes"),
        missing=F.col("n_missing"),
    )


def with_results(df: DataFrame) -> DataFrame:
    return df.join(F.broadcast(results(df.sparkSession)), "outcome", "left")


def triaged(df: DataFrame, force: Column, iss: Column) -> DataFrame:
    """``with_results``, but forced and ISS jobs need the engine whatever a probe would say: triage asks before it probes."""
    out, at_once = with_results(df), F.coalesce(force, F.lit(False)) | F.coalesce(iss, F.lit(False))
    rule = {"triage": F.lit("needs-unity"), "triage_exit": F.lit(None).cast("int"), "triage_metric": F.lit("republished")}
    return out.withColumns({c: F.when(at_once & F.col("outcome").isNotNull(), v).otherwise(F.col(c)) for c, v in rule.items()})


def previous_deployment(entities: DataFrame) -> DataFrame:
    """For each entity the newest other deployment of the same base: the newest of all, or for that one the newest but one.

    Two aggregates instead of a window: a base with a large share of the rows is combined before the shuffle.
    """
    newest = F.max(F.struct("ts", "entity_id"))["entity_id"]
    top = entities.groupBy("base").agg(newest.alias("_top"))
    marked = entities.join(top, "base", "left")
    second = marked.where(F.col("entity_id") != F.col("_top")).groupBy("base").agg(newest.alias("_second"))
    previous = F.when(F.col("entity_id") == F.col("_top"), F.col("_second")).otherwise(F.col("_top"))
    return marked.join(second, "base", "left").select("entity_id", "base", F.when(F.col("base").isNotNull(), previous).alias("previous"))


def manifest_fates(
    manifests: DataFrame,
    version: str,
    entities: DataFrame | None = None,
    unreadable: Column | None = None,
    without_server: Column | None = None,
    digest_failed: Column | None = None,
) -> DataFrame:
    """``manifests`` with ``fate``, the first that holds: error (unreadable), skipped, no-server, no-entity, digest-failed, kept.

    ``entities``: entity_id of those whose content the server still lists; a manifest of any other has no entity.  Flags
    that are null or not given count as false.
    """
    good = (F.col("exit_code") == 0) & (F.col("version") == version)
    flag = lambda c: F.lit(False) if c is None else F.coalesce(c, F.lit(False))
    df, gone = manifests.withColumns({"_unreadable": flag(unreadable), "_no_server": flag(without_server), "_undigested": flag(digest_failed)}), F.lit(False)
    if entities is not None:
        df = df.join(entities.select("entity_id").distinct().withColumn("_active", F.lit(True)), "entity_id", "left")
        gone = F.col("_active").isNull()
    fate = F.when(F.col("_unreadable"), "error").when(~F.coalesce(good, F.lit(False)), "skipped").when(F.col("_no_server"), "no-server").when(gone, "no-entity").when(F.col("_undigested"), "digest-failed").otherwise("kept")
    return df.select(*manifests.columns, fate.alias("fate"))


def migration(files: DataFrame, fates: DataFrame, inventory: DataFrame, dry_run: bool = False, failed: Column | None = None) -> DataFrame:
    """What becomes of every listed bundle of the manifests that are kept.

    ``files``: entity_id, hash, source_key, is_gltf, digest, skipped; ``fates``: of ``manifest_fates``; ``inventory``: hash of what the
    canonical prefix holds; ``failed``: on the files' columns, a bundle whose probe or copy fails.
    Columns: the files' own, target_name, action (skipped, canonical, missing-source, copied, would-copy, error).
    """
    kept = fates.where(F.col("fate") == "kept").select("entity_id")
    there = inventory.select("hash").distinct().withColumn("_there", F.lit(True))
    out = files.withColumn("_failed", F.lit(False) if failed is None else F.coalesce(failed, F.lit(False))).join(kept, "entity_id", "left_semi").join(there, "hash", "left")
    name = F.when(F.col("is_gltf"), F.concat("hash", F.lit("_"), "digest", F.lit("_windows"))).otherwise(F.concat("hash", F.lit("_windows")))
    # A container without a digest has no canonical name: an error of this bundle only.
    wrong = F.col("_failed") | (F.col("is_gltf") & F.col("digest").isNull())
    action = F.when(F.col("skipped"), "skipped").when(wrong, "error").when(F.col("_there").isNotNull(), "canonical")
    action = action.when(F.lit(dry_run), "would-copy").when(F.col("source_key").isNull(), "missing-source").otherwise("copied")
    return out.withColumn("target_name", F.when(~F.col("skipped"), name)).withColumn("action", action).drop("_there", "_failed")


def migration_stats(fates: DataFrame, plan: DataFrame) -> DataFrame:
    """One row of counters; it is there even without any input."""
    of = lambda x: F.count_if(F.col("fate") == x)
    scanned = fates.agg(
        F.count("*").alias("manifests_scanned"),
        of("kept").alias("manifests_kept"),
        of("skipped").alias("manifests_skipped"),
        of("no-server").alias("manifests_missing_content_server"),
        of("no-entity").alias("manifests_entity_fetch_failed"),
        of("digest-failed").alias("manifests_digest_failed"),
        of("error").alias("_unreadable"),
    )
    copied = F.col("action").isin("copied", "would-copy")
    counted = plan.agg(
        F.count_if(F.col("action") != "skipped").alias("bundles_probed"),
        F.count_if(F.col("action") == "canonical").alias("bundles_already_canonical"),
        F.count_if(copied).alias("bundles_copied"),
        F.count_if(copied & F.col("is_gltf")).alias("glb_renamed"),
        F.count_if(F.col("action") == "missing-source").alias("bundles_missing_source"),
        F.count_if("skipped").alias("glb_skipped"),
        F.count_if(F.col("action") == "error").alias("errors"),
    )
    return scanned.crossJoin(counted).withColumn("errors", F.col("errors") + F.col("_unreadable")).drop("_unreadable")  # one row each


def histogram(jobs: DataFrame, seconds: str, labels: list[str]) -> DataFrame:
    """Cumulative buckets in the long form (labels, le, value), le '+Inf' for all."""
    aggs = [F.count_if(F.col(seconds) <= b).alias(str(b)) for b in M.HISTOGRAM_BUCKETS]
    wide = jobs.groupBy(*labels).agg(*aggs, F.count("*").alias("+Inf"))
    return wide.unpivot(labels, [*map(str, M.HISTOGRAM_BUCKETS), "+Inf"], "le", "value")


def running_gauge(steps: DataFrame, labels: list[str], ts: str, tie: str) -> DataFrame:
    """A gauge after each event: the running sum of +1 (start) and -1 (finish).

    A label's history may be any part of the rows: it is cut into ranges, whose sums are carried from range to range, and only within a range
    are events added up one by one.
    """
    n = int(steps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(steps.repartitionByRange(n, *labels, ts, tie).withColumn("_range", F.spark_partition_id()), "gauge")
    sums = ranged.groupBy(*labels, "_range").agg(F.sum("delta").alias("_sum"))
    before = F.sum("_sum").over(Window.partitionBy(*labels).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    carried = sums.select(*[F.col(c).alias(f"_{c}") for c in labels], F.col("_range").alias("_of"), F.coalesce(before, F.lit(0)).alias("_before"))
    same = F.col("_range") == F.col("_of")
    for c in labels:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    w = Window.partitionBy("_range", *labels).orderBy(ts, tie).rowsBetween(Window.unboundedPreceding, 0)
    return ranged.join(carried, same).select(*steps.columns, (F.sum("delta").over(w) + F.col("_before")).alias("running"))


def tolerated(total: Column, failed: Column, tolerance: float) -> Column:
    """Failures up to the tolerance, rounded half to even."""
    return failed <= F.bround(total * F.lit(tolerance).cast("decimal(10,4)"), 0)


def sticky_code(codes: Column) -> Column:
    """Folds codes in order: once tolerated errors were seen, a later success doesn't hide them."""
    return F.aggregate(codes, F.lit(1), lambda a, x: F.when((a == M.TOLERATED) & (x == M.OK), a).otherwise(x))


def finished_event(platform: Column, entity: Column, lods: Column, world: Column, code: Column, version: Column, ts_ms: Column) -> Column:
    return F.struct(
        F.lit("asset-bundle").alias("type"),
        F.lit("converted").alias("subType"),
        F.concat(entity, F.lit("-"), platform).alias("key"),
        ts_ms.alias("timestamp"),
        F.struct(platform.alias("platform"), entity.alias("entityId"), lods.alias("isLods"), world.alias("isWorld"), code.alias("statusCode"), version.alias("version")).alias("metadata"),
    )


def envelope(job: Column) -> Column:
    """A queue message: JSON inside JSON."""
    return F.to_json(F.struct(F.to_json(job).alias("Message")))


def opened(body: Column, schema: str = M.JOB) -> Column:
    return F.from_json(F.get_json_object(body, "$.Message"), schema)
