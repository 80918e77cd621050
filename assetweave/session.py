"""A Spark session with the settings that the engine's results rely on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a table, compressed, for each shuffle partition; most bytes of a split and of shuffle partitions that are joined.
SHARE = 4 << 20
SPLIT = 16 << 20


def session(app: str = "assetweave", cores: int | None = None, **conf: str) -> SparkSession:
    """UTC clock, ANSI arithmetic, adaptive execution; ``conf`` adds or replaces settings.

    Only for a session of one's own (tests, bench); on a cluster use the one that is there.
    """
    n = cores or os.cpu_count() or 4
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(n),
        "spark.ui.enabled": "false",
    }
    return SparkSession.builder.appName(app).master(f"local[{n}]").config(map=settings | conf).getOrCreate()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share, under ``spark.checkpoint.dir``; only a local session may do without that setting."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="assetweave-")
        spark.conf.set("spark.checkpoint.dir", at)
    return f"{at.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of the files under ``path``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def dealt(df: DataFrame, least: int = 4) -> DataFrame:
    """``df`` over as many partitions as the session's shuffles have, so that files written of it are no larger when there are more rows."""
    return df.repartition(max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def fitted(spark: SparkSession, path: str) -> None:
    """Sizes the session's shuffles and splits by the table at ``path``, so that a task's share stays the same however large the table is.

    The number of shuffle partitions is only raised and the size of splits only lowered; adaptive execution joins what turns out small.
    """
    if (n := -(-size_of(spark, path) // SHARE)) > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
    conf = spark._jsparkSession.sessionState().conf()
    if conf.filesMaxPartitionBytes() > SPLIT:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(SPLIT))
    # What adaptive execution joins is no larger than a split either.
    joined = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if conf.getConf(getattr(spark._jvm.org.apache.spark.sql.internal.SQLConf, "ADVISORY_PARTITION_SIZE_IN_BYTES")()) > SPLIT:
        spark.conf.set(joined, str(SPLIT))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: several readers share one computation.  Its row groups are as small as a split."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession, name)
    df.write.option("parquet.block.size", str(SPLIT)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
