"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local session without that setting (tests, a laptop) gets a folder of its own; on a cluster it has to be set.
    """
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="assetweave-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Bucketed:
    """``df`` written to the shared folder in buckets of ``column``: joins and groups by it don't move its rows again."""

    def __init__(self, df: DataFrame, name: str, column: str):
        self.spark, self.name, self.path = df.sparkSession, f"{name.replace('-', '_')}_{uuid.uuid4().hex}", new_path(df.sparkSession, name)
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        df.write.format("parquet").option("path", self.path).option("compression", "zstd").bucketBy(buckets, column).sortBy(column).saveAsTable(self.name)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        discard(self.spark, self.path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a working table that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def drop_tables(*tables: DataFrame) -> None:
    """Delete working tables that ``materialise`` wrote and nothing reads any more, and let Spark free the shuffles of finished jobs.

    Spark's context cleaner deletes a shuffle's files when the driver has collected the plan that made them; so this asks for that.
    """
    for t in tables:
        for folder in {f.rsplit("/", 1)[0] for f in t.inputFiles()}:
            discard(t.sparkSession, folder)
    gc.collect()
    if spark := SparkSession.getActiveSession():
        spark._jvm.java.lang.System.gc()


#: A written table of ids or hashes is broadcast if it has no more rows than this; beyond, both sides are shuffled.
BROADCAST_ROWS = 200_000


def small(table: DataFrame, bound: int = BROADCAST_ROWS) -> DataFrame:
    """``table`` (written before) with a broadcast hint if its counted rows are within the bound."""
    return F.broadcast(table) if table.count() <= bound else table


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def make_folder(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; other letters stay.

    Texts of one byte a character take the built-in ``lower``, which then does just that.
    """
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the decimal id, mod n; a missing id counts as remainder 0 of the empty string."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(n)
