"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Hot keys: let AQE split a skewed join partition even where that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows are cheap to move and dear to parse: small tasks, so that none of them is a second wave of its own.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
    # HotSpot does not compile methods above this size; Spark then uses smaller generated functions.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the jobs rely on to an existing session."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def build_session(name: str = "lonja", cores: str = "*", partitions: int = 8, folder: str | None = None) -> SparkSession:
    """Local session for tests and the benchmark; ``folder`` is its shared working folder."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    if folder:
        builder = builder.config("spark.checkpoint.dir", folder)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="lonja-")


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    A local master may go without that setting (tests on one machine): a temporary folder is set then. On a
    cluster a missing setting is an error, since executors and driver do not see each other's disks.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "local")
        if not re.fullmatch(r"local(\[[^\[\]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a folder shared by driver and executors (master {master})")
        base = _local_folder()
    return f"{base.rstrip('/')}/lonja/{purpose}-{uuid.uuid4().hex}"


def materialized(df: DataFrame, purpose: str = "stage", codec: str | None = None) -> DataFrame:
    """Write rows that several later steps read to the shared folder, and continue from the files.

    Cuts the lineage, survives lost executors, and gives later joins the true size of their input.
    """
    spark = df.sparkSession
    path = work_folder(spark, purpose)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)
