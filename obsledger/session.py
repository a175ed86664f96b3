"""Session settings the operators are tuned for, and the shared folder for written state."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution picks join strategies and splits skewed partitions at run time.
# forceOptimizeSkewedJoin lets it do so even where that costs one more shuffle.
# hugeMethodLimit is what the JVM still compiles; larger fused methods would be interpreted,
# so those plans fall back to one method per expression.
SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

GIVE_BACK = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", memory: str = "8g", shuffle_partitions: int = 8) -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("obsledger")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by `spark.checkpoint.dir`.

    Only a local session without the setting, as in tests, gets a temporary folder, which goes
    when the process ends; on a cluster a missing setting is an error, since a machine-local
    folder would not survive. What is written below the folder of the setting stays until its
    owner clears it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="obsledger-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run below the shared one."""
    return f"{shared_dir(spark)}/{name}/{uuid4().hex}"


@contextmanager
def shuffles_given_back(spark: SparkSession) -> Iterator[None]:
    """What is written inside removes its shuffle files when it ends, not when the driver comes to collect garbage."""
    before = spark.conf.get(GIVE_BACK, None)
    spark.conf.set(GIVE_BACK, "true")
    try:
        yield
    finally:
        spark.conf.unset(GIVE_BACK) if before is None else spark.conf.set(GIVE_BACK, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table written to the shared folder: what follows reads columns, not the whole lineage."""
    spark = df.sparkSession
    path = run_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """`written` for what several branches of a plan read: packed (digests as text take half), its shuffle files given back."""
    spark = df.sparkSession
    path = run_folder(spark, name)
    with shuffles_given_back(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
