"""Session settings and the shared folder that survives the loss of executors."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A repeated JSON key takes its last value instead of failing the line.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Stream state on disk: the ids seen so far do not have to fit in memory.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every operator relies on."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", memory: str = "8g", shared: str | None = None) -> SparkSession:
    """A single-machine session for tests and the benchmark; ``shared`` is its shared folder."""
    partitions = "8" if cores == "*" else str(cores)
    named = {"spark.checkpoint.dir": f"{shared}/shared", "spark.sql.warehouse.dir": f"{shared}/warehouse"} if shared else {}
    spark = (
        SparkSession.builder.config(map=named).master(f"local[{cores}]")
        .appName("postlake")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, named by ``spark.checkpoint.dir``.

    Without that setting it lies in the warehouse, which all executors share as well; a folder of
    one machine, lost with that machine, is never taken.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    return f"{root.rstrip('/')}/postlake/{spark.sparkContext.applicationId}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that all later passes see the same
    rows and none is computed twice, whichever executors are lost."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cuts/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
