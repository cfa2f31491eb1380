"""Session helpers: durable intermediate tables."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
_local_folders: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as named by the cluster.

    Only a local session that names none gets a temporary folder.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    # the setting is fixed once a session runs, so the folder is remembered here
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="placeforge-")
    return _local_folders[app]


def durable(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table.

    Cuts lineage: later jobs, and retries after lost executors, read the files.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._work_path = path
    return table


def forget(table: DataFrame) -> None:
    """Removes a table that ``durable`` gave and that nothing reads any more."""
    _remove(table.sparkSession, table._work_path)


def forget_shuffles(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of plans that nothing refers to any more; it notices them when the driver collects garbage."""
    gc.collect()
    spark._jvm.System.gc()


def clear_work(spark: SparkSession) -> None:
    """Removes the intermediate tables of this application; results read from them must be written first."""
    _remove(spark, f"{work_dir(spark)}/{spark.sparkContext.applicationId}")


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
