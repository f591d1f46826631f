"""Session defaults and the few helpers that need the session itself."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "pricewatch", master: str | None = None, **conf: str) -> SparkSession:
    """Session in UTC with adaptive execution; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, else the SQL warehouse. On a cluster a warehouse on the driver's own
    disk is refused."""
    if configured := spark.conf.get("spark.checkpoint.dir", None):
        return configured
    warehouse, master = spark.conf.get("spark.sql.warehouse.dir"), spark.sparkContext.master
    if on_one_machine(master) or not is_local(warehouse):
        return warehouse
    raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share; the warehouse {warehouse} is local")


def on_one_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def is_local(path: str) -> bool:
    return path.startswith("file:")


def new_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/pricewatch/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read back: later steps see the same rows, read only the
    columns they need, and survive lost executors."""
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _folder(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def folder_exists(spark: SparkSession, path: str) -> bool:
    store, target = _folder(spark, path)
    return store.exists(target)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below a path; none if it is not there."""
    store, target = _folder(spark, path)
    if not store.exists(target):
        return []
    return sorted(s.getPath().getName() for s in store.listStatus(target) if s.isDirectory())


def keyed_state(spark: SparkSession) -> None:
    """Keep the state of streaming operators in RocksDB: on the executor's disk, looked up by key, with changes in the checkpoint."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of any store that Spark reaches; none is fine."""
    store, target = _folder(spark, path)
    store.delete(target, True)
