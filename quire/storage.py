"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Where it is unset, a local session gets a folder of its own; a cluster is refused."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="quire-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none where there is no folder."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in files.listStatus(where)] if files.exists(where) else []


_FOLDERS: dict[str, str] = {}


def application_folder(spark: SparkSession) -> str:
    """A folder for this application's intermediate tables, removed when the driver's JVM ends, whether the session was stopped before or not."""
    name = spark.sparkContext.applicationId
    if name not in _FOLDERS:
        _FOLDERS[name] = path = f"{shared_dir(spark)}/quire-{name}"
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(where)
        files.deleteOnExit(where)
    return _FOLDERS[name]


class Table:
    """A DataFrame written to the shared folder: lineage is cut, lost executors lose nothing.

    ``drop`` removes it once nothing reads it any more; what results still read goes with the application's folder.
    """

    def __init__(self, spark: SparkSession, df: DataFrame):
        self.spark, self.path = spark, f"{application_folder(spark)}/{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(self.path)
        self.schema = df.schema

    @property
    def df(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def drop(self) -> None:
        remove(self.spark, self.path)
