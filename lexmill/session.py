"""Session helpers: reading tables, shared scratch folder, lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def let_workers_import(spark: SparkSession) -> None:
    """Put the folder of this package on the path of the Python workers, for sessions started elsewhere."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors share, from ``spark.checkpoint.dir``.

    Where the session names none, an own folder is made and set, in local mode only: on a cluster each executor
    would write to its own disk, so there it is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors share (master {master})")
        path = tempfile.mkdtemp(prefix="lexmill-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for a written table, in the folder of this application, which is deleted when the driver's JVM ends."""
    folder = f"{shared_dir(spark)}/lexmill/{spark.sparkContext.applicationId}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage of ``df``: write it to the shared folder as Parquet and read it again.

    The files survive the loss of any executor, unlike a local checkpoint.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table (a file or a folder of files) of a data directory."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def width(spark: SparkSession, floor: int = 1) -> int:
    """Number of shuffle partitions the session asks for, at least ``floor``."""
    return max(floor, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
