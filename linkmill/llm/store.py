"""Intermediate tables in the folder that driver and executors share.

Lineage is cut by writing Parquet below ``spark.checkpoint.dir`` and reading it
back, so a lost executor costs only the tasks it ran.  The setting is read from
the session; a folder of our own is used only where it is unset and driver and
executors are one process (tests).  The tables are deleted when the application ends.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_FALLBACK: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; in local mode without it, one temporary folder a process."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if "dir" not in _FALLBACK:
            _FALLBACK["dir"] = "file://" + tempfile.mkdtemp(prefix="linkmill-")
        base = _FALLBACK["dir"]
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/linkmill/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, name: str, path: str | None = None) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet in the shared folder; return the reread table and its path."""
    spark = df.sparkSession
    path = path or new_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    return spark.read.schema(df.schema).parquet(path), path


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete intermediate tables that no later plan reads."""
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
