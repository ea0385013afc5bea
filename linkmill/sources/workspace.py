"""Tables that later steps read more than once, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; in local mode without it, as in tests, a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if not _OWN:
            _OWN.append("file://" + tempfile.mkdtemp(prefix="linkmill-index-"))
        base = _OWN[0]
    return f"{base.rstrip('/')}/linkmill-index"


_SWEEP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCK = threading.Lock()
#: For each session: writers at work, and the setting before them.
_WRITERS: dict[int, list] = {}


@contextmanager
def _swept(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written go when it is written, not when the driver happens to collect its garbage."""
    key = spark._jsparkSession.hashCode()
    with _LOCK:
        writers = _WRITERS.setdefault(key, [0, None])
        if not writers[0]:
            writers[1] = spark.conf.get(_SWEEP, "false")
            spark.conf.set(_SWEEP, "true")
        writers[0] += 1
    try:
        yield
    finally:
        with _LOCK:
            writers[0] -= 1
            if not writers[0]:
                spark.conf.set(_SWEEP, writers[1])


def _place(spark: SparkSession, path: str) -> tuple:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _write(df: DataFrame, path: str) -> None:
    with _swept(df.sparkSession):
        df.write.mode("append").parquet(path)
    p, files = _place(df.sparkSession, path)
    files.deleteOnExit(p)  # when the application ends


def _new(spark: SparkSession, name: str) -> str:
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and reread: lineage is cut, and a lost executor costs only its tasks."""
    path = _new(df.sparkSession, name)
    _write(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def lent(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``stored`` until the block ends."""
    spark, path = df.sparkSession, _new(df.sparkSession, name)
    try:
        _write(df, path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        p, files = _place(spark, path)
        files.delete(p, True)


class Grown:
    """A stored table that is written in parts; ``table`` reads all of them."""

    def __init__(self, spark: SparkSession, name: str):
        self._spark, self._path, self._schema = spark, _new(spark, name), None

    def add(self, df: DataFrame) -> None:
        self._schema = df.schema
        _write(df, self._path)

    def table(self) -> DataFrame:
        return self._spark.read.schema(self._schema).parquet(self._path)


def together(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """Results of steps that run at the same time."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [r.result() for r in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]]


def stored_together(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """``stored`` of each table by name, at the same time: one alone leaves executors idle while it is planned and while its last tasks run."""
    spark = next(iter(tables.values())).sparkSession
    with ThreadPoolExecutor(len(tables)) as pool:
        begun = {name: pool.submit(inheritable_thread_target(spark)(stored), df, name) for name, df in tables.items()}
        return {name: b.result() for name, b in begun.items()}
