"""Tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def new_folder(spark: SparkSession, name: str = "loans") -> str:
    """A name for a new folder in the one that executors share, spark.checkpoint.dir; where that is
    unset, one is made, but only for a local master (tests)."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: later steps neither compute it again nor lose it
    with an executor."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def placed(spark: SparkSession, path: str):
    """(file system, path) of Hadoop for a path: any store that Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = placed(spark, path)
    return files.exists(place)


def removed(spark: SparkSession, path: str) -> None:
    files, place = placed(spark, path)
    files.delete(place, True)


def moved(spark: SparkSession, path: str, to: str) -> bool:
    """Renames a file or folder; False where `to` is there already. One step of the file system, so
    nobody sees a part of it (a store without such a step needs a committer of its own)."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    files, target = placed(spark, to)
    files.mkdirs(target.getParent())
    never_over = spark._sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    context = hadoop.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(files.makeQualified(hadoop.Path(path)), files.makeQualified(target), never_over)
    except Py4JJavaError:
        if files.exists(target):
            return False
        raise
    return True


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings of the session for a while."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
