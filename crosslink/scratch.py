"""Tables between two steps of a job: in the folder that the cluster shares, so that a step survives lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``, else under the checkpoint folder of the context.

    Where neither is set, a local session (as in tests) gets a folder of its own; a cluster raises, as its machines share no
    temporary folder.
    """
    context = spark.sparkContext
    base, own = spark.conf.get("spark.checkpoint.dir", None), context._jsc.sc().getCheckpointDir()
    if not base and own.isDefined():
        base = own.get()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        base = context._jsc.sc().getCheckpointDir().get()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove_at_end(spark: SparkSession, path: str) -> None:
    """The written path goes when the session's JVM ends; results that read it stay usable until then."""
    files, place = _file_system(spark, path)
    files.deleteOnExit(place)


def remove(spark: SparkSession, path: str) -> None:
    """A path that nothing reads any more goes at once."""
    files, place = _file_system(spark, path)
    files.delete(place, True)


def write(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written as Parquet and read again, and its path."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    remove_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read again: lineage ends here."""
    return write(df, name)[0]
