"""File tests that work on any file system Spark reads."""

from __future__ import annotations

from pyspark.sql import SparkSession


def exists(spark: SparkSession, path: str) -> bool:
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(location)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [entry.getPath().getName() for entry in system.listStatus(location)]


def delete(spark: SparkSession, path: str) -> None:
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(location, True)


def copy(spark: SparkSession, source: str, target: str) -> None:
    """Copies a file or a folder as it is; it appears under its name once it is complete."""
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    start, end, part = hadoop.Path(source), hadoop.Path(target), hadoop.Path(target + "._copying")
    files = end.getFileSystem(conf)
    files.delete(part, True)
    if not hadoop.FileUtil.copy(start.getFileSystem(conf), start, files, part, False, conf) or not files.rename(part, end):
        raise OSError(f"{source} could not be copied to {target}")
