"""A few operations on the files of a warehouse, through the file system its paths name."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    system, place = _system(spark, folder)
    return sorted(found.getPath().getName() for found in system.listStatus(place)) if system.exists(place) else []


def delete(spark: SparkSession, path: str) -> None:
    system, place = _system(spark, path)
    system.delete(place, True)


def create_empty(spark: SparkSession, path: str) -> None:
    system, place = _system(spark, path)
    system.create(place, False).close()


def move_if_free(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder in one step; False, and nothing changes, if the target is there already."""
    system, place = _system(spark, target)
    system.mkdirs(place.getParent())
    hadoop, options = spark._jvm.org.apache.hadoop.fs, spark._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
    none = spark._jvm.java.lang.reflect.Array.newInstance(options, 0)
    qualified = system.makeQualified(place)
    context = hadoop.FileContext.getFileContext(qualified.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(system.makeQualified(hadoop.Path(source)), qualified, none)
    except Py4JJavaError:
        if not system.exists(place):
            raise
        return False
    return True
