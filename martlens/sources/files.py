"""File listings and small text files through Hadoop's file systems, which reach every place Spark reads."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def data_files(spark: SparkSession, path: str) -> list[list]:
    """[name below the path, bytes, time of last change] of a file, or of the files in a folder that hold rows."""
    place, system = _at(spark, path)
    if not system.exists(place):
        raise FileNotFoundError(path)
    found, listed = [], system.listFiles(place, True)
    top = system.getFileStatus(place).getPath().toString()
    while listed.hasNext():
        status = listed.next()
        name = status.getPath().toString()[len(top) :]
        if not status.getPath().getName().startswith(("_", ".")):
            found.append([name, status.getLen(), status.getModificationTime()])
    return sorted(found)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    place, system = _at(spark, folder)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place))


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text, or None where there is none."""
    place, system = _at(spark, path)
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text so that it is there as a whole or not at all."""
    unfinished, system = _at(spark, f"{path}.unfinished")
    stream = system.create(unfinished, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not system.rename(unfinished, _at(spark, path)[0]):
        raise FileExistsError(path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that this build has written, with all that is in it."""
    place, system = _at(spark, path)
    system.delete(place, True)
