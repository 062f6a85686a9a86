"""Small file operations through the session's Hadoop file systems: no Spark job, any store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _open(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file, None if it isn't there."""
    fs, where = _open(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put ``text`` at ``path`` in one step: a reader finds the old content or the new one."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fs, where = _open(spark, path)
    fresh = jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{where.getName()}.{jvm.java.util.UUID.randomUUID().toString()}")
    fs.mkdirs(where.getParent())
    stream = fs.create(fresh, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), conf).rename(fresh, where, options)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; nothing happens if it isn't there."""
    fs, where = _open(spark, path)
    fs.delete(where, True)


def names_hash(frame: DataFrame) -> int:
    """A hash of the files a frame reads, taken where their list is."""
    builder = frame.sparkSession._jvm.org.apache.commons.lang3.builder.HashCodeBuilder()
    return builder.append(frame._jdf.inputFiles()).toHashCode()


def identity(spark: SparkSession, path: str) -> str:
    """What tells one state of the files below ``path`` from another: their names as Spark lists
    them, how many they are, their bytes, and the time the path itself was changed.  (A file of a
    folder that is replaced under its own name by one of the same length is not seen; Spark's
    writers give every file a name of its own.)"""
    fs, where = _open(spark, path)
    matched = [s.getPath() for s in fs.globStatus(where) or []]
    total = [fs.getContentSummary(p) for p in matched]
    names = names_hash(spark.read.format("binaryFile").load(path))
    return (f"{path}:{names}:{sum(t.getFileCount() for t in total)}:{sum(t.getLength() for t in total)}:"
            f"{max((fs.getFileStatus(p).getModificationTime() for p in matched), default=0)}")
