"""Small file operations through the cluster's own file systems: whatever Spark can write to, these reach as well."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder, sorted; none for a folder that isn't there."""
    p, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def modified_ms(spark: SparkSession, path: str) -> int:
    p, fs = _path(spark, path)
    return fs.getFileStatus(p).getModificationTime()


def move(spark: SparkSession, source: str, target: str) -> None:
    """Renames a file or folder.  FileExistsError when the target is there already, so of several writers of one name one wins."""
    jvm = spark.sparkContext._jvm
    a, b = _path(spark, source)[0], _path(spark, target)[0]
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(b.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(context.makeQualified(a), context.makeQualified(b), options)
    except Exception as e:
        if "FileAlreadyExistsException" in str(e):
            raise FileExistsError(target) from e
        raise


def write_text(spark: SparkSession, path: str, text: str) -> None:
    p, fs = _path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _path(spark, path)
    source = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(source)).decode()
    finally:
        source.close()
