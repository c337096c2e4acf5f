"""Small-file access through the Hadoop FileSystem API, so any supported store works."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder without hidden ones; none if the folder is missing."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(n for n in found if not n.startswith("."))


def size(spark: SparkSession, path: str) -> int:
    """Bytes below a folder."""
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength()


def sizes(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Path and bytes of the data files directly in a folder."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    found = [(s.getPath().toString(), s.getLen()) for s in fs.listStatus(p) if s.isFile()]
    return sorted(f for f in found if f[0].rsplit("/", 1)[1][0] not in "._")


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Give a folder its final name; fails if that is taken."""
    fs, p = _fs(spark, path)
    if fs.exists(_fs(spark, to)[1]) or not fs.rename(p, _fs(spark, to)[1]):
        raise OSError(f"{path} could not become {to}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a file that must not exist yet; a second creator gets an error.

    The text is written under another name first, so nobody reads half a file.
    """
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    fs, final = _fs(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(final.getParent(), f".{final.getName()}.{uuid.uuid4().hex[:12]}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = gateway.new_array(rename, 1)
    options[0] = rename.NONE  # refuses an existing target
    qualified = fs.makeQualified(final)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(draft), qualified, options)
    except Exception:
        fs.delete(draft, False)
        raise


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a file or folder; False if there was none."""
    fs, p = _fs(spark, path)
    return fs.delete(p, True)
