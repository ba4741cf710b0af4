"""Small files and listings in whatever file system a path names."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop, files = _at(spark, path)
    return files.exists(hadoop)


def is_complete(spark: SparkSession, folder: str) -> bool:
    """Whether a write into ``folder`` has been committed."""
    return exists(spark, f"{folder}/_SUCCESS")


def length(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path."""
    hadoop, files = _at(spark, path)
    return files.getContentSummary(hadoop).getLength()


def make_folder(spark: SparkSession, path: str) -> None:
    hadoop, files = _at(spark, path)
    files.mkdirs(hadoop)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of our own with all that is in it."""
    hadoop, files = _at(spark, path)
    files.delete(hadoop, True)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    hadoop, files = _at(spark, folder)
    if not files.exists(hadoop):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(hadoop))


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that becomes visible whole or not at all; it must not be there yet."""
    hadoop, files = _at(spark, path)
    parent = hadoop.getParent()
    files.mkdirs(parent)
    draft = spark._jvm.org.apache.hadoop.fs.Path(parent, f"_draft-{uuid.uuid4().hex}")
    out = files.create(draft)
    out.write(bytearray(text.encode()))
    out.close()
    if files.exists(hadoop) or not files.rename(draft, hadoop):
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str:
    hadoop, files = _at(spark, path)
    stream = files.open(hadoop)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
