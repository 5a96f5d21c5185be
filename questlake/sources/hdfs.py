"""Folder metadata through Hadoop's file system API, which serves every store Spark reads."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``."""
    if not exists(spark, path):
        return []
    return sorted(s.getPath().getName() for s in _fs(spark, path).listStatus(_path(spark, path)) if s.isDirectory())


def child_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly below ``path``, in order."""
    if not exists(spark, path):
        return []
    return sorted(s.getPath().getName() for s in _fs(spark, path).listStatus(_path(spark, path)) if s.isFile())


def delete_folder(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def read_small(spark: SparkSession, path: str) -> str:
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _draft(spark: SparkSession, path: str, text: str):
    draft = _path(spark, f"{path}.{uuid.uuid4().hex}.draft")
    stream = _fs(spark, path).create(draft, True)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    return draft


def _rename(spark: SparkSession, draft, path: str, how: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = _path(spark, path)
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = getattr(hadoop.Options.Rename, how)
    hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, target, options)


def replace_small(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file in one rename, so that a reader sees the old or the new one."""
    _rename(spark, _draft(spark, path, text), path, "OVERWRITE")


def create_small(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file in place in one rename; False if there is one already, which stays as it is."""
    draft = _draft(spark, path, text)
    try:
        _rename(spark, draft, path, "NONE")
    except Py4JJavaError:
        _fs(spark, path).delete(draft, False)
        if not exists(spark, path):
            raise
        return False
    return True
