"""Folders on any file system that Spark reaches."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    A session on one machine (master ``local``) may leave it unset and gets a
    temporary folder; on a cluster that is an error, as the disks differ.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("skyspark.scratch.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("skyspark.scratch.dir", base)
    return base.rstrip("/")


def new_name(name: str) -> str:
    return f"{name}-{uuid.uuid4().hex[:12]}"


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{new_name(name)}"


def observed(seen: Observation, name: str) -> int:
    """An observed count; 0 if there turned out to be no input at all, when nothing is observed."""
    try:
        return seen.get[name]
    except Py4JJavaError as error:
        if "assertion failed" in str(error.java_exception):
            return 0
        raise


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` in the shared folder, so that it is computed once and outlives executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a write to this folder was finished."""
    return exists(spark, f"{path}/_SUCCESS")


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    p, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def lengths(spark: SparkSession, path: str) -> dict[str, int]:
    """Full name and length of every file below a folder; none if there is no such folder."""
    p, fs = _path(spark, path)
    found: dict[str, int] = {}
    if fs.exists(p):
        files = fs.listFiles(p, True)
        while files.hasNext():
            status = files.next()
            found[status.getPath().toString()] = status.getLen()
    return found


def decoded(name: str) -> str:
    """A name out of ``_metadata.file_path``, which is written as a URI, as the file system has it."""
    return unquote(name)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    p, fs = _path(spark, path)
    stream = fs.create(p, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with this content unless it exists. Of several writers exactly one gets True, and no reader sees half a file.

    The text is written beside the target and then given its name: by a hard link on a
    local file system, elsewhere by a rename that doesn't overwrite, which is atomic on HDFS and
    what is mounted like it. A plain object store has no such step and needs a committer of its own.
    """
    p, fs = _path(spark, path)
    beside = f"{path}.{uuid.uuid4().hex}.tmp"
    _write_text(spark, beside, text)
    try:
        if fs.getScheme() == "file":
            names = [_path(spark, x)[0].toUri().getPath() for x in (beside, path)]
            try:
                os.link(*names)
                return True
            except FileExistsError:
                return False
        return _rename(spark, beside, path)
    finally:
        remove(spark, beside)


def _rename(spark: SparkSession, old: str, new: str) -> bool:
    """Rename without overwriting; False if the new name is taken."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(hadoop.Path(new).toUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(hadoop.Path(old), hadoop.Path(new), none)
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in str(error.java_exception):
            return False
        raise
