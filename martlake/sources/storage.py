"""Listing, creating and removing small things on whatever store a path names, through Spark's
own file-system client (so cluster URIs work)."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it does not exist.  Other errors are raised."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def create_once(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file with its whole content, or raise FileExistsError: of several writers of one
    name exactly one succeeds.

    The content is written under another name first.  On a local file system a hard link then gives it its
    name, elsewhere a rename that doesn't overwrite: both fail in one step if the name is taken.  That
    holds for HDFS and the stores that implement its rename; an object store without an atomic
    rename needs this folder on one that has it.
    """
    fs, p = _fs(spark, path)
    jvm = spark._jvm
    temp = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}.tmp")
    out = fs.create(temp, False)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    try:
        if fs.getScheme() == "file":
            local = lambda x: jvm.java.io.File(x.toUri().getPath()).toPath()
            jvm.java.nio.file.Files.createLink(local(p), local(temp))
        else:
            keep = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            renames = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            renames[0] = keep
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration()).rename(temp, p, renames)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            raise FileExistsError(path) from e
        raise
    finally:
        if fs.exists(temp):
            fs.delete(temp, False)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)
