"""Where intermediate data goes, and small file-system look-ups on any Hadoop URI."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

_local_roots: dict[str, tempfile.TemporaryDirectory] = {}


def join_uri(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *[p.strip("/") for p in parts]])


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the session names for intermediate data.

    Executors must all see it and it must outlive any one of them, so a temporary folder stands in
    only where driver and executors are one process on this machine.
    """
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if shared:
        return shared
    context = spark.sparkContext
    if not (context.master == "local" or context.master.startswith("local[")):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.TemporaryDirectory(
            prefix="firmweave-", ignore_cleanup_errors=True
        )
    return _local_roots[context.applicationId].name


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name below the scratch root."""
    return join_uri(scratch_root(spark), f"{purpose}-{uuid.uuid4().hex}")


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame out and read it back: the result no longer depends on its lineage."""
    uri = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(uri)
    return df.sparkSession.read.schema(df.schema).parquet(uri)


def _file_system(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def delete(spark: SparkSession, uri: str) -> None:
    """Remove a file or a folder and all below it."""
    fs, path = _file_system(spark, uri)
    fs.delete(path, True)


def write_text(spark: SparkSession, uri: str, text: str) -> None:
    """A small file, written by the driver; one of that name must not be there yet."""
    fs, path = _file_system(spark, uri)
    out = fs.create(path, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def publish_text(spark: SparkSession, uri: str, text: str) -> bool:
    """Give the file that name, whole and at once; False if one of that name is there already.

    The text is written under another name first. A local file then gets the name as a hard link, elsewhere it is renamed, which
    must fail onto an existing file, as on HDFS."""
    fs, path = _file_system(spark, uri)
    draft = f"{uri}.{uuid.uuid4().hex}.draft"
    write_text(spark, draft, text)
    if fs.getUri().getScheme() != "file":
        if fs.rename(_file_system(spark, draft)[1], path):
            return True
        delete(spark, draft)
        return False
    link, held = (spark._jvm.java.io.File(_file_system(spark, u)[1].toUri().getPath()).toPath() for u in (uri, draft))
    try:
        spark._jvm.java.nio.file.Files.createLink(link, held)
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error.java_exception):
            return False
        raise
    finally:
        delete(spark, draft)


def file_sizes(spark: SparkSession, uri: str, suffix: str) -> dict[str, int]:
    """Bytes of all files below a folder whose names end so, by path relative to the folder."""
    fs, path = _file_system(spark, uri)
    root, found = fs.makeQualified(path).toString().rstrip("/") + "/", {}
    if fs.exists(path):
        files = fs.listFiles(path, True)
        while files.hasNext():
            status = files.next()
            name = status.getPath().toString()
            if name.endswith(suffix):
                found[name.removeprefix(root)] = status.getLen()
    return found


def file_size(spark: SparkSession, uri: str) -> int:
    fs, path = _file_system(spark, uri)
    return fs.getFileStatus(path).getLen()


def read_text(spark: SparkSession, uri: str) -> str:
    """A small file, read by the driver."""
    fs, path = _file_system(spark, uri)
    stream = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def exists(spark: SparkSession, uri: str) -> bool:
    fs, path = _file_system(spark, uri)
    return fs.exists(path)


def child_names(spark: SparkSession, uri: str) -> list[str]:
    """Names directly below a folder, none if the folder is missing."""
    fs, path = _file_system(spark, uri)
    if not fs.exists(path):
        return []
    return [status.getPath().getName() for status in fs.listStatus(path)]
