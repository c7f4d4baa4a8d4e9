"""File-system metadata through Hadoop's FileSystem: the same call works on any store."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
_session_folders: set[str] = set()
_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def _handle(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _handle(spark, path)
    return fs.exists(p)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths (files or folders) matching a glob; empty when there are none."""
    fs, p = _handle(spark, pattern)
    return sorted(s.getPath().toString() for s in (fs.globStatus(p) or []))


def below(spark: SparkSession, folder: str) -> list[tuple[str, int, int]]:
    """(path, bytes, time of writing) of every file below a folder; the path without its store."""
    fs, p = _handle(spark, folder)
    found, every = [], fs.listFiles(p, True)
    while every.hasNext():
        status = every.next()
        found.append((status.getPath().toUri().getPath(), status.getLen(), status.getModificationTime()))
    return found


def size_of(spark: SparkSession, path: str) -> int:
    fs, p = _handle(spark, path)
    return fs.getContentSummary(p).getLength()


def age_of(spark: SparkSession, path: str) -> float:
    """Seconds since a file or folder was last changed."""
    fs, p = _handle(spark, path)
    return time.time() - fs.getFileStatus(p).getModificationTime() / 1000


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a file, or of the first non-empty file of a folder."""
    fs, p = _handle(spark, path)
    if fs.getFileStatus(p).isDirectory():
        parts = [s for s in fs.listStatus(p) if s.getLen() and not s.getPath().getName().startswith(("_", "."))]
        if not parts:
            return ""
        p = min((s.getPath() for s in parts), key=lambda x: x.getName())
    stream = fs.open(p)
    try:
        reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return (reader.readLine() or "").removeprefix("\ufeff")
    finally:
        stream.close()


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, p = _handle(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _handle(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with all its content at one moment; False if there is one already.

    The content is written under another name first and then gets its name in one step that
    fails where the name is taken: a hard link on a local disk, elsewhere a rename that does not
    replace, which HDFS does atomically. Of several writers exactly one succeeds.
    """
    fs, p = _handle(spark, path)
    jvm = spark._jvm
    folder = p.getParent()
    fs.mkdirs(folder)
    draft = jvm.org.apache.hadoop.fs.Path(folder, f".{uuid.uuid4().hex}.draft")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        if fs.getScheme() == "file":
            paths = [jvm.java.io.File(fs.makeQualified(x).toUri().getPath()).toPath() for x in (p, draft)]
            jvm.java.nio.file.Files.createLink(*paths)
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
            options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
            context.rename(fs.makeQualified(draft), fs.makeQualified(p), options)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    finally:
        fs.delete(draft, False)
    return True


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _handle(spark, source)
    if not fs.rename(p, _handle(spark, target)[1]):
        raise IOError("rename failed")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as named by spark.checkpoint.dir.

    A local session without one gets a temporary folder; a cluster session must name it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="tallystone-")
    return _local_roots[context.applicationId]


def session_folder(spark: SparkSession) -> str:
    """This session's part of the shared folder; the file system removes it when the session's
    JVM ends."""
    application = spark.sparkContext.applicationId
    path = f"{shared_folder(spark)}/tallystone-{application}"
    if path not in _session_folders:
        fs, p = _handle(spark, path)
        fs.mkdirs(p)
        fs.deleteOnExit(p)  # only of a folder that is there
        _session_folders.add(path)
    return path


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{session_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage_sized(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Write the frame once to the shared folder, read it back, and tell its bytes.

    This cuts lineage in a way that survives lost executors, and gives Catalyst the
    real size of the data, so that it broadcasts only what measures small. The table goes with
    the session's folder, if nobody removed it before.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if _staged.get() is not None:
        _staged.get().append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), size_of(spark, path)


def stage(df: DataFrame, label: str) -> DataFrame:
    return stage_sized(df, label)[0]


@contextmanager
def staged_for_now(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end, what was staged inside the block."""
    mine: list[str] = []
    token = _staged.set(mine)
    try:
        yield
    finally:
        _staged.reset(token)
        for path in mine:
            remove_folder(spark, path)
