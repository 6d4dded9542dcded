"""Intermediate results that must be computed once and survive the loss of an executor.

They are kept in a folder that all machines share and are removed when they are no longer needed,
at the latest when the session ends.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate data: the cluster's checkpoint folder, else the warehouse.

    Raises on a cluster if the only choice left is a folder of the local machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    system, _ = _file_system(spark, folder)
    if not context.master.startswith("local") and system.getScheme() == "file":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder + "/_intermediate"


def scratch_path(spark: SparkSession, name: str = "staged") -> str:
    """A new path in the shared folder, removed at the end of the session."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4()}"
    system, target = _file_system(spark, path)
    system.deleteOnExit(target)
    return path


def remove(spark: SparkSession, path: str) -> None:
    system, target = _file_system(spark, path)
    system.delete(target, True)


def make_folder(spark: SparkSession, path: str) -> None:
    system, target = _file_system(spark, path)
    system.mkdirs(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; none if it is not there."""
    system, target = _file_system(spark, path)
    if not system.exists(target):
        return []
    return [status.getPath().getName() for status in system.listStatus(target)]


def same_path(spark: SparkSession, one: str, other: str) -> bool:
    first, second = (spark._jvm.org.apache.hadoop.fs.Path(p).toUri().getPath() for p in (one, other))
    return first == second


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Give a file another name; nothing happens if another job has done so."""
    system, source = _file_system(spark, path)
    if system.exists(source):
        system.rename(source, _file_system(spark, to)[1])


def move_files(spark: SparkSession, path: str, to: str) -> None:
    """Move the files of a folder into another one of the same file system; those moved already stay."""
    system, folder = _file_system(spark, path)
    _, target = _file_system(spark, to)
    if not system.exists(folder):
        return
    system.mkdirs(target)
    for status in system.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        there = spark._jvm.org.apache.hadoop.fs.Path(target, name)
        if not system.rename(status.getPath(), there) and not system.exists(there):
            raise OSError(f"{name} could not be moved to {to}")
    system.delete(folder, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all: written under another name, then renamed."""
    system, target = _file_system(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.part")
    stream = system.create(part, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not system.rename(part, target) and not system.exists(target):
        raise OSError(f"{path} could not be written")
    system.delete(part, False)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file as text; None if it is not there."""
    system, target = _file_system(spark, path)
    if not system.exists(target):
        return None
    stream = system.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at ``path``."""
    system, target = _file_system(spark, path)
    return system.exists(target) and len(system.listStatus(target)) > 0


def remove_children(spark: SparkSession, path: str, prefixes: tuple[str, ...]) -> None:
    """Remove what lies directly in ``path`` under a name with such a prefix, and ``path`` once empty."""
    system, target = _file_system(spark, path)
    if not system.exists(target):
        return
    left = 0
    for status in system.listStatus(target):
        if status.getPath().getName().startswith(prefixes):
            system.delete(status.getPath(), True)
        else:
            left += 1
    if not left:
        system.delete(target, False)


def spread(frame: DataFrame) -> DataFrame:
    """Rows dealt over all tasks: what is read from one small file would all be the work of one."""
    return frame.repartition(int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def materialize(frame: DataFrame) -> DataFrame:
    """``frame`` computed once, with its lineage cut."""
    return staged(frame)[0]


def staged(frame: DataFrame, name: str = "staged") -> tuple[DataFrame, str]:
    """``frame`` as a Parquet copy in the shared folder, and the path for :func:`remove`."""
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path), path
