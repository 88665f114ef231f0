"""What running on a cluster needs: the package on Python workers, and results that appear whole or not at all."""

from __future__ import annotations

import json
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give Python workers this package, once per application."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        root = Path(__file__).resolve().parent
        path = Path(tempfile.mkdtemp(prefix="lexmill-")) / "lexmill_core.zip"
        with zipfile.ZipFile(path, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(str(path))
        _shipped.add(sc.applicationId)


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; a temporary one only where that is unset and the master is local."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named and not re.match(r"local(\[|\Z)", sc.master):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="lexmill-"))
    return (named or sc.getCheckpointDir()).rstrip("/")


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A path in the shared folder that is gone after the block."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        p, fs = _path(spark, path)
        fs.delete(p, True)


_open: list[list[str]] = []
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def keeping(spark: SparkSession) -> Iterator[None]:
    """What is ``materialized`` in the block is gone after it, and shuffle files of the queries that run in it go as each query ends."""
    paths: list[str] = []
    _open.append(paths)
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        _open[:] = [p for p in _open if p is not paths]
        if before is None:
            spark.conf.unset(_CLEAN)
        else:
            spark.conf.set(_CLEAN, before)
        for path in paths:
            p, fs = _path(spark, path)
            fs.delete(p, True)


def materialized(df: DataFrame, lasting: bool = False) -> DataFrame:
    """``df`` computed once and read many times: a table in the shared folder that lasts as long as the block of ``keeping`` around it, or, if ``lasting``, the application; elsewhere a checkpoint there.

    A checkpoint keeps rows as they lie in memory, and reads all columns of them.
    """
    spark = df.sparkSession
    folder = shared_dir(spark)
    if not (lasting or _open):
        return df.checkpoint(eager=True)
    path = f"{folder}/{'lasting' if lasting else 'kept'}-{uuid.uuid4().hex}"
    if lasting:
        p, fs = _path(spark, path)
        fs.deleteOnExit(p)
    else:
        _open[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _move(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"can't move {source} to {target}")


def recover(spark: SparkSession, path: str) -> None:
    """Put back what ``publish`` had moved aside when it was broken off between its two moves."""
    (target, fs), (old, _) = _path(spark, path), _path(spark, f"{path}.old")
    if fs.exists(old) and not fs.exists(target):
        _move(fs, old, target)


def publish(df: DataFrame, path: str, writer) -> None:
    """Write beside ``path`` by ``writer(df.write, place)``, then put the result in its place; what was there stays if anything fails."""
    spark = df.sparkSession
    recover(spark, path)
    (target, fs), (new, _), (old, _) = _path(spark, path), _path(spark, f"{path}.new"), _path(spark, f"{path}.old")
    try:
        writer(df.write.mode("overwrite"), f"{path}.new")
        fs.delete(old, True)
        there = fs.exists(target)
        if there:
            _move(fs, target, old)
        try:
            _move(fs, new, target)
        except BaseException:
            if there:
                _move(fs, old, target)
            raise
    except BaseException:
        fs.delete(new, True)
        raise
    fs.delete(old, True)


def write_json(spark: SparkSession, path: str, value) -> None:
    """A JSON document as one file, there as a whole or not at all."""
    (target, fs), (new, _), (old, _) = _path(spark, path), _path(spark, f"{path}.new"), _path(spark, f"{path}.old")
    out = fs.create(new, True)
    try:
        out.write(bytearray((json.dumps(value, ensure_ascii=False, indent=2) + "\n").encode()))
    finally:
        out.close()
    fs.delete(old, False)
    if fs.exists(target):
        _move(fs, target, old)
    _move(fs, new, target)
    fs.delete(old, False)
