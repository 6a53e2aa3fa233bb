"""Leases on durable scratch tables: who owns one, and when it goes.

Every table that the library writes below the shared checkpoint folder for its own
use has a lease: a small file, in ``tabclass/leases`` of that folder, that names the
table's path, the application that owns it and when it was made.  The owner deletes
the table with ``release``; ``leases_released`` does so for all that were taken in
its block, also when the block fails.  What a lost driver leaves behind, ``sweep``
deletes by age.  The lease is written before the table and deleted after it, so no
table is ever without one.
"""
from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tabclass.session import ensure_checkpoint_dir, scratch_path

#: Leases that are still held, in the order they were taken.
_held: list["Lease"] = []


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path) on the driver."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def _folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tabclass/leases"


class Lease:
    """The owner's handle on one path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.open = spark, path, True
        self.marker = f"{_folder(spark)}/{uuid.uuid4().hex}.json"
        write_text(spark, self.marker, json.dumps({"path": path, "owner": spark.sparkContext.applicationId, "made": time.time()}))
        _held.append(self)

    def release(self) -> None:
        """Delete the table, then the lease; again does nothing."""
        if not self.open:
            return
        self.open = False
        if self in _held:
            _held.remove(self)
        for path in (self.path, self.marker):
            fs, at = file_system(self.spark, path)
            fs.delete(at, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, at = file_system(spark, path)
    out = fs.create(at, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = file_system(spark, path)
    stream = fs.open(at)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def leased_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a leased Parquet table and reread it; a failed write leaves nothing."""
    spark = df.sparkSession
    lease = Lease(spark, scratch_path(spark, name))
    try:
        df.write.mode("error").parquet(lease.path)
    except BaseException:
        lease.release()
        raise
    out = spark.read.schema(df.schema).parquet(lease.path)
    out._lease = lease
    return out


def leased_checkpoint(df: DataFrame) -> DataFrame:
    """A reliable checkpoint with a lease on its files."""
    out = df.checkpoint(eager=True)
    file = out._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    if file.isDefined():
        out._lease = Lease(df.sparkSession, file.get())
    return out


def release(df: DataFrame) -> None:
    """Free a reusable copy: its cached blocks, or its leased table."""
    lease = getattr(df, "_lease", None)
    if lease is not None:
        lease.release()
    else:
        df.unpersist()


@contextmanager
def leases_released() -> Iterator[None]:
    """Release what the block took and still holds, however it ends."""
    before = set(map(id, _held))
    try:
        yield
    finally:
        for lease in [x for x in _held if id(x) not in before][::-1]:
            lease.release()


def leases(spark: SparkSession) -> list[dict]:
    """All leases below the checkpoint folder, of any application."""
    fs, at = file_system(spark, _folder(spark))
    found = []
    for status in fs.listStatus(at) if fs.exists(at) else []:
        marker = status.getPath().toString()
        found.append(json.loads(read_text(spark, marker)) | {"marker": marker})
    return found


def sweep(spark: SparkSession, older_than_s: float) -> list[str]:
    """Delete the tables of other applications whose lease is older; their paths."""
    gone = []
    for lease in leases(spark):
        if lease["owner"] != spark.sparkContext.applicationId and time.time() - lease["made"] > older_than_s:
            for path in (lease["path"], lease["marker"]):
                fs, at = file_system(spark, path)
                fs.delete(at, True)
            gone.append(lease["path"])
    return gone
