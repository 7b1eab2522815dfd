"""Shared storage of an engine run: work folders, written tables that cut lineage, small control files.

Everything goes below the folder the cluster names in ``spark.checkpoint.dir``.  Only where that
setting is absent and all executors are threads of this machine (tests, a laptop) a local folder is made.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def base_dir(spark: SparkSession) -> str:
    """The shared folder of the session."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share: a folder of the driver's machine would lose rows")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="driftline-")
        atexit.register(shutil.rmtree, _local[app], True)
    return "file://" + _local[app]


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, in the folder of this application; nothing is created yet."""
    return f"{base_dir(spark)}/driftline/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def sweep(spark: SparkSession, days: float = 7) -> list[str]:
    """Remove the work folders of other applications that nothing was written to for so many days; their names."""
    files = ControlFiles(spark, f"{base_dir(spark)}/driftline")
    old = time.time() * 1000 - days * 86_400_000
    gone = []
    for status in files._fs.listStatus(files._path("")):
        name = status.getPath().getName()
        if name == spark.sparkContext.applicationId:
            continue
        newest = max([status.getModificationTime(), *(s.getModificationTime() for s in files._fs.listStatus(status.getPath()))])
        if newest < old:
            files.delete(name)
            gone.append(name)
    return gone


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: the lineage ends there.

    Lost executors re-read the files instead of recomputing what led to them.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class ControlFiles:
    """Small files of the control plane (manifests, ledgers) in the shared folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)
        self._local = self._fs.getScheme() == "file"
        self._renames = self._fs.getScheme() in ("hdfs", "viewfs", "webhdfs")
        self._fs.mkdirs(self._path(""))

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def create(self, name: str, text: str) -> bool:
        """Create the file with this content, whole or not at all; False if it already exists.  The winner of a race is unique.

        Local disks: a hard link.  HDFS: a rename, which refuses an existing target.  Stores whose files appear when
        they are closed: one conditional write, as far as the store's client offers it.
        """
        data = text.encode("utf-8")
        if self._local:
            plain = self._path(name).toUri().getPath()
            staged = f"{plain}.{uuid.uuid4().hex}.tmp"
            with open(staged, "wb") as f:
                f.write(data)
            try:
                os.link(staged, plain)
                return True
            except FileExistsError:
                return False
            finally:
                os.unlink(staged)
        if self._renames:
            staged = f"{name}.{uuid.uuid4().hex}.tmp"
            self._fill(self._fs.create(self._path(staged), False), data)
            if self._fs.rename(self._path(staged), self._path(name)):
                return True
            self._fs.delete(self._path(staged), False)
            return False
        try:
            new = self._fs.createFile(self._path(name)).overwrite(False).opt("fs.option.create.conditional.overwrite", "true")
            self._fill(new.build(), data)
        except Exception as e:  # py4j wraps the file system's own exceptions
            if self._fs.exists(self._path(name)):
                return False
            raise e
        return True

    @staticmethod
    def _fill(out, data: bytes) -> None:
        try:
            out.write(bytearray(data))
        finally:
            out.close()

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def names(self) -> list[str]:
        return sorted(
            n for n in (s.getPath().getName() for s in self._fs.listStatus(self._path(""))) if not n.endswith((".tmp", ".crc"))
        )

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)
