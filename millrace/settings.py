"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Runtime settings this library is tuned for. Shuffle partitions are left to the cluster: set
# spark.sql.adaptive.coalescePartitions.initialPartitionNum to about shuffled bytes / 128 MB.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in RECOMMENDED.items():
        spark.conf.set(name, value)
    return spark


def work_folder(spark: SparkSession, *names: str) -> str:
    """A folder under the shared work area, for tables that cut lineage.

    The area is the one `spark.checkpoint.dir` names. Only a local session may go without: a
    machine-local folder would be unreadable for the other machines of a cluster.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", base)
    return "/".join([base.rstrip("/"), "millrace", *names])


def remove(spark: SparkSession, path: str) -> None:
    """Delete a work folder, through the file system Spark uses."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A work folder no other call shares."""
    return work_folder(spark, f"{name}-{uuid.uuid4().hex}")


class Files:
    """Small file operations through the file system Spark uses, as seen from the driver."""

    def __init__(self, spark: SparkSession, folder: str):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway
        self.fs = self.path(folder).getFileSystem(self.conf)
        self.local = self.fs.getScheme() == "file"
        if self.local:  # without checksum files, which would have to be replaced along
            self.fs = self.fs.getRawFileSystem()

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def folders(self, name: str) -> list[tuple[str, int]]:
        """Names and times of change (milliseconds) of the folders in a folder."""
        if not self.exists(name):
            return []
        return [(s.getPath().getName(), s.getModificationTime())
                for s in self.fs.listStatus(self.path(name)) if s.isDirectory()]

    def create(self, name: str, text: str = "") -> bool:
        """Make a file that must not be there yet; False when it is. Of many that try, one makes it,
        as far as the file system creates files in one step; local ones do, and HDFS does."""
        path = self.path(name).makeQualified(self.fs)
        self.fs.mkdirs(path.getParent())
        if self.local:
            if not self.jvm.java.io.File(path.toUri()).createNewFile():
                return False
            if text:
                self._write(path, text, True)
            return True
        try:
            self._write(path, text, False)
        except Py4JJavaError:
            if self.fs.exists(path):
                return False
            raise
        return True

    def _write(self, path, text: str, over: bool) -> None:
        out = self.fs.create(path, over)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            reader = self.jvm.java.util.Scanner(stream, "UTF-8").useDelimiter("\\A")
            return reader.next() if reader.hasNext() else ""
        finally:
            stream.close()

    def replace(self, source: str, target: str) -> None:
        """Rename a file over another one, in one step where the file system has such a step."""
        if self.local:
            self.move(source, target)
            return
        kinds = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self.gateway.new_array(kinds, 1)
        how[0] = kinds.OVERWRITE
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self.path(target).makeQualified(self.fs).toUri(), self.conf).rename(
            self.path(source).makeQualified(self.fs), self.path(target).makeQualified(self.fs), how)

    def move(self, source: str, target: str) -> None:
        if not self.fs.rename(self.path(source), self.path(target)):
            raise OSError(f"{source} could not be renamed to {target}")

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)
