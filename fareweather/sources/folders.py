"""Folders on any file system that Spark reaches."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folder:
    """A path, by the file system it lies on."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        hadoop = self._jvm.org.apache.hadoop.fs.Path
        self.path = path
        self._at = hadoop(path)
        self._child = lambda name: hadoop(f"{path}/{name}")
        self._files = self._at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, name: str = "") -> bool:
        return bool(self._files.exists(self._child(name) if name else self._at))

    def names(self, below: str = "") -> list[str]:
        """What lies directly below, in order; nothing if the folder is missing."""
        return sorted(self.ages(below))

    def ages(self, below: str = "") -> dict[str, int]:
        """What lies directly below, with the milliseconds since 1970 of its last change."""
        try:
            found = self._files.listStatus(self._child(below) if below else self._at)
        except Py4JJavaError as error:
            if "FileNotFoundException" in str(error.java_exception.getClass().getName()):
                return {}
            raise
        return {status.getPath().getName(): status.getModificationTime() for status in found}

    def delete(self, name: str) -> None:
        self._files.delete(self._child(name), True)

    def text(self, name: str) -> str:
        """A small file's content; empty if the file is missing."""
        if not self.exists(name):
            return ""
        stream = self._files.open(self._child(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a small file that must not exist yet; whether it was this call that made it.

        HDFS and local disks let one of several callers at once succeed. Object stores look first
        and write then, so there callers must not come within the same moment.
        """
        file = self._child(name)
        self._files.mkdirs(file.getParent())
        if self._files.getScheme() == "file":  # Hadoop's own call looks first on local disks, too
            try:
                with open(file.toUri().getPath(), "x", encoding="utf-8") as out:
                    out.write(text)
            except FileExistsError:
                return False
            return True
        try:
            stream = self._files.create(file, False)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in str(error.java_exception.getClass().getName()) or self.exists(name):
                return False
            raise
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return True
