"""Small files of a report, through the file system that Spark itself uses.

So a path means here what it means to ``spark.read``: relative ones, and every
scheme the cluster is set up for.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Storage:
    """The folder ``path``; names are relative to it."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark._jvm
        settings = spark._jsparkSession.sessionState().newHadoopConf()
        folder = self._jvm.org.apache.hadoop.fs.Path(path)
        self._system = folder.getFileSystem(settings)
        self.root = self._system.makeQualified(folder).toString().rstrip("/")

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _names(self, found) -> list[str]:
        return sorted(f.getPath().toString()[len(self.root) + 1 :] for f in found or [])

    def names(self, folder: str) -> list[str]:
        """Names in ``folder``, none if there is no such folder."""
        path = self._path(folder)
        return self._names(self._system.listStatus(path)) if self._system.exists(path) else []

    def matching(self, pattern: str) -> list[str]:
        return self._names(self._system.globStatus(self._path(pattern)))

    def read(self, name: str) -> str:
        stream = self._system.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a new file; False if there is one of that name."""
        try:
            stream = self._system.create(self._path(name), False)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" in str(error.java_exception):
                return False
            raise
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return True

    def delete(self, name: str) -> None:
        self._system.delete(self._path(name), True)
