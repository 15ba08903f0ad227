"""Small files and folders on whatever file system a path names."""

from __future__ import annotations

import os
from urllib.parse import urlparse

from pyspark.sql import SparkSession


class Files:
    """The file system of a folder, through Spark's own Hadoop client."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(root).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def list(self, folder: str) -> list[str]:
        """Names in a folder; none if it does not exist."""
        path = self._path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            lines = self._jvm.java.util.Scanner(stream, "UTF-8").useDelimiter("\\A")
            return lines.next() if lines.hasNext() else ""
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        out = self._fs.create(self._path(path), True)
        out.write(bytearray(text.encode()))
        out.close()

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def claim(self, source: str, target: str) -> bool:
        """Give a written file its final name unless that is taken; of several claims one succeeds.

        A rename that refuses to replace is atomic on distributed file systems; a
        local one replaces, but refuses to link.
        """
        if self._fs.getScheme() == "file":
            plain = [urlparse(p).path if p.startswith("file:") else p for p in (source, target)]
            try:
                os.link(*plain)
            except FileExistsError:
                return False
            self.remove(source)
            return True
        try:
            context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(target).toUri(), self._conf)
            kind = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
            context.rename(self._path(source), self._path(target), self._gateway.new_array(kind, 0))
            return True
        except Exception as e:
            if "FileAlreadyExists" in str(e):
                return False
            raise
