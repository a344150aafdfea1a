"""The few file operations a stream table needs beside Spark's own reads and writes.

They go through the Hadoop file system of the path, run on the driver and touch names and small
control files only.
"""

from __future__ import annotations

import os
import uuid
from urllib.parse import urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession, root: str):
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._reader = jvm.org.apache.hadoop.io.IOUtils
        self._bytes = jvm.java.io.ByteArrayOutputStream
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(root).getFileSystem(conf)
        self._local = self._fs.getUri().getScheme() == "file"

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def make_folder(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def names(self, path: str) -> list[str]:
        """Names directly below a folder; none when it does not exist."""
        if not self.exists(path):
            return []
        found = (s.getPath().getName() for s in self._fs.listStatus(self._path(path)))
        return sorted(n for n in found if not n.startswith("."))

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            out = self._bytes()
            self._reader.copyBytes(stream, out, 4096, False)
            return bytes(out.toByteArray()).decode()
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Write a new file; False when the name is taken.

        The text is written beside the file and gets its name in one step that fails when the name is
        taken: no reader sees half a file, and of several writers exactly one succeeds. Hadoop's
        wrapper of the local file system would overwrite, so there it is a hard link.
        """
        if self.exists(path):
            return False
        folder, _, base = path.rpartition("/")
        # Names with a leading dot are hidden from Spark's readers and from ``names``.
        beside = f"{folder}/.{base}.{uuid.uuid4().hex}"
        if self._local:
            name, draft = urlparse(path).path, urlparse(beside).path
            os.makedirs(os.path.dirname(name), exist_ok=True)
            with open(draft, "x", encoding="utf-8") as file:
                file.write(text)
            try:
                os.link(draft, name)
            except FileExistsError:
                return False
            finally:
                os.unlink(draft)
            return True
        stream = self._fs.create(self._path(beside), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        try:
            if self._fs.rename(self._path(beside), self._path(path)):
                return True
        except Py4JJavaError as error:
            if not self.exists(path):
                raise error
        self._fs.delete(self._path(beside), False)
        if self.exists(path):
            return False
        raise OSError(f"{path} could not be created")

    def move(self, source: str, target: str) -> bool:
        """Rename a folder; False when the target is there already."""
        if self.exists(target):
            return False
        return self._fs.rename(self._path(source), self._path(target))

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
