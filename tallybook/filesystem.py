"""Files and folders of any file system that Spark reaches, through Hadoop's interface."""

from __future__ import annotations

import os
from collections.abc import Iterable
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_BUFFER = 1 << 20


class FileSystem:
    """What the jobs do with files beside reading and writing tables. Paths are full ones.

    ``claim`` is atomic: of several callers that move a folder to one new place, one succeeds.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(path).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """What lies in a folder, hidden files too, in the order of names; nothing if there is no such folder."""
        if not self.exists(path):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(self._path(path)))

    def make(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def move(self, source: str, target: str) -> bool:
        """False if ``source`` isn't there (any more)."""
        return self.exists(source) and self._fs.rename(self._path(source), self._path(target))

    def claim(self, folder: str, target: str) -> bool:
        """Move ``folder``, which must not be empty, to ``target``; False if that exists already.

        Hadoop's rename doesn't overwrite on shared file systems. Local files follow POSIX, where a
        folder takes no other folder's place unless that is empty.
        """
        uri = self._fs.makeQualified(self._path(folder)).toString()
        if urlparse(uri).scheme != "file":
            return self._renamed(folder, target)
        there = self._fs.makeQualified(self._path(target)).toString()
        try:
            os.rename(*(unquote(urlparse(x).path) for x in (uri, there)))
        except OSError:
            if not self.exists(target):
                raise
            return False
        return True

    def _renamed(self, source: str, target: str) -> bool:
        fs = self._jvm.org.apache.hadoop.fs
        context = fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        kind = getattr(fs, "Options$Rename")
        how = self._jvm.java.lang.reflect.Array.newInstance(kind._java_lang_class, 1)
        how[0] = kind.NONE
        try:
            context.rename(self._path(source), self._path(target), how)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
                raise
            return False
        return True

    def write_text(self, path: str, text: str) -> None:
        stream = self._fs.create(self._path(path), True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            size = self._fs.getFileStatus(self._path(path)).getLen()
            return self._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream).decode("utf-8") if size else ""
        finally:
            stream.close()

    def join(self, parts: Iterable[str], target: str, heading: str = "") -> None:
        """One file of ``heading`` and the bytes of all parts in their order, through a buffer of fixed size."""
        out = self._fs.create(self._path(target), True)
        try:
            out.write(bytearray(heading.encode("utf-8")))
            for part in parts:
                source = self._fs.open(self._path(part))
                try:
                    self._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, _BUFFER, False)
                finally:
                    source.close()
        finally:
            out.close()
