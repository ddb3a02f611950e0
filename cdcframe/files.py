"""Small files and folders on whatever file system Spark writes to."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """The Hadoop file system of a path, seen from the driver."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """The names in a folder, sorted; none if there is no such folder."""
        if not self.exists(path):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(self._path(path)))

    def size(self, path: str) -> int:
        """The bytes of all files under a folder."""
        return self._fs.getContentSummary(self._path(path)).getLength() if self.exists(path) else 0

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        """Put a whole new file in place by one rename. An existing file is never replaced."""
        if self.exists(path):
            raise FileExistsError(path)
        draft = self._path(path + ".draft")
        stream = self._fs.create(draft, True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        if not self._fs.rename(draft, self._path(path)):
            raise FileExistsError(path)

    def make(self, path: str) -> None:
        """A folder, if it is not there."""
        self._fs.mkdirs(self._path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
