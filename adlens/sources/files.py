"""Files of the shared file system, through Hadoop's FileSystem: listings, small texts, deletion."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """The file system that holds ``root``, whichever the path names (HDFS, object store, local)."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def children(self, path: str) -> dict[str, bool]:
        """Names in a folder and whether each is a folder; none for a folder that isn't there."""
        if not self.exists(path):
            return {}
        return {s.getPath().getName(): s.isDirectory() for s in self._fs.listStatus(self._path(path))}

    def data_files(self, path: str) -> list[str]:
        """The paths of all files below a folder, but for hidden ones."""
        out = []
        for name, is_folder in self.children(path).items():
            if is_folder and (not name.startswith(("_", ".")) or "=" in name):
                out += self.data_files(f"{path}/{name}")
            elif not is_folder and not name.startswith(("_", ".")):
                out.append(f"{path}/{name}")
        return out

    def create(self, path: str, text: str) -> bool:
        """Write a new small file; False if there is one of that name."""
        try:
            out = self._fs.create(self._path(path), False)
        except Py4JJavaError as e:
            if "AlreadyExists" in str(e.java_exception.getClass().getName()) or self.exists(path):
                return False
            raise
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        return True

    def text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
