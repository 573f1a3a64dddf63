"""Small files and folders in the file system that a path belongs to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    """Hadoop's view of a folder; paths are given in full."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway
        self._fs = self._path(root).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, folder: str) -> list[str]:
        """The names in a folder, in order; none if there is no such folder."""
        if not self.exists(folder):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(self._path(folder)))

    def age_seconds(self, path: str) -> float:
        """Seconds since the path was last written to."""
        written = self._fs.getFileStatus(self._path(path)).getModificationTime()
        return self._jvm.java.lang.System.currentTimeMillis() / 1000 - written / 1000

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str, replace: bool = False) -> None:
        """A file that is there as a whole or not at all; without ``replace`` one that exists already raises.

        Written beside its place and renamed, which HDFS and local file systems do in one step.
        """
        place = self._path(path)
        beside = self._path(f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}.tmp")
        stream = self._fs.create(beside, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE if replace else rename.NONE
        try:
            context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), self._conf)
            context.rename(context.makeQualified(beside), context.makeQualified(place), options)
        except Exception:
            self._fs.delete(beside, False)
            raise
