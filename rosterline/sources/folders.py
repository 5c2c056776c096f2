"""Small files and folders on any store that Spark reaches, through Hadoop's file system interface."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Folder:
    """A folder by its path; names are relative to it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._files = self._of(self.path).getFileSystem(self._conf)

    def _of(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def at(self, name: str) -> str:
        return f"{self.path}/{name}" if name else self.path

    def exists(self, name: str = "") -> bool:
        return self._files.exists(self._of(self.at(name)))

    def listing(self, name: str = "") -> dict[str, int]:
        """Names in a folder and when they changed last (milliseconds); empty where there is no such folder."""
        if not self.exists(name):
            return {}
        return {s.getPath().getName(): s.getModificationTime() for s in self._files.listStatus(self._of(self.at(name)))}

    def read(self, name: str) -> str:
        stream = self._files.open(self._of(self.at(name)))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> bool:
        """Write a file whole under a name that is not taken: aside first, then by one rename. False if the name was taken."""
        folder, _, last = name.rpartition("/")
        aside = self.at(f"{folder}/.{last}-{uuid.uuid4().hex}" if folder else f".{last}-{uuid.uuid4().hex}")
        self._files.mkdirs(self._of(self.at(folder)))
        stream = self._files.create(self._of(aside), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._of(self.path).toUri(), self._conf)
        plain = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self._of(aside), self._of(self.at(name)), plain)
        except Exception:
            self._files.delete(self._of(aside), False)
            if self.exists(name):
                return False
            raise
        return True

    def delete(self, name: str = "") -> None:
        self._files.delete(self._of(self.at(name)), True)
