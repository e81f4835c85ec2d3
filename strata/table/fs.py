"""Hadoop FileSystem access for the small control files of a table.

Table paths can be local, HDFS or object-store URIs, so they go through the
JVM's Hadoop FileSystem (the one Spark's readers use), never ``open()``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


class HadoopFS:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        path = self._jvm.org.apache.hadoop.fs.Path(root)
        self._fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.root = self._fs.makeQualified(path).toString().rstrip("/")

    def path(self, relative: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{relative}")

    def remove(self, relative: str) -> None:
        """Remove a directory this writer made and no version names."""
        self._fs.delete(self.path(relative), True)

    def list_names(self, relative: str) -> list[str]:
        p = self.path(relative)
        return [s.getPath().getName() for s in self._fs.listStatus(p)] if self._fs.exists(p) else []

    def read_text(self, relative: str) -> str:
        stream = self._fs.open(self.path(relative))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def write_text(self, relative: str, text: str) -> None:
        """Create or replace a small file."""
        self._write(relative, text, True)

    def create_exclusive(self, relative: str, text: str) -> bool:
        """Create a file that must not exist yet; False if it does."""
        try:
            self._write(relative, text, False)
        except Exception as exc:  # FileAlreadyExistsException via Py4J
            if "FileAlreadyExists" in str(exc) or "already exists" in str(exc):
                return False
            raise
        return True

    def _write(self, relative: str, text: str, overwrite: bool) -> None:
        out = self._fs.create(self.path(relative), overwrite)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
