"""Small files and folders of any Hadoop file system, through the session's own connectors.

Only control files (markers, journals) and folder names pass here, never rows."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Files:
    """Paths of one session. Every method takes whole paths (``hdfs://...``, ``file:/...``)."""

    def __init__(self, spark: SparkSession):
        self._spark = spark

    def _at(self, path: str):
        path = self._spark._jvm.org.apache.hadoop.fs.Path(path)
        return path, path.getFileSystem(self._spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        path, fs = self._at(path)
        return fs.exists(path)

    def names(self, path: str) -> list[str]:
        """The names below a folder, in order; none if there is no such folder."""
        path, fs = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def stamps(self, path: str) -> list[tuple[str, int, int]]:
        """(name, bytes, time of change) of the files in a folder."""
        path, fs = self._at(path)
        return sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(path) if s.isFile())

    def delete(self, path: str) -> None:
        path, fs = self._at(path)
        fs.delete(path, True)

    def replace(self, source: str, target: str) -> None:
        """Put ``source`` in the place of ``target`` (a rename within one file system)."""
        source, fs = self._at(source)
        target, _ = self._at(target)
        fs.delete(target, True)
        fs.mkdirs(target.getParent())
        if not fs.rename(source, target):
            raise OSError(f"could not move {source} to {target}")

    def write_json(self, path: str, value) -> None:
        """The whole file or none: written beside its place and then renamed."""
        beside = f"{path}.{uuid.uuid4().hex}"
        at, fs = self._at(beside)
        out = fs.create(at)
        try:
            out.write(json.dumps(value).encode())
        finally:
            out.close()
        self.replace(beside, path)

    def read_json(self, path: str):
        at, fs = self._at(path)
        stream = fs.open(at)
        try:
            return json.loads(self._spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()


__all__ = ["Files"]
