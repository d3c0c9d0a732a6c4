"""Files of any store that Spark reaches: size, listing, copying, small texts."""

from __future__ import annotations

from typing import Any

from pyspark.sql import SparkSession


class Store:
    """The file system of a path, through the session's Hadoop settings, so that local folders and object stores are alike."""

    def __init__(self, spark: SparkSession) -> None:
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str) -> tuple[Any, Any]:
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return bool(fs.exists(p))

    def size(self, path: str) -> tuple[int, int]:
        """(files, bytes) below a path."""
        fs, p = self._at(path)
        s = fs.getContentSummary(p)
        return int(s.getFileCount()), int(s.getLength())

    def names(self, path: str) -> list[str]:
        """Names of what lies directly in a folder, in order; none of a folder that is not there."""
        fs, p = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def files(self, path: str) -> list[str]:
        """Paths of the data files below a folder, relative to it; names that begin with . or _ are left out."""
        out: list[str] = []
        fs, p = self._at(path)
        if not fs.exists(p):
            return out
        for s in fs.listStatus(p):
            name = s.getPath().getName()
            if name.startswith((".", "_")):
                continue
            out += [f"{name}/{x}" for x in self.files(f"{path.rstrip('/')}/{name}")] if s.isDirectory() else [name]
        return sorted(out)

    def copy(self, source: str, to: str) -> None:
        (a, p), (b, q) = self._at(source), self._at(to)
        b.mkdirs(q.getParent())
        self._jvm.org.apache.hadoop.fs.FileUtil.copy(a, p, b, q, False, True, self._conf)

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def write(self, path: str, text: str) -> None:
        fs, p = self._at(path)
        out = fs.create(p, True)
        out.write(bytearray(text.encode()))
        out.close()

    def read(self, path: str) -> str | None:
        """A small text; None if it is not there."""
        fs, p = self._at(path)
        if not fs.exists(p):
            return None
        data = fs.open(p)
        try:
            return bytes(data.readAllBytes()).decode()
        finally:
            data.close()
