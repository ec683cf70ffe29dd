"""Small files on the store that Spark itself writes to: manifests, logs, commit marks.

All access goes through Hadoop's file systems, so any path that Spark reads works.
These files are a few kB and are read by the driver; tables never pass here.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class Folder:
    """A folder on shared storage."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        at = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        """Sorted names of what a folder holds; none where there is no such folder."""
        if not self.exists(name):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(name)))

    def sizes(self, name: str) -> dict[str, int]:
        """Bytes of each data file below a folder, by relative path."""
        if not self.exists(name):
            return {}
        root, out = self._fs.makeQualified(self._at(name)).toUri().getPath().rstrip("/") + "/", {}
        files = self._fs.listFiles(self._at(name), True)
        while files.hasNext():
            f = files.next()
            rel = f.getPath().toUri().getPath().removeprefix(root)
            if not rel.rsplit("/", 1)[-1].startswith(("_", ".")):
                out[rel] = f.getLen()
        return out

    def write_new(self, name: str, content) -> bool:
        """Write a JSON file that must not exist yet; False where it does.

        The content is whole before the name appears: it is written under
        another name and then renamed, which fails if the name is taken.
        """
        if self.exists(name):
            return False
        draft = f"{name}.{self._jvm.java.util.UUID.randomUUID()}.draft"
        out = self._fs.create(self._at(draft), False)
        try:
            out.write(bytearray(json.dumps(content).encode("utf-8")))
        finally:
            out.close()
        if not self.exists(name) and self._fs.rename(self._at(draft), self._at(name)):
            return True
        self._fs.delete(self._at(draft), False)
        return False

    def read(self, name: str):
        """The content of a JSON file; None where there is none."""
        if not self.exists(name):
            return None
        stream = self._fs.open(self._at(name))
        try:
            data = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(data)

    def delete(self, name: str = "") -> None:
        self._fs.delete(self._at(name), True)
