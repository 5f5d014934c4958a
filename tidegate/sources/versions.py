"""Published tables: whole snapshots behind one manifest.

A version is a folder of its own plus a small manifest that names it, written last, so readers see a version
whole or not at all. A table has one publisher at a time: the check that a version is new and the renaming of its manifest are
two steps.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class _Folder:
    """The few file-system calls a publication needs, on any Hadoop-readable storage."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")

    def _at(self, name: str):
        where = self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return where, where.getFileSystem(self._conf)

    def names(self, name: str = "") -> list[str]:
        where, fs = self._at(name)
        return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []

    def read(self, name: str) -> str:
        where, fs = self._at(name)
        stream = fs.open(where)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_if_absent(self, name: str, text: str) -> bool:
        """Write beside the final name and rename; False when the name is taken."""
        final, fs = self._at(name)
        if fs.exists(final):
            return False
        draft, _ = self._at(f"_draft-{self._jvm.java.util.UUID.randomUUID()}")
        stream = fs.create(draft, True)
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()
        fs.mkdirs(final.getParent())
        return bool(fs.rename(draft, final))


class VersionedTable:
    """The published snapshots of one table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._folder = _Folder(spark, path)

    def manifest(self) -> dict | None:
        """The newest committed manifest, or None before the first commit."""
        committed = self._folder.names("_manifest")
        return json.loads(self._folder.read(f"_manifest/{committed[-1]}")) if committed else None

    def read(self) -> DataFrame | None:
        found = self.manifest()
        if found is None:
            return None
        return self.spark.read.schema(T.StructType.fromJson(found["schema"])).parquet(f"{self.path}/{found['folder']}")

    def commit(self, rows: DataFrame, **notes) -> int:
        """Write `rows` and publish them as the next version."""
        found = self.manifest()
        version = (found["version"] if found else 0) + 1
        # Every attempt has its own folder, so a crashed or losing writer disturbs nobody.
        folder = f"v={version:012d}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{folder}")
        manifest = {"version": version, "folder": folder, "schema": rows.schema.jsonValue(), "notes": notes}
        if not self._folder.put_if_absent(f"_manifest/{version:012d}.json", json.dumps(manifest)):
            raise RuntimeError(f"another writer committed version {version} of {self.path}")
        return version
