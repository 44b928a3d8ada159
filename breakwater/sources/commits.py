"""Which attempts at recording runs count: numbered small files, each published whole or not at all."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from breakwater.sources.shared import file_system

CLEARED = "cleared"

_contents: dict[tuple, str] = {}  # a published file never changes


class Commits:
    """The list of published attempts below one folder.

    File n + 1 can be published once: it is written under another name and renamed, and the rename
    fails if the name is taken. Who has checked his runs against the first n attempts
    and then publishes file n + 1 has therefore checked them against all. (The local file system looks before it
    renames; writers of different processes need one whose rename is atomic, as HDFS has.)
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def entries(self) -> list[str]:
        """All published attempts and clearings in their order."""
        fs, folder = file_system(self.spark, self.path)
        if not fs.exists(folder):
            return []
        found = {}
        for status in fs.listStatus(folder):
            file = status.getPath()
            number, _, kind = file.getName().partition(".")
            if kind == "json":
                key = (file.toString(), status.getModificationTime())
                if key not in _contents:
                    _contents[key] = json.loads(self._read(fs, file, status.getLen()))["attempt"]
                found[int(number)] = _contents[key]
        return [found[n] for n in sorted(found)]

    def attempts(self) -> list[str]:
        """The attempts that count: those after the last clearing."""
        return standing(self.entries())

    def publish(self, attempt: str, after: int) -> bool:
        """Publishes an attempt as entry ``after + 1``; False if that entry exists by now."""
        fs, folder = file_system(self.spark, self.path)
        jvm = self.spark._jvm
        hadoop = jvm.org.apache.hadoop.fs
        fs.mkdirs(folder)
        draft, target = hadoop.Path(folder, f"_{uuid.uuid4().hex}"), hadoop.Path(folder, f"{after + 1:012d}.json")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps({"attempt": attempt}).encode()))
        out.close()
        context = hadoop.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
        try:
            context.rename(draft, target, options)
        except Py4JJavaError as e:
            if not e.java_exception.getClass().getName().endswith("FileAlreadyExistsException"):
                raise
            fs.delete(draft, False)
            return False
        return True

    def _read(self, fs, file, length: int) -> str:
        stream = fs.open(file)
        try:
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, length)).decode()
        finally:
            stream.close()


def standing(entries: list[str]) -> list[str]:
    last = max((k for k, e in enumerate(entries) if e == CLEARED), default=-1)
    return entries[last + 1 :]
