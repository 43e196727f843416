"""Numbered manifests: small JSON files that say which written folders are a table's or layer set's content.

Data goes into folders of its own that nobody reads yet.  Publishing is one conditional
create of ``<root>/manifests/<number>.json``: of two writers that both build on number 4,
one creates 5 and the other is told that it lost.  Readers take the highest manifest that
is whole and keep to it, whatever is published later.  A writer that dies before the
create leaves folders that no manifest names; one that dies within it leaves a manifest
without its end mark, which readers pass over.
"""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from riskmart.session import join_path

END = "end of manifest"


class Manifests:
    """The manifests under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.folder = join_path(root.rstrip("/"), "manifests")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _file(self, number: int):
        return self._path(join_path(self.folder, f"{number:012d}.json"))

    def numbers(self) -> list[int]:
        """All created numbers, whole or not, rising."""
        folder = self._path(self.folder)
        if not self._fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def content(self, number: int) -> dict | None:
        """A manifest's content; None where its writer did not finish."""
        stream = self._fs.open(self._file(number))
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        body, _, mark = text.rpartition("\n")
        return json.loads(body) if mark == END else None

    def latest(self) -> tuple[int, dict] | None:
        """(number, content) of the newest whole manifest."""
        for number in reversed(self.numbers()):
            content = self.content(number)
            if content is not None:
                return number, content
        return None

    def next_number(self) -> int:
        """The number a writer that starts now builds towards."""
        numbers = self.numbers()
        return numbers[-1] + 1 if numbers else 0

    def publish(self, number: int, content: dict) -> bool:
        """Create manifest ``number``; False, and nothing changed, where it exists already."""
        data = bytearray((json.dumps(content, sort_keys=True) + "\n" + END).encode())
        target = self._file(number)
        self._fs.mkdirs(target.getParent())
        try:
            if self._fs.getUri().getScheme() == "file":
                # Hadoop's local file system looks before it creates; the operating system does both in one step
                jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
                option = jvm.java.nio.file.StandardOpenOption
                options = gateway.new_array(jvm.java.nio.file.OpenOption, 2)
                options[0], options[1] = option.CREATE_NEW, option.WRITE
                jvm.java.nio.file.Files.write(jvm.java.nio.file.Path.of(target.toUri()) if target.toUri().getScheme()
                                              else jvm.java.io.File(target.toUri().getPath()).toPath(), data, options)
            else:
                stream = self._fs.create(target, False)
                stream.write(data)
                stream.close()
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        return True

    def delete(self, path: str) -> None:
        """Delete a folder that no kept manifest names."""
        self._fs.delete(self._path(path), True)

    def folders(self, path: str) -> list[str]:
        """Names of the folders under ``path``."""
        at = self._path(path)
        if not self._fs.exists(at):
            return []
        return sorted(f.getPath().getName() for f in self._fs.listStatus(at) if f.isDirectory())
