"""Published JSON manifests: what a job has finished, switched in one step.

A manifest folder holds one file per version. A version is written beside its
place under a name that readers skip and renamed into it, so it is there whole
or not at all; the highest version counts. What a manifest names is written
before it and never changed after, so a run that stops halfway leaves the
previous version in force, whole.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from tributary.sources.lake import _file_system, delete_folder, file_names

#: Versions kept behind the current one, for readers that hold them.
KEPT_VERSIONS = 2


class Manifest:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _versions(self) -> list[int]:
        names = (n.removesuffix(".json") for n in file_names(self.spark, self.folder) if n.endswith(".json"))
        return sorted(int(n) for n in names if n.isdigit())

    def _place(self, version: int) -> str:
        return f"{self.folder}/{version:012d}.json"

    def current(self) -> dict | None:
        """The published manifest, or None before the first."""
        versions = self._versions()
        if not versions:
            return None
        return json.loads(self.spark.read.text(self._place(versions[-1]), wholetext=True).first().value)

    def publish(self, content: dict) -> int:
        """Make ``content`` the current manifest; returns its version. Fails if
        another run has published that version in the meantime."""
        versions = self._versions()
        version = versions[-1] + 1 if versions else 1
        written = f"{self.folder}/.{uuid.uuid4().hex}.tmp"
        fs, path = _file_system(self.spark, written)
        stream = fs.create(path)
        try:
            stream.write(bytearray(json.dumps(content, sort_keys=True).encode()))
        finally:
            stream.close()
        _, place = _file_system(self.spark, self._place(version))
        if fs.exists(place) or not fs.rename(path, place):
            fs.delete(path, False)
            raise RuntimeError(f"Another run has published {place}.")
        for old in versions[: -KEPT_VERSIONS or None]:
            delete_folder(self.spark, self._place(old))
        return version
