"""State kept between named analyses: numbered versions and a pointer to the latest.

A version is a Parquet table ``<root>/<name>/v=<n>``; it becomes the state when
the pointer ``<root>/<name>/latest.json`` names it, which is one small file put
in one step after the table is complete.  An analysis that fails half way
leaves the pointer, and so the state, as it was.  Old versions stay readable.
The folder is on shared storage, so the state outlives the session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import qualified
from ..sources import commit as CM


class NoState(KeyError):
    """The store has no such state or version."""


class StateStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = qualified(spark, root.rstrip("/"))

    def _pointer(self, name: str) -> tuple:
        fs, root = CM.fs_and_path(self.root)
        return fs, f"{root}/{name}/latest.json"

    def _path(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/v={version}"

    def latest(self, name: str) -> int | None:
        """Number of the current version; None if the state was never put."""
        told = CM.get_json(*self._pointer(name))
        return told["version"] if told else None

    def put(self, name: str, table: DataFrame, **note) -> int:
        """Write ``table`` as the next version and make it the state; ``note`` is kept beside the pointer."""
        version = (self.latest(name) or 0) + 1
        table.write.mode("overwrite").parquet(self._path(name, version))
        fs, path = self._pointer(name)
        CM.put_json(fs, path, {"version": version, "note": note})
        return version

    def get(self, name: str, default=None, version: int | None = None) -> DataFrame | None:
        """The current version, or the one asked for; ``default`` if there is none yet."""
        latest = self.latest(name)
        if latest is None:
            return default
        if version is not None and not 1 <= version <= latest:
            raise NoState(f"{name}: version {version} of {latest}")
        return self.spark.read.parquet(self._path(name, version or latest))

    def __getitem__(self, name: str) -> DataFrame:
        found = self.get(name)
        if found is None:
            raise NoState(name)
        return found

    def note(self, name: str) -> dict:
        """What was kept beside the current version."""
        told = CM.get_json(*self._pointer(name))
        return told["note"] if told else {}
