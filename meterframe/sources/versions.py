"""Datasets that change by one file.

Rows are written to a folder of their own, which no one changes again.  Then one
small file in ``versions``, created only if its number is free, names the folders
that make up the dataset.  Readers take the last such file: they see all rows of
a write or none, whenever it ends, in file systems with and without a rename in
one step.

* A write that ends before its file leaves the dataset as it was; its folder
  belongs to no version.
* Of two writers that want the same number one takes the next, on top of the
  other's rows.
* A batch id that is in the dataset already makes an append change nothing, so a
  repeated append is one append.
* A file without its last line is being written or was cut off: readers take the
  version before it, writers refuse until it is whole or removed.

A version names all its folders, about a hundred bytes each; ``replace`` with the
dataset's own rows starts a new list.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..session import create_once, list_names, read_text, remove

END = "\nend\n"


@dataclass(frozen=True)
class Version:
    number: int
    folders: tuple[str, ...] = ()
    batches: tuple[str, ...] = ()


class UnfinishedVersion(RuntimeError):
    """The last version is being written, or its writer was cut off."""


@dataclass(frozen=True)
class Dataset:
    spark: SparkSession = field(repr=False)
    root: str

    # -- reading -----------------------------------------------------------

    def _load(self, name: str) -> Version | None:
        text = read_text(self.spark, f"{self.root}/versions/{name}")
        if not text.endswith(END):
            return None
        said = json.loads(text[: -len(END)])
        return Version(int(name), tuple(said["folders"]), tuple(said["batches"]))

    def _last(self, whole: bool) -> Version:
        for name in reversed(list_names(self.spark, f"{self.root}/versions")):
            found = self._load(name)
            if found:
                return found
            if whole:
                raise UnfinishedVersion(f"{self.root}/versions/{name} has no end; remove it if no writer is at work")
        return Version(0)

    def version(self) -> Version:
        """The last whole version; number 0 has no rows."""
        return self._last(whole=False)

    def paths(self) -> list[str]:
        return [f"{self.root}/rows/{folder}" for folder in self.version().folders]

    def read(self) -> DataFrame:
        paths = self.paths()
        if not paths:
            raise FileNotFoundError(f"'{self.root}' has no version")
        parts = [self.spark.read.option("basePath", path).parquet(path) for path in paths]
        if all(p.schema == parts[0].schema for p in parts):
            # One scan of all folders, unless folders by value need a base each.
            if all("=" not in n for path in paths for n in list_names(self.spark, path)):
                return self.spark.read.schema(parts[0].schema).parquet(*paths)
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    # -- writing -----------------------------------------------------------

    def append(self, df: DataFrame, batch: str | None = None, partition_by: tuple[str, ...] = ()) -> bool:
        """Add rows; False if ``batch`` has been added before."""
        if batch is not None and batch in self._last(whole=True).batches:
            return False

        def grown(before: Version, folder: str) -> Version | None:
            if batch is not None and batch in before.batches:
                return None  # another writer of the same batch was first
            ids = before.batches if batch is None else (*before.batches, batch)
            return Version(before.number + 1, (*before.folders, folder), ids)

        return self._commit(df, partition_by, grown, None)

    def replace(self, df: DataFrame, partition_by: tuple[str, ...] = (), check: Callable[[DataFrame], None] | None = None) -> bool:
        """Let these rows be the dataset.  ``check`` sees them as written and may
        raise, before anyone else sees them."""
        self._last(whole=True)
        return self._commit(df, partition_by, lambda before, folder: Version(before.number + 1, (folder,), before.batches), check)

    def _commit(self, df, partition_by, following, check) -> bool:
        folder = uuid.uuid4().hex
        path = f"{self.root}/rows/{folder}"
        df.write.partitionBy(*partition_by).parquet(path)
        try:
            if check:
                check(self.spark.read.parquet(path))
        except Exception:
            remove(self.spark, path)
            raise
        while True:
            after = following(self._last(whole=True), folder)
            if after is None:
                remove(self.spark, path)
                return False
            text = json.dumps({"folders": after.folders, "batches": after.batches}) + END
            if create_once(self.spark, f"{self.root}/versions/{after.number:012d}", text):
                return True
