"""Stored results that later jobs reuse.

``ResultCatalogue(spark, root).result(df)`` gives the rows of ``df`` from Parquet
under ``root``: stored before, by this or any other job, if an equal plan
was computed over the same versions of the same files; else computed, written and
entered now. A changed, added or removed input file is another version, so
it is never answered from an older result.

An entry is a folder ``plan/versions`` with the data and ``entry.json``, which is
created once, after the data is complete: jobs that compute the same result
at the same time each write their own data, and the first entry counts. An entry is
made only if the input files are still the same after the write. A lost
executor or driver leaves data without an entry, which ``prune`` removes.

Plans without an identity (:mod:`aerolake.lineage`) are not stored: the
DataFrame comes back as it is.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..lineage import Identity, identity
from ..sources.files import create_once, delete_folder, list_files, list_folders, path_exists, read_text

# How often a result is computed again when its inputs change under it.
_TRIES = 3


@dataclass
class ResultCatalogue:
    spark: SparkSession
    root: str
    hits: list[str] = field(default_factory=list)
    stored: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)

    def _folder(self, key: Identity) -> str:
        return f"{self.root.rstrip('/')}/{key.plan}/{key.versions}"

    def _entry(self, key: Identity) -> str:
        return f"{self._folder(key)}/entry.json"

    def lookup(self, df: DataFrame) -> DataFrame | None:
        """The stored rows of ``df``, if there are."""
        key = identity(df)
        return None if key is None else self._read(df, key)

    def _read(self, df: DataFrame, key: Identity) -> DataFrame | None:
        if not path_exists(self.spark, self._entry(key)):
            return None
        data = json.loads(read_text(self.spark, self._entry(key)))["data"]
        return self.spark.read.schema(df.schema).parquet(f"{self._folder(key)}/{data}")

    def result(self, df: DataFrame, name: str = "") -> DataFrame:
        """``df``, read from its stored result, which is computed now if need be.
        Sorted results of one file keep their order."""
        for _ in range(_TRIES):
            key = identity(df)
            if key is None:
                self.skipped.append(name)
                return df
            found = self._read(df, key)
            if found is not None:
                self.hits.append(name)
                return found
            data = f"data-{uuid.uuid4().hex}"
            df.write.parquet(f"{self._folder(key)}/{data}")
            if identity(df) == key:
                create_once(self.spark, self._entry(key), json.dumps({"data": data, "name": name, "files": key.files, "roots": key.roots}))
                self.stored.append(name)
                return self._read(df, key)
        raise RuntimeError(f"the input files of {name or 'a result'} kept changing while it was computed")

    def entries(self) -> list[tuple[str, dict]]:
        """(folder, entry) of all that is stored; None for data without an entry."""
        out = []
        for plan in list_folders(self.spark, self.root):
            for folder in list_folders(self.spark, plan):
                path = f"{folder}/entry.json"
                out.append((folder, json.loads(read_text(self.spark, path)) if path_exists(self.spark, path) else None))
        return out

    def prune(self) -> int:
        """Remove results whose input files have changed, are gone or have more beside
        them, and data that no entry names. Not while other jobs read or write this
        catalogue."""
        removed = 0
        for folder, entry in self.entries():
            if entry is None or {tuple(f) for f in entry["files"]} != {f for r in entry["roots"] for f in list_files(self.spark, r)}:
                delete_folder(self.spark, folder)
                removed += 1
                continue
            for data in list_folders(self.spark, folder):
                if data.rsplit("/", 1)[1] != entry["data"]:
                    delete_folder(self.spark, data)
                    removed += 1
        return removed
