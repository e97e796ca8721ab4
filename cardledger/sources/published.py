"""Tables that are put in place together.

A version is one small file that names a folder for each table. Tables are written to new folders, their
keys are checked, and the version's file comes last, so readers have all new tables or all old ones,
whatever breaks off in between. Versions are never changed: who has begun with one can go on reading it.
Folders that no version names are left from writers that broke off.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from cardledger.schemas import TABLES, require_primary_key
from cardledger.sources import files
from cardledger.sources.scratch import COMPRESSION


@dataclass(frozen=True)
class VersionedStore:
    """The tables under `root`: as the newest version has them, or as the version `pinned` has."""

    spark: SparkSession
    root: str
    pinned: int | None = None

    def version(self) -> int:
        """The version that is read; -1 before the first."""
        if self.pinned is not None:
            return self.pinned
        found = [n for n in files.names(self.spark, f"{self.root}/versions") if n.endswith(".json")]
        return int(found[-1].removesuffix(".json")) if found else -1

    def at(self, version: int) -> VersionedStore:
        return replace(self, pinned=version)

    def run(self) -> str | None:
        """The name of the run that has published the version."""
        return self._content(self.version())["run"]

    def read(self, name: str) -> DataFrame:
        folder = self._content(self.version())["tables"][name]
        return self.spark.read.schema(TABLES[name][0]).parquet(self._folder(name, folder))

    def write(self, df: DataFrame, name: str) -> None:
        self.publish({name: df})

    def publish(self, tables: dict[str, DataFrame], run: str | None = None) -> int:
        """Put `tables` in place of those read here, all at once: the number of the new version.

        It is an error (FileExistsError), and nothing changes, where another writer has published since.
        """
        before = self.version()
        folders = self._content(before)["tables"]
        for name, df in tables.items():
            schema, key = TABLES[name]
            folders[name] = uuid.uuid4().hex
            path = self._folder(name, folders[name])
            df.select(*schema.names).write.parquet(path, compression=COMPRESSION)
            require_primary_key(self.spark.read.schema(schema).parquet(path), key)
        self._commit(before + 1, {"tables": folders, "run": run})
        return before + 1

    def _commit(self, version: int, content: dict) -> None:
        files.write_new(self.spark, self._file(version), json.dumps(content))

    def _content(self, version: int) -> dict:
        if version < 0:
            return {"tables": {}, "run": None}
        return json.loads(files.read_text(self.spark, self._file(version)))

    def _file(self, version: int) -> str:
        return f"{self.root}/versions/{version:012d}.json"

    def _folder(self, name: str, folder: str) -> str:
        return f"{self.root}/tables/{name}/{folder}"
