"""Whole-table snapshots for tables that are rewritten by every micro-batch.

Each version is its own parquet folder. It counts from the moment its marker is there, which
is set after the files are complete and the checks have passed, so a reader sees the old rows
or the new ones, and a failed write is ignored. Versions are batch ids: replaying a batch
starts from the version before it and writes a further attempt beside the first, whose files
stay for those who are reading them.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from marketlake import files

_FOLDER = re.compile(r"version=(-?\d+)\.(\d+)$")
_MARKER = "_PUBLISHED"
_NOTE = "_NOTE"


class Snapshots:
    """``keep`` versions stay on disk for readers that started before a newer one. With a
    ``view`` name, that view always shows the newest version."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keep: int = 3,
        view: str | None = None,
    ):
        self.spark, self.path, self.schema, self.keep, self.view = spark, path, schema, keep, view

    def _folder(self, version: int, attempt: int) -> str:
        return f"{self.path}/version={version}.{attempt}"

    def _attempts(self) -> list[tuple[int, int]]:
        """All folders as (version, attempt), oldest first."""
        named = map(_FOLDER.match, files.names_in(self.spark, self.path))
        return sorted((int(m.group(1)), int(m.group(2))) for m in named if m)

    def _published(self) -> dict[int, int]:
        """The last published attempt of every version."""
        return {
            v: a for v, a in self._attempts() if files.exists(self.spark, f"{self._folder(v, a)}/{_MARKER}")
        }

    def versions(self) -> list[int]:
        """Published versions, oldest first."""
        return sorted(self._published())

    def read(self, before: int | None = None) -> DataFrame:
        """Newest published version, or the newest one older than ``before``."""
        published = self._published()
        usable = [v for v in published if before is None or v < before]
        if not usable:
            raise ValueError(f"no snapshot in {self.path}")
        return self._rows(max(usable), published[max(usable)])

    def _rows(self, version: int, attempt: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self._folder(version, attempt))

    def note(self) -> str | None:
        """What was written beside the newest version's rows, if anything."""
        published = self._published()
        if not published:
            return None
        path = f"{self._folder(max(published), published[max(published)])}/{_NOTE}"
        return files.read_text(self.spark, path) if files.exists(self.spark, path) else None

    def write(
        self,
        version: int,
        rows: DataFrame,
        check: Callable[[DataFrame], object] | None = None,
        note: str | None = None,
    ) -> DataFrame:
        """Write a further attempt at a version, check it, and only then publish it. A ``note``
        becomes visible with the rows or not at all."""
        attempt = 1 + max((a for v, a in self._attempts() if v == version), default=-1)
        folder = self._folder(version, attempt)
        rows.select(*self.schema.fieldNames()).write.parquet(folder)
        written = self._rows(version, attempt)
        if check is not None:
            check(written)
        if note is not None:
            files.write_text(self.spark, f"{folder}/{_NOTE}", note)
        files.touch(self.spark, f"{folder}/{_MARKER}")
        if self.view:
            self.show_newest()
        self._drop_old(version)
        return written

    def change(
        self,
        version: int,
        source: DataFrame,
        rows: Callable[[DataFrame], DataFrame],
        check: Callable[[DataFrame], object] | None = None,
    ) -> DataFrame:
        """The next version: ``rows`` gives what becomes of the stored rows. The whole table is
        read and written, whatever the source touches."""
        return self.write(version, rows(self.read(before=version)), check)

    def show_newest(self) -> bool:
        """Point the view at the newest version, if there is one: for a fresh catalog."""
        published = self._published()
        if published and self.view:
            show(self.spark, self.view, self._folder(max(published), published[max(published)]))
        return bool(published)

    def _drop_old(self, newest: int) -> None:
        old = [v for v in self.versions() if v <= newest][: -self.keep]
        for version, attempt in self._attempts():
            if version in old:
                files.delete(self.spark, self._folder(version, attempt))


def show(spark: SparkSession, view: str, folder: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM parquet.`{folder}`")
