"""Keyed tables whose merges touch little.

Rows lie in folders by a hash bucket of the key (``bucket=b/write=w<version>_<attempt>``). A
version is a manifest that says which write of every bucket belongs to it. A merge finds the
buckets its source falls into, reads and rewrites only those, and carries all others over by
naming their old folders again; so a batch costs what it touches, not what the table holds. The
manifest is put in place by one rename after the files are complete and the checks have passed:
readers see the old rows or the new ones. A replayed version starts from the one before it and
writes a further attempt.

One writer per table. The number of buckets is fixed when the table is made; some 100 MB a
bucket suit a large one.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from marketlake import files

BUCKETS = 16

_MANIFEST = re.compile(r"version=(-?\d+)\.(\d+)\.json$")


class BucketedTable:
    """``by`` names the columns of the bucket; every merge's keys must hold them. ``keep``
    versions stay for readers that started before. With a ``view`` name, that view shows the
    newest version."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        by: tuple[str, ...] = ("ticker",),
        buckets: int = BUCKETS,
        keep: int = 3,
        view: str | None = None,
    ):
        self.spark, self.path, self.schema = spark, path, schema
        self.by, self.buckets, self.keep, self.view = by, buckets, keep, view
        newest = self._manifests()
        if newest:
            self.buckets = self._manifest(*newest[-1])["buckets"]

    # --- versions ---------------------------------------------------------------------------

    def _manifests(self) -> list[tuple[int, int]]:
        """(version, attempt) of all manifests, oldest first."""
        named = map(_MANIFEST.match, files.names_in(self.spark, f"{self.path}/versions"))
        return sorted((int(m.group(1)), int(m.group(2))) for m in named if m)

    def _manifest(self, version: int, attempt: int) -> dict:
        return json.loads(files.read_text(self.spark, f"{self.path}/versions/version={version}.{attempt}.json"))

    def _published(self) -> dict[int, int]:
        return dict(self._manifests())

    def versions(self) -> list[int]:
        """Published versions, oldest first."""
        return sorted(self._published())

    def writes(self, before: int | None = None) -> dict[int, str]:
        """The write of every bucket in the newest version, or the newest older than ``before``."""
        published = self._published()
        usable = [v for v in published if before is None or v < before]
        if not usable:
            raise ValueError(f"no version in {self.path}")
        found = self._manifest(max(usable), published[max(usable)])["writes"]
        return {int(bucket): write for bucket, write in found.items()}

    # --- reading ----------------------------------------------------------------------------

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.by), F.lit(self.buckets)).cast("int")

    @staticmethod
    def _condition(writes: dict[int, str]) -> str:
        """Over partition columns alone, so it prunes folders before anything is read."""
        if not writes:
            return "false"
        chosen = ", ".join(f"{bucket}, '{write}'" for bucket, write in sorted(writes.items()))
        return f"bucket IN ({', '.join(map(str, sorted(writes)))}) AND write = element_at(map({chosen}), bucket)"

    def _rows(self, writes: dict[int, str]) -> DataFrame:
        folder = f"{self.path}/rows"
        if not writes or not files.exists(self.spark, folder):
            return self.spark.createDataFrame([], self.schema)
        placed = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType()), T.StructField("write", T.StringType())])
        rows = self.spark.read.schema(placed).parquet(folder)
        return rows.where(self._condition(writes)).select(*self.schema.fieldNames())

    def read(self, before: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """Newest version, or the newest older than ``before``; all of it or some buckets."""
        writes = self.writes(before)
        return self._rows(writes if buckets is None else {b: w for b, w in writes.items() if b in set(buckets)})

    def touched(self, source: DataFrame) -> list[int]:
        """The buckets that a source falls into: at most as many numbers as there are buckets."""
        return sorted(r[0] for r in source.select(self.bucket()).distinct().collect())

    # --- writing ----------------------------------------------------------------------------

    def write(
        self, version: int, rows: DataFrame, check: Callable[[DataFrame], object] | None = None
    ) -> DataFrame:
        """A version of its own: the rows are all the table holds."""
        return self._publish(version, rows, {}, check)

    def change(
        self,
        version: int,
        source: DataFrame,
        rows: Callable[[DataFrame], DataFrame],
        check: Callable[[DataFrame], object] | None = None,
    ) -> DataFrame:
        """The next version: ``rows`` gets the stored rows of the touched buckets and gives
        what these buckets shall hold. ``check`` sees the whole new version before it counts."""
        writes = self.writes(before=version)
        touched = set(self.touched(source))
        carried = {b: w for b, w in writes.items() if b not in touched}
        stored = self._rows({b: w for b, w in writes.items() if b in touched})
        return self._publish(version, rows(stored), carried, check)

    def _publish(
        self, version: int, rows: DataFrame, carried: dict[int, str], check: Callable[[DataFrame], object] | None
    ) -> DataFrame:
        attempt = 1 + max((a for v, a in self._attempts() if v == version), default=-1)
        name = f"w{version}_{attempt}"
        placed = rows.select(*self.schema.fieldNames()).withColumns({"bucket": self.bucket(), "write": F.lit(name)})
        placed.hint("rebalance", "bucket").write.mode("append").partitionBy("bucket", "write").parquet(f"{self.path}/rows")
        writes = carried | {b: name for b in self._buckets_of(name)}
        found = self._rows(writes)
        if check is not None:
            check(found)
        manifest = json.dumps({"buckets": self.buckets, "writes": writes})
        files.write_text(self.spark, f"{self.path}/versions/version={version}.{attempt}.json", manifest)
        if self.view:
            self._show(writes)
        self._drop_old(version)
        return found

    def _attempts(self) -> list[tuple[int, int]]:
        """(version, attempt) of manifests and of writes that never came to one."""
        left = set(self._manifests())
        for folder in files.names_in(self.spark, f"{self.path}/rows"):
            if folder.startswith("bucket="):
                for write in files.names_in(self.spark, f"{self.path}/rows/{folder}"):
                    version, _, attempt = write.removeprefix("write=w").rpartition("_")
                    left.add((int(version), int(attempt)))
        return sorted(left)

    def _buckets_of(self, name: str) -> list[int]:
        """The buckets that a finished write has a folder in."""
        return [
            b for b in range(self.buckets) if files.exists(self.spark, f"{self.path}/rows/bucket={b}/write={name}")
        ]

    def show_newest(self) -> bool:
        """Point the view at the newest version, if there is one: for a fresh catalog."""
        published = self._published()
        if published and self.view:
            self._show(self.writes())
        return bool(published)

    def _show(self, writes: dict[int, str]) -> None:
        names = self.schema.fieldNames()
        if writes:
            rows = f"SELECT {', '.join(names)} FROM parquet.`{self.path}/rows` WHERE {self._condition(writes)}"
        else:
            columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in self.schema)
            rows = f"SELECT {columns} WHERE false"
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.view} AS {rows}")

    def _drop_old(self, newest: int) -> None:
        """Manifests beyond the last ``keep`` go, and the folders that no other manifest names."""
        old = [v for v in self.versions() if v <= newest][: -self.keep]
        gone, kept = {}, set()
        for version, attempt in self._manifests():
            writes = self._manifest(version, attempt)["writes"].items()
            if version in old:
                gone[version, attempt] = set(writes)
            else:
                kept.update(writes)
        for (version, attempt), writes in gone.items():
            files.delete(self.spark, f"{self.path}/versions/version={version}.{attempt}.json")
            for bucket, write in writes - kept:
                files.delete(self.spark, f"{self.path}/rows/bucket={bucket}/write={write}")
