"""Partitioned tables whose versions stay readable, safe against a second writer.

Under the folder of a table lie

* ``data/commit=<id>/<key>=<value>/...``: the files of one write, never changed;
* ``manifests/<id>``: which commit holds each partition once that write counts;
* ``versions/<number>``: the id of the version's manifest, created atomically.

A reader pins one version: what it has planned stays readable while partitions are
replaced.  A writer stores its rows first, then claims the next number; if another
writer was faster, only the manifest is made again, on top of the other's.  So no
write is lost, and a write that breaks off leaves files that no version names.

Manifests hold a row per partition.  Planning, the newest date or the list of
traits need no data file.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cohortia.errors import Conflict
from cohortia.sources import files


def _same(left: DataFrame, right: DataFrame, columns: list[str]):
    return reduce(and_, [left[c].eqNullSafe(right[c]) for c in columns])


class VersionedTable:
    def __init__(self, spark: SparkSession, uri: str, schema: T.StructType, keys: list[str]):
        self.spark, self.uri, self.schema, self.keys = spark, uri.rstrip("/"), schema, keys
        commit = T.StructField("commit", T.StringType())
        self.partition_schema = T.StructType([commit, *[schema[k] for k in keys]])

    # reading

    def version(self) -> int:
        """Number of the newest version; 0 before the first write."""
        return max((int(n) for n in files.list_names(self.spark, f"{self.uri}/versions") if n.isdigit()), default=0)

    def partitions(self, version: int | None = None) -> DataFrame:
        """``commit`` and the keys of every partition of a version, from its manifest alone."""
        number = self.version() if version is None else version
        if not number:
            return self.spark.createDataFrame([], self.partition_schema)
        name = files.read_text(self.spark, f"{self.uri}/versions/{number}")
        return self.spark.read.schema(self.partition_schema).parquet(f"{self.uri}/manifests/{name}")

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest by default; later writes do not touch them."""
        held = self.partitions(version)
        commits = sorted(r.commit for r in held.select("commit").distinct().collect())  # writes that still count
        if not commits:
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.schema(T.StructType([*self.schema, self.partition_schema["commit"]]))
        rows = reader.option("basePath", f"{self.uri}/data").parquet(*[self._data(c) for c in commits])
        return rows.join(held, _same(rows, held, self.partition_schema.names), "left_semi").select(*self.schema.names)

    def _data(self, commit: str) -> str:
        return f"{self.uri}/data/commit={commit}"

    # writing

    def _store(self, rows: DataFrame) -> tuple[str, DataFrame]:
        """Write rows as a new commit; its id and partitions."""
        commit = uuid.uuid4().hex
        rows = rows.select(*[rows[f.name].cast(f.dataType).alias(f.name) for f in self.schema])
        rows.hint("rebalance", *self.keys).write.partitionBy(*self.keys).parquet(self._data(commit))
        found = files.partition_values(self.spark, self._data(commit), self.keys)  # folders of this commit alone
        text = T.StructType([T.StructField(f.name, T.StringType()) for f in self.partition_schema])
        written = self.spark.createDataFrame([(commit, *values) for values in found], text)
        return commit, written.select(*[written[f.name].cast(f.dataType).alias(f.name) for f in self.partition_schema])

    def _publish(self, base: int, written: DataFrame, covered: DataFrame | None) -> bool:
        """Try to make the next version: the base's partitions, but for replaced ones, and the written."""
        held = self.partitions(base)
        for gone, columns in ((covered, covered.columns if covered is not None else []), (written, self.keys)):
            if gone is not None:
                gone = gone.select(*columns).distinct()
                held = held.join(gone, _same(held, gone, columns), "left_anti")
        name = uuid.uuid4().hex
        held.unionByName(written).coalesce(1).write.parquet(f"{self.uri}/manifests/{name}")  # a row per partition
        return files.claim(self.spark, f"{self.uri}/versions/{base + 1}", name)

    def replace(self, rows: DataFrame, covered: DataFrame | None = None) -> int:
        """Replace the partitions in which rows fall, and all that covered lists; the new version.

        ``covered`` holds some of the keys; a partition it covers that got no rows is gone afterwards.
        """
        _, written = self._store(rows)
        while not self._publish(base := self.version(), written, covered):
            pass  # another writer has that number: on top of its version, then
        return base + 1

    def update(self, change: Callable[[DataFrame], DataFrame], covered: DataFrame | None = None, tries: int = 10) -> int:
        """Replace partitions by what ``change`` makes of the rows; made again where another writer came between."""
        for _ in range(tries):
            base = self.version()
            _, written = self._store(change(self.read(base)))
            if self._publish(base, written, covered):
                return base + 1
        raise Conflict(f"other writers changed {self.uri} during each of {tries} tries")

    def vacuum(self, keep: int = 2, older_than_hours: float = 24.0) -> list[str]:
        """Drop all but the newest versions, and commits and manifests that none of those names.

        Younger files stay, as a writer may be about to name them.  Returns the dropped folders.
        """
        newest = self.version()
        kept = [n for n in range(max(newest - keep + 1, 1), newest + 1)]
        names = {files.read_text(self.spark, f"{self.uri}/versions/{n}") for n in kept}
        commits = {r.commit for n in kept for r in self.partitions(n).select("commit").distinct().collect()}
        dropped = []
        for n in files.list_names(self.spark, f"{self.uri}/versions"):
            if n.isdigit() and int(n) < newest - keep + 1:
                dropped.append(f"{self.uri}/versions/{n}")
        old = files.names_older_than(self.spark, f"{self.uri}/manifests", older_than_hours)
        dropped += [f"{self.uri}/manifests/{n}" for n in old if n not in names]
        old = files.names_older_than(self.spark, f"{self.uri}/data", older_than_hours)
        dropped += [f"{self.uri}/data/{n}" for n in old if n.removeprefix("commit=") not in commits]
        for path in dropped:
            files.delete(self.spark, path)
        return dropped
