"""Stored tables that change by whole partitions, with versions that are switched at once.

A table is a folder of data folders and a folder of versions. A version is one small file that
names, for every place of the table, the data folder that holds it. Writers add data folders
first and the version last, by a rename that fails if another writer was faster; so a reader
sees the version before or after, and a run that dies midway leaves the table as it was.
"""

from __future__ import annotations

import json
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridops.session import file_system, scratch_path

_PLACE = "__place"


class Conflict(RuntimeError):
    """Another writer has committed since the version was read."""


def one_per_key(df: DataFrame, keys: list[str], pick, order_by: list[str]) -> DataFrame:
    """One row of each key, by ``pick`` (``F.min`` or ``F.max``) over ``order_by`` and then the other columns."""
    # min/max of a struct has partial aggregation, so a key with many copies
    # collapses before the shuffle, and the surviving row is deterministic.
    order = [c for c in order_by if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = pick(F.struct(*order, *rest)) if order or rest else F.lit(None)
    fields = [F.col(f"_row.{c}").alias(c) for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(row.alias("_row")).select(*keys, *fields).select(*df.columns)


class StoredTable:
    """A keyed Parquet table below ``path`` that merges rewrite in part.

    ``place`` is a column of the keys (a date of them, say) that tells in which part of the table a key stands;
    by default one of ``buckets`` hashes; a text is the one place of all rows. Its distinct values in one merge pass through the
    driver, rows never do. All writers of a table must use the same keys and place.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], place: Column | str | None = None, buckets: int = 64):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys
        self.only = place if isinstance(place, str) else None
        place = F.lit(place) if self.only else place
        hashed = F.pmod(F.xxhash64(*keys), F.lit(buckets))
        self.place = F.coalesce((hashed if place is None else place).cast("string"), F.lit("none"))

    def versions(self) -> list[int]:
        system, own = file_system(self.spark, f"{self.path}/versions")
        if not system.exists(own):
            return []
        names = [s.getPath().getName() for s in system.listStatus(own)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """``version, schema, places`` of a version, by default the last; empty before the first."""
        known = self.versions()
        if not known:
            return {"version": 0, "schema": None, "places": {}}
        number = known[-1] if version is None else version
        system, own = file_system(self.spark, f"{self.path}/versions/{number:010d}.json")
        stream = system.open(own)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def _commit(self, before: dict, schema: dict, places: dict[str, str]) -> int:
        number = before["version"] + 1
        system, own = file_system(self.spark, f"{self.path}/versions/{number:010d}.json")
        _, draft = file_system(self.spark, f"{self.path}/drafts/{uuid4().hex}")
        system.mkdirs(own.getParent())
        stream = system.create(draft)
        try:
            stream.write(bytearray(json.dumps({"version": number, "schema": schema, "places": places}).encode()))
        finally:
            stream.close()
        if system.exists(own) or not system.rename(draft, own):
            raise Conflict(f"version {number} of {self.path} exists")
        return number

    def _folders(self, places: dict[str, str]) -> list[str]:
        return sorted(f"{self.path}/data/{folder}" for folder in places.values())

    def _frame(self, manifest: dict, places: dict[str, str], schema: dict | None = None) -> DataFrame:
        kind = StructType.fromJson(schema or manifest["schema"])
        if not places:
            return self.spark.createDataFrame([], kind)
        return self.spark.read.schema(kind).parquet(*self._folders(places))

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, by default the last."""
        manifest = self.manifest(version)
        if manifest["schema"] is None:
            raise FileNotFoundError(self.path)
        return self._frame(manifest, manifest["places"])

    def _write(self, rows: DataFrame) -> dict[str, str]:
        """Write rows with their place as new data folders; which folder has which place."""
        run = uuid4().hex
        if self.only:  # nothing to deal out: every task writes what it has as it comes, without a shuffle or a sort
            rows.drop(_PLACE).write.parquet(f"{self.path}/data/{run}/{_PLACE}={self.only}")
            return {self.only: f"{run}/{_PLACE}={self.only}"}
        rows.hint("rebalance", _PLACE).write.partitionBy(_PLACE).parquet(f"{self.path}/data/{run}")
        system, own = file_system(self.spark, f"{self.path}/data/{run}")
        folders = [s.getPath().getName() for s in system.listStatus(own) if s.isDirectory()]
        unescape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        return {unescape(f.split("=", 1)[1]): f"{run}/{f}" for f in folders}

    def replace(self, rows: DataFrame) -> int:
        """Make ``rows`` the table; until they are all written readers see the old one. May read from the table itself."""
        before = self.manifest()
        places = self._write(rows.withColumn(_PLACE, self.place))
        return self._commit(before, json.loads(rows.schema.json()), places)

    def upsert(self, incoming: DataFrame, order_by: list[str] | None = None) -> list[str]:
        """Add the incoming rows, replacing rows of the same key; the places that were rewritten.

        Of several incoming rows with one key the last by ``order_by``, then by the other columns, wins.
        """
        return self._merge(one_per_key(incoming, self.keys, F.max, order_by or []), replace=True)

    def insert_ignore(self, incoming: DataFrame, order_by: list[str] | None = None) -> list[str]:
        """Add the incoming rows whose key the table lacks; the places that were rewritten.

        Of several incoming rows with one key the first by ``order_by``, then by the other columns, is kept.
        """
        return self._merge(one_per_key(incoming, self.keys, F.min, order_by or []), replace=False)

    def _merge(self, rows: DataFrame, replace: bool) -> list[str]:
        """Copy on write: only places that the incoming keys stand in are read, and only those that change are written."""
        before = self.manifest()
        schema = before["schema"] or json.loads(rows.schema.json())
        names = StructType.fromJson(schema).names
        path = scratch_path(self.spark, "incoming")
        rows.select(*names).withColumn(_PLACE, self.place).write.parquet(path)
        fresh = self.spark.read.parquet(path)
        met = {r[0] for r in fresh.select(_PLACE).distinct().collect()}
        old = self._frame(before, {p: f for p, f in before["places"].items() if p in met}, schema)
        # Rows that are there already, whole (or, to be left alone, by key), change nothing.
        same = names if replace else self.keys
        known = old.select(*(F.col(c).alias(f"__{c}") for c in same))
        equal = F.lit(True)
        for c in same:
            equal = equal & fresh[c].eqNullSafe(known[f"__{c}"])
        path = scratch_path(self.spark, "changes")
        fresh.join(known, equal, "left_anti").write.parquet(path)
        changes = self.spark.read.schema(fresh.schema).parquet(path)
        touched = sorted(r[0] for r in changes.select(_PLACE).distinct().collect())
        if not touched:
            return []
        kept = self._frame(before, {p: f for p, f in before["places"].items() if p in set(touched)}, schema)
        if replace:
            gone = changes.select(*(F.col(c).alias(f"__{c}") for c in self.keys))
            equal = F.lit(True)
            for c in self.keys:
                equal = equal & kept[c].eqNullSafe(gone[f"__{c}"])
            kept = kept.join(gone, equal, "left_anti")
        written = self._write(kept.withColumn(_PLACE, self.place).unionByName(changes))
        self._commit(before, schema, {**before["places"], **written})
        return touched

    def vacuum(self, keep: int = 2) -> int:
        """Delete the data folders and versions that none of the last ``keep`` versions needs; how many folders."""
        known = self.versions()
        used = {f for v in known[-keep:] for f in self.manifest(v)["places"].values()}
        system, _ = file_system(self.spark, self.path)
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        old = {f for v in known[:-keep] for f in self.manifest(v)["places"].values()} - used
        for folder in sorted(old):
            system.delete(path(f"{self.path}/data/{folder}"), True)
        for v in known[:-keep]:
            system.delete(path(f"{self.path}/versions/{v:010d}.json"), False)
        return len(old)
