"""Result tables merged by key, range by range (K3 and incremental A1-A3).

A table is a folder of immutable data sets and a manifest that says which of
them count.  Every commit adds one data set (a delta), split by *range*: a text
worked out from the key, such as the month of a result's date.  A range is read
from the few data sets that the manifest lists for it; once they are more than
``deltas``, that range alone is merged into one new data set, and the replaced
ones are retired.

Rows of equal key are resolved by the table's rule when they are read and when
they are merged: ``"last"`` keeps the row of the newest commit; a mapping such
as ``{"traffic": "sum"}`` adds up (or takes the ``"max"`` of) each column.

A version of the manifest counts once Spark has written its ``_SUCCESS``.  A
commit or merge that is killed before that leaves files which no manifest
lists: nothing changes.  A batch number that is committed already, or an input
file that the ledger holds, is not added again.  A table has one writer at a
time.  Readers plan on one version; retired data sets stay until
:meth:`KeyedTable.vacuum` finds them older than its grace.
"""

from __future__ import annotations

import time
import uuid
from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtally.sources.stream import list_names, modified, remove_path

RANGE, VERSION = "_range", "_version"
DELTAS = 8              # data sets of one range before it is merged
SPLITS = 8              # files of one range in one data set, at most
MANIFEST = T.StructType([
    T.StructField("kind", T.StringType()),      # live, retired, ledger, batch
    T.StructField("range", T.StringType()), T.StructField("path", T.StringType()),
    T.StructField("at", T.DoubleType())])       # live: version; retired: when; batch: its number


@dataclass
class KeyedTable:
    spark: SparkSession
    root: str
    schema: T.StructType
    keys: Sequence[str]
    range_of: Column | str              # an expression of key columns
    rule: str | Mapping[str, str] = "last"
    deltas: int = DELTAS
    splits: int = SPLITS

    # --- versions --------------------------------------------------------

    def version(self) -> int:
        """The newest complete version; 0 of a table without one."""
        numbers = sorted((int(n.split("=")[1]) for n in list_names(self.spark, f"{self.root}/manifest")
                          if n.startswith("v=")), reverse=True)
        return next((n for n in numbers if "_SUCCESS" in list_names(self.spark, self._manifest(n))), 0)

    def _manifest(self, version: int) -> str:
        return f"{self.root}/manifest/v={version}"

    def entries(self, version: int | None = None) -> list[T.Row]:
        """The manifest: a row for each range and data set, at most
        ``deltas + 1`` to a range beside the retired ones."""
        version = self.version() if version is None else version
        if not version:
            return []
        return self.spark.read.schema(MANIFEST).json(self._manifest(version)).collect()

    def _commit(self, version: int, entries: Sequence[tuple]) -> None:
        if "_SUCCESS" in list_names(self.spark, self._manifest(version)):
            raise RuntimeError(f"{self.root}: version {version} was committed by another writer")
        (self.spark.createDataFrame(list(entries), MANIFEST).coalesce(1)
         .write.mode("overwrite").json(self._manifest(version)))

    # --- reading ---------------------------------------------------------

    def _stored(self, paths: Sequence[str]) -> DataFrame:
        full = T.StructType([*self.schema.fields, T.StructField(VERSION, T.LongType())])
        if not paths:
            return self.spark.createDataFrame([], full)
        return self.spark.read.schema(full).parquet(*paths)

    def _resolved(self, rows: DataFrame) -> DataFrame:
        """One row per key, and the newest version it is made of."""
        values = [c for c in self.schema.names if c not in self.keys]
        newest = F.max(VERSION).alias(VERSION)
        if self.rule == "last":
            kept = F.max_by(F.struct(F.lit(0).alias("_"), *values), VERSION).alias("_kept")
            return rows.groupBy(*self.keys).agg(kept, newest).select(
                *[F.col(f"_kept.{c}").alias(c) if c in values else F.col(c) for c in self.schema.names], VERSION)
        made = {"sum": F.sum, "max": F.max}
        return rows.groupBy(*self.keys).agg(
            *[made[self.rule[c]](c).cast(self.schema[c].dataType).alias(c) for c in values], newest
        ).select(*self.schema.names, VERSION)

    def read(self, version: int | None = None) -> DataFrame:
        """The table's rows, one per key."""
        paths = [e.path for e in self.entries(version) if e.kind == "live"]
        return self._resolved(self._stored(paths)).select(*self.schema.names)

    # --- writing ---------------------------------------------------------

    def _write(self, rows: DataFrame) -> list[tuple[str, str]]:
        """(range, path) of a new data set of ``rows``."""
        path = f"{self.root}/data/{uuid.uuid4().hex}"
        range_of = F.expr(self.range_of) if isinstance(self.range_of, str) else self.range_of
        ranged = rows.withColumn(RANGE, F.coalesce(range_of.cast("string"), F.lit("none")))
        (ranged.repartition(RANGE, F.pmod(F.xxhash64(*self.keys), F.lit(self.splits)))
         .write.partitionBy(RANGE).parquet(path))
        return [(n, f"{path}/{n}") for n in list_names(self.spark, path) if n.startswith(f"{RANGE}=")]

    def add(self, rows: DataFrame, batch: int | None = None, ledger: DataFrame | None = None) -> bool:
        """Commit ``rows`` as a delta.  ``batch``: a number that rises from
        commit to commit; one that is committed already changes nothing and
        returns False.  ``ledger`` is kept with the commit (:meth:`ledger`).
        Ranges of too many data sets are merged right after."""
        version = self.version()
        entries = self.entries(version)
        if batch is not None and any(e.kind == "batch" and e.at >= batch for e in entries):
            return False
        new = [("live", r, p, float(version + 1)) for r, p in self._write(
            rows.select(*self.schema.names, F.lit(version + 1).cast("long").alias(VERSION)))]
        if ledger is not None:
            path = f"{self.root}/data/ledger-{uuid.uuid4().hex}"
            ledger.write.parquet(path)
            new.append(("ledger", None, path, float(version + 1)))
        if batch is not None:
            entries = [e for e in entries if e.kind != "batch"]
            new.append(("batch", None, None, float(batch)))
        self._commit(version + 1, [*map(tuple, entries), *new])
        self.merge()
        return True

    def merge(self, deltas: int | None = None) -> list[str]:
        """Merge the ranges of more than ``deltas`` data sets (the table's
        own number by default) into one each, and so many ledgers into one;
        returns the ranges."""
        deltas = self.deltas if deltas is None else deltas
        version = self.version()
        entries = self.entries(version)
        of_range = defaultdict(list)
        for e in entries:
            if e.kind == "live":
                of_range[e.range].append(e.path)
        full = {r: paths for r, paths in of_range.items() if len(paths) > deltas}
        ledgers = [e.path for e in entries if e.kind == "ledger"]
        ledgers = ledgers if len(ledgers) > deltas else []
        if not full and not ledgers:
            return []
        replaced = {p for paths in full.values() for p in paths}
        new = [("live", r, p, float(version + 1)) for r, p in self._write(
            self._resolved(self._stored(sorted(replaced))))] if full else []
        if ledgers:
            path = f"{self.root}/data/ledger-{uuid.uuid4().hex}"
            self.spark.read.parquet(*ledgers).write.parquet(path)
            new.append(("ledger", None, path, float(version + 1)))
        replaced.update(ledgers)
        now = time.time()
        self._commit(version + 1, [
            *[("retired", e.range, e.path, now) if e.path in replaced else tuple(e) for e in entries], *new])
        return sorted(full)

    def ledger(self, schema: T.StructType) -> DataFrame:
        """What was handed to :meth:`add` as ledger, of all commits."""
        paths = [e.path for e in self.entries() if e.kind == "ledger"]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def vacuum(self, grace: float = 7 * 24 * 3600) -> int:
        """Delete what was retired, or never committed, more than ``grace``
        seconds ago, and the manifests before; returns how many folders of
        data went."""
        version, before = self.version(), time.time() - grace
        entries = self.entries(version)
        old = [e.path for e in entries if e.kind == "retired" and e.at < before]
        kept = [tuple(e) for e in entries if e.path is None or e.path not in old]
        if old:
            self._commit(version + 1, kept)
        held = {p.removeprefix(f"{self.root}/data/").split("/")[0] for _, _, p, _ in kept if p}
        times = modified(self.spark, f"{self.root}/data")
        for path in old:
            remove_path(self.spark, path)
        orphans = [n for n, at in times.items() if n not in held and at < before]
        for name in orphans:
            remove_path(self.spark, f"{self.root}/data/{name}")
        for name, at in modified(self.spark, f"{self.root}/manifest").items():
            if int(name.split("=")[1]) < version and at < before:
                remove_path(self.spark, f"{self.root}/manifest/{name}")
        return len(old) + len(orphans)


def stored_table(spark: SparkSession, root: str, keys: Sequence[str]) -> KeyedTable:
    """A stored table of rule ``"last"`` for reading, its schema that of its
    data sets."""
    table = KeyedTable(spark, root, T.StructType([]), keys, "'none'")
    paths = [e.path for e in table.entries() if e.kind == "live"]
    if paths:
        table.schema = T.StructType([f for f in spark.read.parquet(paths[0]).schema.fields if f.name != VERSION])
    return table


def keyed_writer(table: KeyedTable, per_batch=None):
    """A ``foreachBatch`` function that merges each micro-batch by key; a
    batch replayed after a failure changes nothing.  A table belongs to one
    checkpoint, whose batch numbers it goes by."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        if not table.add(per_batch(batch_df) if per_batch is not None else batch_df, batch=batch_id):
            # Committed here, but not yet in the checkpoint: the batch's state still has to be stored.
            batch_df.write.format("noop").mode("overwrite").save()
    return write
