"""Destination records at rest: whole ones as shredded VARIANT, and typed ones laid out by the key on which reports meet them.

Whole records are Parquet whose VARIANT cells Spark shreds into typed leaves as it writes, so a reader of four cells reads
these leaves and not the records.

A layout holds, for one strategy, the last record of each key in a table bucketed by that key, and all other records beside it.
Only the first is ever joined with a report, and it has one row per key, so a key that very many records share fills no bucket.
The join needs no shuffle of records, and records that are not the last of their key are read without any join. Changed
records are merged in: only keys that lost their last record are elected anew.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftledger.operators.reconcile import Layout, key_columns, matchable
from shiftledger.sources.tables import SNAPSHOT, Tables, ddl, stage

#: Buckets of a new layout; a layout keeps its number.
BUCKETS = 256
_MANIFEST = "version STRING, buckets INT"


def store_records(records: DataFrame, path: str) -> DataFrame:
    """Write records (id, pos, fields) with their cells shredded, and read them back."""
    records.write.parquet(path)
    return records.sparkSession.read.schema(records.schema).parquet(path)


class RecordStore:
    """Layouts of one strategy's typed cells (``reconcile.destination_cells``) under the folder of ``tables``.

    A version is written beside the one it builds on and counts once its manifest is there. Of two writers on one state the second
    fails with ``PublishConflict``. Cells have unique ids.
    """

    def __init__(self, tables: Tables, strategy: str) -> None:
        self.tables, self.spark, self.strategy = tables, tables.spark, strategy
        self.keys = key_columns(strategy)
        self.root = f"{tables.root}/records_{strategy.lower()}"

    def read(self) -> Layout | None:
        """The newest layout; None before the first."""
        number, version, buckets = self._held()
        return None if number < 0 else self._layout(version, buckets)

    def replace(self, cells: DataFrame, buckets: int = BUCKETS) -> Layout:
        """Lay out a complete delivery."""
        number, _, _ = self._held()
        version = uuid4().hex
        with self.tables.claim("records_" + self.strategy.lower(), number + 1):
            current = last_of_key(cells, self.strategy).repartition(buckets, *self.keys)
            self._write_current(current, version, buckets)
            last = self._current(version, buckets).select("id")
            cells.join(last, "id", "left_anti").write.parquet(f"{self.root}/rest/{version}")
            self._publish(number + 1, version, buckets)
        return self._layout(version, buckets)

    def refresh(self, changed: DataFrame, gone: DataFrame | None = None, run: str = "refresh") -> Layout:
        """Take up cells that are new or have changed, and ids (``id``) of records that are gone.

        An id that is both counts as changed; ids nobody holds are passed over.
        """
        number, old, buckets = self._held()
        if number < 0:
            return self.replace(changed)
        held, keys, version = self._layout(old, buckets), self.keys, uuid4().hex
        changed = stage(self.spark, changed.select(held.rest.columns), "changed_records", run)
        touched = changed.select("id") if gone is None else changed.select("id").unionByName(gone.select("id"))
        touched = stage(self.spark, touched.distinct(), "touched_records", run)

        kept = held.current.join(touched, "id", "left_anti")
        rest = held.rest.join(touched, "id", "left_anti")
        # Written, so that Spark knows how few keys these are: records of one key may be many.
        orphaned = held.current.join(touched, "id", "left_semi").select(*keys)
        orphaned = stage(self.spark, orphaned, "orphaned_keys", run)
        heirs = rest.join(orphaned, keys, "left_semi").select(changed.columns)
        elected = last_of_key(changed.unionByName(heirs), self.strategy)
        rivals = elected.select(*keys, self._whole(elected).alias("_new")).join(
            kept.select(*keys, self._whole(kept).alias("_old")), keys, "left"
        )
        won = F.col("_old").isNull() | (F.struct("_new.pos", "_new.id") > F.struct("_old.pos", "_old.id"))
        winners = stage(self.spark, rivals.where(won), "elected_records", run)

        with self.tables.claim("records_" + self.strategy.lower(), number + 1):
            # Both sides lie in the layout's buckets, so each task writes one.
            joined = kept.select(*keys, self._whole(kept).alias("_kept")).join(winners.select(*keys, "_new"), keys, "full")
            now = joined.select(*keys, F.coalesce("_new", "_kept").alias("_r")).select(*keys, "_r.*")
            self._write_current(now, version, buckets)
            overtaken = winners.where(F.col("_old").isNotNull()).select(*keys, "_old.*")
            others = rest.unionByName(changed).join(winners.select("_new.id"), "id", "left_anti")
            others.unionByName(overtaken).write.parquet(f"{self.root}/rest/{version}")
            self._publish(number + 1, version, buckets)
        return self._layout(version, buckets)

    def _whole(self, df: DataFrame) -> Column:
        return F.struct(*[c for c in df.columns if c not in self.keys])

    def _held(self) -> tuple[int, str, int]:
        found = self.tables.newest(self.root)
        if found is None:
            return -1, "", 0
        row = self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/{SNAPSHOT}={found}").first()
        return int(found), row["version"], row["buckets"]

    def _publish(self, number: int, version: str, buckets: int) -> None:
        manifest = self.spark.createDataFrame([(version, buckets)], _MANIFEST)
        manifest.coalesce(1).write.parquet(f"{self.root}/{SNAPSHOT}={number:012d}")

    def _write_current(self, df: DataFrame, version: str, buckets: int) -> None:
        writer = df.write.bucketBy(buckets, *self.keys).sortBy(*self.keys)
        writer.option("path", f"{self.root}/current/{version}").saveAsTable(f"records_{version}")

    def _current(self, version: str, buckets: int) -> DataFrame:
        """Buckets are known to the catalogue only, so a session that did not write the table declares it."""
        name, path = f"records_{version}", f"{self.root}/current/{version}"
        if not self.spark.catalog.tableExists(name):
            columns, keys = ddl(self.spark.read.parquet(path).schema), ", ".join(self.keys)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
                f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{path}'"
            )
        return self.spark.table(name)

    def _layout(self, version: str, buckets: int) -> Layout:
        current = self._current(version, buckets)
        return Layout(current, self.spark.read.schema(current.schema).parquet(f"{self.root}/rest/{version}"))


def last_of_key(cells: DataFrame, strategy: str) -> DataFrame:
    """The last record of each key, whole; reduced before the shuffle."""
    keys = key_columns(strategy)
    values = [c for c in cells.columns if c not in keys]
    last = F.max_by(F.struct(*values), F.struct("pos", "id")).alias("_last")
    return matchable(cells, strategy).groupBy(*keys).agg(last).select(*keys, "_last.*")
