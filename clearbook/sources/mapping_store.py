"""A mapping table in buckets, for mappings too large to shuffle for every lookup.

The pairs are dealt to a fixed number of files by the hash of the dirty value.
Spark knows that from the table's definition: a lookup or an append sends the
values that are looked up to the buckets, and the stored pairs stay where they
are. Appends add a file to each bucket that gets pairs. ``compact`` writes the
one pair of each value that counts into a new version of the table, one sorted
file for each bucket; readers see the old version until the new one is whole.

The files say all: a version's folder is named by its number and its number of
buckets, and a session that has not seen it yet defines its table anew.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearbook import schemas
from clearbook.operators.mapping import one_pair_each, only_new

BUCKETS = 64


class MappingStore:
    """The pairs of all domains under one path. One job at a time may compact it; appends may run side by side."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.new_buckets = spark, path.rstrip("/"), buckets

    def _versions(self) -> list[tuple[int, int]]:
        """(number, buckets) of the whole versions, oldest first; a version is whole once a job has ended in it."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        system = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        done = system.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/version-*/_SUCCESS"))
        names = [status.getPath().getParent().getName() for status in done or []]
        return sorted(tuple(map(int, re.findall(r"\d+", name))) for name in names)

    def _table(self, version: int, buckets: int) -> str:
        """The name of a version's table, which is defined if the session does not know it."""
        folder = f"{self.path}/version-{version}-buckets-{buckets}"
        name = f"mapping_{hashlib.sha256(folder.encode()).hexdigest()[:24]}"
        if self.spark.catalog.tableExists(name):
            self.spark.catalog.refreshTable(name)  # another session may have added files
        else:
            self.spark.sql(
                f"CREATE TABLE {name} ({schemas.MAPPING}) USING parquet CLUSTERED BY (dirty) SORTED BY (dirty) "
                f"INTO {buckets} BUCKETS LOCATION '{folder}'"
            )
        return name

    def read(self, domain: str | None = None) -> DataFrame:
        """(domain, dirty, clean): one pair for each value, the one stored first; no rows before the first append."""
        versions = self._versions()
        if not versions:
            return self.spark.createDataFrame([], schemas.MAPPING).drop("stored_at")
        return self._first_pairs(self._table(*versions[-1]), domain).drop("stored_at")

    def _first_pairs(self, table: str, domain: str | None) -> DataFrame:
        pairs = self.spark.table(table)
        pairs = pairs if domain is None else pairs.where(F.col("domain") == domain)
        first = F.min(F.struct("stored_at", "clean"))
        return pairs.groupBy("domain", "dirty").agg(first.alias("first")).select("domain", "dirty", "first.clean", "first.stored_at")

    def _write(self, pairs: DataFrame, table: str, buckets: int) -> None:
        dealt = pairs.select("domain", "dirty", "clean", "stored_at").repartition(buckets, "dirty")
        dealt.sortWithinPartitions("dirty").write.insertInto(table)

    def append(self, new: DataFrame, domain: str) -> None:
        """Store the (dirty, clean) pairs whose value has none in ``domain`` yet, one for each; stored pairs always win."""
        version, buckets = (self._versions() or [(0, self.new_buckets)])[-1]
        fresh = one_pair_each(only_new(new, self.read(domain)))
        dated = fresh.select(F.lit(domain).alias("domain"), "dirty", "clean", F.current_timestamp().alias("stored_at"))
        self._write(dated, self._table(version, buckets), buckets)

    def compact(self, buckets: int | None = None) -> None:
        """Keep the pair that counts of each value, one file for each bucket; the number of buckets may change."""
        versions = self._versions()
        if versions:
            number, before = versions[-1]
            target = buckets or before
            self._write(self._first_pairs(self._table(number, before), None), self._table(number + 1, target), target)
