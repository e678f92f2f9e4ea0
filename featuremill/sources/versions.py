"""Feature tables in versions: bucketed by the entity key, switched as a whole.

A refresh writes every table of a version into a folder of its own, bucketed and sorted by the
entity key into the same number of buckets, so joins on the key need no shuffle: the shuffle
is paid once, when a table is written, and not by each of its readers. The version becomes the
current one when its manifest, one small file that lists its tables, is put in place; before
that nobody sees it. Folders are never written twice, so a reader that has asked for the
current version goes on reading that one, whole, while the next is written and switched to. A
refresh that fails leaves the version before it in place. Versions that nobody reads any more
are the folder owner's to delete.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from hashlib import md5

from pyspark.sql import DataFrame, SparkSession

from featuremill.operators.search import read_if_written

MANIFEST = "number long, version string, key string, buckets int, tables string"


@dataclass(frozen=True)
class Version:
    """One committed version: its number, folder name, key, buckets and tables' schemas (JSON)."""
    number: int
    version: str
    key: str
    buckets: int
    tables: dict


@dataclass(frozen=True)
class VersionedTables:
    """The versions under ``base``, a folder that all executors see."""
    base: str

    def _name(self, version: str, table: str) -> str:
        """The catalog's name of a version's table: the same in every session."""
        return f"v_{md5(self.base.encode()).hexdigest()[:12]}_{version}_{table}"

    def _path(self, version: str, table: str) -> str:
        return f"{self.base}/tables/{version}/{table}"

    def current(self, spark: SparkSession) -> Version | None:
        """The version of the newest manifest, or None before the first."""
        found = read_if_written(spark, f"{self.base}/manifest")
        row = None if found is None else found.orderBy("number", "version", ascending=False).first()
        return row and Version(row.number, row.version, row.key, row.buckets, json.loads(row.tables))

    def write(self, tables: dict[str, DataFrame], key: str, buckets: int) -> Version:
        """Writes a version's tables, without switching to it. One file a bucket: the rows are dealt out
        by the hash that the buckets use."""
        spark = next(iter(tables.values())).sparkSession
        before = self.current(spark)
        number = 1 if before is None else before.number + 1
        version = f"{number:06d}_{uuid.uuid4().hex[:8]}"
        for name, df in tables.items():
            if not re.fullmatch(r"\w+", name):
                raise ValueError(f"table name {name!r}")
            (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
             .option("path", self._path(version, name)).saveAsTable(self._name(version, name)))
        return Version(number, version, key, buckets, {n: df.schema.jsonValue() for n, df in tables.items()})

    def switch(self, spark: SparkSession, to: Version) -> None:
        """Makes a written version the current one, in one step: its manifest file appears."""
        row = (to.number, to.version, to.key, to.buckets, json.dumps(to.tables))
        (spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append")
         .parquet(f"{self.base}/manifest"))

    def refresh(self, tables: dict[str, DataFrame], key: str, buckets: int) -> Version:
        spark = next(iter(tables.values())).sparkSession
        new = self.write(tables, key, buckets)
        self.switch(spark, new)
        return new

    def open(self, spark: SparkSession, version: Version | None = None) -> Callable[[str], DataFrame]:
        """``open(spark)(name)`` reads a table of one version (default: the current one, asked for once)."""
        at = version or self.current(spark)
        if at is None:
            raise FileNotFoundError(f"no version under {self.base}")

        def table(name: str) -> DataFrame:
            own = self._name(at.version, name)
            if not spark.catalog.tableExists(own):  # written by another session
                from pyspark.sql.types import StructType
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                                    for f in StructType.fromJson(at.tables[name]).fields)
                spark.sql(f"CREATE TABLE IF NOT EXISTS `{own}` ({columns}) USING parquet CLUSTERED BY (`{at.key}`) "
                          f"SORTED BY (`{at.key}`) INTO {at.buckets} BUCKETS LOCATION '{self._path(at.version, name)}'")
            return spark.table(own)

        return table
