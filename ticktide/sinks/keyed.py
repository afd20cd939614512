"""A keyed table of versions, bucketed by its keys, so that neither reading nor joining it shuffles.

Every write appends a run: one row per key, or a tombstone, in the bucket of its key. Readers take the newest row per key
inside each bucket. Compaction folds all runs into the next generation, with one row per living key, and so bounds what a
reader has to fold: after ``max_runs`` runs a write compacts by itself. A generation counts from the moment its table is
marked complete; a compaction that dies before leaves the old one as it was. The generation before the newest stays for
those who still read it. One job writes at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

VERSION, DELETED = "_version", "_deleted"


@dataclass
class KeyedTable:
    """``database`` is created at ``location`` if it does not exist; each keyed table has a name in it."""

    spark: SparkSession
    database: str
    name: str
    keys: list[str]
    location: str
    buckets: int = 32
    max_runs: int = 8

    def __post_init__(self) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{self.location}'")

    def write(self, rows: DataFrame, version: int) -> None:
        """Insert or replace rows by key. Of rows with one key in one run any one counts."""
        self._append(rows.withColumns({VERSION: F.lit(version).cast("bigint"), DELETED: F.lit(False)}))

    def delete(self, keys: DataFrame, version: int) -> None:
        """Tombstones for the keys; a key that is written again later lives again."""
        marked = keys.select(*self.keys).withColumns({VERSION: F.lit(version).cast("bigint"), DELETED: F.lit(True)})
        current = self._current()
        if current is not None:
            columns = [field for field in self.spark.table(current).schema if field.name not in marked.columns]
            self._append(marked.withColumns({field.name: F.lit(None).cast(field.dataType) for field in columns}))

    def read(self) -> DataFrame:
        """The newest row of every living key."""
        return self._newest(self._known()).where(~F.col(DELETED)).drop(VERSION, DELETED)

    def versions(self) -> DataFrame:
        """As ``read``, with the version that wrote each row."""
        return self._newest(self._known()).where(~F.col(DELETED)).drop(DELETED).withColumnRenamed(VERSION, "version")

    def compact(self) -> None:
        """Fold all runs into the next generation, without tombstones, and drop the one before the current."""
        current = self._known()
        number = self._number(current)
        following = self._table(number + 1)
        self.spark.sql(f"DROP TABLE IF EXISTS {following}")  # left by a compaction that did not finish
        self._save(self._newest(current).where(~F.col(DELETED)), following)
        self._mark(following, 1)
        if number:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(number - 1)}")

    def runs(self) -> int:
        return int(self._properties(self._known())["runs"])

    def _append(self, rows: DataFrame) -> None:
        current = self._current()
        if current is None:
            current, runs = self._table(0), 0
            self.spark.sql(f"DROP TABLE IF EXISTS {current}")
            self._save(rows, current)
        else:
            runs = self.runs()
            self._save(rows.select(*self.spark.table(current).columns), current, "append")
        self._mark(current, runs + 1)
        if runs + 1 > self.max_runs:
            self.compact()

    def _save(self, rows: DataFrame, table: str, mode: str = "errorifexists") -> None:
        """One file per bucket: the tasks are the buckets."""
        once = rows.repartition(self.buckets, *self.keys).dropDuplicates(self.keys)
        once.write.mode(mode).format("parquet").bucketBy(self.buckets, *self.keys).sortBy(*self.keys).saveAsTable(table)

    def _newest(self, table: str) -> DataFrame:
        latest = Window.partitionBy(*self.keys).orderBy(F.desc(VERSION))
        ranked = self.spark.table(table).withColumn("_place", F.row_number().over(latest))
        return ranked.where(F.col("_place") == 1).drop("_place")

    def _table(self, number: int) -> str:
        return f"{self.database}.{self.name}_g{number}"

    def _number(self, table: str) -> int:
        return int(table.rsplit("_g", 1)[1])

    def _properties(self, table: str) -> dict[str, str]:
        return {row["key"]: row["value"] for row in self.spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}

    def _mark(self, table: str, runs: int) -> None:
        self.spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('complete' = 'true', 'runs' = '{runs}')")

    def _current(self) -> str | None:
        """The newest complete generation."""
        shown = self.spark.sql(f"SHOW TABLES IN {self.database} LIKE '{self.name}_g*'").collect()
        tables = sorted((f"{self.database}.{row['tableName']}" for row in shown), key=self._number, reverse=True)
        return next((table for table in tables if self._properties(table).get("complete") == "true"), None)

    def _known(self) -> str:
        current = self._current()
        if current is None:
            raise LookupError(f"{self.database}.{self.name} has no rows yet")
        return current
