"""Landed hours that change at once, and can be read as they were.

Every landing of hours writes its rows below a version of its own and then, when all files are there, adds the version to
a manifest. An hour is what its newest version in the manifest holds, so a reader sees the old hour or the new one and
never a mixture, a writer that dies leaves nothing that counts, and a reader may ask for an earlier version. One job
writes at a time.

A landing of few hours has a folder for each below ``data``. One of many, as when a history is loaded, would be as many
tiny files; it is packed: files below ``packed`` hold runs of whole or split hours, with the hour as a column.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ticktide.operators.sides import small_table
from ticktide.sinks.files import BY_TASKS

MANIFEST = "version bigint, hour string, rows bigint, packed boolean"
FOLDERS = 1_000  # hours of one landing that have a folder each; more are packed
NO_HOUR = "__HIVE_DEFAULT_PARTITION__"


def _manifest(spark: SparkSession, root: str) -> DataFrame:
    """(version, hour, rows, packed) of all finished landings; no rows before the first."""
    try:
        found = spark.read.schema(MANIFEST).parquet(f"{root}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], MANIFEST)
    return found.withColumn("packed", F.coalesce("packed", F.lit(False)))  # older manifests know no packed landings


def newest_version(spark: SparkSession, root: str) -> int:
    return _manifest(spark, root).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def _path(root: str, version: int, packed: bool) -> str:
    return f"{root}/{'packed' if packed else 'data'}/version={version}"


def write_version(rows: DataFrame, root: str, version: int) -> bool:
    """Write a version's rows, which count only once published; whether they were packed."""
    packed = rows.select("hour").distinct().limit(FOLDERS + 1).count() > FOLDERS
    # overwrite: an unfinished landing may have left files under the same number
    writer = rows.hint("rebalance", "hour").write.mode("overwrite").options(**BY_TASKS)
    (writer if packed else writer.partitionBy("hour")).parquet(_path(root, version, packed))
    return packed


def land_hours(rows: DataFrame, root: str, hour: str = "hour") -> int:
    """Replace the hours that ``rows`` hold; returns the version that it made."""
    spark = rows.sparkSession
    version = newest_version(spark, root) + 1
    packed = write_version(rows.withColumnRenamed(hour, "hour").withColumn("hour", F.col("hour").cast("string")), root, version)
    publish(spark, root, version, packed)
    return version


def publish(spark: SparkSession, root: str, version: int, packed: bool = False) -> None:
    """Make a version count: one small file, which appears when it is whole."""
    landed = spark.read.schema("hour string").parquet(_path(root, version, packed))
    counted = landed.groupBy("hour").agg(F.count(F.lit(1)).alias("rows"))
    listed = counted.select(F.lit(version).cast("bigint").alias("version"), "hour", "rows", F.lit(packed).alias("packed"))
    listed.coalesce(1).write.mode("append").parquet(f"{root}/manifest")


def read_hours(spark: SparkSession, root: str, as_of: int | None = None) -> DataFrame:
    """All hours as they are now, or as they were after version ``as_of``, with the version that each came with.

    The manifest has one row per landed hour, and the newest ones name the folders to read; no other is listed. Of packed
    landings those are read that still hold a newest hour, and their rows meet the newest hours in a join.
    """
    known = _manifest(spark, root)
    if as_of is not None:
        known = known.where(F.col("version") <= as_of)
    newest = known.groupBy("hour").agg(F.max(F.struct("version", "packed")).alias("at")).select("hour", "at.*")

    def read(packed: bool, *folders: str) -> DataFrame:
        base = f"{root}/{'packed' if packed else 'data'}"
        rows = spark.read.option("basePath", base).option("mergeSchema", "true").parquet(*(folders or [base]))
        rows = rows.withColumns({"version": F.col("version").cast("bigint"), "hour": F.col("hour").cast("string")})
        return rows.select(*[name for name in rows.columns if name not in ("version", "hour")], "version", "hour")

    found = []
    named = newest.where(~F.col("packed")).orderBy("hour").collect()
    if named:
        hour_names = [NO_HOUR if row["hour"] is None else row["hour"] for row in named]
        found.append(read(False, *[f"{_path(root, row['version'], False)}/hour={hour}" for row, hour in zip(named, hour_names)]))
    versions = newest.where("packed").select("version").distinct().orderBy("version").collect()
    if versions:
        wanted = small_table(newest.where("packed").select(F.col("version").alias("_version"), F.col("hour").alias("_hour")))
        same = (F.col("version") == F.col("_version")) & F.col("hour").eqNullSafe(F.col("_hour"))
        rows = read(True, *[_path(root, row["version"], True) for row in versions])
        found.append(rows.join(wanted, same, "left_semi"))
    if not found:
        first = _manifest(spark, root).orderBy("version").first()  # none counts: no rows, with the columns of the landed ones
        found.append(read(first is not None and first["packed"]).limit(0))
    return found[0] if len(found) == 1 else found[0].unionByName(found[1], allowMissingColumns=True)
