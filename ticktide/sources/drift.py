"""JSON lines whose fields and types differ from file to file, read as variants.

Each file's fields are profiled with the types they really have; the types of a field widen to one that holds them all,
and rows are read with the widened types. Nothing is declared, and no file decides for the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# How a field's types widen: whole numbers go into doubles, everything else that is mixed into text.
WHOLE, REAL, TEXT, NOTHING = "bigint", "double", "string", "void"


def read_variants(spark: SparkSession, root: str, partition: str) -> DataFrame:
    """Lines as variants (``record``) with the folder that they lie in; lines that are no JSON are nulls."""
    lines = spark.read.schema(f"value string, {partition} string").text(root)
    return lines.where(F.length(F.trim("value")) > 0).select(partition, F.try_parse_json("value").alias("record"))


def _kind(found: Column) -> Column:
    """The name of a variant's type, without the precision of decimals and the inside of objects and arrays."""
    name = F.lower(F.regexp_extract(found, "^[A-Za-z]+", 0))
    return F.when(name.isin("decimal", "float", "double"), REAL).otherwise(name)


def field_types(variants: DataFrame, partition: str) -> DataFrame:
    """(partition, field, type, rows): the types that each top-level field has in each folder."""
    found = variants.sparkSession.sql(
        f"SELECT {partition}, key AS field, schema_of_variant(value) AS found FROM {{variants}}, LATERAL variant_explode(record)",
        variants=variants.where("schema_of_variant(record) LIKE 'OBJECT%'"))
    return found.groupBy(partition, "field", _kind(F.col("found")).alias("type")).agg(F.count(F.lit(1)).alias("rows"))


def drift_report(types: DataFrame, partition: str) -> DataFrame:
    """Per field: its types, the type that holds them all, in how many folders and rows it occurs, and whether it drifts.

    A field drifts if its types differ or if folders lack it. The report has one row per field.
    """
    folders = types.agg(F.count_distinct(partition)).first()[0]
    kinds = F.array_sort(F.collect_set(F.when(F.col("type") != NOTHING, F.col("type")))).alias("kinds")
    fields = types.groupBy("field").agg(
        kinds, F.count_distinct(partition).alias("folders"), F.sum("rows").alias("rows"))
    some = F.size("kinds")
    numbers = F.forall("kinds", lambda kind: kind.isin(WHOLE, REAL))
    simple = ~F.exists("kinds", lambda kind: kind.isin("object", "array"))
    widened = F.when(some == 0, TEXT).when((some == 1) & simple, F.col("kinds")[0]).when(numbers, REAL).otherwise(TEXT)
    return fields.select(
        "field", F.array_join("kinds", ",").alias("types"), widened.alias("widened"), "folders", "rows",
        ((some > 1) | (F.col("folders") < folders)).alias("drifts"))


def read_widened(variants: DataFrame, report: DataFrame, *keep: str) -> DataFrame:
    """The records with one column per field of the report, in its widened type; values a row lacks are null.

    Objects and arrays become their JSON text. A record has a bounded number of fields, so the report fits the driver.
    """
    fields = [(row["field"], row["widened"]) for row in report.orderBy("field").collect()]
    members = variants.where(F.col("record").isNotNull()).select(
        *keep, F.try_variant_get("record", "$", "map<string, variant>").alias("_members"))  # names may hold any sign
    values = [F.try_variant_get(F.col("_members")[name], "$", kind).alias(name) for name, kind in fields]
    return members.select(*keep, *values)
