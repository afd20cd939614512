"""Landed JSON files: posts, weather and ticks, all with declared schemas."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ticktide.schemas import POST, TICK, WEATHER

CORRUPT = "_corrupt_record"


def _with_extra(schema: T.StructType, *fields: T.StructField) -> T.StructType:
    return T.StructType([*schema.fields, *fields])


def _read_text(spark: SparkSession, root: str, partitions: list[str] | None, whole: bool) -> DataFrame:
    text = T.StructType([T.StructField(name, T.StringType()) for name in ["value", *(partitions or [])]])
    read = spark.read.schema(text).text(root, wholetext=whole)
    return read.where(F.length(F.trim("value")) > 0)


def read_lines(spark: SparkSession, root: str, schema: T.StructType, partitions: list[str] | None = None) -> DataFrame:
    """One JSON record per line, blank lines skipped, unreadable records in ``_corrupt_record``.

    Parses text instead of using the JSON source: that source judges only the columns a query happens to
    read, so the same line could be good in one query and bad in the next.
    """
    kept = [*(partitions or []), "_metadata"]
    return _judged(_read_text(spark, root, partitions, whole=False), schema, kept)


def _judged(records: DataFrame, schema: T.StructType, kept: list[str]) -> DataFrame:
    record = _with_extra(schema, T.StructField(CORRUPT, T.StringType()))
    parsed = F.from_json("value", record, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return records.select(parsed.alias("record"), *kept).select("record.*", *kept)


def read_documents(spark: SparkSession, root: str, schema: T.StructType, partitions: list[str] | None = None) -> DataFrame:
    """One JSON array (or object) per file, spread over any number of lines.

    The array is cut into the texts of its records, and each record is judged by the same rule as a line. A file that
    is no array is one row with its text in ``_corrupt_record``. A file is one task's work and one string, so this
    suits the producer's hourly files; larger landings are written as lines.
    """
    kept = [*(partitions or []), "_metadata"]
    files = _read_text(spark, root, partitions, whole=True)
    pieces = F.from_json("value", "array<string>", {"mode": "PERMISSIVE"})
    records = files.select("*", "_metadata", F.explode(F.coalesce(pieces, F.array("value"))).alias("record_text"))
    return _judged(records.withColumn("value", F.col("record_text")), schema, kept)


def read_posts(spark: SparkSession, root: str, multi_line: bool = False, partitions: list[str] | None = None) -> DataFrame:
    """Posts, with unreadable records in ``_corrupt_record``.

    The producer writes pretty-printed arrays (``multi_line``). Line-delimited files split across tasks
    and should be preferred for large landings.
    """
    return (read_documents if multi_line else read_lines)(spark, root, POST, partitions)


def read_split_documents(spark: SparkSession, root: str, schema: T.StructType, partitions: list[str] | None = None) -> DataFrame:
    """As ``read_documents`` for arrays of any size: a file is read in byte ranges by many tasks.

    Spark cuts the bytes at closing braces. Whether a piece begins inside a string, and how deep in the array, follows from
    all pieces before it: quotes and brackets are summed up per range of a file, and only these sums, one row per range, are
    carried on. A record is what lies between two pieces that end at depth one. Records of an array must be objects. What is
    left behind the last whole record of a broken file is one row with its text in ``_corrupt_record``; the records before
    it are read.
    """
    parts = partitions or []
    text = T.StructType([T.StructField(name, T.StringType()) for name in ["value", *parts]])
    pieces = spark.read.schema(text).option("lineSep", "}").text(root).select(
        "value", *parts, F.col("_metadata").alias("_file"), F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_range"), F.monotonically_increasing_id().alias("_piece"))

    strings = r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+(?:"|$)'  # the last one may go on in the next piece
    rest_of_string = r'(?s)^[^"\\]*+(?:\\.[^"\\]*+)*+(?:"|$)'

    def size(value: Column, signs: str) -> Column:
        return F.length(value) - F.length(F.translate(value, signs, ""))

    def steps(value: Column) -> Column:
        bare = F.regexp_replace(value, strings, "")
        return size(bare, "[{") - size(bare, "]}")

    quotes = size(F.regexp_replace("value", r"(?s)\\.", ""), '"') % 2
    own = Window.partitionBy("_path", "_range").orderBy("_piece")
    upto, before = own.rowsBetween(Window.unboundedPreceding, 0), own.rowsBetween(Window.unboundedPreceding, -1)
    judged = pieces.withColumns({
        "_quotes": quotes, "_outside": steps(F.col("value")), "_inside": steps(F.regexp_replace("value", rest_of_string, ""))})
    judged = judged.withColumn("_opened", F.coalesce(F.sum("_quotes").over(before), F.lit(0)) % 2)

    def deeper(began: int | Column) -> Column:
        """Change of depth by a piece and its closing brace, if the range began inside a string (1) or not (0)."""
        inside = (F.col("_opened") + began) % 2
        closed = F.when((inside + F.col("_quotes")) % 2 == 0, 1).otherwise(0)
        return F.when(inside == 0, F.col("_outside")).otherwise(F.col("_inside")) - closed

    ranges = judged.groupBy("_path", "_range").agg(
        F.sum("_quotes").alias("_all_quotes"), F.sum(deeper(0)).alias("_plain"), F.sum(deeper(1)).alias("_quoted"))
    earlier = Window.partitionBy("_path").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    began = ranges.withColumn("_began", F.coalesce(F.sum("_all_quotes").over(earlier), F.lit(0)) % 2)
    change = F.when(F.col("_began") == 0, F.col("_plain")).otherwise(F.col("_quoted"))
    began = began.withColumn("_change", change).select(
        "_path", "_range", "_began", F.coalesce(F.sum("_change").over(earlier), F.lit(0)).alias("_depth"))

    placed = judged.join(began, ["_path", "_range"]).withColumn("_by", deeper(F.col("_began")))
    ended = ((F.col("_opened") + F.col("_began") + F.col("_quotes")) % 2 == 0) & (F.col("_at") == 1)
    placed = placed.withColumn("_at", F.col("_depth") + F.sum("_by").over(upto)).withColumn("_ends", ended.cast("int"))
    counted = placed.withColumn("_nth", F.coalesce(F.sum("_ends").over(before), F.lit(0)))
    ends = counted.groupBy("_path", "_range").agg(F.sum("_ends").alias("_all"))
    first = ends.select("_path", "_range", F.coalesce(F.sum("_all").over(earlier), F.lit(0)).alias("_first"))

    numbered = counted.join(first, ["_path", "_range"]).withColumn("_record", F.col("_first") + F.col("_nth"))
    kept = [*parts, "_metadata"]
    records = numbered.groupBy("_path", "_record", *parts).agg(
        F.array_sort(F.collect_list(F.struct("_range", "_piece", "value"))).alias("pieces"),
        F.max("_ends").alias("whole"), F.first("_file").alias("_metadata"))
    body = F.concat(F.array_join("pieces.value", "}"), F.when(F.col("whole") == 1, "}").otherwise(""))
    trimmed = F.regexp_replace(body, r"^[\s,\[]+", "")
    found = records.withColumn("value", F.when(F.col("whole") == 1, trimmed).otherwise(body))
    behind = (F.col("whole") == 0) & F.col("value").rlike(r"^\s*(\[\s*)?\]?\s*$")
    return _judged(found.where(~behind), schema, kept)


def read_split_posts(spark: SparkSession, root: str, partitions: list[str] | None = None) -> DataFrame:
    return read_split_documents(spark, root, POST, partitions)


def read_hourly_posts(
    spark: SparkSession, root: str, read: Callable[..., DataFrame] = read_lines
) -> DataFrame:
    """Posts that name the hour they were landed for, below one folder a day."""
    return read(spark, root, _with_extra(POST, T.StructField("hour", T.StringType())), ["day"])


def good_posts(posts: DataFrame, keyless: bool = False) -> DataFrame:
    """Readable posts. Producers that know no parts write none, so a missing part is the first. ``keyless`` adds records
    that name no post."""
    good = posts.where(F.col(CORRUPT).isNull() & (F.lit(keyless) | F.col("post_id").isNotNull())).drop(CORRUPT)
    return good.withColumn("part", F.coalesce("part", F.lit(0)))


def bad_records(rows: DataFrame) -> DataFrame:
    """Quarantine: records that could not be read, with the fields that could."""
    return rows.where(F.col(CORRUPT).isNotNull())


def read_weather(spark: SparkSession, root: str, multi_line: bool = False) -> DataFrame:
    """Weather of all hours below ``root`` (directories ``hour=yyyy-MM-dd-HH``) in one scan."""
    schema = _with_extra(WEATHER, T.StructField("hour", T.StringType()))
    return spark.read.schema(schema).option("multiLine", multi_line).json(root)


def read_weather_hour(spark: SparkSession, root: str, hour: str) -> DataFrame:
    """One hour's weather; only that hour's directory is listed and read."""
    schema = _with_extra(WEATHER, T.StructField("hour", T.StringType()))
    return spark.read.schema(schema).option("basePath", root).json(f"{root}/hour={hour}")


def read_inferred(spark: SparkSession, root: str, multi_line: bool = False, sampling: float = 1.0) -> DataFrame:
    """For exploring unknown files only: inference costs a pass over the data."""
    return spark.read.option("multiLine", multi_line).option("samplingRatio", sampling).json(root)


def read_ticks_ndjson(spark: SparkSession, root: str) -> DataFrame:
    """Tick lines of all files; blank lines are skipped, unreadable ones kept in ``_corrupt_record``.

    The time stamp stays text, as in the files. Every good line counts, also behind a bad one.
    """
    record = T.StructType([TICK["symbol"], TICK["price"], T.StructField("timestamp", T.StringType())])
    return read_lines(spark, root, record).drop("_metadata")


def good_ticks(lines: DataFrame) -> DataFrame:
    return lines.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def bad_ticks(lines: DataFrame) -> DataFrame:
    """Lines that are no JSON or hold a field of the wrong type, with the symbol where it could be read."""
    return bad_records(lines).select(F.col(CORRUPT).alias("line"), "symbol")


def file_audit(rows: DataFrame, *by: str) -> DataFrame:
    """One row per file that was read, or per file and value of ``by``: path, size, modification time and rows."""
    return rows.groupBy(
        *by,
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("modified"),
    ).agg(F.count(F.lit(1)).alias("rows"))


def leaf_fields(schema: T.DataType, path: str = "") -> list[tuple[str, str]]:
    """(path, type) of every leaf; array elements are written ``name[]``."""
    if isinstance(schema, T.StructType):
        return [
            leaf
            for field in schema.fields
            for leaf in leaf_fields(field.dataType, f"{path}.{field.name}" if path else field.name)
        ]
    if isinstance(schema, T.ArrayType):
        return leaf_fields(schema.elementType, f"{path}[]")
    return [(path, schema.simpleString())]


def schema_profile(rows: DataFrame) -> DataFrame:
    """Every leaf field with its type and how many non-null values it holds, from one aggregate."""

    def present(path: str):
        array, _, rest = path.partition("[].")
        if not rest:
            return F.count(F.col(path.removesuffix("[]")))
        values = F.filter(F.col(array), lambda item: item[rest].isNotNull())
        return F.coalesce(F.sum(F.size(values)), F.lit(0))

    leaves = leaf_fields(rows.schema)
    once = rows.agg(*[present(path).cast("bigint").alias(f"n{at}") for at, (path, _) in enumerate(leaves)])
    lines = [
        F.struct(F.lit(path).alias("path"), F.lit(kind).alias("type"), F.col(f"n{at}").alias("non_null"))
        for at, (path, kind) in enumerate(leaves)
    ]
    return once.select(F.inline(F.array(*lines)))
