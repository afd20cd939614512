"""Message streams: rows with a binary ``value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ticktide.schemas import MESSAGE

FILE_FORMATS = ("parquet", "json", "orc", "text")


def read_messages(spark: SparkSession, source: str = "kafka", **options: str) -> DataFrame:
    """Open a message stream.

    ``source`` is any streaming format. For a broker pass its options with ``__`` for dots::

        read_messages(spark, "kafka", kafka__bootstrap__servers="host:9092", subscribe="ticks",
                      startingOffsets="latest", maxOffsetsPerTrigger="5000000")

    For files pass ``path`` and, for admission control, ``maxFilesPerTrigger``.
    """
    named = {key.replace("__", "."): value for key, value in options.items()}
    reader = spark.readStream.format(source)
    if source == "kafka":
        named.setdefault("startingOffsets", "latest")
    elif source in FILE_FORMATS:
        reader = reader.schema(MESSAGE)
    path = named.pop("path", None)
    return reader.options(**named).load(path) if path else reader.options(**named).load()
