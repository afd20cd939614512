"""Wiring of the streaming jobs. Every query has a checkpoint; every per-batch write is keyed by batch id."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ticktide.functions.times import hour_key, hour_start
from ticktide.models.learners import LinearLearner, NetworkLearner, train, train_minibatches
from ticktide.models.state import load, to_frame
from ticktide.operators.enrich import asof_hour_join, complete
from ticktide.operators.ordered import ROWS_PER_SEGMENT
from ticktide.operators.results import typed_results
from ticktide.operators.ticks import lag_features, parse_ticks, split_symbol, tumbling_avg
from ticktide.schemas import FEATURE_COLUMNS
from ticktide.sinks.files import batch_path, overwrite_batch_results, write_batch

CARRIED_TICKS = 2
ARRIVAL_ORDER = ["arrival", "event_time", "event_id", "price"]


def start(writer: DataStreamWriter, drain: bool = False) -> StreamingQuery:
    """Start a query: endless by default, or until what is there now has been processed."""
    if not drain:
        return writer.start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def skip_to_latest(messages: DataFrame, checkpoint: str) -> bool:
    """Start a new stream at its source's latest message, whatever the source: what is there now is marked as read.

    It does so only for a checkpoint that has no offsets yet, so a restart goes on where the stream stopped; returns
    whether it did. The batch that passes the old messages never reads them. For queries that keep no state of their own
    in the checkpoint, such as those that work per batch.
    """
    spark = messages.sparkSession
    try:
        if spark.read.text(f"{checkpoint}/offsets").limit(1).count():
            return False
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    start(messages.writeStream.foreachBatch(lambda rows, batch_id: None).option("checkpointLocation", checkpoint), drain=True)
    return True


def parsed_stream(messages: DataFrame) -> DataFrame:
    """Ticks of a message stream with base and quote; the message key, a number, breaks ties in time."""
    keyed = messages.withColumn("event_id", F.col("key").cast("string").try_cast("bigint"))
    return split_symbol(parse_ticks(keyed, keep=["event_id"]))


def archive(ticks: DataFrame, path: str, checkpoint: str, name: str = "ticks") -> DataStreamWriter:
    """Append parsed ticks to Parquet, partitioned by day."""
    return (
        ticks.withColumn("day", F.to_date("event_time"))
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("day")
        .queryName(name)
        .outputMode("append")
    )


def batches(ticks: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Every batch as it is, in a folder of its own."""
    return _per_batch(ticks, checkpoint, lambda rows, batch_id: write_batch(rows, path, batch_id)).outputMode("append")


def land_stream(records: DataFrame, at: str, path: str, checkpoint: str) -> DataStreamWriter:
    """Land arriving records as JSON below their event-time hour. With ``start(..., drain=True)`` it is the
    hourly job: it takes what has arrived since the last run and stops."""
    return (
        records.withColumn("hour", hour_key(F.col(at)))
        .writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("hour")
        .outputMode("append")
    )


def averages_to_console(ticks: DataFrame, checkpoint: str, width: str = "1 minute") -> DataStreamWriter:
    """Print the running averages; complete mode, for small windows of history only."""
    return (
        tumbling_avg(ticks, width)
        .writeStream.format("console")
        .option("checkpointLocation", checkpoint)
        .outputMode("complete")
    )


def averages_complete(ticks: DataFrame, path: str, checkpoint: str, width: str = "1 minute") -> DataStreamWriter:
    """All windows so far, anew with every batch; complete mode, for small windows of history only."""
    return _per_batch(
        tumbling_avg(ticks, width), checkpoint, lambda rows, batch_id: write_batch(rows, path, batch_id)).outputMode("complete")


def average_versions(
    ticks: DataFrame, path: str, checkpoint: str, watermark: str, width: str = "1 minute"
) -> DataStreamWriter:
    """Write every changed average with its batch id as version; readers take the newest per window.

    ``watermark`` has no default: ticks that are later than it are left out of their window, so whoever starts the
    stream must say how late ticks may be. Spark counts them as ``numRowsDroppedByWatermark`` in the query's progress.
    Update mode sends only what changed, where complete mode would rewrite all windows every time.
    """
    return _per_batch(
        tumbling_avg(ticks, width, watermark), checkpoint, lambda rows, batch_id: write_batch(rows, path, batch_id)
    ).outputMode("update")


def _per_batch(rows: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    return rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)


def usable(ticks: DataFrame) -> DataFrame:
    """Ticks that parsed: the others have no place in an order."""
    return ticks.where(F.col("symbol").isNotNull() & F.col("event_time").isNotNull() & F.col("price").isNotNull())


@dataclass
class CarriedPrices:
    """Last ticks per symbol across batches, as a table of at most two rows per symbol.

    Batch n reads what batch n-1 left and writes its own version, so a replayed batch starts from the
    same state. Only a few versions are kept: version n takes the folder of version n-4.
    """

    root: str
    versions: int = 4

    def path(self, batch_id: int) -> str:
        return f"{self.root}/version={batch_id % self.versions}"

    def with_state(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The batch's ticks behind the carried ones, in order of arrival."""
        new = batch.select("event_id", "symbol", "event_time", "price").withColumn("arrival", F.lit(0))
        if batch_id == 0:
            return new
        return new.unionByName(batch.sparkSession.read.parquet(self.path(batch_id - 1)))

    def save(self, ticks: DataFrame, batch_id: int) -> None:
        newest_first = Window.partitionBy("symbol").orderBy(*[F.col(name).desc() for name in ARRIVAL_ORDER])
        (
            ticks.withColumn("back", F.row_number().over(newest_first))
            .where(F.col("back") <= CARRIED_TICKS)
            .withColumn("arrival", -F.col("back"))
            .drop("back")
            .write.mode("overwrite")
            .parquet(self.path(batch_id))
        )

    def features(self, ticks: DataFrame, rows_per_segment: int = ROWS_PER_SEGMENT) -> DataFrame:
        """Lag features of the new ticks, plus ``previous_price``: the symbol's last price before the batch."""
        lags = lag_features(ticks, ARRIVAL_ORDER, rows_per_segment)
        before = (
            ticks.where(F.col("arrival") == -1).select("symbol", F.col("price").alias("previous_price"))
        )
        return lags.where(F.col("arrival") == 0).drop("arrival").join(before, "symbol", "left")


def lag_stream(
    ticks: DataFrame, path: str, state: str, checkpoint: str, rows_per_segment: int = ROWS_PER_SEGMENT
) -> DataStreamWriter:
    """Lag features across batches, per symbol, kept through restarts."""
    carried = CarriedPrices(state)

    def handle(batch: DataFrame, batch_id: int) -> None:
        known = carried.with_state(usable(batch), batch_id).persist()
        try:
            write_batch(carried.features(known, rows_per_segment), path, batch_id)
            carried.save(known, batch_id)
        finally:
            known.unpersist()

    return _per_batch(ticks, checkpoint, handle).outputMode("append")


Context = Callable[[], tuple[DataFrame, DataFrame]]


def enrich_stream(ticks: DataFrame, context: Context, path: str, checkpoint: str) -> DataStreamWriter:
    """Ticks with the context of their hour. ``context`` opens the weather and sentiment tables anew for each
    batch, so an hour that lands late is seen by the next batch."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        timed = batch.where(F.col("event_time").isNotNull()).persist()  # read for its hours and for its rows
        try:
            write_batch(asof_hour_join(timed, *context()), path, batch_id)
        finally:
            timed.unpersist()

    return _per_batch(ticks, checkpoint, handle).outputMode("append")


def prequential_stream(
    ticks: DataFrame,
    context: Context,
    learner: LinearLearner | NetworkLearner,
    root: str,
    checkpoint: str,
    table: str | None = None,
    rows_per_step: int | None = None,
) -> DataStreamWriter:
    """Test-then-train per batch: predict with the model so far, score, take one step, store one result row.

    With ``rows_per_step`` a batch is trained on in several steps of about so many rows.

    Below ``root``: ``prices`` (carried ticks), ``models`` (one version per batch) and, unless ``table`` names the
    results table, ``results``. Each is keyed by batch id and read from the version before, so a replay changes nothing.
    """
    carried = CarriedPrices(f"{root}/prices")

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = carried.with_state(usable(batch), batch_id).persist()
        lags = carried.features(known).withColumn("hour", hour_start(F.col("event_time")))
        enriched = asof_hour_join(lags, *context(), known.select(hour_start(F.col("event_time")).alias("hour")).distinct())
        rows = complete(enriched.withColumn("y", F.col("price") - F.col("previous_price")))
        rows = rows.select("event_id", "event_time", *FEATURE_COLUMNS, "y").persist()

        state = None
        if batch_id > 0:
            state = load(spark.read.parquet(batch_path(f"{root}/models", batch_id - 1)), learner.name)
        fitted = state is not None and state.fitted
        state = state or learner.start()
        if fitted:
            first = learner.predict(rows.orderBy("event_time", "event_id").limit(1), state)
            first = first.withColumn("time_stamp", F.unix_micros(F.col("event_time").cast("timestamp")) / F.lit(1e6))
        if rows_per_step:
            state, gradient = train_minibatches(rows, learner, state, rows_per_step)
        else:
            state, gradient = train(rows, learner, state)
        state.version = batch_id
        if fitted and gradient is not None:
            scored = first.withColumns({
                "mse": F.bround(F.lit(float(gradient.squared_error)), 0),
                "mse_exact": F.lit(float(gradient.squared_error)),
            })
            if table:
                overwrite_batch_results(typed_results(scored), table, batch_id)
            else:
                write_batch(typed_results(scored), f"{root}/results", batch_id)
        write_batch(to_frame(spark, [state]), f"{root}/models", batch_id)
        carried.save(known, batch_id)
        rows.unpersist()
        known.unpersist()

    return _per_batch(ticks, checkpoint, handle).outputMode("append")
