"""Event-time expressions. The session time zone is UTC (see ``session.prepare``)."""

from pyspark.sql import Column, functions as F


def hour_start(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def hour_key(ts: Column) -> Column:
    """Hour as the partition value ``yyyy-MM-dd-HH``."""
    return F.date_format(ts, "yyyy-MM-dd-HH")


def epoch_seconds(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1e6)


def from_epoch(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")


def from_text(text: Column) -> Column:
    """Null instead of a failure on text that is no time stamp."""
    return F.try_to_timestamp(text).cast("timestamp_ntz")


def event_rank(ts: Column, tie: Column, other: Column) -> Column:
    """(time, tie) as one decimal. Rows without a tie-breaking id are ranked by the hash of ``other``, so rows that
    differ in it keep one order in every run.

    A fixed-width ordering value keeps ``max_by``/``min_by`` in the hash aggregate, where a struct
    would force a sort of the whole input.
    """
    micros = F.unix_micros(ts.cast("timestamp")).cast("decimal(19,0)")
    known = F.coalesce(tie.cast("bigint"), F.pmod(F.xxhash64(other), F.lit(10**18)))
    return (micros * F.lit(10**18).cast("decimal(19,0)") + known.cast("decimal(19,0)")).cast("decimal(38,0)")
