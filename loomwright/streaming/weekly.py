"""Weekly counts as a stream: event-time weeks from Monday, with a watermark for late rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.operators.ranking import top_per_key


def weekly_counts(events: DataFrame, ts: str = "ts", key: str = "event_type", late: str = "14 days") -> DataFrame:
    """(week, key, n) of a stream or a table; a stream keeps a week open until its rows can't be late any more."""
    rows = events.withColumn(ts, F.col(ts).cast("timestamp"))
    if events.isStreaming:
        rows = rows.withWatermark(ts, late)
    weeks = rows.groupBy(F.window(ts, "7 days", "7 days", "4 days").alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
    return weeks.select(F.to_date("w.start").alias("week"), key, "n")


def first_sightings(events: DataFrame, key: str, ts: str, late: str = "14 days") -> DataFrame:
    """Rows of a stream whose key hasn't been seen within the watermark; of a table, the first row of each key by time, then by its other columns."""
    rows = events.withColumn(ts, F.col(ts).cast("timestamp"))
    if events.isStreaming:
        return rows.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])
    return top_per_key(rows, [key], [F.col(ts), *[F.col(c) for c in rows.columns if c not in (key, ts)]])
