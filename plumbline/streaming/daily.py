"""Extension: daily users over a stream of sessions. The studied queries are batch only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.schema import STATUS_SUBMITTED


def daily_sessions(sessions: DataFrame, late: str = "2 days") -> DataFrame:
    """Sessions and submitted sessions per day of their start, from a stream or a table.

    A session's row counts once, however often it comes within the watermark. Users are counted
    approximately, as an exact distinct count over a stream would keep every user of a day in state."""
    timed = sessions.where(F.col("start_at").isNotNull()).withColumn("started", F.timestamp_seconds("start_at"))
    watched = timed.withWatermark("started", late).dropDuplicatesWithinWatermark(["id"]) if sessions.isStreaming else timed.dropDuplicates(["id"])
    day = F.window("started", "1 day")
    grouped = watched.groupBy(day.alias("day")).agg(F.count("*").alias("sessions"), F.count_if(F.col("status") == STATUS_SUBMITTED).alias("submitted"), F.approx_count_distinct("user_id").alias("users"))
    return grouped.select(F.col("day.start").alias("day"), "sessions", "submitted", "users")
