"""Gap merging on a stream: an extension; late events beyond the watermark are left out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_stream(events: DataFrame, gap: str = "6 hours", late: str = "1 hour") -> DataFrame:
    """Sessions of a user's events: `user_id, first_ts, last_ts, n, total`."""
    s = events.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap)).agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count("*").alias("n"), F.sum("value").alias("total"))
    return s.select("user_id", "first_ts", "last_ts", "n", "total")
