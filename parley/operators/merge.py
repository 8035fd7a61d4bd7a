"""Merging of what is close in time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def reply_groups(pairs: DataFrame, gap: float) -> DataFrame:
    """Adds `grp`: consecutive pairs of one speaker with at most `gap` seconds between (a negative gap merges too). An
    unknown or zero end takes the latest known one before it."""
    w = W.partitionBy("file_id").orderBy("seg_idx")
    last = F.last(F.nullif("tend", F.lit(0.0)), ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1))
    joins = (F.col("output_speaker") == F.lag("output_speaker").over(w)) & F.col("tstart").isNotNull() & last.isNotNull() & (F.col("tstart") - last <= gap)
    p = pairs.withColumn("new", (~F.coalesce(joins, F.lit(False))).cast("int"))
    return p.withColumn("grp", F.sum("new").over(w.rowsBetween(W.unboundedPreceding, W.currentRow))).drop("new")


def fold_average(scores):
    """The running (a + b) / 2 over an ordered array; a null on either side leaves the average so far."""
    rest = F.slice(scores, 2, F.greatest(F.size(scores) - 1, F.lit(0)))
    return F.aggregate(rest, F.get(scores, 0), lambda s, x: F.when(s.isNotNull() & x.isNotNull(), (s + x) / 2).otherwise(s))


def merge_replies(pairs: DataFrame, gap: float) -> DataFrame:
    """One pair a group: the first one's input and number, outputs and words one after another, lengths summed, the last end."""
    p = reply_groups(pairs, gap)
    row = F.struct("seg_idx", "input", "input_len", "output", "output_len", "output_speaker", "avg_score", "tstart", "tend", "words", "num_context_turns", "is_first_utterance")
    g = p.groupBy("file_id", "grp").agg(F.array_sort(F.collect_list(row)).alias("r"))
    first = F.col("r")[0]
    ends = F.filter(F.transform("r", lambda x: F.nullif(x["tend"], F.lit(0.0))), lambda x: x.isNotNull())
    return g.select(
        "file_id",
        first["seg_idx"].alias("seg_idx"),
        first["input"].alias("input"),
        first["input_len"].alias("input_len"),
        F.array_join(F.transform("r", lambda x: x["output"]), " ").alias("output"),
        F.aggregate("r", F.lit(0).cast("long"), lambda s, x: s + x["output_len"]).alias("output_len"),
        first["output_speaker"].alias("output_speaker"),
        fold_average(F.transform("r", lambda x: x["avg_score"])).alias("avg_score"),
        first["tstart"].alias("tstart"),
        F.element_at(ends, -1).alias("tend"),
        F.flatten(F.transform("r", lambda x: x["words"])).alias("words"),
        first["num_context_turns"].alias("num_context_turns"),
        first["is_first_utterance"].alias("is_first_utterance"),
        F.size("r").cast("long").alias("n_merged"),
    )


def micros(ts):
    """Microseconds since 1970 of a time without zone, whatever the session's zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts).cast("timestamp_ntz"))


def merge_events(events: DataFrame, hours: float) -> DataFrame:
    """`user_id, grp, n, first_ts, last_ts, total`: events of a user with at most so many hours between neighbours."""
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    gap = F.col("us") - F.lag("us").over(w) > int(hours * 3_600_000_000)
    e = events.withColumn("us", micros("ts")).withColumn("new", F.coalesce(gap, F.lit(True)).cast("int")).withColumn("grp", F.sum("new").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)))
    return e.groupBy("user_id", "grp").agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.sum("value").alias("total"))
