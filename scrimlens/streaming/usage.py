"""Usage counters and weekly windows over a request stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from scrimlens.operators.sizes import settle
from scrimlens.sources.requests import usage
from scrimlens.sources.versioned import KeyedTable
from scrimlens.streaming.landing import run

COUNTER_BUCKETS = 64


def count_usage(stream: DataFrame, root: str, checkpoint: str, user: str = "token", at: str = "at", buckets: int = COUNTER_BUCKETS,
                **running) -> StreamingQuery:
    """Calls and last use per user. Each batch replaces the counters it changed, in their hash buckets only; there is one
    row per user, and the version before the last batch for a batch that is repeated."""
    def each(changed: DataFrame, batch_id: int) -> None:
        KeyedTable(changed.sparkSession, root, [user], buckets).put(settle(changed), batch_id)
    return run(usage(stream, user, at), each, checkpoint, output_mode="update", **running)


def read_usage(spark: SparkSession, root: str, user: str = "token", buckets: int = COUNTER_BUCKETS) -> DataFrame:
    """Current counters, one row per user."""
    return KeyedTable(spark, root, [user], buckets).read()


def weekly_calls(stream: DataFrame, user: str = "token", at: str = "at", delay: str = "3 days") -> DataFrame:
    """Calls per user and seven-day window, closed once the watermark has passed."""
    stamped = stream.withColumn(at, F.col(at).cast("timestamp"))
    return stamped.withWatermark(at, delay).groupBy(F.window(at, "7 days").alias("week"), user).agg(
        F.count(F.lit(1)).alias("calls"))


def close_weeks(stream: DataFrame, root: str, checkpoint: str, user: str = "token", at: str = "at", delay: str = "3 days", **running) -> StreamingQuery:
    """Append each closed week once: what a batch closes is stored under its number, so repeating it changes nothing. The state
    holds open weeks only; calls that come ``delay`` after the newest one count no more."""
    def each(closed: DataFrame, batch_id: int) -> None:
        closed.select(user, F.col("week.start").alias("start"), F.col("week.end").alias("end"), "calls").write.mode("overwrite").parquet(
            f"{root}/batch={batch_id}")
    return run(weekly_calls(stream, user, at, delay), each, checkpoint, **running)


def read_weeks(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(root).drop("batch")
