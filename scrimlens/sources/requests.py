"""Request log: what was asked for, by whom, and who came back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from scrimlens import schemas
from scrimlens.functions.expressions import column

TOKEN_CHARS = 8
_TEXT_MAP = "map<string,string>"


def read_request_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.REQUEST_LOG).json(path)


def described(log: DataFrame, body: str = "body", token: str = "token") -> DataFrame:
    """Add method, tool and arguments of a JSON-RPC body and cut the token.

    Tool and arguments only for ``tools/call``; a body that is not a JSON object has method ``?``.
    """
    text = F.coalesce(F.nullif(F.col(body), F.lit("")), F.lit("{}"))
    is_call = F.col("method") == "tools/call"
    return (
        log.withColumn("_outer", F.when(text.rlike(r"^\s*\{"), F.from_json(text, _TEXT_MAP)))
        .withColumn("method", F.when(F.col("_outer").isNull(), "?").otherwise(F.try_element_at("_outer", F.lit("method"))))
        .withColumn("_params", F.when(is_call, F.from_json(F.try_element_at("_outer", F.lit("params")), _TEXT_MAP)))
        .withColumn("tool", F.try_element_at("_params", F.lit("name")))
        .withColumn("arguments", F.from_json(F.try_element_at("_params", F.lit("arguments")), _TEXT_MAP))
        .withColumn("token", F.substring(F.col(token), 1, TOKEN_CHARS))
        .drop("_outer", "_params", body)
    )


def usage(calls: DataFrame, user: str, at: str) -> DataFrame:
    """Calls and last use per user."""
    return calls.groupBy(user).agg(F.count(F.lit(1)).alias("calls"), F.max(at).alias("last_use"))


def retention(calls: DataFrame, user: str, at: Column | str) -> DataFrame:
    """Calls, active weeks since the first use, and whether the user came back in week 2.

    Calls are first reduced to one row per user and day, so counting weeks
    never sees more than the days of a user.
    """
    days = calls.groupBy(user, column(at).cast("date").alias("_day")).agg(
        F.count(F.lit(1)).alias("_calls"), F.max(column(at)).alias("_last"))
    first = days.groupBy(user).agg(F.min("_day").alias("_first"))
    weeks = days.join(first, user).withColumn("_week", F.floor(F.datediff("_day", "_first") / 7))
    return weeks.groupBy(user).agg(
        F.sum("_calls").alias("calls"), F.max("_last").alias("last_use"),
        F.count_distinct("_week").alias("active_weeks"),
        (F.max(F.when(F.col("_week") == 1, 1).otherwise(0)) == 1).alias("back_in_week_2"),
    )
