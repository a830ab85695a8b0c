"""Broadcast only what has been measured; compute once what several branches read."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, functions as F

from scrimlens.functions.expressions import bit_is_set

MAX_BROADCAST_ROWS = 1_000_000
#: Bitmaps of Spark's bitmap aggregates, of 4 KB and up to 32,768 numbers each.
MAX_BITMAPS = 16_384


def fits(df: DataFrame, most: int = MAX_BROADCAST_ROWS) -> bool:
    """Whether the frame has at most ``most`` rows; stops counting right after that."""
    return df.limit(most + 1).count() <= most


def broadcast_if_small(df: DataFrame, most: int = MAX_BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """(frame, True) with a broadcast hint when it fits, else (frame, False) for an ordinary join."""
    return (F.broadcast(df), True) if fits(df, most) else (df, False)


def number_bitmaps(wanted: DataFrame, number: str) -> DataFrame:
    """The numbers of rows as bitmaps, one bit a row, for :func:`numbered`."""
    return wanted.groupBy(F.bitmap_bucket_number(number).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("_bitmap"))


def numbered(rows: DataFrame, bitmaps: DataFrame, number: str) -> DataFrame:
    """The rows whose number is in the bitmaps; where these are broadcast, wide rows are not shuffled for it."""
    joined = rows.join(bitmaps, F.bitmap_bucket_number(number) == F.col("_bucket"))
    return joined.where(bit_is_set("_bitmap", F.bitmap_bit_position(number))).select(*rows.columns)


def settle(df: DataFrame) -> DataFrame:
    """Write a summary that several branches read to the shared checkpoint folder, so it is computed once.

    The folder is the session's ``spark.checkpoint.dir`` and outlives executors.
    Only local mode may choose its own; on a cluster the setting is needed.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if shared is None and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="scrimlens-checkpoints-"))
    return df.checkpoint()


def small_side(df: DataFrame, most: int = 100_000) -> DataFrame:
    """The small side of a join against facts: settled, counted, and broadcast if it is as small as expected.

    Left alone, the planner may shuffle all facts by a key with few values
    before it learns how small the other side is.
    """
    settled = settle(df)
    return broadcast_if_small(settled, most)[0]
