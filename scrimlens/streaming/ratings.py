"""Change-only rating series as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from scrimlens.operators.series import change_points
from scrimlens.operators.sizes import settle
from scrimlens.operators.state import latest_per_key, upsert
from scrimlens.sources.versioned import KeyedTable
from scrimlens.streaming.landing import run

STATE_BUCKETS = 64


def record_changes(stream: DataFrame, root: str, checkpoint: str, entity: str = "puuid", order: Sequence[str] = ("moment",),
                   watched: Sequence[str] = ("lp", "tier"), slices: Sequence[Column] = (), buckets: int = STATE_BUCKETS,
                   **running) -> StreamingQuery:
    """Store a point only when a watched column differs from the entity's last one.

    The latest row per entity lies in hash buckets: a batch reads the buckets of its own entities and writes these anew, under
    its own number, while versions older than the batch before are removed. A repeated batch finds the state from before it and
    writes the same again. Points must arrive in order from batch to batch.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        latest = KeyedTable(batch.sparkSession, f"{root}/latest", [entity], buckets)
        points = batch.where(F.col(watched[0]).isNotNull())
        newest = settle(latest_per_key(points, [entity], order).select(*points.columns))
        touched = latest.touched(newest)
        before = latest.read(touched, before=batch_id)
        tagged = points.withColumn("_new", F.lit(True))
        if before is not None:
            mine = before.join(newest.select(entity), entity, "left_semi")
            tagged = tagged.unionByName(mine.withColumn("_new", F.lit(False)))
        changed = change_points(tagged, entity, order, watched, slices).where("_new").drop("_new")
        changed.write.mode("overwrite").parquet(f"{root}/points/batch={batch_id}")
        current = newest if before is None else upsert(before, newest, [entity], order).select(*points.columns)
        latest.replace(current, touched, batch_id)

    return run(stream, each, checkpoint, **running)


def read_changes(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/points").drop("batch")


def read_latest(spark: SparkSession, root: str, entity: str = "puuid", buckets: int = STATE_BUCKETS) -> DataFrame | None:
    """Newest row of every entity; None before the first batch."""
    return KeyedTable(spark, f"{root}/latest", [entity], buckets).read()
