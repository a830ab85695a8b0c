"""Bounded admission: every run takes at most so many items of each entity, and what is left waits for the next run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from scrimlens.operators.backlog import admit
from scrimlens.operators.sizes import settle
from scrimlens.sources.versioned import KeyedTable
from scrimlens.streaming.landing import run

#: State numbers a batch has for the runs without input that follow it.
RUNS_A_BATCH = 1_000_000


class Backlog:
    """Items that wait, and the ids of those that were admitted, in hash buckets of their entity."""

    def __init__(self, spark: SparkSession, root: str, entity: str, item: str, order: Sequence[Column], budget: int = 10, buckets: int = 64) -> None:
        self.spark, self.root, self.entity, self.item, self.order, self.budget = spark, root.rstrip("/"), entity, item, list(order), budget
        self.waiting = KeyedTable(spark, f"{self.root}/waiting", [entity], buckets)
        self.known = KeyedTable(spark, f"{self.root}/known", [entity], buckets)

    def step(self, new: DataFrame | None, number: int) -> None:
        """One run: items that are neither admitted nor waiting join the queue, then every entity gets its budget."""
        keys = [self.entity, self.item]
        queue = self.waiting.read(before=number)
        touched = set(self.waiting.parts.state(before=number))
        if new is not None:
            new = settle(new.dropDuplicates(keys))
            own = self.known.touched(new)
            touched |= set(own)
            for stored in (self.known.read(own, before=number), self.waiting.read(own, before=number)):
                if stored is not None:
                    new = new.join(stored.select(*keys), keys, "left_anti")
            queue = new if queue is None else queue.unionByName(new)
        if queue is None:
            return
        queue = settle(queue)
        admitted = settle(admit(queue, [self.entity], self.order, self.budget).drop("place"))
        admitted.write.mode("overwrite").parquet(f"{self.root}/admitted/run={number}")
        ids = admitted.select(*keys)
        buckets = self.known.touched(ids)
        before = self.known.read(buckets, before=number)
        self.known.replace(ids if before is None else ids.unionByName(before.select(*keys)), buckets, number)
        # Last, as the runs read their number off this table.
        self.waiting.replace(queue.join(ids, keys, "left_anti"), touched, number)

    def drain(self) -> int:
        """A run without input; how many items were admitted."""
        states = self.waiting.parts.states()
        if not states or not self.waiting.parts.state():
            return 0
        self.step(None, states[-1] + 1)
        return self.spark.read.parquet(f"{self.root}/admitted/run={states[-1] + 1}").count()

    def admitted(self) -> DataFrame:
        """All admitted items with the number of their ``run``."""
        return self.spark.read.parquet(f"{self.root}/admitted")


def admit_stream(stream: DataFrame, backlog: Backlog, checkpoint: str, **running) -> StreamingQuery:
    """A run per micro-batch. A batch that is repeated finds the state from before it and admits the same items again; runs without
    input in between have numbers of their own, after their batch."""
    def each(batch: DataFrame, batch_id: int) -> None:
        backlog.step(batch, (batch_id + 1) * RUNS_A_BATCH)
    return run(stream, each, checkpoint, **running)
