"""What is missing, what is new, and how a run went. No cursor: two tables are compared each time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from scrimlens.operators.state import newest_per_entity


def pending(wanted: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct wanted keys that are not done yet."""
    return wanted.select(*keys).distinct().join(done.select(*keys), list(keys), "left_anti")


def next_batch(waiting: DataFrame, order: Sequence[Column], budget: int = 60) -> DataFrame:
    """The first ``budget`` pending keys (1 to 500), by default newest first."""
    if not 1 <= budget <= 500:
        raise ValueError("budget must be between 1 and 500")
    return waiting.orderBy(*order).limit(budget)


def split_known(page: DataFrame, processed: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(already processed, new) rows of a page of ids."""
    ids = processed.select(*keys)
    return page.join(ids, list(keys), "left_semi"), page.join(ids, list(keys), "left_anti")


def admit(new: DataFrame, entity: Sequence[str], order: Sequence[Column], budget: int = 10) -> DataFrame:
    """At most ``budget`` new rows per entity and run; the others stay pending for the next run."""
    return newest_per_entity(new, entity, order, budget)


def run_report(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Totals of new, existing and failed items; failed only if there were errors and nothing new.

    ``results`` has a text column ``result`` with new, existing or error.
    """
    totals = results.groupBy(*by).agg(*[
        F.count(F.when(F.col("result") == r, 1)).alias(name)
        for r, name in (("new", "new"), ("existing", "existing"), ("error", "errors"))
    ])
    return totals.withColumn("failed", (F.col("errors") > 0) & (F.col("new") == 0))
