"""Group summaries: one scan and one wide aggregate, long rows afterwards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from scrimlens.operators.metrics import MEAN, SHARE, Metric


def _summary_columns(metric: Metric, value: Column, tag: str) -> list[Column]:
    """Row count, mean and spread of one metric; a share needs only its count and its hits."""
    columns = [F.count(value).alias(f"{metric.name}__n{tag}")]
    if metric.kind == SHARE:
        return columns + [F.count(F.when(value, 1)).alias(f"{metric.name}__hits{tag}")]
    return columns + [
        F.avg(value).alias(f"{metric.name}__mean{tag}"),
        F.stddev_samp(value).alias(f"{metric.name}__sd{tag}"),
    ]


def _summary_fields(metric: Metric, tag: str) -> list[Column]:
    n = F.col(f"{metric.name}__n{tag}")
    if metric.kind == SHARE:
        hits = F.col(f"{metric.name}__hits{tag}")
        mean = F.try_divide(hits, n)
        sd = F.sqrt(mean * (1 - mean))
    else:
        hits = F.lit(None).cast("bigint")
        mean, sd = F.col(f"{metric.name}__mean{tag}"), F.col(f"{metric.name}__sd{tag}")
    return [n.alias(f"n{tag}"), mean.alias(f"mean{tag}"), sd.alias(f"sd{tag}"), hits.alias(f"hits{tag}")]


def _long(wide: DataFrame, keep: Sequence[str], metrics: Sequence[Metric], tags: Sequence[str]) -> DataFrame:
    """One row per metric. The generator keeps the grouping columns, so no new exchange follows."""
    rows = [
        F.struct(
            F.lit(m.name).alias("metric"), F.lit(m.sense).alias("sense"), F.lit(m.kind).alias("kind"),
            *[field for tag in tags for field in _summary_fields(m, tag)],
        )
        for m in metrics
    ]
    return wide.select(*keep, F.inline(F.array(*rows)))


def main_only(wide: DataFrame, entity: str, role: str, rows: Column) -> DataFrame:
    """The most played assigned role of each entity, ties to the first name.

    Chosen among summary rows (one per entity and role), so the facts need
    neither a second scan nor a join.
    """
    order = Window.partitionBy(entity).orderBy(rows.desc(), F.col(role))
    ranked = wide.where(F.col(role) != "").withColumn("_place", F.row_number().over(order))
    return ranked.where(F.col("_place") == 1).drop("_place")


def summarize(
    df: DataFrame, by: Sequence[str], metrics: Sequence[Metric], main: tuple[str, str] | None = None,
) -> DataFrame:
    """Long summary: by…, group_n, metric, sense, kind, n, mean, sd, hits.

    ``main=(entity, role)`` keeps each entity's main role only.
    """
    columns = [c for m in metrics for c in _summary_columns(m, m.value(), "")]
    wide = df.groupBy(*by).agg(F.count(F.lit(1)).alias("group_n"), *columns)
    if main:
        wide = main_only(wide, *main, F.col("group_n"))
    return _long(wide, [*by, "group_n"], metrics, [""])


def summarize_sides(
    df: DataFrame, by: Sequence[str], metrics: Sequence[Metric], side_a: Column, side_b: Column,
    main: tuple[str, str] | None = None,
) -> DataFrame:
    """Both sides of a comparison next to each other, from a single aggregation.

    Conditional aggregates keep the plan at one exchange on ``by``; partial
    aggregation makes an entity with a large part of all rows harmless.
    """
    columns = [
        F.count(F.when(side_a, 1)).alias("group_n_a"),
        F.count(F.when(side_b, 1)).alias("group_n_b"),
    ]
    for m in metrics:
        for tag, side in (("_a", side_a), ("_b", side_b)):
            columns += _summary_columns(m, F.when(side, m.value()), tag)
    wide = df.groupBy(*by).agg(*columns)
    if main:
        wide = main_only(wide, *main, F.col("group_n_a") + F.col("group_n_b"))
    return _long(wide, [*by, "group_n_a", "group_n_b"], metrics, ["_a", "_b"])


def means(df: DataFrame, by: Sequence[str], metrics: Sequence[Metric], outcome: Column | None = None) -> DataFrame:
    """Readable segment table: n, win percentage, and one average column per metric."""
    columns = [F.count(F.lit(1)).alias("n")]
    if outcome is not None:
        columns.append(F.try_divide(F.lit(100.0) * F.count(F.when(outcome, 1)), F.count(F.lit(1))).alias("win_pct"))
    for m in metrics:
        value = m.value() if m.kind == MEAN else m.value().cast("int")
        columns.append(F.avg(value).alias(m.name))
    return df.groupBy(*by).agg(*columns)


def coverage(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """How many rows of each group carry a value, per column, and whether some do not."""
    wide = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("group_n"), *[F.count(c).alias(f"{c}__n") for c in columns]
    )
    rows = [
        F.struct(
            F.lit(c).alias("metric"), F.col(f"{c}__n").alias("n"),
            F.try_divide(F.lit(100.0) * F.col(f"{c}__n"), F.col("group_n")).alias("covered_pct"),
            (F.col(f"{c}__n") < F.col("group_n")).alias("partial_coverage"),
        )
        for c in columns
    ]
    return wide.select(*by, "group_n", F.inline(F.array(*rows)))
