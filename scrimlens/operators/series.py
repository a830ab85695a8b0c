"""Ordered per-entity series: the previous row, changes, and deltas that belong to one game."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from scrimlens.functions.expressions import column

BONUS_FACTOR = 1.7


def with_previous(
    df: DataFrame, entity: str, order: Sequence[str], carry: Sequence[str], slices: Sequence[Column] = (),
) -> DataFrame:
    """Add struct ``previous`` with the ``carry`` columns of the row before (NULL for the first row).

    ``slices`` are order-preserving pieces of the sort key, such as its day. With
    them a long series is sorted slice by slice in parallel, and each slice gets
    the last row of the one before from a table with one row per slice. Without
    them an entity's series is sorted in one task.
    """
    carried, position = F.struct(*carry), F.struct(*order)
    if not slices:
        return df.withColumn("previous", F.lag(carried).over(Window.partitionBy(entity).orderBy(*order)))
    keys = [f"_slice{i}" for i in range(len(slices))]
    cut = df.withColumns(dict(zip(keys, slices)))
    inside = Window.partitionBy(entity, *keys).orderBy(*order)
    rows = cut.withColumns({"_inside": F.lag(carried).over(inside), "_at": F.row_number().over(inside)})
    tails = cut.groupBy(entity, *keys).agg(F.max_by(carried, position).alias("_last"))
    before = F.lag("_last").over(Window.partitionBy(entity).orderBy(*keys)).alias("_before")
    heads = tails.select(*[F.col(k).alias(f"_head_{k}") for k in (entity, *keys)], before)
    same_slice = [F.col(k).eqNullSafe(F.col(f"_head_{k}")) for k in (entity, *keys)]
    return (
        rows.join(heads, same_slice)
        .withColumn("previous", F.when(F.col("_at") == 1, F.col("_before")).otherwise(F.col("_inside")))
        .drop("_inside", "_at", "_before", *keys, *[f"_head_{k}" for k in (entity, *keys)])
    )


def change_points(
    df: DataFrame, entity: str, order: Sequence[str], watched: Sequence[str], slices: Sequence[Column] = (),
) -> DataFrame:
    """Rows where a watched column differs from the row before; the first row always stays.

    Unchanged rows equal the last kept one, so comparing neighbours is the same
    as comparing with the last stored point.
    """
    seen = with_previous(df, entity, order, watched, slices)
    changed = F.lit(False)
    for c in watched:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"previous.{c}"))
    return seen.where(F.col("previous").isNull() | changed).drop("previous")


def rating_deltas(
    points: DataFrame, entity: str = "puuid", order: Sequence[str] = ("moment",), slices: Sequence[Column] = (),
    division_matters: bool = True,
) -> DataFrame:
    """Classify each step of a rating series as gain, loss, ambiguous or none.

    A step counts only when exactly one game lies in it; a change of tier resets
    the rating, and so does a change of division below the top tiers
    (``division_matters=False`` looks at the tier alone).
    """
    carry = ["lp", "tier", "division", "wins", "losses"]
    seen = with_previous(points, entity, order, carry, slices).where(F.col("previous").isNotNull())
    before = lambda c: F.col(f"previous.{c}")
    zero = F.lit(0)
    won = F.coalesce("wins", zero) - F.coalesce(before("wins"), zero)
    lost = F.coalesce("losses", zero) - F.coalesce(before("losses"), zero)
    same = F.col("tier").eqNullSafe(before("tier"))
    if division_matters:
        same = same & F.col("division").eqNullSafe(before("division"))
    moved = F.col("lp") - before("lp")
    kind = (
        F.when(~same, "reset").when((won == 1) & (lost == 0), "gain").when((lost == 1) & (won == 0), "loss")
        .when(won + lost > 1, "ambiguous").otherwise("none")
    )
    return seen.select(entity, *order, kind.alias("kind"), moved.alias("_moved")).select(
        entity, *order, "kind",
        F.when(F.col("kind") == "gain", F.col("_moved")).when(F.col("kind") == "loss", -F.col("_moved")).alias("amount"),
    )


def _tallied(deltas: DataFrame, entity: str) -> DataFrame:
    """Steps counted per kind and amount, with the median amount of each kind alongside.

    Rating amounts are small whole numbers, so an entity has few distinct ones
    however long its series is; windows only ever see those.
    """
    tally = deltas.groupBy(entity, "kind", "amount").agg(F.count(F.lit(1)).alias("times"))
    whole = Window.partitionBy(entity, "kind")
    upto = F.sum("times").over(whole.orderBy("amount").rowsBetween(Window.unboundedPreceding, 0))
    counted = tally.withColumns({"_upto": upto, "_n": F.sum("times").over(whole)})
    low, high = F.floor((F.col("_n") - 1) / 2) + 1, F.floor(F.col("_n") / 2) + 1

    def at(rank: Column) -> Column:
        inside = (F.col("_upto") - F.col("times") < rank) & (F.col("_upto") >= rank)
        return F.max(F.when(inside, F.col("amount"))).over(whole)

    return counted.select(entity, "kind", "amount", "times", ((at(low) + at(high)) / 2.0).alias("median"))


def _is_bonus() -> Column:
    return (F.col("kind") == "gain") & (F.col("median") != 0) & (F.col("amount") >= F.col("median") * F.lit(BONUS_FACTOR))


def rating_progress(points: DataFrame, deltas: DataFrame, entity: str = "puuid") -> DataFrame:
    """Median gain per win and loss per defeat, counted bonus wins, and whether both are measurable.

    The medians run over all wins, bonus ones included.
    """
    sized = points.groupBy(entity).agg(F.count(F.lit(1)).alias("points"))
    of = lambda kind, value: F.when(F.col("kind") == kind, F.col(value))
    found = _tallied(deltas, entity).groupBy(entity).agg(
        F.max(of("gain", "median")).alias("gain_median"), F.max(of("loss", "median")).alias("loss_median"),
        F.sum(of("gain", "times")).alias("gains"), F.sum(of("loss", "times")).alias("losses"),
        F.sum(of("ambiguous", "times")).alias("ambiguous"), F.sum(F.when(_is_bonus(), F.col("times"))).alias("bonus_gains"),
    )
    counts = ("gains", "losses", "ambiguous", "bonus_gains")
    return sized.join(found, entity, "left").withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in counts}
    ).withColumn("measurable", (F.col("points") >= 2) & (F.col("gains") > 0) & (F.col("losses") > 0))


def bonus_gains(deltas: DataFrame, entity: str = "puuid") -> DataFrame:
    """Distinct gains of at least 1.7 times a non-zero median gain: (entity, amount, times)."""
    return _tallied(deltas, entity).where(_is_bonus()).select(entity, "amount", "times")


def by_epoch_day(seconds: Column | str) -> Column:
    """Day slice of an epoch-second value."""
    return F.floor(column(seconds) / 86400)
