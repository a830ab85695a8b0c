"""Exact order statistics per group, for groups of any size.

``percentile`` keeps every distinct value of a group in one buffer. Here a
mergeable sketch first brackets each wanted rank; a second pass counts what
lies below each bracket, and a third takes out only the values inside. What is
still many values is cut into slices by pivots, round after round: the slices
are counted, those that hold a wanted rank stay, and only these are ranked, each
slice by a task of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from scrimlens.operators.sizes import settle, small_side

ACCURACY = 10_000
#: Distinct values that one task ranks at most, and the pieces that a slice is cut into when it has more.
SLICE_VALUES, PIECES = 200_000, 64
#: Slot of the groups that are smaller than the sketch: all their values are taken, for all shares at once.
_WHOLE = -1


def exact_quantiles(
    df: DataFrame, by: Sequence[str], columns: Sequence[str], shares: Sequence[float], upper: bool = False,
    accuracy: int = ACCURACY, slice_values: int = SLICE_VALUES,
) -> DataFrame:
    """Long rows (by…, metric, share, n, value).

    Values between two ranks are interpolated; ``upper`` takes the element at
    0-based position floor(share * n) instead, which for 0.5 is the upper median.
    A metric without any value in a group gets its rows, with value NULL.
    """
    if not by:
        raise ValueError("exact_quantiles needs at least one grouping column")
    k, slack, places = len(shares), 4.0 / accuracy, range(len(shares))
    edges = [*[max(0.0, s - slack) for s in shares], *[min(1.0, s + slack) for s in shares]]
    values = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    own = [F.col(b).alias(f"_{b}") for b in by]
    brackets = small_side(values.groupBy(*own).agg(
        *[F.percentile_approx(c, edges, accuracy).alias(f"{c}__edges") for c in columns], *[F.count(c).alias(f"{c}__n") for c in columns]))

    def same(left: str = "", right: str = "_", more: Sequence[str] = ()) -> list[Column]:
        return [F.col(f"{left}{b}").eqNullSafe(F.col(f"{right}{b}")) for b in (*by, *more)]

    hit = values.join(brackets, same())
    whole = lambda c: F.col(f"{c}__n") < accuracy
    low = lambda c, i: F.col(f"{c}__edges")[i]
    high = lambda c, i: F.col(f"{c}__edges")[k + i]
    zero = F.lit(0).cast("bigint")

    # Where the wanted ranks lie: a row per group and metric.
    counted = hit.groupBy(*by).agg(*[
        F.count(F.when(~whole(c) & (F.col(c) < low(c, i)), 1)).alias(f"{c}__below{i}") for c in columns for i in places])
    n = F.col("n")
    position = lambda i: shares[i] * (n if upper else n - 1)
    first = lambda i: F.least(F.floor(position(i)), n - 1) + 1
    last = lambda i: first(i) if upper else F.least(first(i) + 1, n)
    targets = counted.join(brackets, same()).select(*by, F.inline(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(f"{c}__n").alias("n"), F.array(*[F.col(f"{c}__below{i}") for i in places]).alias("below")) for c in columns])))
    targets = small_side(targets.withColumns({
        "first": F.array(*[first(i).cast("bigint") for i in places]), "last": F.array(*[last(i).cast("bigint") for i in places])}))

    # The values inside the brackets; most rows have none.
    def taken(c: str) -> list[Column]:
        x = F.col(c)
        item = lambda slot: F.struct(F.lit(c).alias("metric"), F.lit(slot).alias("slot"), x.alias("x"))
        inside = [F.when(~whole(c) & (x >= low(c, i)) & (x <= high(c, i)), item(i)) for i in places]
        return [F.when(whole(c) & x.isNotNull(), item(_WHOLE)), *inside]

    items = F.filter(F.array(*[t for c in columns for t in taken(c)]), lambda t: t.isNotNull())
    found = hit.select(*by, F.inline(items)).groupBy(*by, "metric", "slot", "x").agg(F.count(F.lit(1)).alias("rows"))

    wanted = targets.select(*[F.col(c).alias(f"_{c}") for c in (*by, "metric")], "below", "first", "last")

    def rank(i: int, which: str) -> Column:
        """The rank among the values taken out for share i."""
        return F.col(which)[i] - F.when(F.col("slot") == _WHOLE, zero).otherwise(F.col("below")[i])

    def holds(before: Column, upto: Column) -> Column:
        ranks = [(i, rank(i, which)) for i in places for which in ("first", "last")]
        hits = [F.col("slot").isin(_WHOLE, i) & (r > before) & (r <= upto) for i, r in ranks]
        out = hits[0]
        for h in hits[1:]:
            out = out | h
        return out

    keys = [*by, "metric", "slot"]
    sliced = _narrowed(found, keys, lambda rows: rows.join(wanted, same(more=["metric"])), holds, slice_values)
    inside = Window.partitionBy(*keys, "slice").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    ranked = sliced.withColumn("upto", F.col("base") + F.sum("rows").over(inside)).join(wanted, same(more=["metric"]))

    def at(i: int, which: str) -> Column:
        here = F.col("slot").isin(_WHOLE, i) & (F.col("upto") - F.col("rows") < rank(i, which)) & (F.col("upto") >= rank(i, which))
        return F.max(F.when(here, F.col("x")))

    picked = ranked.groupBy(*[F.col(c).alias(f"_{c}") for c in (*by, "metric")]).agg(
        F.array(*[at(i, "first") for i in places]).alias("lows"), F.array(*[at(i, "last") for i in places]).alias("highs"))

    def value(i: int) -> Column:
        a, b = F.col("lows")[i], F.col("highs")[i]
        part = F.lit(0.0) if upper else position(i) - F.floor(position(i))
        lost = F.raise_error(F.lit("rank outside its bracket")).cast("double")
        return F.when(n > 0, F.when(a.isNull() | b.isNull(), lost).otherwise(a + part * (b - a)))

    return targets.join(picked, same(more=["metric"]), "left").select(
        *by, "metric", "n", F.inline(F.array(*[F.struct(F.lit(float(s)).alias("share"), value(i).alias("value")) for i, s in enumerate(shares)]))
    ).select(*by, "metric", "share", "n", "value")


def _narrowed(found: DataFrame, keys: list[str], with_ranks, holds, slice_values: int) -> DataFrame:
    """Values (keys, x, rows) with the ``slice`` they lie in and the number of rows before it (``base``).

    While a slice has more than ``slice_values`` distinct values it is cut at pivots taken from the values; the pieces are
    counted, and those without a wanted rank are left out.
    """
    current = settle(found.withColumns({"slice": F.lit(0).cast("bigint"), "base": F.lit(0).cast("bigint")}))
    whole = [*keys, "slice", "base"]
    while True:
        sizes = current.groupBy(*whole).agg(F.count(F.lit(1)).alias("distinct"))
        if (sizes.agg(F.max("distinct")).first()[0] or 0) <= slice_values:
            return current
        cuts = [i / PIECES for i in range(1, PIECES)]
        pivots = small_side(current.groupBy(*[F.col(c).alias(f"_{c}") for c in whole]).agg(F.percentile_approx("x", cuts, 1000).alias("_pivots")))
        match = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in whole]
        cut = current.join(pivots, match).withColumn("piece", F.size(F.filter("_pivots", lambda p: p < F.col("x"))))
        cut = cut.select(*whole, "x", "rows", "piece")
        totals = cut.groupBy(*whole, "piece").agg(F.sum("rows").alias("rows"))  # at most PIECES rows a slice
        before = F.sum("rows").over(Window.partitionBy(*whole).orderBy("piece").rowsBetween(Window.unboundedPreceding, 0)) - F.col("rows")
        placed = with_ranks(totals.withColumn("_before", F.col("base") + before))
        kept = small_side(placed.where(holds(F.col("_before"), F.col("_before") + F.col("rows"))).select(
            *[F.col(c).alias(f"_{c}") for c in whole], F.col("piece").alias("_piece"), "_before"))
        match = [*match, F.col("piece") == F.col("_piece")]
        current = settle(cut.join(kept, match).select(
            *keys, "x", "rows", (F.col("slice") * PIECES + F.col("piece")).alias("slice"), F.col("_before").alias("base")))


def exact_medians(df: DataFrame, by: Sequence[str], column: str, upper: bool = False) -> DataFrame:
    """(by…, n, median); an even group gives the mean of its two middle values, or the upper one."""
    found = exact_quantiles(df, by, [column], [0.5], upper)
    return found.select(*by, "n", F.col("value").alias("median"))


def approx_percentiles(df: DataFrame, by: Sequence[str], columns: Sequence[str], shares: Sequence[float],
                       accuracy: int = 10_000) -> DataFrame:
    """Long rows (by…, metric, share, value) from sketches alone: one pass, each value an actual element."""
    wide = df.groupBy(*by).agg(*[F.percentile_approx(c, list(shares), accuracy).alias(c) for c in columns])
    rows = [
        F.struct(F.lit(c).alias("metric"), F.lit(float(s)).alias("share"), F.col(c)[i].cast("double").alias("value"))
        for c in columns for i, s in enumerate(shares)
    ]
    return wide.select(*by, F.inline(F.array(*rows)))
