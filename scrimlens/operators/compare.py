"""Comparison of two groups of rows on many metrics, for every entity at once.

The outcome is always long: one row per entity and metric with both sample
sizes, the test, the effect size and what may be claimed.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from scrimlens.functions import stats
from scrimlens.functions.expressions import column, share_pct
from scrimlens.functions.filters import since
from scrimlens.operators import fdr
from scrimlens.operators.metrics import SHARE, Metric
from scrimlens.operators.sizes import settle
from scrimlens.operators.summarize import main_only, summarize_sides

MIN_PER_OUTCOME = 5


def judge(
    sides: DataFrame, family: Sequence[str], alpha: float = stats.ALPHA, decide_on_rounded: bool = False,
) -> DataFrame:
    """Add test, effect, direction and verdict to rows with n_a, mean_a, sd_a, hits_a and the same for b.

    ``family`` is the set of rows that the correction for multiple tests covers:
    one entity's metrics, never all entities together. Decisions use the exact
    p and d; ``decide_on_rounded`` takes p at 4 and d at 2 decimals instead.

    A family has a few dozen rows at most, so it is packed into one row: tail
    probabilities and the correction need no second exchange where the input
    lies by family already, as it does after the summary.
    """
    c = F.col
    a = (c("mean_a"), c("sd_a"), c("n_a"))
    b = (c("mean_b"), c("sd_b"), c("n_b"))
    t, dof, flat_t = stats.welch(*a, *b)
    z, flat_z = stats.proportions(c("hits_a"), c("n_a"), c("hits_b"), c("n_b"))
    is_share = c("kind") == SHARE
    d = stats.cohen_d(*a, *b)
    tested = (
        sides.where(c("mean_a").isNotNull() & c("mean_b").isNotNull())
        .withColumns({
            "stat": F.when(is_share, z).otherwise(t),
            "dof": F.when(~is_share, dof),
            "_flat": F.when(is_share, flat_z).otherwise(flat_t),
            "d": F.round(d, 2) if decide_on_rounded else d,
            "delta": stats.difference(c("mean_a"), c("mean_b")),
            "delta_pct": stats.delta_pct(c("mean_a"), c("mean_b")),
        })
    )
    rest = [x for x in tested.columns if x not in family]
    packed = tested.groupBy(*family).agg(F.collect_list(F.struct(*rest)).alias("_rows"))
    tails = packed.withColumn("_tails", stats.two_sided_ps("_rows.stat", "_rows.dof"))

    def p_value(row: Column, tail: Column) -> Column:
        p = F.coalesce(row["_flat"], tail)
        return F.round(p, 4) if decide_on_rounded else p

    ps = tails.withColumn("_ps", F.zip_with("_rows", "_tails", p_value))
    limited = ps.withColumn("_limit", fdr.family_limit(c("_ps"), alpha))
    unpacked = limited.select(*family, "_limit", F.inline(F.arrays_zip("_rows", "_ps")))
    judged = unpacked.select(
        *family, *[c(f"_rows.{x}").alias(x) for x in rest if x != "_flat"], c("_ps").alias("p"),
        F.coalesce(c("_ps") <= c("_limit"), F.lit(False)).alias("significant"))
    return judged.withColumns({
        "magnitude": stats.magnitude(c("d")),
        "direction": stats.direction(c("delta"), c("sense")),
        "verdict": stats.verdict(c("significant"), c("p"), alpha),
        "relevant": c("significant") & F.coalesce(F.abs("d") >= stats.SMALL, F.lit(False)),
    })


def compare_windows(
    df: DataFrame, by: Sequence[str], metrics: Sequence[Metric], ts: str, as_of: str | datetime, days: float,
    outcome: str | None = None, **judging,
) -> DataFrame:
    """Last N days (side a) against the N days before (side b).

    ``outcome`` adds the win rate as a share metric that joins the same family.
    """
    wanted = [Metric("win_rate", kind=SHARE, source=outcome), *metrics] if outcome else list(metrics)
    recent = since(ts, as_of, days)
    facts = df.where(since(ts, as_of, 2 * days))
    judged = judge(summarize_sides(facts, by, wanted, recent, ~recent), by, **judging)
    # The win rate is the window itself, so it has no coverage of its own.
    partial = (F.col("n_a") < F.col("group_n_a")) | (F.col("n_b") < F.col("group_n_b"))
    return judged.withColumns({
        "partial_coverage": partial & (F.col("metric") != "win_rate"),
        "enough": stats.enough(F.col("group_n_a"), F.col("group_n_b")),
    })


def window_overview(
    df: DataFrame, report: DataFrame, by: Sequence[str], ts: str, as_of: str | datetime, days: float, outcome: str,
) -> DataFrame:
    """One row per entity: sizes and wins of both windows, the metric lists and a note code."""
    recent, won = since(ts, as_of, days), F.expr(outcome)
    sizes = df.where(since(ts, as_of, 2 * days)).groupBy(*by).agg(
        F.count(F.when(recent, 1)).alias("recent_n"), F.count(F.when(recent & won, 1)).alias("recent_wins"),
        F.count(F.when(~recent, 1)).alias("previous_n"), F.count(F.when(~recent & won, 1)).alias("previous_wins"),
    )
    found = report.groupBy(*by).agg(
        F.count(F.lit(1)).alias("tested"),
        F.sort_array(F.collect_list(F.when(F.col("significant"), F.col("metric")))).alias("significant_metrics"),
        F.sort_array(F.collect_list(F.when(F.col("verdict") == "hint", F.col("metric")))).alias("hints"),
    )
    none = F.array().cast("array<string>")
    joined = sizes.join(found, list(by), "left").withColumns({
        "tested": F.coalesce("tested", F.lit(0)),
        "significant_metrics": F.coalesce("significant_metrics", none), "hints": F.coalesce("hints", none),
    })
    n_a, n_b = F.col("recent_n"), F.col("previous_n")
    note = (
        F.when((n_a == 0) | (n_b == 0), "window_missing").when(~stats.enough(n_a, n_b), "small_sample")
        .when(F.size("significant_metrics") == 0, "stable").when(F.size("hints") > 0, "changes_and_hints")
        .otherwise("changes")
    )
    return joined.withColumns({"enough": stats.enough(n_a, n_b), "note": note})


def compare_outcomes(
    df: DataFrame, by: Sequence[str], metrics: Sequence[Metric], outcome: str, least: int = MIN_PER_OUTCOME,
    main: tuple[str, str] | None = None, **judging,
) -> DataFrame:
    """Won rows (side a) against lost rows (side b); entities below ``least`` of either are left out.

    As in a two-way CASE, a row without an outcome counts as lost.
    ``main=(entity, role)`` looks at each entity's main role only.
    """
    won = F.coalesce(F.expr(outcome), F.lit(False))
    sides = summarize_sides(df, by, metrics, won, ~won, main)
    ready = sides.where((F.col("group_n_a") >= least) & (F.col("group_n_b") >= least))
    return judge(ready, by, **judging).withColumn("guidance", outcome_guidance())


def outcome_sample(
    df: DataFrame, by: Sequence[str], outcome: str, least: int = MIN_PER_OUTCOME, main: tuple[str, str] | None = None,
) -> DataFrame:
    """Wins and losses per entity and whether they suffice for the split."""
    won = F.coalesce(F.expr(outcome), F.lit(False))
    counted = df.groupBy(*by).agg(F.count(F.when(won, 1)).alias("wins"), F.count(F.when(~won, 1)).alias("losses"))
    if main:
        counted = main_only(counted, *main, F.col("wins") + F.col("losses"))
    return counted.withColumn(
        "status", F.when(F.least("wins", "losses") >= least, "ok").otherwise("insufficient_sample")
    )


def group_vs_rest(
    df: DataFrame, groups: Sequence[str], outcome: str, least: int = 10, within: Sequence[str] = (),
    alpha: float = stats.ALPHA,
) -> DataFrame:
    """Hit rate of every group of rows against all other rows, corrected over all groups of ``within``."""
    hit = F.coalesce(F.expr(outcome), F.lit(False))
    counts = df.groupBy(*within, *groups).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(hit, 1)).alias("hits"))
    return counts_vs_rest(counts, least, within, alpha)


def counts_vs_rest(
    counts: DataFrame, least: int = 10, within: Sequence[str] = (), alpha: float = stats.ALPHA,
) -> DataFrame:
    """The same from rows that are groups already, with columns ``n`` and ``hits``.

    The rest is the total minus the group, so no row is compared with another one.
    """
    # A constant key stands in when there is no outer grouping.
    outer = list(within) or ["_all"]
    counts = counts if within else counts.withColumn("_all", F.lit(0))
    totals = counts.groupBy(*outer).agg(F.sum("n").alias("_n"), F.sum("hits").alias("_hits"))
    totals = totals if within else F.broadcast(totals)  # a single row
    against = counts.join(totals, outer).where(F.col("n") >= least).withColumns({
        "rest_n": F.col("_n") - F.col("n"), "rest_hits": F.col("_hits") - F.col("hits"),
    })
    z, flat = stats.proportions(F.col("hits"), F.col("n"), F.col("rest_hits"), F.col("rest_n"))
    tested = against.withColumns({
        "hit_pct": share_pct(F.col("hits"), F.col("n")),
        "rest_pct": share_pct(F.col("rest_hits"), F.col("rest_n")),
        "stat": z, "_flat": flat,
    }).withColumn("p", F.coalesce(F.col("_flat"), stats.two_sided_p(F.col("stat"), F.lit(None).cast("double"))))
    judged = fdr.reject(settle(tested), within, "p", alpha)
    return judged.withColumn("verdict", stats.verdict(F.col("significant"), F.col("p"), alpha)).drop(
        "_all", "_n", "_hits", "_flat"
    )


def pool_changes(
    df: DataFrame, by: Sequence[str], segment: str, ts: str, as_of: str | datetime, days: float, outcome: str,
    min_games: int = 3, alpha: float = stats.ALPHA,
) -> DataFrame:
    """Per entity and segment: new, dropped or constant, and how the win rate moved (no correction)."""
    recent, won = since(ts, as_of, days), F.expr(outcome)
    counts = df.where(since(ts, as_of, 2 * days)).groupBy(*by, segment).agg(
        F.count(F.when(recent, 1)).alias("recent_n"), F.count(F.when(recent & won, 1)).alias("recent_wins"),
        F.count(F.when(~recent, 1)).alias("previous_n"), F.count(F.when(~recent & won, 1)).alias("previous_wins"),
    ).where(F.col("recent_n") + F.col("previous_n") >= min_games)
    n_a, n_b = F.col("recent_n"), F.col("previous_n")
    z, flat = stats.proportions(F.col("recent_wins"), n_a, F.col("previous_wins"), n_b)
    p = F.coalesce(F.col("_flat"), stats.two_sided_p(F.col("stat"), F.lit(None).cast("double")))
    return counts.withColumns({
        "status": F.when(n_b == 0, "new").when(n_a == 0, "dropped").otherwise("constant"),
        "recent_win_pct": share_pct(F.col("recent_wins"), n_a),
        "previous_win_pct": share_pct(F.col("previous_wins"), n_b),
        "stat": z, "_flat": flat,
    }).withColumn("p", p).withColumns({
        "delta_win_pct": F.col("recent_win_pct") - F.col("previous_win_pct"),
        "significant": F.coalesce(F.col("p") < alpha, F.lit(False)),
    }).drop("_flat")


# --- what may be said about a row ------------------------------------------------

#: What follows from the rule behind each code.
ADVICE = {
    "claim_change": "significant after correction: report",
    "watch_only": "p below alpha, fails correction: keep watching",
    "do_not_report": "p not below alpha: omit",
    "same_in_both": "no significant effect, or |d| < 0.2",
    "drops_a_little": "significant, 0.2 <= |d| < 0.5, association only",
    "drops_clearly": "significant, |d| >= 0.5, association only",
    "at_peer_level": "no significant gap, or |d| < 0.2",
    "small_gap": "significant gap, 0.2 <= |d| < 0.5, one point in time",
    "real_gap": "significant gap, |d| >= 0.5, one point in time",
}


def _banded(weak: str, small: str, strong: str, d: Column | str = "d", significant: Column | str = "significant") -> Column:
    size = F.abs(column(d))
    return (
        F.when(~column(significant) | size.isNull() | (size < stats.SMALL), weak)
        .when(size < stats.MEDIUM, small).otherwise(strong)
    )


def trend_guidance(verdict: Column | str = "verdict") -> Column:
    v = column(verdict)
    return F.when(v == "significant", "claim_change").when(v == "hint", "watch_only").otherwise("do_not_report")


def outcome_guidance() -> Column:
    return _banded("same_in_both", "drops_a_little", "drops_clearly")


def peer_guidance() -> Column:
    return _banded("at_peer_level", "small_gap", "real_gap")


def advice(code: Column | str) -> Column:
    """Text of a guidance code."""
    pairs = [F.lit(x) for item in ADVICE.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), column(code))
