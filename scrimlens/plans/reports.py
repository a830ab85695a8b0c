"""The reports over the match tables. Each runs for every player in one job.

``player`` narrows a report to one player before anything is computed. Rank,
cutoff and rating reports take their state tables. ``as_of`` is always given;
nothing reads the clock.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from scrimlens.functions.expressions import platform_of, played_at, queue_label, short_version
from scrimlens.functions.filters import moment, since, solo, with_role
from scrimlens.operators import compare, curate, peers as peer_reports, quantiles, segments, series, state
from scrimlens.operators.metrics import (
    CS_PER_MIN, DEATHS, OUTCOME_METRICS, PEER_METRICS, TIME_DEAD, TREND_METRICS, Metric, on_peers,
)
from scrimlens.operators.summarize import coverage, summarize
from scrimlens.plans.tables import shown
from scrimlens.sources.scope import scoped

LANING_MINUTES = (5, 10, 14, 20)
When = str | datetime


def _facts(matches: DataFrame, as_of: When, days: float, solo_only: bool, player: str | None) -> DataFrame:
    return solo(scoped(matches, player), solo_only).where(since("played_at", as_of, days))


def _by_effect(report: DataFrame) -> DataFrame:
    """``place`` of a metric within its player and role: largest absolute effect first, without an effect last."""
    return state.placed(report, ["puuid", "team_position"], [F.abs("d").desc_nulls_last(), F.asc("metric")])


def _by_games(table: DataFrame, segment: str, games: str = "n") -> DataFrame:
    """``place`` of a segment within its player: most games first."""
    return state.placed(table, ["puuid"], [F.desc(games), F.asc(segment)])


def window_trends(matches: DataFrame, as_of: When, days: int = 30, solo_only: bool = True, player: str | None = None,
                  by_role: bool = False, **judging) -> DataFrame:
    """Recent window against the one before: win rate and 22 metrics per player."""
    by = ["puuid", "team_position"] if by_role else ["puuid"]
    facts = solo(scoped(matches, player), solo_only)
    report = compare.compare_windows(facts, by, TREND_METRICS, "played_at", as_of, days, "win", **judging)
    return report.withColumn("guidance", compare.trend_guidance())


def trend_overview(matches: DataFrame, report: DataFrame, as_of: When, days: int = 30, solo_only: bool = True,
                   player: str | None = None) -> DataFrame:
    """One row per player: window sizes, significant and hinted metrics, note code."""
    facts = solo(scoped(matches, player), solo_only)
    return compare.window_overview(facts, report, ["puuid"], "played_at", as_of, days, "win")


def champion_pool_trends(matches: DataFrame, as_of: When, days: int = 30, solo_only: bool = True, min_games: int = 3,
                         player: str | None = None) -> DataFrame:
    facts = solo(scoped(matches, player), solo_only)
    changes = compare.pool_changes(facts, ["puuid"], "champion_name", "played_at", as_of, days, "win", min_games)
    return state.placed(changes, ["puuid"], [(F.col("recent_n") + F.col("previous_n")).desc(), F.asc("champion_name")])


def coaching_priorities(matches: DataFrame, peers: DataFrame, as_of: When, days: int = 90, role: str | None = None,
                        solo_only: bool = True, player: str | None = None, scope: str = "lake", **judging) -> DataFrame:
    """Every player against peers of the same role.

    ``scope="lake"`` takes everybody else of the role in the peer table,
    ``"own_matches"`` only the others of the player's own matches.
    """
    own = with_role(_facts(matches, as_of, days, solo_only, player), "team_position", role)
    judging["main_role"] = role is None
    pool = with_role(_facts(peers, as_of, days, solo_only, None), "team_position", role)
    if scope == "own_matches":
        report = peer_reports.compare_to_match_peers(
            own, pool, "puuid", "team_position", "match_id", PEER_METRICS, on_peers(PEER_METRICS), **judging)
    elif scope == "lake":
        report = peer_reports.compare_to_peers(
            own, pool, "puuid", "team_position", PEER_METRICS, on_peers(PEER_METRICS), **judging)
    else:
        raise ValueError("scope must be lake or own_matches")
    return _by_effect(report)


def win_loss_split(matches: DataFrame, as_of: When, days: int = 90, role: str | None = None, solo_only: bool = True,
                   player: str | None = None, **judging) -> DataFrame:
    own = with_role(_facts(matches, as_of, days, solo_only, player), "team_position", role)
    main = None if role else ("puuid", "team_position")
    return _by_effect(compare.compare_outcomes(own, ["puuid", "team_position"], OUTCOME_METRICS, "win", main=main, **judging))


def win_loss_sample(matches: DataFrame, as_of: When, days: int = 90, role: str | None = None, solo_only: bool = True,
                    player: str | None = None) -> DataFrame:
    """Which players have enough wins and losses for the split."""
    own = with_role(_facts(matches, as_of, days, solo_only, player), "team_position", role)
    main = None if role else ("puuid", "team_position")
    return compare.outcome_sample(own, ["puuid", "team_position"], "win", main=main)


def laning_benchmarks(frames: DataFrame, matches: DataFrame, as_of: When, days: int = 90, role: str | None = None,
                      solo_only: bool = True, player: str | None = None) -> DataFrame:
    """Curves against the lane rival; frames carry no date or queue, so their match decides."""
    dated = _facts(matches, as_of, days, solo_only, player).select("match_id", "puuid")
    wanted = scoped(frames, player).where(F.col("minute").isin(*LANING_MINUTES))
    wanted = wanted.where(F.col("team_position") == role) if role else wanted
    joined = wanted.join(dated, ["match_id", "puuid"])
    return segments.minute_benchmarks(joined, ["puuid", "team_position", "minute"])


def lead_to_win(frames: DataFrame, matches: DataFrame, minute: int = 14, solo_only: bool = True, band: float = 500.0,
                player: str | None = None) -> DataFrame:
    """Win rate by gold lead at one minute, among frames with a rival."""
    ids = solo(scoped(matches, player), solo_only).select("match_id", "puuid")
    at = scoped(frames, player).where((F.col("minute") == minute) & F.col("gold_rival").isNotNull())
    return segments.state_vs_outcome(at.join(ids, ["match_id", "puuid"]), "diff_gold", "win", band, ["puuid"])


# The averages of the champion report.
CHAMPION_METRICS = [
    Metric("kills"), DEATHS, Metric("assists"), Metric("kda"), Metric("kill_participation"), Metric("team_damage_percentage"),
    CS_PER_MIN, Metric("lane_minions_first10_minutes"), Metric("damage_per_minute"), Metric("gold_per_minute"),
    Metric("vision_score_per_minute"), Metric("vision_score"), TIME_DEAD,
]


def champion_stats(matches: DataFrame, as_of: When, days: int = 90, solo_only: bool = True, min_games: int = 1,
                   player: str | None = None) -> DataFrame:
    facts = _facts(matches, as_of, days, solo_only, player)
    return _by_games(segments.segment_stats(facts, ["puuid", "champion_name"], CHAMPION_METRICS, "win", min_games), "champion_name")


# The columns of the recent-match report, with the decimals shown.
_RECENT = {
    "kda": 2, "kill_participation": 3, "team_damage_percentage": 3, "damage_per_minute": 1, "gold_per_minute": 1,
}


def recent_matches(matches: DataFrame, as_of: When, days: int = 7, limit: int = 20, solo_only: bool = True,
                   player: str | None = None) -> DataFrame:
    """The newest ``limit`` matches of every player."""
    facts = _facts(matches, as_of, days, solo_only, player)
    newest = state.newest_per_entity(facts, ["puuid"], [F.desc("played_at"), F.desc("match_id")], limit)
    rounded = [shown(c, places).alias(c) for c, places in _RECENT.items()]
    return newest.select(
        "puuid", "place", "match_id", "played_at", "queue_id", queue_label("queue_id").alias("queue_name"), "champion_name",
        "team_position", "win", "kills", "deaths", "assists", *rounded, "cs", "gold_earned", "total_damage_dealt_to_champions",
        "vision_score", "lane_minions_first10_minutes", "turret_plates_taken", "solo_kills", "control_wards_placed",
        "wards_killed", "total_time_spent_dead", "duration_min", "game_version")


def recent_matches_of_documents(raw: DataFrame, as_of: When, days: int = 7, limit: int = 20, solo_only: bool = True) -> DataFrame:
    """The same straight from raw rows of many players. Their documents are read twice: first for who played when, which alone is
    sorted and moved, then whole for matches that can be among the newest."""
    dates = _facts(curate.match_dates(raw), as_of, days, solo_only, None)
    rows = raw.withColumn("puuid", F.explode("puuid")) if isinstance(raw.schema["puuid"].dataType, T.ArrayType) else raw
    likely = state.likely_newest(rows.withColumn("played_at", played_at("game_creation")), dates, ["puuid"], "played_at", limit)
    return recent_matches(curate.flatten_matches(likely), as_of, days, limit, solo_only)


def rating_progress(points: DataFrame, as_of: When, days: int = 30, player: str | None = None,
                    division_matters: bool = True) -> DataFrame:
    """Points gained per win and lost per defeat, from steps with exactly one game."""
    first, end = (F.unix_timestamp(moment(as_of, back).cast("timestamp")) for back in (days, 0))
    recent = scoped(points, player).where((F.col("moment") >= first) & (F.col("moment") < end))
    deltas = series.rating_deltas(
        recent, slices=[series.by_epoch_day("moment")], division_matters=division_matters)
    return series.rating_progress(recent, deltas)


def league_cutoff_gaps(rank_state: DataFrame, matches: DataFrame, cutoffs: DataFrame, player: str | None = None) -> DataFrame:
    """Solo-queue rank of every player against the leagues of its platform.

    The platform is read off any of the player's match ids; ``cutoffs`` has
    platform, league, cutoff, seats, median.
    """
    platforms = scoped(matches, player).groupBy("puuid").agg(platform_of(F.min("match_id")).alias("platform"))
    solo_rank = F.try_element_at("ranks", F.lit("RANKED_SOLO_5x5"))
    ranked = scoped(rank_state, player).select("puuid", solo_rank.alias("_r"))
    players = platforms.where(F.col("platform").isNotNull()).join(ranked, "puuid", "left").select(
        "puuid", "platform", F.col("_r.tier").alias("tier"), F.coalesce("_r.lp", F.lit(0)).alias("lp"))
    return state.cutoff_gaps(players, cutoffs.where(F.col("league").isin(*state.LEAGUES)), "platform", "tier", "lp")


def ranks(rank_state: DataFrame, player: str | None = None) -> DataFrame:
    return state.rank_rows(scoped(rank_state, player))


def list_players(matches: DataFrame, session: str | None = None) -> DataFrame:
    """Players with their match counts; a session sees only its own."""
    return segments.player_rollup(scoped(matches, session), "puuid", "riot_id_game_name", "riot_id_tagline")


def patch_vs_rest(matches: DataFrame, solo_only: bool = True, min_games: int = 10, player: str | None = None) -> DataFrame:
    """Win rate of every patch against all other patches of the same player."""
    facts = solo(scoped(matches, player), solo_only).withColumn("version", short_version("game_version"))
    return compare.group_vs_rest(facts, ["version"], "win", min_games, within=["puuid"])


# --- ad-hoc tables --------------------------------------------------------------------

def matches_per_day(raw: DataFrame, player: str | None = None) -> DataFrame:
    counts = scoped(raw, player).groupBy("puuid", "year", "month", "day").agg(F.count(F.lit(1)).alias("n"))
    return segments.newest_day_first(counts)


def role_performance(matches: DataFrame, solo_only: bool = True, player: str | None = None) -> DataFrame:
    facts = with_role(solo(scoped(matches, player), solo_only), "team_position")
    return _by_games(segments.segment_stats(facts, ["puuid", "team_position"], [CS_PER_MIN, Metric("vision_score")], "win"), "team_position")


def early_phase(matches: DataFrame, solo_only: bool = True, player: str | None = None) -> DataFrame:
    facts = with_role(solo(scoped(matches, player), solo_only), "team_position")
    metrics = [Metric(m) for m in (
        "lane_minions_first10_minutes", "jungle_cs_before10_minutes", "turret_plates_taken", "max_cs_advantage_on_lane_opponent",
        "vision_score_advantage_lane_opponent", "total_time_spent_dead", "kill_participation")]
    return segments.early_phase(facts, ["puuid", "team_position"], metrics, "max_cs_advantage_on_lane_opponent")


def patch_performance(matches: DataFrame, solo_only: bool = True, min_games: int = 10, player: str | None = None) -> DataFrame:
    facts = solo(scoped(matches, player), solo_only)
    metrics = [Metric("kda"), Metric("damage_per_minute"), Metric("gold_per_minute")]
    return segments.newest_version_first(segments.by_version(facts, "game_version", metrics, "win", min_games, ["puuid"]))


def monthly_trend(matches: DataFrame, solo_only: bool = True, player: str | None = None) -> DataFrame:
    facts = solo(scoped(matches, player), solo_only)
    return segments.by_month(facts, "played_at", "kills", "deaths", "assists", "win", ["puuid"])


def peer_percentiles(peers: DataFrame, solo_only: bool = True, exact: bool = False) -> DataFrame:
    """Quartiles per role; by default from sketches, as ``exact`` needs a second pass."""
    facts = solo(peers, solo_only)
    columns, shares = ["cs_per_min", "kill_participation", "damage_per_minute", "vision_score_per_minute"], [0.25, 0.5, 0.75]
    if exact:
        return quantiles.exact_quantiles(facts, ["team_position"], columns, shares)
    return quantiles.approx_percentiles(facts, ["team_position"], columns, shares)


def peer_sizes(peers: DataFrame, solo_only: bool = True) -> DataFrame:
    """Observations and distinct players per role."""
    return solo(peers, solo_only).groupBy("team_position").agg(
        F.count(F.lit(1)).alias("observations"), F.count_distinct("puuid").alias("players"))


def player_and_peers(matches: DataFrame, peers: DataFrame, player: str, role: str, solo_only: bool = True) -> DataFrame:
    """Two summaries under each other: the player, and everybody else of the role."""
    own = with_role(solo(scoped(matches, player), solo_only), "team_position", role).withColumn("side", F.lit("player"))
    rest = with_role(solo(peers, solo_only), "team_position", role).where(F.col("puuid") != player)
    both = summarize(own, ["side"], PEER_METRICS).unionByName(
        summarize(rest.withColumn("side", F.lit("peers")), ["side"], on_peers(PEER_METRICS)))
    return both


def rival_coverage(matches: DataFrame) -> DataFrame:
    """How many matches of each queue carry the lane-rival metrics."""
    rival = ["max_cs_advantage_on_lane_opponent", "max_level_lead_lane_opponent", "vision_score_advantage_lane_opponent"]
    return coverage(matches, ["queue_id"], rival).withColumn("queue_name", queue_label("queue_id"))
