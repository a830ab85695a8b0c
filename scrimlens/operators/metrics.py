"""Metric catalogues: what is compared, in which direction, and how."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

HIGHER, LOWER, NEUTRAL = "higher", "lower", "neutral"
MEAN, SHARE = "mean", "share"


@dataclass(frozen=True)
class Metric:
    """``source`` is a SQL expression over the fact row; by default the column of the same name."""

    name: str
    sense: str = HIGHER
    kind: str = MEAN
    source: str | None = None

    def value(self) -> Column:
        source = F.expr(self.source or f"`{self.name}`")
        return source.cast("double") if self.kind == MEAN else source.cast("boolean")


def _metrics(*entries: str | Metric) -> list[Metric]:
    return [e if isinstance(e, Metric) else Metric(e) for e in entries]


CS_PER_MIN = Metric("cs_per_min", source="cast(cs as double) / nullif(duration_min, 0)")
DURATION = Metric("duration_min", NEUTRAL)
DEATHS, TIME_DEAD = Metric("deaths", LOWER), Metric("total_time_spent_dead", LOWER)

# The metrics of each report and their good direction.
TREND_METRICS = _metrics(
    "kda", "kill_participation", "kills", DEATHS, "assists", Metric("deaths_by_enemy_champs", LOWER),
    "solo_kills", CS_PER_MIN, "gold_per_minute", "damage_per_minute", "team_damage_percentage",
    "lane_minions_first10_minutes", "jungle_cs_before10_minutes", "turret_plates_taken",
    "max_cs_advantage_on_lane_opponent", "max_level_lead_lane_opponent",
    "vision_score_advantage_lane_opponent", "vision_score_per_minute", "control_wards_placed",
    "wards_killed", TIME_DEAD, DURATION,
)
OUTCOME_METRICS = _metrics(
    "lane_minions_first10_minutes", "jungle_cs_before10_minutes", "max_cs_advantage_on_lane_opponent",
    Metric("first_blood_kill", kind=SHARE),
    "dragon_takedowns", "baron_takedowns", "rift_herald_takedowns", "turret_takedowns",
    "turret_plates_taken", Metric("first_tower_kill", kind=SHARE), "damage_dealt_to_objectives",
    "kill_participation", "kda", DEATHS, "solo_kills", "team_damage_percentage",
    "gold_per_minute", "damage_per_minute", CS_PER_MIN, TIME_DEAD, "vision_score_per_minute",
    "control_wards_placed", DURATION,
)
PEER_METRICS = _metrics(
    "kda", "kill_participation", "team_damage_percentage", CS_PER_MIN, "gold_per_minute",
    "damage_per_minute", "vision_score_per_minute", "lane_minions_first10_minutes",
    "jungle_cs_before10_minutes", "turret_plates_taken", "max_cs_advantage_on_lane_opponent",
    "vision_score_advantage_lane_opponent", "control_wards_placed", "wards_killed", DEATHS,
    TIME_DEAD, "solo_kills",
)


def on_peers(metrics: list[Metric]) -> list[Metric]:
    """The same metrics over the peer table, which stores the derived ones as columns."""
    return [Metric(m.name, m.sense, m.kind) for m in metrics]
