"""Schemas of the raw documents and of the curated tables.

Curated columns are named after the JSON leaf in snake case, so the leaf lists
below are the only mapping there is.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import types as T

STRING, DOUBLE, INT, BOOL = "string", "double", "int", "boolean"


def snake(leaf: str) -> str:
    """``challenges.maxKillDeficit`` -> ``max_kill_deficit``."""
    return re.sub(r"(?<=[a-z0-9])([A-Z])", r"_\1", leaf.split(".")[-1]).lower()


# Fields of one participant that the curated match table keeps,
# with the stored type. Every number is read as double and rounded afterwards.
MATCH_LEAVES = [
    ("riotIdGameName", STRING), ("riotIdTagline", STRING), ("championName", STRING),
    ("teamPosition", STRING), ("win", BOOL),
    ("kills", INT), ("deaths", INT), ("assists", INT),
    ("goldEarned", INT), ("totalDamageDealtToChampions", INT), ("visionScore", INT),
    ("challenges.kda", DOUBLE), ("challenges.killParticipation", DOUBLE),
    ("challenges.teamDamagePercentage", DOUBLE), ("challenges.damageTakenOnTeamPercentage", DOUBLE),
    ("challenges.damagePerMinute", DOUBLE), ("challenges.goldPerMinute", DOUBLE),
    ("challenges.visionScorePerMinute", DOUBLE),
    ("challenges.laneMinionsFirst10Minutes", INT), ("challenges.jungleCsBefore10Minutes", INT),
    ("challenges.maxCsAdvantageOnLaneOpponent", DOUBLE), ("challenges.maxLevelLeadLaneOpponent", INT),
    ("challenges.visionScoreAdvantageLaneOpponent", DOUBLE),
    ("challenges.laningPhaseGoldExpAdvantage", INT), ("challenges.earlyLaningPhaseGoldExpAdvantage", INT),
    ("challenges.turretPlatesTaken", INT), ("challenges.takedownsFirstXMinutes", INT),
    ("challenges.takedowns", INT), ("challenges.soloKills", INT), ("challenges.outnumberedKills", INT),
    ("challenges.skillshotsDodged", INT), ("challenges.skillshotsHit", INT),
    ("challenges.enemyChampionImmobilizations", INT), ("challenges.killsNearEnemyTurret", INT),
    ("challenges.killsUnderOwnTurret", INT), ("challenges.multikills", INT),
    ("challenges.deathsByEnemyChamps", INT), ("challenges.maxKillDeficit", INT),
    ("challenges.survivedSingleDigitHpCount", INT),
    ("wardsPlaced", INT), ("wardsKilled", INT), ("challenges.controlWardsPlaced", INT),
    ("challenges.stealthWardsPlaced", INT), ("detectorWardsPlaced", INT),
    ("challenges.wardTakedowns", INT), ("challenges.wardTakedownsBefore20M", INT),
    ("challenges.wardsGuarded", INT),
    ("challenges.dragonTakedowns", INT), ("challenges.baronTakedowns", INT),
    ("challenges.riftHeraldTakedowns", INT), ("turretTakedowns", INT), ("turretKills", INT),
    ("inhibitorTakedowns", INT), ("challenges.scuttleCrabKills", INT),
    ("challenges.epicMonsterSteals", INT), ("challenges.alliedJungleMonsterKills", INT),
    ("challenges.enemyJungleMonsterKills", INT), ("damageDealtToObjectives", INT),
    ("damageDealtToTurrets", INT), ("firstBloodKill", BOOL), ("firstTowerKill", BOOL),
    ("totalTimeSpentDead", INT), ("longestTimeSpentLiving", INT), ("damageSelfMitigated", INT),
    ("totalDamageTaken", INT), ("totalHeal", INT), ("totalHealsOnTeammates", INT),
    ("totalDamageShieldedOnTeammates", INT), ("challenges.effectiveHealAndShielding", INT),
    ("timeCCingOthers", DOUBLE), ("champLevel", INT), ("goldSpent", INT), ("itemsPurchased", INT),
    ("summoner1Id", INT), ("summoner2Id", INT), ("individualPosition", STRING),
    ("gameEndedInSurrender", BOOL),
]

# Fields of one participant that the peer table keeps.
PEER_LEAVES = [
    ("championName", STRING), ("win", BOOL), ("kills", INT), ("deaths", INT), ("assists", INT),
    ("challenges.kda", DOUBLE), ("challenges.killParticipation", DOUBLE),
    ("challenges.teamDamagePercentage", DOUBLE), ("challenges.damagePerMinute", DOUBLE),
    ("challenges.goldPerMinute", DOUBLE), ("challenges.visionScorePerMinute", DOUBLE),
    ("challenges.laneMinionsFirst10Minutes", INT), ("challenges.jungleCsBefore10Minutes", INT),
    ("challenges.turretPlatesTaken", INT), ("challenges.maxCsAdvantageOnLaneOpponent", DOUBLE),
    ("challenges.visionScoreAdvantageLaneOpponent", DOUBLE), ("challenges.controlWardsPlaced", INT),
    ("wardsKilled", INT), ("totalTimeSpentDead", INT), ("challenges.soloKills", INT),
    ("challenges.deathsByEnemyChamps", INT), ("teamPosition", STRING),
]

# Read but stored only inside a derived column (``cs``, ``cs_per_min``) or as a key.
_EXTRA_LEAVES = [("puuid", STRING), ("totalMinionsKilled", INT), ("neutralMinionsKilled", INT)]

_SPARK_TYPES = {STRING: T.StringType(), BOOL: T.BooleanType(), INT: T.DoubleType(), DOUBLE: T.DoubleType()}


def _participant() -> T.StructType:
    leaves = list(dict.fromkeys(_EXTRA_LEAVES + MATCH_LEAVES + PEER_LEAVES))
    own = [T.StructField(p, _SPARK_TYPES[t]) for p, t in leaves if "." not in p]
    nested = [T.StructField(p.split(".")[1], _SPARK_TYPES[t]) for p, t in leaves if "." in p]
    return T.StructType(own + [T.StructField("challenges", T.StructType(nested))])


PARTICIPANT = _participant()

MATCH_DOCUMENT = T.StructType([
    T.StructField("metadata", T.StructType([T.StructField("matchId", T.StringType())])),
    T.StructField("info", T.StructType([
        T.StructField("gameCreation", T.LongType()),
        T.StructField("gameDuration", T.LongType()),
        T.StructField("gameMode", T.StringType()),
        T.StructField("queueId", T.IntegerType()),
        T.StructField("gameVersion", T.StringType()),
        T.StructField("participants", T.ArrayType(PARTICIPANT)),
    ])),
])



def document_of(columns: Iterable[str]) -> T.StructType:
    """The part of a match document that some curated columns are made of; ids and roles are always in it."""
    columns = set(columns)
    named = {"puuid", "teamPosition", *(("totalMinionsKilled", "neutralMinionsKilled") if columns & {"cs", "cs_per_min"} else ())}
    wanted = lambda fields: [f for f in fields if f.name in named or snake(f.name) in columns]
    nested = wanted(PARTICIPANT["challenges"].dataType)
    participant = T.StructType(wanted(f for f in PARTICIPANT if f.name != "challenges"))
    if nested:
        participant = participant.add("challenges", T.StructType(nested))
    return T.StructType([T.StructField("info", T.StructType([
        MATCH_DOCUMENT["info"].dataType["gameVersion"], T.StructField("participants", T.ArrayType(participant))]))])


# The fields that are lifted out of a document on landing; the parser skips everything else.
MATCH_HEADER = T.StructType([
    MATCH_DOCUMENT["metadata"],
    T.StructField("info", T.StructType([
        f for f in MATCH_DOCUMENT["info"].dataType if f.name not in ("gameVersion", "participants")
    ])),
])

_PLAYER_FRAME = T.StructType([
    T.StructField(name, T.DoubleType())
    for name in ("totalGold", "xp", "minionsKilled", "jungleMinionsKilled", "level")
])

TIMELINE_DOCUMENT = T.StructType([
    T.StructField("info", T.StructType([
        T.StructField("participants", T.ArrayType(T.StructType([
            T.StructField("participantId", T.IntegerType()),
            T.StructField("puuid", T.StringType()),
        ]))),
        T.StructField("frames", T.ArrayType(T.StructType([
            T.StructField("timestamp", T.LongType()),
            T.StructField("participantFrames", T.MapType(T.StringType(), _PLAYER_FRAME)),
        ]))),
    ])),
])

# Partition keys are text on purpose: month "09" must not turn into 9.
_PARTITION_KEYS = [T.StructField(k, T.StringType()) for k in ("puuid", "year", "month", "day")]

RAW_MATCH = T.StructType([
    T.StructField("match_id", T.StringType()),
    T.StructField("game_creation", T.LongType()),
    T.StructField("game_duration", T.LongType()),
    T.StructField("game_mode", T.StringType()),
    T.StructField("queue_id", T.IntegerType()),
    T.StructField("ingested_at", T.StringType()),
    T.StructField("payload", T.StringType()),
    *_PARTITION_KEYS,
])

RAW_TIMELINE = T.StructType([
    T.StructField("match_id", T.StringType()),
    T.StructField("ingested_at", T.StringType()),
    T.StructField("payload", T.StringType()),
    *_PARTITION_KEYS,
])


def _stored(name: str, kind: str) -> T.StructField:
    types = {STRING: T.StringType(), BOOL: T.BooleanType(), INT: T.IntegerType(), DOUBLE: T.DoubleType()}
    return T.StructField(name, types[kind])


_LEAF_NAMES = [snake(p) for p, _ in MATCH_LEAVES]
_AFTER_ASSISTS = _LEAF_NAMES.index("assists") + 1
_MATCH_FIELDS = [_stored(snake(p), t) for p, t in MATCH_LEAVES]

CURATED_MATCH = T.StructType([
    T.StructField("match_id", T.StringType()),
    T.StructField("played_at", T.TimestampNTZType()),
    T.StructField("queue_id", T.IntegerType()),
    T.StructField("duration_min", T.DoubleType()),
    *_MATCH_FIELDS[:_AFTER_ASSISTS],
    T.StructField("cs", T.IntegerType()),
    *_MATCH_FIELDS[_AFTER_ASSISTS:],
    T.StructField("game_version", T.StringType()),
    T.StructField("puuid", T.StringType()),
])

CURATED_PEER = T.StructType([
    T.StructField("match_id", T.StringType()),
    T.StructField("puuid", T.StringType()),
    T.StructField("played_at", T.TimestampNTZType()),
    T.StructField("queue_id", T.IntegerType()),
    T.StructField("duration_min", T.DoubleType()),
    T.StructField("cs_per_min", T.DoubleType()),
    *[_stored(snake(p), t) for p, t in PEER_LEAVES],
])

TIMELINE_FRAME = T.StructType([
    T.StructField("match_id", T.StringType()),
    T.StructField("minute", T.IntegerType()),
    T.StructField("team_position", T.StringType()),
    T.StructField("champion_name", T.StringType()),
    T.StructField("win", T.BooleanType()),
    *[T.StructField(n, T.IntegerType()) for n in (
        "gold", "xp", "cs", "level", "gold_rival", "xp_rival", "cs_rival", "level_rival",
        "diff_gold", "diff_xp", "diff_cs")],
    T.StructField("puuid", T.StringType()),
])

RATING_POINT = T.StructType([
    T.StructField("puuid", T.StringType()),
    T.StructField("moment", T.LongType()),
    T.StructField("lp", T.IntegerType()),
    T.StructField("tier", T.StringType()),
    T.StructField("division", T.StringType()),
    T.StructField("wins", T.IntegerType()),
    T.StructField("losses", T.IntegerType()),
])

RANK_STATE = T.StructType([
    T.StructField("puuid", T.StringType()),
    T.StructField("ranks", T.MapType(T.StringType(), T.StructType([
        T.StructField("tier", T.StringType()),
        T.StructField("division", T.StringType()),
        T.StructField("lp", T.IntegerType()),
        T.StructField("wins", T.IntegerType()),
        T.StructField("losses", T.IntegerType()),
    ]))),
    T.StructField("updated_at", T.LongType()),
])

REQUEST_LOG = T.StructType([
    T.StructField("at", T.TimestampType()),
    T.StructField("token", T.StringType()),
    T.StructField("riot_id", T.StringType()),
    T.StructField("body", T.StringType()),
])
