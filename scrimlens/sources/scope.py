"""Who may see what, and which entity a request means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from scrimlens.functions.expressions import column

PUUID = r"^[A-Za-z0-9_-]{70,90}$"


def scoped(df: DataFrame, session_id: str | None, entity: str = "puuid") -> DataFrame:
    """With a session every read is limited to that session's entity, whatever else was asked for."""
    return df if session_id is None else df.where(F.col(entity) == session_id)


def effective_entity(session: Column | str, requested: Column | str) -> Column:
    """The same rule for requests in a table: the session wins over the requested entity."""
    return F.coalesce(column(session), column(requested))


def resolve_entities(
    requests: DataFrame, players: DataFrame, request: str = "player", entity: str = "puuid",
    name: str = "game_name", riot_id: str = "riot_id", session: str | None = None,
) -> DataFrame:
    """Add ``resolved`` (entity id or NULL) and ``resolution`` to every request.

    A session wins; a raw id is taken as it is; otherwise the full ``name#tag`` or
    the bare name decides, ignoring case. A name several players share goes to
    the smallest id. An empty request is allowed only when there is one player.
    """
    names = players.select(
        F.explode(F.array(F.lower(riot_id), F.lower(name))).alias("_key"), F.col(entity).cast("string").alias("_id"))
    lookup = names.groupBy("_key").agg(F.min("_id").alias("_id"), F.count_distinct("_id").alias("_owners"))
    # The empty request is one more key, present only when there is a single player.
    only = players.agg(F.count(F.lit(1)).alias("_owners"), F.min(entity).cast("string").alias("_id")).where(
        F.col("_owners") == 1).select(F.lit("").alias("_key"), "_id", "_owners")
    asked = F.col(request)
    keyed = requests.withColumn("_key", F.coalesce(F.lower(asked), F.lit("")))
    found = keyed.join(lookup.where(F.col("_key") != "").unionByName(only), "_key", "left")
    by_session = F.col(session).cast("string") if session else F.lit(None).cast("string")
    raw_id = F.coalesce(asked.rlike(PUUID), F.lit(False))
    resolved = F.when(by_session.isNotNull(), by_session).when(raw_id, asked).otherwise(F.col("_id"))
    how = (
        F.when(by_session.isNotNull(), "session").when(raw_id, "raw_id")
        .when(asked.isNull(), F.when(F.col("_id").isNull(), "ambiguous_request").otherwise("only_player"))
        .when(F.col("_id").isNull(), "unknown").when(F.col("_owners") > 1, "shared_name").otherwise("name")
    )
    return found.withColumns({"resolved": resolved, "resolution": how}).drop("_key", "_id", "_owners")


def with_user(requests: DataFrame, users: DataFrame, token: str = "token", entity: str = "puuid") -> DataFrame:
    """Requests with their user; ``known`` is false for a token without one."""
    owners = users.where(F.col(entity).isNotNull()).select(token, entity).dropDuplicates([token])
    return requests.join(owners, token, "left").withColumn("known", F.col(entity).isNotNull())
