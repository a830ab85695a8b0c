"""Keyed state in tables: latest row, top rows, ranks, league cutoffs, processed ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from scrimlens.functions.expressions import bit_is_set, ranked_queue_label, share_pct
from scrimlens.operators.quantiles import exact_medians
from scrimlens.operators.sizes import settle, small_side

# The refresh age of a cutoff, the kept ids per key, the leagues and the tiers with a gap.
CUTOFF_MAX_AGE_SECONDS = 6 * 3600
KEPT_IDS = 100
LEAGUES = ("grandmaster", "challenger")
APEX_TIERS = ("MASTER", "GRANDMASTER", "CHALLENGER")


def latest_per_key(df: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """Newest row per key by ``max_by``, which combines on the map side."""
    rest = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*version)).alias("_row"))
    return newest.select(*keys, "_row.*")


def upsert(current: DataFrame, updates: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """Current state with newer rows put in place of older ones."""
    return latest_per_key(current.unionByName(updates), keys, version)


def patch(current: DataFrame, updates: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Replace only ``fields`` of the matching keys and add unknown keys; other fields stay as they are."""
    new = updates.select(*keys, *[F.col(f).alias(f"_new_{f}") for f in fields], F.lit(True).alias("_hit"))
    joined = current.join(new, list(keys), "full")
    return joined.select(*[
        F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c)
        for c in current.columns
    ])


def newest_per_entity(df: DataFrame, entity: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First k rows per entity. Spark limits every group before the shuffle, so a hot one stays small."""
    rank = F.row_number().over(Window.partitionBy(*entity).orderBy(*order))
    return df.withColumn("place", rank).where(F.col("place") <= k)


#: Bits of one bitmap of Spark's bitmap functions, bits for each chosen key, and bitmaps (of 4 KB) that are broadcast.
BLOCK_BITS, KEY_BITS, MOST_BITMAPS = 32_768, 16, 16_384


def likely_newest(rows: DataFrame, narrow: DataFrame, entity: Sequence[str], version: str, k: int, most_broadcast: int = MOST_BITMAPS) -> DataFrame:
    """Of many wide rows all that can be among the first k of their entity by falling ``version``, ties with the last one too, and
    about one of sixteen others; the exact choice is :func:`newest_per_entity` of what is left.

    ``narrow`` has entity and version of the rows to choose from and is all that is sorted and moved. The chosen pairs come back as
    bitmaps of their hashes. Where these are too many to be broadcast, every row is left to the exact choice.
    """
    pair = F.xxhash64(*entity, version)
    chosen = newest_per_entity(narrow.select(*entity, version), entity, [F.desc(version)], k)
    chosen = settle(chosen.select(pair.alias("_pair")).distinct())
    blocks = chosen.count() * KEY_BITS // BLOCK_BITS + 1
    if blocks > most_broadcast:
        return rows
    block = lambda h: F.pmod(h, F.lit(blocks))
    bit = lambda h: F.shiftrightunsigned(h, 40) % BLOCK_BITS
    bitmaps = chosen.groupBy(block(F.col("_pair")).alias("_block")).agg(F.bitmap_construct_agg(bit(F.col("_pair"))).alias("_bitmap"))
    found = rows.join(F.broadcast(bitmaps), block(pair) == F.col("_block")).where(bit_is_set("_bitmap", bit(pair)))
    return found.drop("_block", "_bitmap")


def placed(df: DataFrame, entity: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Add ``place``, from 1 on within each entity. For summaries: an entity's rows come to one task."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*entity).orderBy(*order)))


def processed_ids(known: DataFrame, new: DataFrame, key: str, item: str, keep: int = KEPT_IDS) -> DataFrame:
    """Union of known and new ids per key, cut to the last ``keep`` in text order."""
    union = known.select(key, item).union(new.select(key, item)).distinct()
    last = newest_per_entity(union, [key], [F.desc(item)], keep)
    return last.groupBy(key).agg(F.sort_array(F.collect_list(item)).alias("processed_ids"))


def rank_map(entries: DataFrame, entity: str = "puuid") -> DataFrame:
    """Rank entries (queue, tier, division, lp, wins, losses, updated_at) -> one map queue -> rank per entity."""
    latest = latest_per_key(entries.where(F.col("queue").isNotNull()), [entity, "queue"], ["updated_at"])
    rank = F.struct("tier", "division", "lp", "wins", "losses")
    return latest.groupBy(entity).agg(
        F.map_from_entries(F.collect_list(F.struct("queue", rank))).alias("ranks"),
        F.max("updated_at").alias("updated_at"),
    )


def rank_rows(state: DataFrame, entity: str = "puuid", preferred: str = "RANKED_SOLO_5x5") -> DataFrame:
    """One row per entity and ranked queue, with the season win rate; ``place`` puts the solo queue first."""
    rows = state.select(entity, "updated_at", F.explode("ranks").alias("queue", "_r"))
    zero = F.lit(0)
    wins, losses = F.coalesce("_r.wins", zero), F.coalesce("_r.losses", zero)
    return rows.select(
        entity, "queue", ranked_queue_label("queue").alias("queue_name"), "_r.tier", "_r.division",
        F.coalesce("_r.lp", zero).alias("lp"), wins.alias("wins"), losses.alias("losses"),
        share_pct(wins, F.nullif(wins + losses, zero)).alias("win_pct"),
        F.when(F.col("queue") == preferred, 0).otherwise(1).alias("place"), "updated_at",
    )


def league_cutoffs(entries: DataFrame, platform: str, league: str, points: str) -> DataFrame:
    """Per platform and league: lowest points (the cutoff), seats, upper median."""
    scored = entries.where(F.col(points).isNotNull())
    sizes = scored.groupBy(platform, league).agg(F.min(points).alias("cutoff"), F.count(points).alias("seats"))
    return sizes.join(exact_medians(scored, [platform, league], points, upper=True).drop("n"), [platform, league])


def stale_keys(current: DataFrame, wanted: DataFrame, key: str, now: Column, updated: str = "updated_at",
               max_age: int = CUTOFF_MAX_AGE_SECONDS) -> DataFrame:
    """Wanted keys that have no stored value, or one at least ``max_age`` seconds old."""
    fresh = current.where(now - F.col(updated) < max_age)
    return wanted.select(key).distinct().join(fresh, key, "left_anti")


def refresh_cutoffs(current: DataFrame, entries: DataFrame, now: Column, platform: str, league: str, points: str,
                    max_age: int = CUTOFF_MAX_AGE_SECONDS) -> DataFrame:
    """One run of the cutoff job: platforms whose stored cutoffs are stale or missing are computed anew from the entries, and only
    their rows are replaced. ``current`` has platform, league, cutoff, seats, median, updated_at."""
    stale = small_side(stale_keys(current.select(platform, "updated_at").distinct(), entries, platform, now, max_age=max_age))
    fresh = league_cutoffs(entries.join(stale, platform, "left_semi"), platform, league, points).withColumn("updated_at", now)
    return current.join(stale, platform, "left_anti").unionByName(fresh.select(*current.columns))


def cutoff_gaps(players: DataFrame, cutoffs: DataFrame, platform: str, tier: str, points: str) -> DataFrame:
    """Every player against every league of its platform; the gap exists only from the apex tiers on. A platform without cutoffs
    yet gives one row with neither league nor gap."""
    in_apex = F.upper(tier).isin(*APEX_TIERS)
    gap = F.greatest(F.col("cutoff") - F.coalesce(points, F.lit(0)), F.lit(0))
    gap = F.when(F.col("cutoff").isNotNull(), gap)
    return players.join(small_side(cutoffs), platform, "left").withColumn("missing", F.when(in_apex, gap))


def season_record(df: DataFrame, by: Sequence[str], won: Column, lost: Column) -> DataFrame:
    """Wins, losses and win rate; NULL when nothing was decided."""
    counts = df.groupBy(*by).agg(F.count(F.when(won, 1)).alias("wins"), F.count(F.when(lost, 1)).alias("losses"))
    total = F.nullif(F.col("wins") + F.col("losses"), F.lit(0))
    return counts.withColumn("win_pct", share_pct(F.col("wins"), total))
