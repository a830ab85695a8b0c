"""Small column helpers shared by the jobs. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"

# Readable names of the queue ids and of the ranked queue keys.
QUEUE_NAMES = {
    400: "normal draft", 420: "ranked solo/duo", 430: "normal blind", 440: "ranked flex",
    450: "ARAM", 900: "URF", 1700: "Arena", 1710: "Arena", 1750: "Arena",
}
RANKED_QUEUE_NAMES = {"RANKED_SOLO_5x5": "ranked solo/duo", "RANKED_FLEX_SR": "ranked flex"}


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bit_is_set(bitmap: Column | str, position: Column) -> Column:
    """Whether a bitmap of Spark's bitmap aggregates has the bit at this position."""
    byte = F.conv(F.hex(F.substring(bitmap, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    return F.getbit(byte, (position % 8).cast("int")) == 1


#: The largest double below one half: added to a number just below a half it stays below one, added to a half it gives one.
_BELOW_HALF = 0.49999999999999994


def rounded_int(value: Column) -> Column:
    """Nearest integer of a double, halves away from zero (a plain cast would cut 2.7 to 2). Two additions and a cast, as ``round``
    would make a decimal of each of a row's sixty numbers."""
    half = F.lit(_BELOW_HALF)
    return F.when(value < 0, value - half).otherwise(value + half).try_cast("int")


def played_at(epoch_ms: Column | str) -> Column:
    """UTC wall time of an epoch-millisecond value, independent of the session zone, whole seconds."""
    seconds = F.floor(column(epoch_ms) / F.lit(1000)).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.expr(EPOCH) + F.make_dt_interval(zero, zero, zero, seconds)


def epoch_seconds(ts: Column | str) -> Column:
    """Whole epoch seconds of a zone-less timestamp read as UTC."""
    ts = column(ts)
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def minutes_of(duration_seconds: Column | str) -> Column:
    """Length in minutes with one decimal, as a double."""
    return F.round(column(duration_seconds) / F.lit(60.0), 1)


def date_keys(ts: Column | str) -> list[Column]:
    """Text partition keys year, month, day of a timestamp."""
    ts = column(ts)
    return [
        F.lpad(F.year(ts).cast("string"), 4, "0").alias("year"),
        F.lpad(F.month(ts).cast("string"), 2, "0").alias("month"),
        F.lpad(F.dayofmonth(ts).cast("string"), 2, "0").alias("day"),
    ]


def label(code: Column | str, names: dict, fallback: Column) -> Column:
    """Name of a code, or the fallback for an unknown one."""
    pairs = [F.lit(x) for item in sorted(names.items()) for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), column(code)), fallback)


def queue_label(queue_id: Column | str) -> Column:
    queue_id = column(queue_id).cast("int")
    return label(queue_id, QUEUE_NAMES, F.concat(F.lit("queue "), queue_id.cast("string")))


def ranked_queue_label(queue: Column | str) -> Column:
    return label(queue, RANKED_QUEUE_NAMES, column(queue))


def platform_of(match_id: Column | str) -> Column:
    """Lower-case prefix before the first underscore; NULL if either side of it is empty."""
    return F.nullif(F.regexp_extract(F.lower(column(match_id)), r"(?s)^([^_]+)_.+$", 1), F.lit(""))


def riot_id(name: Column | str, tag: Column | str) -> Column:
    """``name#tag`` with ``?`` for a missing or empty part."""
    def shown(c: Column | str) -> Column:
        return F.coalesce(F.nullif(column(c), F.lit("")), F.lit("?"))
    return F.concat_ws("#", shown(name), shown(tag))


def short_version(version: Column | str) -> Column:
    """``16.17.5`` -> ``16.17``; NULL when the text does not start like a version."""
    return F.nullif(F.regexp_extract(column(version), r"^(\d+\.\d+)", 1), F.lit(""))


def version_number(short: Column | str, part: int) -> Column:
    """Numeric part (1 = major, 2 = minor), because 16.9 sorts before 16.17."""
    return F.split_part(column(short), F.lit("."), F.lit(part)).try_cast("int")


def share_pct(hits: Column, total: Column) -> Column:
    """Percentage, NULL for an empty group."""
    return F.try_divide(F.lit(100.0) * hits, total)


def kda_ratio(kills: Column, assists: Column, deaths: Column) -> Column:
    return F.try_divide(kills + assists, deaths)
