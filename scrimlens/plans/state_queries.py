"""Series, keyed state, backlog and request reports on the driver tables, each with its oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from scrimlens.functions.expressions import date_keys, epoch_seconds, queue_label
from scrimlens.functions.filters import from_day, moment
from scrimlens.operators import backlog, series, state
from scrimlens.plans.tables import EVENTS_AS_OF, shown, sql_shown, table, work_folder
from scrimlens.sources import requests, scope
from scrimlens.sources.readers import read_raw
from scrimlens.sources.writers import append_raw


def change_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders where a customer's status differs from the order before, series cut by month."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    months = [F.year("o_orderdate") * 12 + F.month("o_orderdate")]
    return series.change_points(orders, "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderstatus"], months)


# --- rating series made of events ---------------------------------------------------

def rating_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as rating points: weeks are tiers, days count wins, 36-hour steps count losses."""
    day = F.dayofmonth("ts") - 1
    hours = day * 24 + F.hour("ts")
    return table(spark, sf_dir, "events").select(
        "user_id", epoch_seconds("ts").alias("moment"), "event_id", F.round("value").cast("int").alias("lp"),
        F.concat(F.lit("T"), F.floor(day / 7).cast("string")).alias("tier"),
        F.concat(F.lit("D"), F.floor(day / 4).cast("string")).alias("division"),
        day.cast("int").alias("wins"), F.floor(hours / 36).cast("int").alias("losses"))


def _deltas(points: DataFrame) -> DataFrame:
    return series.rating_deltas(points, "user_id", ["moment", "event_id"], [series.by_epoch_day("moment")])


def delta_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every step of every rating series: gain, loss, ambiguous, reset or nothing."""
    return _deltas(rating_points(spark, sf_dir)).select("user_id", "event_id", "kind", "amount")


def rating_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = rating_points(spark, sf_dir)
    return series.rating_progress(points, _deltas(points), "user_id").select(
        "user_id", "points", "gains", "losses", "ambiguous", shown("gain_median", 1).alias("gain_median"),
        shown("loss_median", 1).alias("loss_median"), "bonus_gains", "measurable")


def bonus_gains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.bonus_gains(_deltas(rating_points(spark, sf_dir)), "user_id")


_SQL_DELTAS = """p AS (SELECT user_id, event_id, ts, CAST(floor(value + 0.5) AS INTEGER) AS lp,
    'T' || ((day(ts) - 1) // 7) AS tier, 'D' || ((day(ts) - 1) // 4) AS division, day(ts) - 1 AS wins,
    ((day(ts) - 1) * 24 + hour(ts)) // 36 AS losses FROM events),
l AS (SELECT *, lag(lp) OVER w AS lp0, lag(tier) OVER w AS tier0, lag(division) OVER w AS division0,
    lag(wins) OVER w AS wins0, lag(losses) OVER w AS losses0 FROM p
    WINDOW w AS (PARTITION BY user_id ORDER BY date_trunc('second', ts), event_id)),
k AS (SELECT user_id, event_id, lp - lp0 AS moved, CASE WHEN tier <> tier0 OR division <> division0 THEN 'reset'
    WHEN wins - wins0 = 1 AND losses = losses0 THEN 'gain' WHEN losses - losses0 = 1 AND wins = wins0 THEN 'loss'
    WHEN wins - wins0 + losses - losses0 > 1 THEN 'ambiguous' ELSE 'none' END AS kind FROM l WHERE lp0 IS NOT NULL),
deltas AS (SELECT user_id, event_id, kind, CASE kind WHEN 'gain' THEN moved WHEN 'loss' THEN -moved END AS amount FROM k),
medians AS (SELECT user_id, median(amount) FILTER (kind = 'gain') AS gain_median,
    median(amount) FILTER (kind = 'loss') AS loss_median, count(*) FILTER (kind = 'gain') AS gains,
    count(*) FILTER (kind = 'loss') AS losses, count(*) FILTER (kind = 'ambiguous') AS ambiguous FROM deltas GROUP BY 1),
bonus AS (SELECT d.user_id, d.amount, count(*) AS times FROM deltas d JOIN medians m USING (user_id)
    WHERE kind = 'gain' AND gain_median <> 0 AND amount >= gain_median * 1.7e0 GROUP BY 1, 2)"""


# --- keyed state --------------------------------------------------------------------

def latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last event per user, after an upsert of the late half over the early half."""
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    cut = moment(EVENTS_AS_OF, 15)
    order = ["ts", "event_id"]
    current = state.latest_per_key(events.where(F.col("ts") < cut), ["user_id"], order)
    return state.upsert(current, events.where(F.col("ts") >= cut), ["user_id"], order)


def cutoff_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers against the league cutoffs of their segment; balances stand in for points."""
    who = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    league = F.when(F.col("c_acctbal") >= 8000, "challenger").when(F.col("c_acctbal") >= 6000, "grandmaster")
    entries = who.withColumn("league", league).where(F.col("league").isNotNull())
    cutoffs = state.league_cutoffs(entries, "c_mktsegment", "league", "c_acctbal")
    tier = F.when(F.col("c_acctbal") >= 4000, F.coalesce(league, F.lit("master"))).otherwise("diamond")
    gaps = state.cutoff_gaps(who.withColumn("tier", tier), cutoffs, "c_mktsegment", "tier", "c_acctbal")
    return gaps.select("c_custkey", "c_mktsegment", "tier", "league", shown("cutoff", 2).alias("cutoff"), "seats",
                       shown("median", 2).alias("median"), shown("missing", 2).alias("missing"))


_SQL_CUTOFF = f"""WITH e AS (SELECT *, CASE WHEN c_acctbal >= 8000 THEN 'challenger' WHEN c_acctbal >= 6000 THEN 'grandmaster' END AS league FROM customer),
o AS (SELECT *, row_number() OVER (PARTITION BY c_mktsegment, league ORDER BY c_acctbal) - 1 AS i,
  count(*) OVER (PARTITION BY c_mktsegment, league) AS seats FROM e WHERE league IS NOT NULL),
c AS (SELECT c_mktsegment, league, min(c_acctbal) AS cutoff, max(seats) AS seats,
  max(CASE WHEN i = seats // 2 THEN c_acctbal END) AS median FROM o GROUP BY 1, 2),
t AS (SELECT *, CASE WHEN c_acctbal >= 4000 THEN coalesce(league, 'master') ELSE 'diamond' END AS tier FROM e)
SELECT t.c_custkey, t.c_mktsegment, t.tier, c.league, {sql_shown('c.cutoff', 2)} AS cutoff, c.seats,
  {sql_shown('c.median', 2)} AS median,
  {sql_shown("CASE WHEN t.tier <> 'diamond' THEN greatest(c.cutoff - t.c_acctbal, 0) END", 2)} AS missing
FROM t LEFT JOIN c USING (c_mktsegment)"""


def stale_cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users whose last event is six hours old or older, seen from the end of the data."""
    events = table(spark, sf_dir, "events")
    stored = events.groupBy("user_id").agg(F.max(epoch_seconds("ts")).alias("updated_at"))
    now = epoch_seconds(F.lit("2024-01-30 23:00:00").cast("timestamp_ntz"))
    return state.stale_keys(stored, events, "user_id", now)


def rank_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Season record per customer and queue; priorities stand in for queues, some of them unnamed."""
    orders = table(spark, sf_dir, "orders")
    number = F.substring("o_orderpriority", 1, 1).cast("int")
    queue = F.when(number == 1, 420).when(number == 2, 440).when(number == 3, 450).otherwise(number)
    status = F.col("o_orderstatus")
    record = state.season_record(orders.withColumn("queue", queue), ["o_custkey", "queue"], status == "F", status == "O")
    return record.select(
        "o_custkey", "queue", queue_label("queue").alias("queue_name"), "wins", "losses",
        shown("win_pct", 1).alias("win_pct"), F.when(F.col("queue") == 420, 0).otherwise(1).alias("place"))


def rank_map_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest rank per user and queue folded into one map per user and unfolded again."""
    day, half = F.dayofmonth("ts"), F.hour("ts")
    queue = F.when(F.col("event_type") == "click", "RANKED_SOLO_5x5").when(F.col("event_type") == "view", "RANKED_FLEX_SR")
    entries = table(spark, sf_dir, "events").select(
        "user_id", F.coalesce(queue, F.col("event_type")).alias("queue"), F.concat(F.lit("T"), day.cast("string")).alias("tier"),
        F.lit("I").alias("division"), F.round("value").cast("int").alias("lp"), day.alias("wins"), half.alias("losses"),
        F.col("event_id").alias("updated_at"))
    return state.rank_rows(state.rank_map(entries, "user_id"), "user_id").select(
        "user_id", "queue", "queue_name", "tier", "lp", "wins", "losses", shown("win_pct", 1).alias("win_pct"), "place")


_SQL_RANK_MAP = f"""WITH e AS (SELECT *, CASE event_type WHEN 'click' THEN 'RANKED_SOLO_5x5' WHEN 'view' THEN 'RANKED_FLEX_SR'
  ELSE event_type END AS queue FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1)
SELECT user_id, queue, CASE queue WHEN 'RANKED_SOLO_5x5' THEN 'ranked solo/duo' WHEN 'RANKED_FLEX_SR' THEN 'ranked flex' ELSE queue END AS queue_name,
  'T' || day(ts) AS tier, CAST(floor(value + 0.5) AS INTEGER) AS lp, CAST(day(ts) AS INTEGER) AS wins, CAST(hour(ts) AS INTEGER) AS losses,
  {sql_shown('100.0e0 * day(ts) / nullif(day(ts) + hour(ts), 0)', 1)} AS win_pct,
  CAST(CASE queue WHEN 'RANKED_SOLO_5x5' THEN 0 ELSE 1 END AS INTEGER) AS place FROM e"""


def recent_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five newest orders of every customer."""
    orders = table(spark, sf_dir, "orders")
    newest = state.newest_per_entity(orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], 5)
    number = F.substring("o_orderpriority", 1, 1).cast("int")
    return newest.select(
        "o_custkey", "o_orderkey", "o_orderdate", shown("o_totalprice", 1).alias("price"),
        (F.col("o_orderstatus") == "F").alias("win"), F.col("place").cast("bigint").alias("place"),
        queue_label(F.when(number == 1, 420).otherwise(number)).alias("queue_name"))


# --- backlog ------------------------------------------------------------------------

def pending_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next 60 orders, newest key first, that no line item refers to."""
    wanted = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"))
    done = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"))
    return backlog.next_batch(backlog.pending(wanted, done, ["key"]), [F.desc("key")], 60)


def pending_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole backlog."""
    wanted = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"))
    done = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"))
    return backlog.pending(wanted, done, ["key"])


def _early_and_page(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    return events.where(F.col("ts") < moment(EVENTS_AS_OF, 12)), events


def known_new_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known rows of a page of ids, and the first ten new ones per user."""
    processed, page = _early_and_page(spark, sf_dir)
    known, new = backlog.split_known(page, processed, ["user_id", "event_id"])
    admitted = backlog.admit(new, ["user_id"], [F.desc("ts"), F.desc("event_id")], 10)
    return known.select("user_id", "event_id", F.lit("known").alias("state")).unionByName(
        admitted.select("user_id", "event_id", F.lit("admitted").alias("state")))


def processed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last hundred ids per user in text order after a batch was added."""
    known, page = _early_and_page(spark, sf_dir)
    text = F.concat(F.lit("EV_"), F.col("event_id").cast("string"))
    as_text = lambda df: df.select("user_id", text.alias("id"))
    ids = state.processed_ids(as_text(known), as_text(page), "user_id", "id")
    return ids.select("user_id", F.array_join("processed_ids", ",").alias("processed_ids"))


def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New, existing and failed items per user."""
    kind = F.when(F.col("event_type") == "error", "error").when(F.col("value") > 50, "new").otherwise("existing")
    return backlog.run_report(table(spark, sf_dir, "events").withColumn("result", kind), ["user_id"])


# --- requests -----------------------------------------------------------------------

def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request bodies made of events, some of them not JSON, read back into method, tool and arguments."""
    kind = F.col("event_type")
    call = F.to_json(F.struct(
        F.lit("2.0").alias("jsonrpc"), F.lit("tools/call").alias("method"),
        F.struct(F.concat(F.lit("get_"), kind).alias("name"), F.from_json("props", "map<string,int>").alias("arguments")).alias("params")))
    listing = F.to_json(F.struct(F.lit("tools/list").alias("method"), F.struct(kind.alias("name")).alias("params")))
    body = (F.when(kind == "error", F.concat(F.lit("{broken "), "props")).when(kind == "signup", F.lit(""))
            .when(kind == "view", listing).otherwise(call))
    token = F.concat(F.lit("token-"), F.lpad(F.col("user_id").cast("string"), 9, "0"))
    log = table(spark, sf_dir, "events").select("event_id", token.alias("token"), body.alias("body"))
    return requests.described(log).select(
        "event_id", "token", "method", "tool", F.try_element_at("arguments", F.lit("k")).alias("k"))


def usage_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = requests.retention(table(spark, sf_dir, "events"), "user_id", "ts")
    return kept.select("user_id", "calls", "last_use", "active_weeks", "back_in_week_2")


def scoped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every request may see: a session (purchases have one) outranks the requested customer."""
    asked = table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "purchase", F.col("user_id")).alias("session"),
        F.floor(F.col("value")).cast("bigint").alias("requested"))
    visible = asked.groupBy(scope.effective_entity("session", "requested").alias("o_custkey")).agg(
        F.count(F.lit(1)).alias("requests"))
    owned = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"), F.max("o_orderkey").alias("last_order"))
    return visible.join(owned, "o_custkey")


def resolve_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests by full id, bare name in any case, or something unknown, for every customer."""
    players = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("puuid"), F.col("c_name").alias("game_name"),
        F.concat_ws("#", "c_name", "c_mktsegment").alias("riot_id"))
    segment = F.col("riot_id")
    player = (F.when(segment.endswith("BUILDING"), F.upper("riot_id")).when(segment.endswith("MACHINERY"), F.lower("game_name"))
              .when(segment.endswith("AUTOMOBILE"), F.lit(None).cast("string")).when(segment.endswith("HOUSEHOLD"), F.concat("game_name", F.lit("!")))
              .otherwise(F.rpad("game_name", 78, "x")))
    asked = players.select(F.col("puuid").alias("request_id"), F.regexp_replace(player, r"^(\w+)#(\d+x)", "$1_$2").alias("player"))
    return scope.resolve_entities(asked, players).select("request_id", "player", "resolved", "resolution")


_SQL_RESOLVE = """WITH r AS (SELECT c_custkey AS request_id, CASE c_mktsegment WHEN 'BUILDING' THEN upper(c_name || '#' || c_mktsegment)
  WHEN 'MACHINERY' THEN lower(c_name) WHEN 'AUTOMOBILE' THEN NULL WHEN 'HOUSEHOLD' THEN c_name || '!'
  ELSE replace(rpad(c_name, 78, 'x'), '#', '_') END AS player FROM customer),
k AS (SELECT lower(c_name) AS key, c_custkey FROM customer UNION ALL SELECT lower(c_name || '#' || c_mktsegment), c_custkey FROM customer),
u AS (SELECT key, min(c_custkey) AS id, count(DISTINCT c_custkey) AS owners FROM k GROUP BY 1)
SELECT request_id, player, CASE WHEN regexp_full_match(player, '[A-Za-z0-9_-]{70,90}') THEN player ELSE CAST(id AS VARCHAR) END AS resolved,
  CASE WHEN player IS NULL THEN 'ambiguous_request' WHEN regexp_full_match(player, '[A-Za-z0-9_-]{70,90}') THEN 'raw_id'
  WHEN id IS NULL THEN 'unknown' WHEN owners > 1 THEN 'shared_name' ELSE 'name' END AS resolution
FROM r LEFT JOIN u ON key = lower(player)"""


# --- partitions ---------------------------------------------------------------------

def late_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed as JSON under their own day, then read back from ten days before the end on."""
    ts = F.col("ts")
    raw = table(spark, sf_dir, "events").select(
        F.concat(F.lit("EV_"), F.col("event_id").cast("string")).alias("match_id"),
        (epoch_seconds(ts) * 1000).alias("game_creation"), F.lit(0).cast("bigint").alias("game_duration"),
        F.col("event_type").alias("game_mode"), F.lit(420).alias("queue_id"), F.lit("").alias("ingested_at"),
        F.col("props").alias("payload"), F.col("user_id").cast("string").alias("puuid"), *date_keys(ts))
    folder = f"{work_folder(spark)}/raw"
    append_raw(raw, folder, partitions=("year", "month", "day"))
    append_raw(raw, folder, partitions=("year", "month", "day"))  # the second run must add nothing
    landed = read_raw(spark, folder).where(from_day(EVENTS_AS_OF, 10))
    return landed.groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("puuid").alias("users"), F.max("payload").alias("last_payload"))


QUERIES = {f.__name__: f for f in (
    change_points, delta_attribution, rating_progress, bonus_gains, latest_state, cutoff_gap, stale_cutoffs, rank_records,
    rank_map_rows, recent_topk, pending_work, pending_all, known_new_split, processed_ids, run_report, request_log,
    usage_retention, scoped_rows, resolve_entities, late_partitions)}

SQL = {
    "change_points": """SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus FROM (
  SELECT *, lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS before FROM orders)
  WHERE before IS NULL OR before <> o_orderstatus""",
    "delta_attribution": f"WITH {_SQL_DELTAS} SELECT user_id, event_id, kind, amount FROM deltas",
    "rating_progress": f"""WITH {_SQL_DELTAS}, n AS (SELECT user_id, count(*) AS points FROM events GROUP BY 1),
  b AS (SELECT user_id, sum(times) AS bonus_gains FROM bonus GROUP BY 1)
  SELECT user_id, points, coalesce(gains, 0) AS gains, coalesce(losses, 0) AS losses, coalesce(ambiguous, 0) AS ambiguous,
  {sql_shown('gain_median', 1)} AS gain_median, {sql_shown('loss_median', 1)} AS loss_median,
  CAST(coalesce(bonus_gains, 0) AS BIGINT) AS bonus_gains,
  points >= 2 AND coalesce(gains, 0) > 0 AND coalesce(losses, 0) > 0 AS measurable
  FROM n LEFT JOIN medians USING (user_id) LEFT JOIN b USING (user_id)""",
    "bonus_gains": f"WITH {_SQL_DELTAS} SELECT user_id, amount, times FROM bonus",
    "latest_state": """SELECT user_id, ts, event_id, event_type, value FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "cutoff_gap": _SQL_CUTOFF,
    "stale_cutoffs": """SELECT user_id FROM events GROUP BY 1
  HAVING date_trunc('second', max(ts)) <= TIMESTAMP '2024-01-30 17:00:00'""",
    "rank_records": f"""WITH q AS (SELECT *, CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 420 WHEN '2' THEN 440 WHEN '3' THEN 450
  ELSE CAST(substring(o_orderpriority, 1, 1) AS INTEGER) END AS queue FROM orders)
  SELECT o_custkey, queue, CASE queue WHEN 420 THEN 'ranked solo/duo' WHEN 440 THEN 'ranked flex' WHEN 450 THEN 'ARAM'
  ELSE 'queue ' || queue END AS queue_name, count(*) FILTER (o_orderstatus = 'F') AS wins,
  count(*) FILTER (o_orderstatus = 'O') AS losses,
  {sql_shown("100.0e0 * count(*) FILTER (o_orderstatus = 'F') / nullif(count(*) FILTER (o_orderstatus IN ('F', 'O')), 0)", 1)} AS win_pct,
  CAST(CASE queue WHEN 420 THEN 0 ELSE 1 END AS INTEGER) AS place FROM q GROUP BY 1, 2""",
    "rank_map_rows": _SQL_RANK_MAP,
    "recent_topk": f"""SELECT o_custkey, o_orderkey, o_orderdate, {sql_shown('o_totalprice', 1)} AS price, o_orderstatus = 'F' AS win,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS place,
  CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'ranked solo/duo' ELSE 'queue ' || substring(o_orderpriority, 1, 1) END AS queue_name
  FROM orders QUALIFY place <= 5""",
    "pending_work": """SELECT DISTINCT o_orderkey AS key FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
  ORDER BY key DESC LIMIT 60""",
    "pending_all": "SELECT DISTINCT o_orderkey AS key FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
    "known_new_split": f"""SELECT user_id, event_id, 'known' AS state FROM events WHERE ts < TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 12 DAY
  UNION ALL SELECT user_id, event_id, 'admitted' FROM (SELECT * FROM events WHERE ts >= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 12 DAY
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 10)""",
    "processed_ids": """SELECT user_id, string_agg(id, ',' ORDER BY id) AS processed_ids FROM (
  SELECT user_id, 'EV_' || event_id AS id FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY 'EV_' || event_id DESC) <= 100) GROUP BY 1""",
    "run_report": """WITH c AS (SELECT user_id, count(*) FILTER (event_type <> 'error' AND value > 50) AS new,
  count(*) FILTER (event_type <> 'error' AND NOT value > 50) AS existing, count(*) FILTER (event_type = 'error') AS errors
  FROM events GROUP BY 1) SELECT *, errors > 0 AND new = 0 AS failed FROM c""",
    "request_log": """SELECT event_id, substring('token-' || lpad(CAST(user_id AS VARCHAR), 9, '0'), 1, 8) AS token,
  CASE event_type WHEN 'error' THEN '?' WHEN 'signup' THEN NULL WHEN 'view' THEN 'tools/list' ELSE 'tools/call' END AS method,
  CASE WHEN event_type IN ('click', 'purchase') THEN 'get_' || event_type END AS tool,
  CASE WHEN event_type IN ('click', 'purchase') THEN json_extract_string(props, '$.k') END AS k FROM events""",
    "usage_retention": """WITH f AS (SELECT *, min(CAST(ts AS DATE)) OVER (PARTITION BY user_id) AS first FROM events),
  w AS (SELECT *, date_diff('day', first, CAST(ts AS DATE)) // 7 AS week FROM f)
  SELECT user_id, count(*) AS calls, max(ts) AS last_use, count(DISTINCT week) AS active_weeks,
  max(CASE WHEN week = 1 THEN 1 ELSE 0 END) = 1 AS back_in_week_2 FROM w GROUP BY 1""",
    "scoped_rows": """WITH r AS (SELECT coalesce(CASE WHEN event_type = 'purchase' THEN user_id END, CAST(floor(value) AS BIGINT)) AS o_custkey,
  count(*) AS requests FROM events GROUP BY 1),
  o AS (SELECT o_custkey, count(*) AS orders, max(o_orderkey) AS last_order FROM orders GROUP BY 1)
  SELECT o_custkey, requests, orders, last_order FROM r JOIN o USING (o_custkey)""",
    "resolve_entities": _SQL_RESOLVE,
    "late_partitions": f"""SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, count(*) AS n,
  count(DISTINCT user_id) AS users, max(props) AS last_payload FROM events
  WHERE CAST(ts AS DATE) >= CAST(TIMESTAMP '{EVENTS_AS_OF}' AS DATE) - 10 GROUP BY 1, 2, 3""",
}
