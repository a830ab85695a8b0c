"""Segment tables on the driver tables, each with its oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from scrimlens.functions.expressions import platform_of
from scrimlens.functions.filters import since
from scrimlens.operators import quantiles, segments
from scrimlens.operators.metrics import Metric
from scrimlens.operators.sizes import small_side
from scrimlens.operators.summarize import coverage as coverage_of
from scrimlens.plans.tables import (
    AS_OF, DAYS, EVENTS_AS_OF, ORDER_METRICS, SQL_CUSTOMER_FACTS, SQL_FACTS, order_facts, shown, spread, sql_shown, table,
)

WON, DECIDED = "o_orderstatus = 'F'", "o_orderstatus <> 'P'"


def daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.newest_day_first(segments.per_day(table(spark, sf_dir, "orders"), "o_orderdate"))


def entity_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their label and order count; orders are counted before the names are joined."""
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    who = table(spark, sf_dir, "customer")
    players = segments.player_rollup(who, "c_custkey", "c_name", "c_mktsegment").drop("n")
    return players.join(counts, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", "game_name", "riot_id", F.coalesce("orders", F.lit(0)).alias("orders"))


def segment_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user and event type over the last 20 days, at least 3 events."""
    events = table(spark, sf_dir, "events").where(since("ts", EVENTS_AS_OF, 20))
    metrics = [Metric("value"), Metric("k", source="cast(get_json_object(props, '$.k') as double)")]
    stats = segments.segment_stats(events, ["user_id", "event_type"], metrics, "value > 50", min_games=3)
    return stats.select("user_id", "event_type", "n", shown("win_pct", 1).alias("win_pct"),
                        shown("value", 2).alias("value"), shown("k", 2).alias("k"))


def ratio_of_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both KDA definitions side by side: ratio of the means and mean of the ratios."""
    lines = table(spark, sf_dir, "lineitem")
    of_means = segments.kda_by_segment(
        lines, ["l_suppkey"], "l_quantity", "l_linenumber", "l_tax", "l_returnflag = 'R'", min_games=3)
    of_ratios = segments.segment_stats(
        lines, ["l_suppkey"], [Metric("mean_kda", source="(l_quantity + l_tax) / nullif(l_linenumber, 0)")])
    return of_means.join(of_ratios.select("l_suppkey", "mean_kda"), "l_suppkey").select(
        "l_suppkey", "n", shown("win_pct", 1).alias("win_pct"), shown("kills").alias("kills"),
        shown("deaths").alias("deaths"), shown("assists").alias("assists"),
        shown("kda_of_means").alias("kda_of_means"), shown("mean_kda").alias("mean_kda"))


def role_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = order_facts(spark, sf_dir, customers=True).where(DECIDED).where("c_mktsegment <> ''")
    metrics = [Metric("price_per_unit", source="o_totalprice / nullif(quantity, 0)"), Metric("lines")]
    return segments.segment_stats(facts, ["c_mktsegment"], metrics, WON).select(
        "c_mktsegment", "n", shown("win_pct", 1).alias("win_pct"), shown("price_per_unit").alias("price_per_unit"),
        shown("lines").alias("lines"))


def early_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = order_facts(spark, sf_dir, customers=True).where(DECIDED)
    return segments.early_phase(facts, ["c_nationkey", "c_mktsegment"], ORDER_METRICS, "quantity").select(
        "c_nationkey", "c_mktsegment", "n", "n_covered", *[shown(m.name).alias(m.name) for m in ORDER_METRICS])


def two_window_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = order_facts(spark, sf_dir).where(DECIDED)
    table_ = segments.window_means(facts, ["o_orderpriority"], ORDER_METRICS, "o_orderdate", AS_OF, DAYS, WON)
    return table_.select("o_orderpriority", "window", "n", shown("win_pct", 1).alias("win_pct"), *[
        shown(f"{m.name}_{s}").alias(f"{m.name}_{s}") for m in ORDER_METRICS for s in ("mean", "sd")])


def _two_window_sql() -> str:
    values = ", ".join(
        f"{sql_shown(f'avg({m.name})')} AS {m.name}_mean, {sql_shown(f'stddev_samp({m.name})')} AS {m.name}_sd"
        for m in ORDER_METRICS)
    return f"""WITH {SQL_FACTS} SELECT o_orderpriority,
  CASE WHEN o_orderdate >= TIMESTAMP '{AS_OF}' - INTERVAL {DAYS} DAY THEN 'recent' ELSE 'previous' END AS "window",
  count(*) AS n, {sql_shown(f'100.0e0 * count(*) FILTER ({WON}) / count(*)', 1)} AS win_pct, {values}
  FROM facts WHERE {DECIDED} AND o_orderdate >= TIMESTAMP '{AS_OF}' - INTERVAL {2 * DAYS} DAY
  AND o_orderdate < TIMESTAMP '{AS_OF}' GROUP BY 1, 2"""


def version_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means per short version; the version text is made of size, brand number and key."""
    brand = F.regexp_extract("p_brand", r"(\d+)", 1)
    part = table(spark, sf_dir, "part").withColumn(
        "version", F.concat_ws(".", F.col("p_size").cast("string"), brand, F.col("p_partkey").cast("string")))
    table_ = segments.by_version(part, "version", [Metric("price", source="p_retailprice")], "p_type = 'ECONOMY'", 3)
    return segments.newest_version_first(table_).select(
        "version", "major", "minor", "n", shown("win_pct", 1).alias("win_pct"), shown("price").alias("price"))


def monthly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = order_facts(spark, sf_dir).where(DECIDED)
    months = segments.by_month(facts, "o_orderdate", "quantity", "discount", "lines", WON, ["o_orderpriority"])
    return months.select("o_orderpriority", "month", "n", shown("win_pct", 1).alias("win_pct"),
                         shown("kda_of_means", 2).alias("kda_of_means"))


def peer_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quartiles of line items per return flag, with row and supplier counts."""
    lines = table(spark, sf_dir, "lineitem")
    sizes = lines.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("observations"), F.count_distinct("l_suppkey").alias("suppliers"))
    found = quantiles.exact_quantiles(
        spread(lines), ["l_returnflag"], ["l_extendedprice", "l_quantity", "l_discount"], [0.25, 0.5, 0.75])
    return found.join(sizes, "l_returnflag").select(
        "l_returnflag", "observations", "suppliers", "metric", "share", "n", shown("value").alias("value"))


def _percentile_sql() -> str:
    parts = [
        f"SELECT l_returnflag, count(*) AS observations, count(DISTINCT l_suppkey) AS suppliers, '{c}' AS metric, "
        f"CAST({s} AS DOUBLE) AS share, count({c}) AS n, {sql_shown(f'quantile_cont({c}, {s})')} AS value "
        f"FROM lineitem GROUP BY 1" for c in ("l_extendedprice", "l_quantity", "l_discount") for s in (0.25, 0.5, 0.75)]
    return " UNION ALL ".join(parts)


def state_vs_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders well above, well below or near their priority's mean price, against the outcome."""
    orders = table(spark, sf_dir, "orders")
    mean = small_side(orders.groupBy("o_orderpriority").agg(F.avg("o_totalprice").alias("mean_price")))
    lead = orders.join(mean, "o_orderpriority").withColumn("lead", F.col("o_totalprice") - F.col("mean_price"))
    return segments.state_vs_outcome(lead, "lead", WON, 50000.0, ["o_orderpriority"]).select(
        "o_orderpriority", "state", "n", shown("win_pct", 1).alias("win_pct"))


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many documents of each language and source carry a label."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    joined = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return coverage_of(joined, ["lang", "source"], ["quality", "toxic"]).select(
        "lang", "source", "metric", "group_n", "n", shown("covered_pct", 1).alias("covered_pct"), "partial_coverage")


def json_extract_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON field of every event, absent fields as NULL."""
    return table(spark, sf_dir, "events").select(
        "event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"),
        F.get_json_object("props", "$.missing").alias("missing"))


def platform_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Platform prefix of ids, among them ids without a prefix or without a rest."""
    flag = F.col("p_type")
    made = F.when(flag == "ECONOMY", F.concat(F.lit("_"), "p_brand")).when(flag == "PROMO", F.concat("p_brand", F.lit("_")))
    ids = table(spark, sf_dir, "part").select(
        "p_partkey", made.otherwise(F.concat_ws("_", "p_brand", "p_name", "p_type")).alias("match_id"))
    return ids.select("p_partkey", "match_id", platform_of("match_id").alias("platform"))


QUERIES = {f.__name__: f for f in (
    daily_counts, entity_rollup, segment_stats, ratio_of_means, role_performance, early_phase, two_window_summary,
    version_order, monthly_trend, peer_percentiles, state_vs_outcome, coverage, json_extract_props, platform_key)}

SQL = {
    "daily_counts": """SELECT strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month,
  strftime(o_orderdate, '%d') AS day, count(*) AS n FROM orders GROUP BY 1, 2, 3""",
    "entity_rollup": """SELECT c_custkey, coalesce(nullif(max(c_name), ''), '?') AS game_name,
  coalesce(nullif(max(c_name), ''), '?') || '#' || coalesce(nullif(max(c_mktsegment), ''), '?') AS riot_id,
  count(o_orderkey) AS orders FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1""",
    "segment_stats": f"""SELECT user_id, event_type, count(*) AS n,
  {sql_shown('100.0e0 * count(*) FILTER (value > 50) / count(*)', 1)} AS win_pct, {sql_shown('avg(value)', 2)} AS value,
  {sql_shown("avg(CAST(json_extract_string(props, '$.k') AS DOUBLE))", 2)} AS k FROM events
  WHERE ts >= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 20 DAY AND ts < TIMESTAMP '{EVENTS_AS_OF}' GROUP BY 1, 2 HAVING count(*) >= 3""",
    "ratio_of_means": f"""SELECT l_suppkey, count(*) AS n,
  {sql_shown("100.0e0 * count(*) FILTER (l_returnflag = 'R') / count(*)", 1)} AS win_pct,
  {sql_shown('avg(l_quantity)')} AS kills, {sql_shown('avg(l_linenumber)')} AS deaths, {sql_shown('avg(l_tax)')} AS assists,
  {sql_shown('(avg(l_quantity) + avg(l_tax)) / nullif(avg(l_linenumber), 0)')} AS kda_of_means,
  {sql_shown('avg((l_quantity + l_tax) / nullif(l_linenumber, 0))')} AS mean_kda
  FROM lineitem GROUP BY 1 HAVING count(*) >= 3""",
    "role_performance": f"""WITH {SQL_CUSTOMER_FACTS} SELECT c_mktsegment, count(*) AS n,
  {sql_shown(f'100.0e0 * count(*) FILTER ({WON}) / count(*)', 1)} AS win_pct,
  {sql_shown('avg(o_totalprice / nullif(quantity, 0))')} AS price_per_unit, {sql_shown('avg(lines)')} AS lines
  FROM facts WHERE {DECIDED} AND c_mktsegment <> '' GROUP BY 1""",
    "early_phase": f"""WITH {SQL_CUSTOMER_FACTS} SELECT c_nationkey, c_mktsegment, count(*) AS n, count(quantity) AS n_covered,
  {', '.join(f'{sql_shown(f"avg({m.name})")} AS {m.name}' for m in ORDER_METRICS)}
  FROM facts WHERE {DECIDED} GROUP BY 1, 2""",
    "two_window_summary": _two_window_sql(),
    "version_order": f"""WITH v AS (SELECT *, p_size || '.' || regexp_extract(p_brand, '(\\d+)', 1) AS version FROM part)
  SELECT version, CAST(split_part(version, '.', 1) AS INTEGER) AS major, CAST(split_part(version, '.', 2) AS INTEGER) AS minor,
  count(*) AS n, {sql_shown("100.0e0 * count(*) FILTER (p_type = 'ECONOMY') / count(*)", 1)} AS win_pct,
  {sql_shown('avg(p_retailprice)')} AS price FROM v GROUP BY 1 HAVING count(*) >= 3""",
    "monthly_trend": f"""WITH {SQL_FACTS} SELECT o_orderpriority, strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n,
  {sql_shown(f'100.0e0 * count(*) FILTER ({WON}) / count(*)', 1)} AS win_pct,
  {sql_shown('(avg(quantity) + avg(lines)) / nullif(avg(discount), 0)', 2)} AS kda_of_means
  FROM facts WHERE {DECIDED} GROUP BY 1, 2""",
    "peer_percentiles": _percentile_sql(),
    "state_vs_outcome": f"""WITH m AS (SELECT o_orderpriority, avg(o_totalprice) AS mean_price FROM orders GROUP BY 1),
  l AS (SELECT *, CASE WHEN o_totalprice - mean_price > 50000 THEN 'ahead' WHEN o_totalprice - mean_price < -50000 THEN 'behind'
  ELSE 'even' END AS state FROM orders JOIN m USING (o_orderpriority))
  SELECT o_orderpriority, state, count(*) AS n, {sql_shown(f'100.0e0 * count(*) FILTER ({WON}) / count(*)', 1)} AS win_pct
  FROM l GROUP BY 1, 2""",
    "coverage": " UNION ALL ".join(f"""SELECT lang, source, '{c}' AS metric, count(*) AS group_n, count({c}) AS n,
  {sql_shown(f'100.0e0 * count({c}) / count(*)', 1)} AS covered_pct, count({c}) < count(*) AS partial_coverage
  FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1, 2""" for c in ("quality", "toxic")),
    "json_extract_props": """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
  json_extract_string(props, '$.missing') AS missing FROM events""",
    "platform_key": """WITH i AS (SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN '_' || p_brand WHEN 'PROMO' THEN p_brand || '_'
  ELSE p_brand || '_' || p_name || '_' || p_type END AS match_id FROM part)
  SELECT p_partkey, match_id, CASE WHEN instr(match_id, '_') > 1 AND instr(match_id, '_') < length(match_id)
  THEN lower(split_part(match_id, '_', 1)) END AS platform FROM i""",
}
