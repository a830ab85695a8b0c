"""Comparison reports on the driver tables, each with its oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from scrimlens.functions import stats
from scrimlens.functions.filters import since
from scrimlens.operators import compare, fdr, peers
from scrimlens.operators.metrics import SHARE, Metric
from scrimlens.operators.state import newest_per_entity
from scrimlens.operators.summarize import summarize
from scrimlens.plans.tables import (
    AS_OF, DAYS, EVENTS_AS_OF, LATE_AS_OF, ORDER_METRICS, SQL_CUSTOMER_FACTS, SQL_FACTS, order_facts, shown,
    sql_judged, sql_normal_tail, sql_shown, sql_sides, table,
)

WON = "o_orderstatus = 'F'"
DECIDED = "o_orderstatus <> 'P'"
SPLIT_DAYS = 1500
URGENT = Metric("urgent", kind=SHARE, source="o_orderpriority = '1-URGENT'")

_ORDER_SQL = [("price", "higher", "mean", "price"), ("lines", "higher", "mean", "lines"),
              ("quantity", "higher", "mean", "quantity"), ("discount", "lower", "mean", "discount")]
_WIN_SQL = ("win_rate", "higher", "share", f"({WON})")
_URGENT_SQL = ("urgent", "higher", "share", "(o_orderpriority = '1-URGENT')")


def _numbers(df: DataFrame, by: list[str], *extra: str) -> DataFrame:
    return df.select(
        *by, "metric", F.col("n_a").cast("bigint").alias("n_a"), F.col("n_b").cast("bigint").alias("n_b"),
        shown("mean_a").alias("mean_a"), shown("mean_b").alias("mean_b"), shown("delta").alias("delta"),
        shown("delta_pct", 2).alias("delta_pct"), shown("d").alias("d"), shown("p").alias("p"),
        "magnitude", "direction", "significant", "verdict", *extra,
    )


def _sql_numbers(by: list[str], *extra: str) -> str:
    return ", ".join([
        *by, "metric", "CAST(n_a AS BIGINT) AS n_a", "CAST(n_b AS BIGINT) AS n_b",
        *[f"{sql_shown(c)} AS {c}" for c in ("mean_a", "mean_b", "delta")], f"{sql_shown('delta_pct', 2)} AS delta_pct",
        f"{sql_shown('d')} AS d", f"{sql_shown('p')} AS p", "magnitude", "direction", "significant", "verdict", *extra,
    ])


_PARTIAL = "(n_a < group_n_a OR n_b < group_n_b) AND metric <> 'win_rate' AS partial_coverage"
_ENOUGH = "least(group_n_a, group_n_b) >= 10 AS enough"
_TREND_GUIDANCE = ("CASE verdict WHEN 'significant' THEN 'claim_change' WHEN 'hint' THEN 'watch_only' "
                   "ELSE 'do_not_report' END AS guidance")


def _banded_sql(weak: str, small: str, strong: str) -> str:
    return (f"CASE WHEN NOT significant OR d IS NULL OR abs(d) < 0.2 THEN '{weak}' "
            f"WHEN abs(d) < 0.5 THEN '{small}' ELSE '{strong}' END")


# --- windows ---------------------------------------------------------------------

def _windows(spark: SparkSession, sf_dir: str, by: str, as_of: str, days: int) -> DataFrame:
    facts = order_facts(spark, sf_dir).where(DECIDED)
    report = compare.compare_windows(facts, [by], ORDER_METRICS, "o_orderdate", as_of, days, WON)
    return report.withColumn("guidance", compare.trend_guidance())


def _windows_sql(by: str, as_of: str, days: int) -> str:
    recent = f"o_orderdate >= TIMESTAMP '{as_of}' - INTERVAL {days} DAY"
    return f"""WITH {SQL_FACTS},
picked AS (SELECT * FROM facts WHERE {DECIDED} AND o_orderdate >= TIMESTAMP '{as_of}' - INTERVAL {2 * days} DAY
  AND o_orderdate < TIMESTAMP '{as_of}'),
{sql_sides('picked', [by], [_WIN_SQL, *_ORDER_SQL], recent, f'NOT ({recent})')},
{sql_judged([by])}
SELECT {_sql_numbers([by], _PARTIAL, _ENOUGH, _TREND_GUIDANCE)} FROM judged"""


def window_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: last year against the year before, per order priority."""
    return _numbers(_windows(spark, sf_dir, "o_orderpriority", AS_OF, DAYS), ["o_orderpriority"],
                    "partial_coverage", "enough", "guidance")


def window_trends_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for every customer at once, with small samples."""
    return _numbers(_windows(spark, sf_dir, "o_custkey", LATE_AS_OF, 1200), ["o_custkey"],
                    "partial_coverage", "enough", "guidance")


def trend_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = order_facts(spark, sf_dir).where(DECIDED)
    report = _windows(spark, sf_dir, "o_custkey", LATE_AS_OF, 1200)
    overview = compare.window_overview(facts, report, ["o_custkey"], "o_orderdate", LATE_AS_OF, 1200, WON)
    return overview.select(
        "o_custkey", "recent_n", "recent_wins", "previous_n", "previous_wins",
        F.col("tested").cast("bigint").alias("tested"), F.array_join("significant_metrics", ",").alias("significant"),
        F.array_join("hints", ",").alias("hints"), F.coalesce("enough", F.lit(False)).alias("enough"), "note",
    )


def _trend_overview_sql() -> str:
    recent = f"o_orderdate >= TIMESTAMP '{LATE_AS_OF}' - INTERVAL 1200 DAY"
    base = _windows_sql("o_custkey", LATE_AS_OF, 1200)
    chain = base[: base.rindex("SELECT")]
    return chain + f""",
sizes AS (SELECT o_custkey, count(*) FILTER ({recent}) AS recent_n, count(*) FILTER ({recent} AND {WON}) AS recent_wins,
    count(*) FILTER (NOT {recent}) AS previous_n, count(*) FILTER (NOT {recent} AND {WON}) AS previous_wins
  FROM picked GROUP BY o_custkey),
found AS (SELECT o_custkey, count(*) AS tested,
    coalesce(string_agg(metric, ',' ORDER BY metric) FILTER (significant), '') AS significant,
    coalesce(string_agg(metric, ',' ORDER BY metric) FILTER (verdict = 'hint'), '') AS hints
  FROM judged GROUP BY o_custkey)
SELECT o_custkey, recent_n, recent_wins, previous_n, previous_wins, CAST(coalesce(tested, 0) AS BIGINT) AS tested,
  coalesce(significant, '') AS significant, coalesce(hints, '') AS hints,
  least(recent_n, previous_n) >= 10 AS enough,
  CASE WHEN recent_n = 0 OR previous_n = 0 THEN 'window_missing' WHEN least(recent_n, previous_n) < 10 THEN 'small_sample'
       WHEN coalesce(significant, '') = '' THEN 'stable' WHEN hints <> '' THEN 'changes_and_hints' ELSE 'changes' END AS note
FROM sizes LEFT JOIN found USING (o_custkey)"""


# --- outcomes --------------------------------------------------------------------

def _recent_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = order_facts(spark, sf_dir, customers=True)
    return facts.where(DECIDED).where(since("o_orderdate", LATE_AS_OF, SPLIT_DAYS))


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.compare_outcomes(
        _recent_facts(spark, sf_dir), _SPLIT_KEYS, [*ORDER_METRICS, URGENT], WON, main=("c_nationkey", "c_mktsegment"))


_SQL_MAIN = f"""{SQL_CUSTOMER_FACTS},
recent AS (SELECT * FROM facts WHERE {DECIDED} AND o_orderdate >= TIMESTAMP '{LATE_AS_OF}' - INTERVAL {SPLIT_DAYS} DAY
  AND o_orderdate < TIMESTAMP '{LATE_AS_OF}'),
main AS (SELECT c_nationkey, c_mktsegment FROM recent WHERE c_mktsegment <> '' GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY count(*) DESC, c_mktsegment) = 1),
own AS (SELECT recent.* FROM recent JOIN main USING (c_nationkey, c_mktsegment))"""
_SPLIT_KEYS = ["c_nationkey", "c_mktsegment"]
_SQL_SPLIT = f"""WITH {_SQL_MAIN},
{sql_sides('own', _SPLIT_KEYS, [*_ORDER_SQL, _URGENT_SQL], WON, f'NOT ({WON})')},
{sql_judged(_SPLIT_KEYS, where='group_n_a >= 5 AND group_n_b >= 5')}"""
_OUTCOME_GUIDANCE = _banded_sql("same_in_both", "drops_a_little", "drops_clearly")


def outcome_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbers(_split(spark, sf_dir), _SPLIT_KEYS, "relevant", "guidance")


def outcome_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _recent_facts(spark, sf_dir)
    return compare.outcome_sample(facts, ["o_custkey", "c_mktsegment"], WON)


def guidance_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels and advice texts per row of the outcome split."""
    return _split(spark, sf_dir).select(
        *_SPLIT_KEYS, "metric", "magnitude", "direction", "verdict", shown("delta_pct", 1).alias("delta_pct"),
        "guidance", compare.advice("guidance").alias("advice"),
    )


def effect_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of each nation by absolute effect, largest first."""
    rows = _split(spark, sf_dir)
    ordered = newest_per_entity(rows, ["c_nationkey"], [F.abs("d").desc_nulls_last(), F.asc("metric")], len(ORDER_METRICS) + 1)
    return ordered.select(
        "c_nationkey", F.col("place").cast("bigint").alias("place"), "metric", shown("d").alias("d"), "magnitude",
        stats.enough(F.col("n_a"), F.col("n_b")).alias("enough"),
    )


def _advice_sql() -> str:
    cases = " ".join(f"WHEN '{code}' THEN '{text}'" for code, text in compare.ADVICE.items())
    return f"CASE {_OUTCOME_GUIDANCE} {cases} END"


# --- peers -----------------------------------------------------------------------

def peer_priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer in its main priority class against all other customers of that class."""
    facts = order_facts(spark, sf_dir)
    report = peers.compare_to_peers(facts, facts, "o_custkey", "o_orderpriority", ORDER_METRICS, main_role=True)
    return _numbers(report, ["o_custkey", "o_orderpriority"], F.col("group_n_b").cast("bigint").alias("peer_rows"),
                    F.col("peers").cast("bigint").alias("peers"), "standing", "guidance")


def _peer_sql() -> str:
    keys = ["o_custkey", "o_orderpriority"]
    own, rest = [], []
    for name, sense, kind, value in _ORDER_SQL:
        v = f"CAST({value} AS DOUBLE)"
        own.append(
            f"SELECT o_custkey, o_orderpriority, '{name}' AS metric, '{sense}' AS sense, '{kind}' AS kind, "
            f"count({v}) AS n_a, avg({v}) AS mean_a, stddev_samp({v}) AS sd_a, NULL::BIGINT AS hits_a "
            f"FROM own GROUP BY 1, 2")
        rest.append(
            f"SELECT m.o_custkey, m.o_orderpriority, '{name}' AS metric, count(*) AS group_n_b, "
            f"count(DISTINCT f.o_custkey) AS peers, count(f.{value}) AS n_b, avg(CAST(f.{value} AS DOUBLE)) AS mean_b, "
            f"stddev_samp(CAST(f.{value} AS DOUBLE)) AS sd_b, NULL::BIGINT AS hits_b FROM main m JOIN facts f "
            f"ON f.o_orderpriority = m.o_orderpriority AND f.o_custkey <> m.o_custkey GROUP BY 1, 2")
    standing = ("CASE WHEN significant AND abs(d) >= 0.2 AND direction = 'worse' THEN 'weakness' "
                "WHEN significant AND abs(d) >= 0.2 AND direction = 'better' THEN 'strength' "
                "ELSE 'no_relevant_difference' END AS standing")
    guidance = _banded_sql("at_peer_level", "small_gap", "real_gap") + " AS guidance"
    return f"""WITH {SQL_FACTS},
main AS (SELECT o_custkey, o_orderpriority FROM facts WHERE o_orderpriority <> '' GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority) = 1),
own AS (SELECT facts.* FROM facts JOIN main USING (o_custkey, o_orderpriority)),
mine AS ({' UNION ALL '.join(own)}), rest AS ({' UNION ALL '.join(rest)}),
sides AS (SELECT * FROM mine JOIN rest USING (o_custkey, o_orderpriority, metric)),
{sql_judged(keys)}
SELECT {_sql_numbers(keys, 'CAST(group_n_b AS BIGINT) AS peer_rows', 'CAST(peers AS BIGINT) AS peers', standing, guidance)}
FROM judged"""


_LINE_METRICS = [Metric("price", source="l_extendedprice"), Metric("quantity", source="l_quantity")]
_LINE_KEYS = ["l_returnflag", "l_suppkey"]


def match_peer_priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers against the other suppliers of the same orders and return flag."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_returnflag", "l_extendedprice", "l_quantity")
    report = peers.compare_to_match_peers(lines, lines, "l_suppkey", "l_returnflag", "l_orderkey", _LINE_METRICS)
    return _numbers(report, _LINE_KEYS, "standing")


def _match_peer_sql() -> str:
    def part(source: str, tag: str, name: str, value: str) -> str:
        return (f"SELECT l_returnflag, l_suppkey, '{name}' AS metric, count({value}) AS n_{tag}, avg({value}) AS mean_{tag}, "
                f"stddev_samp({value}) AS sd_{tag}, NULL::BIGINT AS hits_{tag} FROM {source} GROUP BY 1, 2")
    both = [("price", "l_extendedprice"), ("quantity", "l_quantity")]
    return f"""WITH own AS (SELECT DISTINCT l_orderkey, l_returnflag, l_suppkey FROM lineitem),
others AS (SELECT o.l_returnflag, o.l_suppkey, l.l_extendedprice, l.l_quantity FROM own o JOIN lineitem l
  ON l.l_orderkey = o.l_orderkey AND l.l_returnflag = o.l_returnflag AND l.l_suppkey <> o.l_suppkey),
mine AS ({' UNION ALL '.join(part('lineitem', 'a', *m) for m in both)}),
rest AS ({' UNION ALL '.join(part('others', 'b', *m) for m in both)}),
sides AS (SELECT *, 'higher' AS sense, 'mean' AS kind FROM mine JOIN rest USING (l_returnflag, l_suppkey, metric)),
{sql_judged(_LINE_KEYS)}
SELECT {_sql_numbers(_LINE_KEYS, "CASE WHEN significant AND abs(d) >= 0.2 AND direction = 'worse' THEN 'weakness' WHEN significant AND abs(d) >= 0.2 AND direction = 'better' THEN 'strength' ELSE 'no_relevant_difference' END AS standing")}
FROM judged"""


def union_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two aggregates under each other: the first segment and all others."""
    facts = order_facts(spark, sf_dir, customers=True)

    both = facts.where(F.col("c_mktsegment").isNotNull()).withColumn(
        "grp", F.when(F.col("c_mktsegment") == "HOUSEHOLD", "household").otherwise("others"))
    people = both.groupBy("grp").agg(F.count_distinct("o_custkey").alias("customers"))
    rows = summarize(both, ["grp"], ORDER_METRICS).join(people, "grp")
    return rows.select("grp", "metric", "group_n", "customers", "n", shown("mean").alias("mean"), shown("sd").alias("sd"))


def _union_sql() -> str:
    def part(name: str, where: str, metric: tuple) -> str:
        return (f"SELECT '{name}' AS grp, '{metric[0]}' AS metric, count(*) AS group_n, count(DISTINCT o_custkey) AS customers, "
                f"count({metric[3]}) AS n, {sql_shown(f'avg({metric[3]})')} AS mean, "
                f"{sql_shown(f'stddev_samp({metric[3]})')} AS sd FROM facts WHERE {where}")
    parts = [part(n, w, m) for n, w in (("household", "c_mktsegment = 'HOUSEHOLD'"), ("others", "c_mktsegment <> 'HOUSEHOLD'"))
             for m in _ORDER_SQL]
    return f"WITH {SQL_CUSTOMER_FACTS} " + " UNION ALL ".join(parts)


# --- groups and pools --------------------------------------------------------------

def group_vs_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Return rate of every brand and size against all other lines; line items are counted per part first."""
    per_part = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("hits"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    counts = per_part.join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand", "p_size").agg(
        F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    return compare.counts_vs_rest(counts).select(
        "p_brand", "p_size", "n", "hits", "rest_n", "rest_hits", shown("hit_pct", 1).alias("hit_pct"),
        shown("rest_pct", 1).alias("rest_pct"), shown("stat").alias("z"), shown("p").alias("p"), "significant", "verdict")


def _group_sql() -> str:
    return f"""WITH c AS (SELECT p_brand, p_size, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS hits
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2),
a AS (SELECT *, sum(n) OVER () - n AS rest_n, sum(hits) OVER () - hits AS rest_hits FROM c),
b AS (SELECT *, (hits + rest_hits) * 1.0e0 / (n + rest_n) AS pooled FROM a WHERE n >= 10),
z AS (SELECT *, (hits * 1.0e0 / n - rest_hits * 1.0e0 / rest_n)
  / sqrt(pooled * (1 - pooled) * (1.0e0 / n + 1.0e0 / rest_n)) AS z FROM b),
p AS (SELECT *, {sql_normal_tail('z')} AS p FROM z),
r AS (SELECT *, row_number() OVER (ORDER BY p) * 1.0e0 / count(*) OVER () * 0.05e0 AS step FROM p),
s AS (SELECT *, coalesce(p <= max(CASE WHEN p <= step THEN p END) OVER (), FALSE) AS significant FROM r)
SELECT p_brand, p_size, n, hits, CAST(rest_n AS BIGINT) AS rest_n, CAST(rest_hits AS BIGINT) AS rest_hits,
  {sql_shown('100.0e0 * hits / n', 1)} AS hit_pct, {sql_shown('100.0e0 * rest_hits / rest_n', 1)} AS rest_pct,
  {sql_shown('z')} AS z, {sql_shown('p')} AS p, significant,
  CASE WHEN significant THEN 'significant' WHEN p < 0.05 THEN 'hint' ELSE 'noise' END AS verdict FROM s"""


def pool_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the mix of event types changed for every user."""
    changes = compare.pool_changes(
        table(spark, sf_dir, "events"), ["user_id"], "event_type", "ts", EVENTS_AS_OF, 15, "value > 50")
    return changes.select(
        "user_id", "event_type", "status", "recent_n", "recent_wins", "previous_n", "previous_wins",
        shown("recent_win_pct", 1).alias("recent_win_pct"), shown("previous_win_pct", 1).alias("previous_win_pct"),
        shown("delta_win_pct", 1).alias("delta_win_pct"), shown("p").alias("p"), "significant")


def _pool_sql() -> str:
    recent = f"ts >= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 15 DAY"
    return f"""WITH c AS (SELECT user_id, event_type, count(*) FILTER ({recent}) AS recent_n,
  count(*) FILTER ({recent} AND value > 50) AS recent_wins, count(*) FILTER (NOT {recent}) AS previous_n,
  count(*) FILTER (NOT {recent} AND value > 50) AS previous_wins
  FROM events WHERE ts >= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 30 DAY AND ts < TIMESTAMP '{EVENTS_AS_OF}' GROUP BY 1, 2 HAVING count(*) >= 3),
a AS (SELECT *, 100.0e0 * recent_wins / nullif(recent_n, 0) AS ra, 100.0e0 * previous_wins / nullif(previous_n, 0) AS rb,
  CASE WHEN recent_n > 0 AND previous_n > 0 THEN (recent_wins + previous_wins) * 1.0e0 / (recent_n + previous_n) END AS pooled FROM c),
b AS (SELECT *, CASE WHEN pooled > 0 AND pooled < 1 THEN (ra - rb) / 100.0e0
  / sqrt(pooled * (1 - pooled) * (1.0e0 / recent_n + 1.0e0 / previous_n)) END AS z FROM a),
p AS (SELECT *, CASE WHEN pooled IN (0, 1) THEN 1.0e0 WHEN z IS NOT NULL THEN {sql_normal_tail('z')} END AS p FROM b)
SELECT user_id, event_type, CASE WHEN previous_n = 0 THEN 'new' WHEN recent_n = 0 THEN 'dropped' ELSE 'constant' END AS status,
  recent_n, recent_wins, previous_n, previous_wins, {sql_shown('ra', 1)} AS recent_win_pct,
  {sql_shown('rb', 1)} AS previous_win_pct, {sql_shown('ra - rb', 1)} AS delta_win_pct, {sql_shown('p')} AS p,
  coalesce(p < 0.05, FALSE) AS significant FROM p"""


# --- false discoveries ---------------------------------------------------------------

_P = "pow(((p_partkey * 7919) % 10007) / 10007.0e0, 3)"


def bh_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benjamini-Hochberg over large families: a spread-out p per part, one family per brand."""
    spread = (F.col("p_partkey") * 7919) % 10007 / F.lit(10007.0)
    rows = table(spark, sf_dir, "part").select("p_brand", "p_partkey", F.pow(spread, F.lit(3.0)).alias("p"))
    return fdr.reject(rows, ["p_brand"]).select(
        "p_brand", "p_partkey", F.round("p", 8).alias("p"), "significant",
        stats.verdict(F.col("significant"), F.col("p")).alias("verdict"))


_BH_SQL = f"""WITH p AS (SELECT p_brand, p_partkey, {_P} AS p FROM part),
r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p) * 1.0e0 / count(*) OVER (PARTITION BY p_brand) * 0.05e0 AS step FROM p),
s AS (SELECT *, coalesce(p <= max(CASE WHEN p <= step THEN p END) OVER (PARTITION BY p_brand), FALSE) AS significant FROM r)
SELECT p_brand, p_partkey, round(p, 8) AS p, significant,
  CASE WHEN significant THEN 'significant' WHEN p < 0.05 THEN 'hint' ELSE 'noise' END AS verdict FROM s"""

QUERIES = {
    "window_trends": window_trends, "window_trends_by_customer": window_trends_by_customer,
    "trend_overview": trend_overview, "outcome_split": outcome_split, "outcome_sample": outcome_sample,
    "guidance_labels": guidance_labels, "effect_order": effect_order, "peer_priorities": peer_priorities,
    "match_peer_priorities": match_peer_priorities, "union_summary": union_summary, "group_vs_rest": group_vs_rest,
    "pool_trends": pool_trends, "bh_flags": bh_flags,
}

SQL = {
    "window_trends": _windows_sql("o_orderpriority", AS_OF, DAYS),
    "window_trends_by_customer": _windows_sql("o_custkey", LATE_AS_OF, 1200),
    "trend_overview": _trend_overview_sql(),
    "outcome_split": f"{_SQL_SPLIT} SELECT {_sql_numbers(_SPLIT_KEYS, 'significant AND coalesce(abs(d) >= 0.2, FALSE) AS relevant', _OUTCOME_GUIDANCE + ' AS guidance')} FROM judged",
    "outcome_sample": f"""WITH {SQL_CUSTOMER_FACTS} SELECT o_custkey, c_mktsegment, count(*) FILTER ({WON}) AS wins,
  count(*) FILTER (NOT {WON}) AS losses,
  CASE WHEN least(count(*) FILTER ({WON}), count(*) FILTER (NOT {WON})) >= 5 THEN 'ok' ELSE 'insufficient_sample' END AS status
  FROM facts WHERE {DECIDED} AND o_orderdate >= TIMESTAMP '{LATE_AS_OF}' - INTERVAL {SPLIT_DAYS} DAY
  AND o_orderdate < TIMESTAMP '{LATE_AS_OF}' GROUP BY 1, 2""",
    "guidance_labels": f"""{_SQL_SPLIT} SELECT {', '.join(_SPLIT_KEYS)}, metric, magnitude, direction, verdict,
  {sql_shown('delta_pct', 1)} AS delta_pct, {_OUTCOME_GUIDANCE} AS guidance, {_advice_sql()} AS advice FROM judged""",
    "effect_order": f"""{_SQL_SPLIT} SELECT c_nationkey,
  row_number() OVER (PARTITION BY c_nationkey ORDER BY abs(d) DESC NULLS LAST, metric) AS place, metric,
  {sql_shown('d')} AS d, magnitude, least(n_a, n_b) >= 10 AS enough FROM judged""",
    "peer_priorities": _peer_sql(), "match_peer_priorities": _match_peer_sql(), "union_summary": _union_sql(),
    "group_vs_rest": _group_sql(), "pool_trends": _pool_sql(), "bh_flags": _BH_SQL,
}
