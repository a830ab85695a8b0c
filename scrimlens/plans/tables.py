"""Access to the driver tables, and the SQL pieces that the oracle queries share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from scrimlens.functions.expressions import column
from scrimlens.operators.metrics import Metric

AS_OF, DAYS = "1998-01-01 00:00:00", 365
LATE_AS_OF = "2001-08-02 00:00:00"
EVENTS_AS_OF = "2024-01-31 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer splits than cores (one small file) is dealt out before costly per-row work."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def work_folder(spark: SparkSession) -> str:
    """New folder under the cluster's shared checkpoint folder; a local one only in local mode."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="scrimlens-")
    return f"{base.rstrip('/')}/scrimlens-{uuid.uuid4().hex}"


def shown(value: Column | str, places: int = 4) -> Column:
    """Display rounding; the nudge keeps exact halves from depending on the order of a sum."""
    return F.round(column(value) + F.lit(1e-9), places) + F.lit(0.0)


def sql_shown(value: str, places: int = 4) -> str:
    return f"(round(CAST({value} AS DOUBLE) + 1e-9, {places}) + CAST(0.0 AS DOUBLE))"


# --- facts: one row per order, its line items rolled up ---------------------------

ORDER_METRICS = [
    Metric("price", source="o_totalprice"), Metric("lines"), Metric("quantity"), Metric("discount", "lower"),
]


def order_facts(spark: SparkSession, sf_dir: str, customers: bool = False) -> DataFrame:
    """Orders with their line items aggregated first, so the join moves one row per order."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"), F.avg("l_discount").alias("discount"))
    facts = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    if customers:
        who = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_name")
        facts = facts.join(who, F.col("o_custkey") == F.col("c_custkey"))
    return facts


SQL_FACTS = """facts AS (
  SELECT o.*, o.o_totalprice AS price, l.lines, l.quantity, l.discount
  FROM orders o LEFT JOIN (
    SELECT l_orderkey, count(*) AS lines, sum(l_quantity) AS quantity, avg(l_discount) AS discount
    FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey)"""

SQL_CUSTOMER_FACTS = SQL_FACTS.replace("SELECT o.*,", "SELECT o.*, c.c_nationkey, c.c_mktsegment, c.c_name,").replace(
    "FROM orders o LEFT JOIN", "FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN")

# --- SQL for the statistics: numerical integration, independent of the Spark code ---

_STEPS = 600


def _simpson(integrand: str, upper: str) -> str:
    """Integral from 0 to ``upper`` of an expression in ``:u``."""
    h = f"(({upper}) / {_STEPS}.0e0)"
    weight = f"(CASE WHEN i = 0 OR i = {_STEPS} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)"
    term = integrand.replace(":u", f"(i * {h})")
    return f"({h} / 3.0e0 * list_sum(list_transform(range(0, {_STEPS + 1}), lambda i: {weight} * {term})))"


def sql_student_tail(t: str, df: str) -> str:
    front = f"2.0e0 * exp(lgamma(({df} + 1.0e0) / 2.0e0) - lgamma({df} / 2.0e0)) / sqrt(pi())"
    area = _simpson(f"pow(cos(:u), {df} - 1.0e0)", f"atan(abs({t}) / sqrt({df}))")
    return f"greatest(0.0e0, 1.0e0 - {front} * {area})"


def sql_normal_tail(z: str) -> str:
    area = _simpson("exp(-pow(:u, 2) / 2.0e0)", f"least(abs({z}), 12.0e0)")
    return f"greatest(0.0e0, 1.0e0 - 2.0e0 / sqrt(2.0e0 * pi()) * {area})"


def sql_sides(facts: str, by: Sequence[str], metrics: Sequence[tuple[str, str, str, str]], side_a: str, side_b: str) -> str:
    """UNION ALL of one aggregate per metric (name, sense, kind, SQL value) from ``facts``."""
    keys = ", ".join(by)
    parts = []
    for name, sense, kind, value in metrics:
        def half(tag: str, side: str) -> str:
            if kind == "share":
                n, hits = f"count({value}) FILTER ({side})", f"count(*) FILTER (({side}) AND ({value}))"
                mean = f"({hits} * 1.0e0 / nullif({n}, 0))"
                return f"{n} AS n_{tag}, {mean} AS mean_{tag}, sqrt({mean} * (1 - {mean})) AS sd_{tag}, {hits} AS hits_{tag}"
            v = f"CAST({value} AS DOUBLE)"
            return (f"count({v}) FILTER ({side}) AS n_{tag}, avg({v}) FILTER ({side}) AS mean_{tag}, "
                    f"stddev_samp({v}) FILTER ({side}) AS sd_{tag}, NULL::BIGINT AS hits_{tag}")
        parts.append(
            f"SELECT {keys}, '{name}' AS metric, '{sense}' AS sense, '{kind}' AS kind, "
            f"count(*) FILTER ({side_a}) AS group_n_a, count(*) FILTER ({side_b}) AS group_n_b, "
            f"{half('a', side_a)}, {half('b', side_b)} FROM {facts} GROUP BY {keys}")
    return "sides AS (" + " UNION ALL ".join(parts) + ")"


def sql_judged(by: Sequence[str], source: str = "sides", where: str = "TRUE") -> str:
    """CTE chain ``judged`` over rows with n, mean, sd, hits of both sides."""
    keys = ", ".join(by)
    return f"""
v AS (SELECT *, pow(coalesce(sd_a, 0), 2) / nullif(n_a, 0) AS va, pow(coalesce(sd_b, 0), 2) / nullif(n_b, 0) AS vb,
        (hits_a + hits_b) * 1.0e0 / nullif(n_a + n_b, 0) AS pooled,
        n_a >= 2 AND n_b >= 2 AS ready
      FROM {source} WHERE mean_a IS NOT NULL AND mean_b IS NOT NULL AND ({where})),
w AS (SELECT *, sqrt(va + vb) AS se, sqrt(pooled * (1 - pooled) * (1.0e0 / nullif(n_a, 0) + 1.0e0 / nullif(n_b, 0))) AS zse,
        CASE WHEN ready THEN sqrt(((n_a - 1) * pow(coalesce(sd_a, 0), 2) + (n_b - 1) * pow(coalesce(sd_b, 0), 2))
             / nullif(n_a + n_b - 2, 0)) END AS sdp FROM v),
x0 AS (SELECT *, 1e-12 * greatest(abs(mean_a), abs(mean_b)) AS eps,
        CASE WHEN abs(mean_a - mean_b) <= 1e-12 * greatest(abs(mean_a), abs(mean_b)) THEN 0.0e0 ELSE mean_a - mean_b END AS delta FROM w),
x AS (SELECT *, CASE WHEN ready AND se > eps THEN delta / se END AS t,
        CASE WHEN ready AND se > eps THEN pow(va + vb, 2) / (va * va / (n_a - 1) + vb * vb / (n_b - 1)) END AS dof,
        CASE WHEN pooled > 0 AND pooled < 1 THEN (hits_a * 1.0e0 / n_a - hits_b * 1.0e0 / n_b) / zse END AS z,
        CASE WHEN sdp > eps THEN delta / sdp END AS d FROM x0),
y AS (SELECT *, 100.0e0 * (mean_a - mean_b) / nullif(mean_b, 0) AS delta_pct,
        CASE WHEN kind = 'share' THEN CASE WHEN pooled IN (0, 1) THEN 1.0e0 ELSE {sql_normal_tail('z')} END
             WHEN t IS NOT NULL THEN {sql_student_tail('t', 'dof')}
             WHEN ready AND se <= eps THEN CASE WHEN delta = 0 THEN 1.0e0 ELSE 0.0e0 END END AS p FROM x),
r AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY p NULLS LAST) * 1.0e0
        / nullif(count(p) OVER (PARTITION BY {keys}), 0) * 0.05e0 AS step FROM y),
s AS (SELECT *, coalesce(p <= max(CASE WHEN p <= step THEN p END) OVER (PARTITION BY {keys}), FALSE) AS significant FROM r),
judged AS (SELECT *,
        CASE WHEN d IS NULL THEN 'undetermined' WHEN abs(d) < 0.2 - 1e-12 THEN 'insignificant' WHEN abs(d) < 0.5 - 1e-12 THEN 'small'
             WHEN abs(d) < 0.8 - 1e-12 THEN 'medium' ELSE 'large' END AS magnitude,
        CASE WHEN delta = 0 THEN 'unchanged' WHEN sense = 'neutral' THEN 'neutral'
             WHEN (delta > 0) = (sense = 'higher') THEN 'better' ELSE 'worse' END AS direction,
        CASE WHEN significant THEN 'significant' WHEN p < 0.05 THEN 'hint' ELSE 'noise' END AS verdict FROM s)"""
