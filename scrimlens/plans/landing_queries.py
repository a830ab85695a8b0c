"""What lands from several deliveries, on orders as light documents; each with its oracle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from scrimlens.functions.expressions import epoch_seconds
from scrimlens.operators import curate, state
from scrimlens.plans.tables import table, work_folder
from scrimlens.sources import readers, writers
from scrimlens.streaming import landing

DAYS = ("year", "month", "day")
AT = "2024-01-01T00:00:00+00:00"


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per order and customer, played on the first of the order's month: (puuid, document, o_orderkey, o_orderdate)."""
    played = F.date_trunc("month", "o_orderdate").cast("timestamp_ntz")
    match_id = F.concat(F.lit("OR_"), F.col("o_orderkey").cast("string"))
    document = F.struct(
        F.struct(match_id.alias("matchId")).alias("metadata"),
        F.struct((epoch_seconds(played) * 1000).alias("gameCreation"), F.lit(1800).alias("gameDuration"), F.lit(420).alias("queueId")).alias("info"))
    puuid = F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
    return table(spark, sf_dir, "orders").select(puuid.alias("puuid"), F.to_json(document).alias("document"), "o_orderkey", "o_orderdate")


def _landed(raw: DataFrame) -> DataFrame:
    return raw.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("match_id").alias("matches"))


def _delivery(key: Column) -> list[Column]:
    """Three deliveries of the orders, each overlapping the ones before."""
    return [key % 4 < 2, (key % 4).isin(1, 2), key % 4 != 1]


def ledger_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three overlapping deliveries land each order once; how many rows were new comes from the ledger of keys."""
    path = f"{work_folder(spark)}/raw"
    documents = order_documents(spark, sf_dir)
    new = []
    for part in _delivery(F.col("o_orderkey")):
        raw = curate.promote(documents.where(part), ingested_at=F.lit(AT))
        new.append(writers.append_raw(raw, path, partitions=DAYS))
    counted = spark.createDataFrame([(f"new_{i}", "", n, n) for i, n in enumerate(new)], "year string, month string, n long, matches long")
    keys = writers.ledger_of(spark, path).places()
    known = keys.agg(F.lit("known").alias("year"), F.lit("").alias("month"), F.count(F.lit(1)).alias("n"), F.count_distinct("match_id").alias("matches"))
    return _landed(readers.read_raw(spark, path)).unionByName(counted).unionByName(known)


def late_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The middle years first, then the newest with a year again, then the oldest: all land, and what came too late is told."""
    folder = work_folder(spark)
    documents = order_documents(spark, sf_dir)
    year = F.year("o_orderdate")
    for part in (year.isin(1995, 1996), year >= 1996, year < 1995):
        documents.where(part).select("puuid", "document").write.mode("append").json(f"{folder}/in")
        stream = landing.file_stream(spark, f"{folder}/in", landing.LANDED, with_file=True)
        landing.land_documents(stream, f"{folder}/raw", f"{folder}/checkpoint", DAYS, repeats_within="1 hour", ingested_at=F.lit(AT)).awaitTermination()
    raw = _landed(readers.read_raw(spark, f"{folder}/raw"))
    late = spark.read.parquet(f"{folder}/raw_late").groupBy("year", "month").agg(F.count_distinct("match_id").alias("late"))
    return raw.join(late, ["year", "month"], "left").select("year", "month", "n", "matches", F.coalesce("late", F.lit(0)).alias("late"))


def split_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines of which some do not parse: one pass gives the rows and, beside them, the broken lines with their file."""
    folder = work_folder(spark)
    documents = order_documents(spark, sf_dir)
    raw = curate.promote(documents, ingested_at=F.lit(AT))
    line = F.to_json(F.struct(*[c for c in raw.columns if c not in DAYS]))
    broken = F.substring_index("match_id", "_", -1).cast("bigint") % 11 == 0
    cut = F.when(broken, F.substring(line, F.lit(1), F.length(line) - 5)).otherwise(line)
    raw.select(cut.alias("value"), *DAYS).write.partitionBy(*DAYS).text(f"{folder}/raw")
    parts = readers.split_raw(spark, f"{folder}/raw", f"{folder}/staging")
    rows = _landed(parts.accepted).select("year", "month", F.lit("rows").alias("part"), "n", "matches")
    month = F.regexp_extract("file", r"/year=(\d+)/month=(\d+)/", 0)
    bad = parts.rejected.groupBy(F.regexp_extract(month, r"year=(\d+)", 1).alias("year"), F.regexp_extract(month, r"month=(\d+)", 1).alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("_corrupt_record").alias("matches"))
    return rows.unionByName(bad.select("year", "month", F.lit("broken").alias("part"), "n", "matches"))


def waiting_timelines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timelines fetched before their match wait, and land beside it once it is there."""
    folder = work_folder(spark)
    documents = order_documents(spark, sf_dir)
    fetched = documents.select(
        F.concat(F.lit("OR_"), F.col("o_orderkey").cast("string")).alias("match_id"),
        F.when(F.col("o_orderkey") % 5 > 0, F.lit('{"info":{"frames":[{"timestamp":0}]}}')).alias("document"))
    # Some are fetched twice; every seventh match lands in time, more of them later, every eleventh never.
    first, later = F.col("o_orderkey") % 7 == 0, (F.col("o_orderkey") % 7 > 0) & (F.col("o_orderkey") % 11 > 0)
    twice = fetched.unionByName(fetched.where("match_id LIKE '%3'"))
    for part, lines in ((first, twice), (later, fetched.limit(0))):
        writers.append_raw(curate.promote(documents.where(part), ingested_at=F.lit(AT)), f"{folder}/raw", partitions=DAYS)
        places = writers.ledger_of(spark, f"{folder}/raw").places()
        writers.append_timelines(lines, places, f"{folder}/timelines", at=F.lit(AT))
    landed = readers.read_raw_timelines(spark, f"{folder}/timelines")
    marker = F.count_if(~F.contains("payload", F.lit("timestamp"))).alias("markers")
    rows = landed.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("match_id").alias("matches"), marker)
    waiting = writers.waiting_timelines(spark, f"{folder}/timelines").withColumn("payload", F.coalesce("document", F.lit("")))
    return rows.unionByName(waiting.agg(
        F.lit("waiting").alias("year"), F.count(F.lit(1)).alias("n"), F.count_distinct("match_id").alias("matches"), marker))


def listed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with a file of their own, known from the listing alone, against those that are wanted."""
    path = f"{work_folder(spark)}/files"
    suppliers = table(spark, sf_dir, "supplier")
    key = F.concat(F.lit("SU_"), F.col("s_suppkey").cast("string"))
    own = suppliers.where("s_acctbal > 0").select(key.alias("match_id"), F.col("s_name").alias("payload"))
    writers.write_by_key(own, path, "match_id")
    there = readers.listed_match_ids(spark, path).withColumn("listed", F.lit(True))
    return suppliers.select(key.alias("match_id"), "s_nationkey").join(there, "match_id", "left").select(
        "match_id", "s_nationkey", F.coalesce("listed", F.lit(False)).alias("listed"))


def player_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored rank map of users, read back by key for every third user; one row per queue."""
    path = f"{work_folder(spark)}/state"
    events = table(spark, sf_dir, "events")
    entries = events.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("puuid"), F.col("event_type").alias("queue"), F.lit("GOLD").alias("tier"),
        F.lit("II").alias("division"), F.floor("value").cast("int").alias("lp"), F.lit(3).alias("wins"), F.lit(1).alias("losses"),
        F.col("event_id").cast("bigint").alias("updated_at"))
    state.rank_map(entries).write.parquet(path)
    asked = events.where("user_id % 3 = 0").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("puuid")).distinct()
    found = readers.read_rank_state(spark, path).join(asked, "puuid", "left_semi")
    return state.rank_rows(found).select("puuid", "queue", "lp", "win_pct", "updated_at")


QUERIES = {f.__name__: f for f in (ledger_landing, late_deliveries, split_lines, waiting_timelines, listed_ids, player_state)}

_MONTH = "strftime(o_orderdate, '%Y') AS \"year\", strftime(o_orderdate, '%m') AS \"month\""
SQL = {
    "ledger_landing": f"""SELECT {_MONTH}, count(*) AS n, count(DISTINCT o_orderkey) AS matches FROM orders GROUP BY 1, 2
  UNION ALL SELECT 'new_0', '', count(*), count(*) FROM orders WHERE o_orderkey % 4 < 2
  UNION ALL SELECT 'new_1', '', count(*), count(*) FROM orders WHERE o_orderkey % 4 = 2
  UNION ALL SELECT 'new_2', '', count(*), count(*) FROM orders WHERE o_orderkey % 4 = 3
  UNION ALL SELECT 'known', '', count(*), count(*) FROM orders""",
    "late_deliveries": f"""WITH o AS (SELECT *, date_trunc('month', o_orderdate) AS played FROM orders),
  d AS (SELECT *, 1 AS part FROM o WHERE year(o_orderdate) IN (1995, 1996) UNION ALL SELECT *, 2 FROM o WHERE year(o_orderdate) >= 1996
        UNION ALL SELECT *, 3 FROM o WHERE year(o_orderdate) < 1995),
  repeated AS (SELECT o_orderkey FROM o WHERE year(o_orderdate) = 1996),
  -- What is delivered again within the hour is held back by the stream's state.
  fresh AS (SELECT * FROM d WHERE NOT (part = 2 AND o_orderkey IN (SELECT o_orderkey FROM repeated))),
  marks AS (SELECT 1 AS part, NULL::TIMESTAMP AS mark UNION ALL SELECT 2, max(played) FROM fresh WHERE part < 2
            UNION ALL SELECT 3, max(played) FROM fresh WHERE part < 3),
  late AS (SELECT DISTINCT o_orderkey FROM fresh JOIN marks USING (part) WHERE played < mark - INTERVAL 3 DAY)
  SELECT {_MONTH}, count(*) AS n, count(DISTINCT o.o_orderkey) AS matches, count(late.o_orderkey) AS late
  FROM o LEFT JOIN late ON late.o_orderkey = o.o_orderkey GROUP BY 1, 2""",
    "split_lines": f"""SELECT {_MONTH}, 'rows' AS part, count(*) AS n, count(*) AS matches FROM orders WHERE o_orderkey % 11 <> 0 GROUP BY 1, 2
  UNION ALL SELECT {_MONTH}, 'broken', count(*), count(*) FROM orders WHERE o_orderkey % 11 = 0 GROUP BY 1, 2""",
    "waiting_timelines": """SELECT strftime(o_orderdate, '%Y') AS "year", count(*) AS n, count(*) AS matches, count(*) FILTER (o_orderkey % 5 = 0) AS markers
  FROM orders WHERE o_orderkey % 7 = 0 OR o_orderkey % 11 > 0 GROUP BY 1
  UNION ALL SELECT 'waiting', count(*), count(*), count(*) FILTER (o_orderkey % 5 = 0) FROM orders WHERE o_orderkey % 7 > 0 AND o_orderkey % 11 = 0""",
    "listed_ids": "SELECT 'SU_' || s_suppkey AS match_id, s_nationkey, s_acctbal > 0 AS listed FROM supplier",
    "player_state": """SELECT 'u' || user_id AS puuid, event_type AS queue, CAST(floor(arg_max(value, event_id)) AS INTEGER) AS lp, CAST(75 AS DOUBLE) AS win_pct,
  max(max(event_id)) OVER (PARTITION BY user_id) AS updated_at FROM events WHERE user_id % 3 = 0 GROUP BY user_id, event_type""",
}
