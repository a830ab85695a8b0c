import json
import os

import pytest
from pyspark.sql import functions as F

from scrimlens import schemas
from scrimlens.functions.filters import from_day
from scrimlens.operators import curate, state
from scrimlens.plans import registry, reports
from scrimlens.sources import readers, requests, scope, writers
from scrimlens.streaming import curation, landing, ratings, usage
from tests.fixtures import landed, match, participant, timeline

A, B = "A" * 78, "B" * 78


@pytest.fixture(scope="module")
def documents():
    duo = match(1, [participant(A, "TOP"), participant(B, "JUNGLE", False), participant("c", "TOP", False), participant("d", "TOP")])
    return landed(
        (A, duo), (B, duo),  # two tracked players in one match
        (A, match(2, [participant(A, "", challenges=False)], day=1, queue=450)),  # laneless, no challenges
        (A, match(3, [participant(A, "TOP", challenges={"effectiveHealAndShielding": 2.7, "soloKills": 3.0}, kills=4)], day=9)),
        (A, match(4, [participant("someone", "TOP")], day=2)),  # the owner does not take part
        (A, match(5, [participant(A, "MIDDLE", challenges={"soloKills": 2.5})], day=3, seconds=80)),
        (B, "{broken"),
    )


@pytest.fixture(scope="module")
def raw(spark, documents):
    df = spark.createDataFrame(documents, "puuid string, document string")
    return curate.promote(df, ingested_at=F.lit("now"))


def test_column_counts():
    assert len(schemas.CURATED_MATCH) == 84 and len(schemas.CURATED_PEER) == 28
    assert len(schemas.TIMELINE_FRAME) == 17
    assert schemas.snake("challenges.maxCsAdvantageOnLaneOpponent") == "max_cs_advantage_on_lane_opponent"


def test_promotion(spark, raw, documents):
    rows = {(r.match_id, r.puuid): r for r in raw.collect()}
    assert len(rows) == 6 and set(raw.columns) == set(schemas.RAW_MATCH.names)
    r = rows["LA2_3", A]
    assert (r.year, r.month, r.day, r.queue_id, r.game_duration) == ("2025", "09", "11", 420, 1801)
    assert json.loads(r.payload)["metadata"]["matchId"] == "LA2_3"
    bad = curate.parsed_headers(spark.createDataFrame(documents, "puuid string, document string")).where(~curate.has_id())
    assert [b.document for b in bad.collect()] == ["{broken"]


def test_match_rows(raw):
    got = curate.flatten_matches(raw)
    assert got.columns == schemas.CURATED_MATCH.names
    assert [f.dataType for f in got.schema] == [f.dataType for f in schemas.CURATED_MATCH]
    rows = {(r.match_id, r.puuid): r for r in got.collect()}
    assert set(rows) == {("LA2_1", A), ("LA2_1", B), ("LA2_2", A), ("LA2_3", A), ("LA2_5", A)}
    r = rows["LA2_3", A]
    assert (r.effective_heal_and_shielding, r.solo_kills, r.cs, r.duration_min, r.time_ccing_others) == (3, 3, 120, 30.0, 7.5)
    assert rows["LA2_2", A].kda is None and rows["LA2_2", A].team_position == "" and rows["LA2_2", A].queue_id == 450
    assert rows["LA2_5", A].solo_kills == 3 and rows["LA2_5", A].duration_min == 1.3
    assert r.game_version == "16.17.1" and str(r.played_at) == "2025-09-11 00:00:01"


def test_peer_rows_once_per_match(raw):
    got = curate.flatten_peers(raw)
    rows = [(r.match_id, r.puuid) for r in got.collect()]
    assert len(rows) == len(set(rows))
    assert sorted(rows) == sorted([("LA2_1", A), ("LA2_1", B), ("LA2_1", "c"), ("LA2_1", "d"), ("LA2_3", A), ("LA2_4", "someone"), ("LA2_5", A)])
    assert got.columns == schemas.CURATED_PEER.names
    assert got.where("match_id = 'LA2_1'").first().cs_per_min == pytest.approx(120 / 30.0)


def test_copies_are_chosen_without_moving_payloads(raw):
    """More matches than may be broadcast: what is joined are parsed rows, not documents."""
    few, many = curate.flatten_peers(raw), curate.flatten_peers(raw, most_broadcast=0)
    assert sorted(map(str, many.collect())) == sorted(map(str, few.collect()))
    plan = many._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftSemi") < plan.index("Generate explode")


def test_copies_that_rows_tell_themselves_are_not_joined(spark):
    """Only matches whose smallest player has no copy, or a copy by somebody else, are looked up, however many matches there are."""
    def copy(number, owner, kills):
        people = [participant(p, kills=kills) for p in ("a", "b", "c")]
        return owner, json.dumps(match(number, people))
    docs = [copy(1, "a", 1), copy(1, "b", 2), copy(2, "c", 3), copy(2, "b", 4), copy(3, "a", 5), copy(3, "Z", 6)]
    raw = curate.promote(spark.createDataFrame(docs, "puuid string, document string"))
    few, many = curate.flatten_peers(raw, most_broadcast=2), curate.flatten_peers(raw, most_broadcast=1)
    want = [(f"LA2_{n}", p, kills) for n, kills in ((1, 1), (2, 4), (3, 6)) for p in ("a", "b", "c")]
    for got in (few, many):
        assert sorted((r.match_id, r.puuid, r.kills) for r in got.collect()) == want
    assert "LeftSemi" in many._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in few._jdf.queryExecution().optimizedPlan().toString()


def test_peers_of_shared_documents_need_no_choice_of_a_copy(spark, raw):
    """A match with its owners in a list lies there once: the same peers, without a pass over the documents before."""
    shared = raw.groupBy("match_id", "game_creation", "game_duration", "queue_id", "payload").agg(F.collect_list("puuid").alias("puuid"))
    got = curate.flatten_peers(shared)
    assert sorted(map(str, got.collect())) == sorted(map(str, curate.flatten_peers(raw).collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Aggregate") == 1  # the list of the test itself


def test_documents_shared_by_players_are_parsed_once(raw):
    """Rows with a list of players give the rows of one row a player."""
    shared = raw.groupBy("match_id", "game_creation", "game_duration", "queue_id", "payload").agg(F.collect_list("puuid").alias("puuid"))
    assert sorted(map(str, curate.flatten_matches(shared).collect())) == sorted(map(str, curate.flatten_matches(raw).collect()))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="driver tables are not here")
@pytest.mark.parametrize("name", ["flatten_documents", "peer_flatten", "minute_benchmarks", "report_champions", "report_win_loss", "report_recent_matches"])
def test_document_queries_write_no_documents(spark, name):
    files = registry.QUERIES[name](spark, "/root/testdata/sf0.001").inputFiles()
    assert files and all("lineitem" in f for f in files)


def test_shared_documents_are_curated_without_repeats(spark, folder, raw):
    """The same tables from documents that lie once for all their owners; each participant is staged once, and nothing is left of the stage."""
    shared = raw.groupBy("match_id", "game_creation", "game_duration", "queue_id", "payload").agg(F.collect_list("puuid").alias("puuid"))
    staged = curate.shared_parse(curate.participants(shared, together=True))
    assert staged.groupBy("match_id", "peer.puuid").count().where("count > 1").isEmpty()
    lakes = [curation.Lake(f"{folder}/{name}") for name in ("shared", "single")]
    for rows, lake in zip((shared, raw), lakes, strict=True):
        for buckets in (3, 5):  # the second run adds nothing
            curation.curate_raw(rows, lake, buckets=buckets)
        assert not [f for _, _, names in os.walk(f"{lake.root}/curate_staging") for f in names]
    for read, of in ((readers.read_matches, "matches"), (readers.read_peers, "peers")):
        got, want = (read(spark, getattr(lake, of)).drop("bucket", "buckets") for lake in lakes)
        assert want.count() > 0 and sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_recent_matches_of_documents_move_few_whole_rows(raw):
    """The report over the curated rows, and rows that cannot be among the newest are gone before their documents are parsed."""
    shared = raw.groupBy("match_id", "game_creation", "game_duration", "queue_id", "payload").agg(F.collect_list("puuid").alias("puuid"))
    for rows in (raw, shared):
        want = reports.recent_matches(curate.flatten_matches(raw), AS_OF, 3000, 2, solo_only=False).collect()
        got = reports.recent_matches_of_documents(rows, AS_OF, 3000, 2, solo_only=False)
        assert want and sorted(map(str, got.collect())) == sorted(map(str, want))


def test_only_likely_rows_are_left(spark):
    """All of the three newest with their ties, also those of a hot entity, and few others."""
    rows = spark.range(20_000).select((F.col("id") % 20).alias("e"), F.when(F.col("id") % 20 == 0, F.col("id") / 2000).otherwise(F.col("id")).cast("int").alias("at"), "id")
    left = state.likely_newest(rows, rows.select("e", "at"), ["e"], "at", 3)
    want = {r.id for r in state.newest_per_entity(rows, ["e"], [F.desc("at"), F.desc("id")], 3).collect()}
    assert want <= {r.id for r in left.collect()} and left.where("e > 0").count() < 2_500
    assert {r.id for r in state.newest_per_entity(left, ["e"], [F.desc("at"), F.desc("id")], 3).collect()} == want
    assert state.likely_newest(rows, rows, ["e"], "at", 3, most_broadcast=0).count() == 20_000


def test_directories_of_keys_are_written_by_several_tasks(spark, folder):
    rows = spark.range(40).select(F.concat(F.lit("SU_"), "id").alias("match_id"), F.col("id").alias("payload"))
    writers.write_by_key(rows, f"{folder}/own", "match_id", a_task=5)
    names = [f for d in os.listdir(f"{folder}/own") if d.startswith("match_id=") for f in os.listdir(f"{folder}/own/{d}") if f.startswith("part-")]
    assert len(names) == 40 and len({n.split("-")[1] for n in names}) > 4
    assert readers.listed_match_ids(spark, f"{folder}/own").count() == 40


def test_shared_parse_gives_the_same_tables(raw):
    shared = curate.shared_parse(curate.participants(raw))
    assert sorted(map(str, curate.match_facts(shared).collect())) == sorted(map(str, curate.flatten_matches(raw).collect()))


def test_rival_is_the_smallest_other(spark):
    people = spark.createDataFrame(
        [("m", "TOP", x) for x in "bcd"] + [("m", "JUNGLE", "a")] + [("n", "TOP", "b")], "match_id string, team_position string, puuid string")
    got = {(r.match_id, r.puuid): r.rival for r in curate.lane_rivals(people, people).collect()}
    assert got == {("m", "b"): "c", ("m", "c"): "b", ("m", "d"): "b"}


def _timelines(spark):
    docs = [("LA2_1", timeline([A, B, "c", "d"])), ("LA2_5", {"info": {"frames": []}}), ("LA2_3", timeline([A]))]
    return spark.createDataFrame([(m, json.dumps(d)) for m, d in docs], "match_id string, payload string")


@pytest.mark.parametrize("most_broadcast", [1_000_000, 0])
def test_frames(spark, raw, most_broadcast):
    matches, peers = curate.flatten_matches(raw), curate.flatten_peers(raw)
    got = curate.flatten_frames(_timelines(spark), matches, peers, most_broadcast=most_broadcast)
    assert got.columns == schemas.TIMELINE_FRAME.names
    rows = {(r.match_id, r.puuid, r.minute): r for r in got.collect()}
    assert sorted(rows) == sorted([("LA2_1", p, m) for p in (A, B) for m in range(3)] + [("LA2_3", A, m) for m in range(3)])
    r = rows["LA2_1", A, 2]  # the end-of-game frame lies in minute 2 as well and must not win
    assert (r.gold, r.gold_rival, r.diff_gold, r.cs, r.level) == (500 + 1200, 500 + 3600, -2400, 13, 3)
    assert rows["LA2_1", B, 1].gold_rival is None and rows["LA2_1", B, 1].diff_cs is None
    done = got.where("match_id = 'LA2_1'")
    left = curate.flatten_frames(_timelines(spark), matches, peers, done, most_broadcast)
    assert {r.match_id for r in left.collect()} == {"LA2_3"}


@pytest.mark.parametrize("layout", ["bucket", "entity"])
def test_curation_twice_adds_nothing(spark, raw, folder, layout):
    lake = curation.Lake(folder)
    for _ in range(2):
        curation.curate_raw(raw, lake, layout=layout, buckets=4, as_of="2025-09-12", lookback_days=30)
        curation.curate_frames(_timelines(spark), lake, layout=layout, buckets=4)
        curation.curate_frames(_timelines(spark), lake, whole=True, layout=layout, buckets=4)
    assert readers.read_matches(spark, lake.matches).count() == 5
    assert readers.read_matches(spark, lake.matches, A).count() == 4
    assert readers.read_peers(spark, lake.peers).count() == 7
    assert readers.read_frames(spark, lake.frames).count() == 9
    assert readers.read_frames(spark, lake.frames, B).count() == 3
    plan = readers.read_matches(spark, lake.matches, A)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(" in plan


def test_raw_round_trip_and_day_filter(spark, raw, documents, folder):
    writers.append_raw(raw, folder)
    writers.append_raw(raw, folder)
    back = readers.read_raw(spark, folder)
    assert back.count() == 6 and dict(back.dtypes)["month"] == "string"
    recent = back.where(from_day("2025-09-12", 3))
    assert {r.match_id for r in recent.collect()} == {"LA2_3"}
    assert "PartitionFilters: [(concat(year" in recent._jdf.queryExecution().executedPlan().toString()
    with open(f"{folder}/puuid={A}/year=2025/month=09/day=02/extra.json", "w") as f:
        f.write("not json\n")
    assert readers.read_raw(spark, folder).count() == 6
    parts = readers.split_raw(spark, folder, f"{folder}_staging")
    assert parts.counts == {"accepted": 6, "rejected": 1} and parts.accepted.count() == 6
    bad = parts.rejected.first()
    assert bad._corrupt_record == "not json" and bad.file.endswith("/day=02/extra.json")
    assert "extra" in {r.match_id for r in readers.listed_match_ids(spark, folder).collect()}


def test_timeline_marker_inherits_the_partition(spark, raw):
    fetched = spark.createDataFrame([("LA2_3", None), ("LA2_1", '{"info":{}}')], "match_id string, document string")
    rows = {r.match_id: r for r in curate.promote_timelines(fetched, raw).collect()}
    assert json.loads(rows["LA2_3"].payload) == {"info": {"frames": []}} and rows["LA2_3"].day == "11"
    assert rows["LA2_1"].puuid == A


# --- scope and requests ---------------------------------------------------------------

@pytest.fixture(scope="module")
def players(spark):
    return spark.createDataFrame([(A, "ana", "ana#LAS", 10), (B, "beto", "beto#LAS", 20)],
                                 "puuid string, game_name string, riot_id string, n int")


def test_session_wins_over_any_request(spark, players):
    asked = spark.createDataFrame([("beto#LAS",), ("beto",), (B,), (None,)], "player string").withColumn("session", F.lit(A))
    rows = scope.resolve_entities(asked, players, session="session").collect()
    assert all(r.resolved == A and r.resolution == "session" for r in rows)
    assert [r.puuid for r in scope.scoped(players, A).collect()] == [A]
    assert scope.scoped(players, None).count() == 2


def test_resolution_without_a_session(spark, players):
    asked = spark.createDataFrame([("BETO#las",), ("Ana",), (B,), (None,), ("nobody",)], "player string")
    rows = {r.player: (r.resolved, r.resolution) for r in scope.resolve_entities(asked, players).collect()}
    assert rows == {"BETO#las": (B, "name"), "Ana": (A, "name"), B: (B, "raw_id"), None: (None, "ambiguous_request"),
                    "nobody": (None, "unknown")}
    one = scope.resolve_entities(asked.where("player is null"), players.where("game_name = 'ana'")).first()
    assert (one.resolved, one.resolution) == (A, "only_player")


def test_request_bodies(spark):
    call = json.dumps({"method": "tools/call", "params": {"name": "get_trends", "arguments": {"days": 30, "role": "TOP"}}})
    bodies = [call, '{"method":"tools/list","params":{"name":"x"}}', "{broken", "[1]", "", None, '{"id":1}',
              '{"method":"tools/call","params":[1]}']
    log = spark.createDataFrame([(i, "0123456789", b) for i, b in enumerate(bodies)], "i int, token string, body string")
    rows = {r.i: r for r in requests.described(log).collect()}
    assert (rows[0].method, rows[0].tool, rows[0].arguments) == ("tools/call", "get_trends", {"days": "30", "role": "TOP"})
    assert [rows[i].method for i in range(1, 8)] == ["tools/list", "?", "?", None, None, None, "tools/call"]
    assert all(rows[i].tool is None for i in range(1, 8)) and rows[0].token == "01234567"


def test_unknown_token_is_told_apart(spark):
    users = spark.createDataFrame([("t1", A), ("t2", None)], "token string, puuid string")
    got = {r.token: r.known for r in scope.with_user(spark.createDataFrame([("t1",), ("t2",), ("t3",)], "token string"), users).collect()}
    assert got == {"t1": True, "t2": False, "t3": False}


def test_retention(spark):
    calls = spark.sql("""select * from values ('a', timestamp_ntz'2025-01-01 23:00:00'), ('a', timestamp_ntz'2025-01-09 01:00:00'),
        ('b', timestamp_ntz'2025-01-01 00:00:00'), ('b', timestamp_ntz'2025-01-20 00:00:00') t(u, at)""")
    got = {r.u: (r.calls, r.active_weeks, r.back_in_week_2) for r in requests.retention(calls, "u", "at").collect()}
    assert got == {"a": (2, 2, True), "b": (2, 2, False)}


# --- streams ------------------------------------------------------------------------

def test_landing_stream_is_idempotent(spark, documents, folder):
    spark.createDataFrame(documents, "puuid string, document string").write.json(f"{folder}/in")
    for attempt in (1, 2):
        stream = landing.file_stream(spark, f"{folder}/in", landing.LANDED, files_per_batch=1)
        landing.land_documents(stream, f"{folder}/raw", f"{folder}/ckpt{attempt}").awaitTermination()
    assert readers.read_raw(spark, f"{folder}/raw").count() == 6


def test_watermark_dedup(spark, folder):
    rows = spark.sql("select * from values (1, timestamp_ntz'2025-01-01 00:00:00'), (1, timestamp_ntz'2025-01-01 01:00:00'), "
                     "(2, timestamp_ntz'2025-01-01 00:00:00') t(id, ts)")
    rows.write.parquet(f"{folder}/in")
    stream = landing.without_repeats(landing.file_stream(spark, f"{folder}/in", rows.schema, "parquet"), ["id"], "ts")
    query = (stream.writeStream.format("memory").queryName("dedup_out").trigger(availableNow=True)
             .option("checkpointLocation", f"{folder}/ckpt").start())
    query.awaitTermination()
    assert sorted(r.id for r in spark.table("dedup_out").collect()) == [1, 2]


def test_change_stream_matches_the_batch(spark, folder):
    rows = [("p", m, 300 + m // 3, "MASTER", "I", m, 0) for m in range(12)] + [("q", m, 1, "GOLD", "II", 0, 0) for m in range(12)]
    points = spark.createDataFrame(rows, schemas.RATING_POINT)
    for part in range(3):
        points.where((F.col("moment") / 4).cast("int") == part).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = landing.file_stream(spark, f"{folder}/in", schemas.RATING_POINT, "parquet", files_per_batch=1)
    ratings.record_changes(stream, f"{folder}/out", f"{folder}/ckpt").awaitTermination()
    got = sorted((r.puuid, r.moment) for r in ratings.read_changes(spark, f"{folder}/out").collect())
    assert got == [("p", 0), ("p", 3), ("p", 6), ("p", 9), ("q", 0)]


def test_usage_stream_adds_up_over_batches(spark, folder):
    for day in (1, 2, 3):
        spark.sql(f"select 't' token, timestamp'2025-01-0{day} 00:00:00' at").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    schema = spark.read.parquet(f"{folder}/in").schema
    stream = landing.file_stream(spark, f"{folder}/in", schema, "parquet", files_per_batch=1)
    usage.count_usage(stream, f"{folder}/out", f"{folder}/ckpt").awaitTermination()
    row = usage.read_usage(spark, f"{folder}/out").first()
    assert row.calls == 3 and str(row.last_use).startswith("2025-01-03")


# --- reports over the match tables ----------------------------------------------------

@pytest.fixture(scope="module")
def lake_tables(spark):
    docs = []
    for i in range(60):
        win = i % 2 == 0
        role = "TOP" if i % 10 else "MIDDLE"
        people = [
            participant(A, role, win, {"kda": 4.0 + i % 3, "soloKills": float(i % 4), "dragonTakedowns": (3.0 if win else 0.0) + i % 3}, deaths=2 + i % 3),
            participant(B, role, not win, {"kda": 2.0 + i % 4}, deaths=5 + i % 2),
            *[participant(f"peer{i % 7}{k}", role, k == 0, {"kda": 6.0 + i % 2}, deaths=3) for k in range(2)],
        ]
        docs.append((A, match(1000 + i, people, day=i, version=f"16.{1 + i // 20}.9")))
    raw = curate.promote(spark.createDataFrame(landed(*docs), "puuid string, document string"))
    matches, peers_ = curate.flatten_matches(raw).cache(), curate.flatten_peers(raw).cache()
    lines = [(f"LA2_{1000 + i}", json.dumps(timeline([A, B, f"peer{i % 7}0", f"peer{i % 7}1"], (0, 5, 10, 14, 20)))) for i in range(60)]
    frames = curate.flatten_frames(spark.createDataFrame(lines, "match_id string, payload string"), matches, peers_).cache()
    return matches, peers_, frames


AS_OF = "2025-11-01 00:00:00"


def test_all_reports_run(spark, lake_tables):
    matches, peers_, frames = lake_tables
    trends = reports.window_trends(matches, AS_OF, 30)
    assert {r.puuid for r in trends.collect()} == {A} and trends.where("metric = 'win_rate'").count() == 1
    assert reports.trend_overview(matches, trends, AS_OF, 30).first().recent_n == 30
    assert reports.champion_pool_trends(matches, AS_OF, 30).first().status == "constant"
    lake = reports.coaching_priorities(matches, peers_, AS_OF)
    assert {r.team_position for r in lake.collect()} == {"TOP"}
    deaths = {r.metric: r for r in lake.collect()}["deaths"]
    assert deaths.n_b == 3 * 54 and deaths.peers == 15
    own = {r.metric: r for r in reports.coaching_priorities(matches, peers_, AS_OF, scope="own_matches").collect()}["deaths"]
    assert own.n_b == 3 * 54 and own.mean_b == pytest.approx(deaths.mean_b)
    split = {r.metric: r for r in reports.win_loss_split(matches, AS_OF).collect()}
    assert split["dragon_takedowns"].relevant and split["dragon_takedowns"].guidance == "drops_clearly"
    assert reports.win_loss_sample(matches, AS_OF).first().status == "ok"
    marks = reports.laning_benchmarks(frames, matches, AS_OF).collect()
    assert {r.minute for r in marks} == {5, 10, 14, 20} and all(r.ahead_pct == 0.0 for r in marks)
    assert reports.lead_to_win(frames, matches).first().state == "behind"
    champs = reports.champion_stats(matches, AS_OF).first()
    assert champs.n == 60 and champs.win_pct == 50.0
    recent = reports.recent_matches(matches, AS_OF, 30, 5).collect()
    assert [r.place for r in recent] == [1, 2, 3, 4, 5] and recent[0].queue_name == "ranked solo/duo"
    assert reports.list_players(matches, A).first().riot_id == A.lower() + "#TAG"
    assert reports.list_players(matches, B).count() == 0
    assert {r.version for r in reports.patch_vs_rest(matches).collect()} == {"16.1", "16.2", "16.3"}
    assert [r.version for r in reports.patch_performance(matches).collect()] == ["16.3", "16.2", "16.1"]
    assert reports.monthly_trend(matches).count() == 2
    assert reports.role_performance(matches).count() == 2 and reports.early_phase(matches).count() == 2
    assert reports.peer_percentiles(peers_).count() == 24 and reports.peer_percentiles(peers_, exact=True).count() == 24
    assert reports.peer_sizes(peers_).count() == 2
    assert reports.player_and_peers(matches, peers_, A, "TOP").count() == 34
    assert reports.rival_coverage(matches).first().partial_coverage is False


def test_rating_reports(spark, lake_tables):
    matches, _, _ = lake_tables
    ranks = spark.createDataFrame([(A, {"RANKED_SOLO_5x5": ("GRANDMASTER", "I", 540, 88, 71)}, 1)], schemas.RANK_STATE)
    assert reports.ranks(ranks).first().queue_name == "ranked solo/duo"
    cuts = spark.createDataFrame([("la2", "challenger", 905, 6, 1010.5), ("kr", "challenger", 2, 1, 2.0), ("la2", "gold", 1, 1, 1.0)],
                                 "platform string, league string, cutoff int, seats int, median double")
    gap = reports.league_cutoff_gaps(ranks, matches, cuts).collect()
    assert [(g.league, g.missing) for g in gap] == [("challenger", 905 - 540)]
    end = 1_761_955_200  # 2025-11-01 UTC
    steps = [(50, 610, 80, 66), (9, 520, 85, 70), (6, 533, 86, 70), (4, 523, 86, 71), (2, 540, 88, 71), (-3, 560, 89, 71)]
    rows = [(A, end - 86400 * d, lp, "GRANDMASTER", "I", w, l) for d, lp, w, l in steps]
    progress = reports.rating_progress(spark.createDataFrame(rows, schemas.RATING_POINT), AS_OF).first()
    # The first point is too old and the last lies after the end; two wins between two points tell nothing.
    assert (progress.points, progress.gain_median, progress.loss_median, progress.measurable) == (4, 13, 10, True)


def test_player_filter_reaches_the_scan(spark, lake_tables, folder):
    matches, _, _ = lake_tables
    matches.write.parquet(f"{folder}/m")
    report = reports.champion_stats(spark.read.parquet(f"{folder}/m"), AS_OF, player=A)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    pushed = [line for line in report._jdf.queryExecution().explainString(mode).splitlines() if "PushedFilters" in line]
    assert "GreaterThanOrEqual(played_at" in pushed[0] and "EqualTo(puuid" in pushed[0]


def test_tables_with_several_bucket_numbers_are_read_by_entity(spark, raw, folder):
    lake = curation.Lake(folder)
    first = raw.where("match_id IN ('LA2_1', 'LA2_2')")
    curation.curate_raw(first, lake, buckets=3)
    curation.curate_raw(raw, lake, buckets=64)
    everyone = readers.read_matches(spark, lake.matches)
    for who in (A, B):
        got = readers.read_matches(spark, lake.matches, who)
        assert got.count() == everyone.where(F.col("puuid") == who).count() > 0
        assert "PartitionFilters: [isnotnull(" in got._jdf.queryExecution().executedPlan().toString()


def test_late_rows_are_stored_once_despite_the_lookback(spark, raw, folder):
    lake = curation.Lake(folder)
    for _ in range(3):
        curation.curate_raw(raw, lake, buckets=4, as_of="2025-12-24", lookback_days=1)
    assert readers.read_matches(spark, lake.matches).count() == 5
    assert readers.read_peers(spark, lake.peers).count() == 7


def test_broken_documents_are_kept_beside_the_raw_rows(spark, documents, folder):
    broken = spark.createDataFrame([(A, "{no json"), (B, None), (B, '{"metadata": {}}')], "puuid string, document string")
    landed = spark.createDataFrame(documents, "puuid string, document string").unionByName(broken)
    landed.write.parquet(f"{folder}/landing")
    stream = landing.file_stream(spark, f"{folder}/landing", landing.LANDED, "parquet")
    landing.land_documents(stream, f"{folder}/raw", f"{folder}/checkpoint").awaitTermination()
    kept = spark.read.parquet(f"{folder}/raw_unreadable").select("puuid", "document")
    good = readers.read_raw(spark, f"{folder}/raw")
    assert {tuple(r) for r in broken.collect()} <= {tuple(r) for r in kept.collect()}
    assert good.count() > 0 and kept.count() + good.count() <= landed.count()


def test_rows_after_the_end_of_a_window_change_nothing(spark, lake_tables):
    matches, _, _ = lake_tables
    later = matches.withColumns({"played_at": F.to_timestamp_ntz(F.lit(AS_OF)), "kills": F.lit(99)})
    both = matches.unionByName(later)
    plain = lambda df: sorted(map(str, df.collect()))
    assert plain(reports.window_trends(both, AS_OF, 30)) == plain(reports.window_trends(matches, AS_OF, 30))
    assert plain(reports.champion_stats(both, AS_OF)) == plain(reports.champion_stats(matches, AS_OF))


def test_waiting_timelines_are_found_by_their_ids(spark, folder, monkeypatch):
    """Which timelines wait is asked without their documents; one without an id waits too."""
    asked, settle = [], writers.settle
    monkeypatch.setattr(writers, "settle", lambda df: asked.append(df.columns) or settle(df))
    fetched = spark.createDataFrame([("m", "{}"), ("w", "{}"), (None, "{}")], "match_id string, document string")
    places = spark.createDataFrame([("m", "p", "2025", "09", "02")], "match_id string, puuid string, year string, month string, day string")
    writers.append_timelines(fetched, places, f"{folder}/timelines")
    assert asked == [["match_id"]]
    assert {r.match_id for r in writers.waiting_timelines(spark, f"{folder}/timelines").collect()} == {"w", None}
    assert [r.match_id for r in readers.read_raw_timelines(spark, f"{folder}/timelines").collect()] == ["m"]


def test_columns_of_documents(raw):
    """Some columns are the same as all with the others left out, and nothing else is taken out of a document."""
    wanted = ["match_id", "puuid", "played_at", "cs", "solo_kills", "team_position", "queue_id"]
    plain = lambda df: sorted(map(str, df.select(*wanted).collect()))
    some = curate.flatten_matches(raw, wanted)
    assert set(some.columns) == set(wanted) and plain(some) == plain(curate.flatten_matches(raw))
    parsed = {f.name for f in schemas.document_of(wanted)["info"].dataType["participants"].dataType.elementType}
    assert parsed == {"puuid", "teamPosition", "totalMinionsKilled", "neutralMinionsKilled", "challenges"}
    peers = ["match_id", "puuid", "cs_per_min", "wards_killed", "team_position"]
    all_peers = curate.flatten_peers(raw).select(*peers)
    assert sorted(map(str, curate.flatten_peers(raw, columns=peers).select(*peers).collect())) == sorted(map(str, all_peers.collect()))


def test_both_tables_of_one_parse(spark):
    """Marked participants give the rows that the two tables have on their own, also of who is named twice or nowhere."""
    nobody = {**participant("n"), "puuid": None}
    twice = match(1, [participant(A), participant("b", win=False), participant("b", "JUNGLE"), nobody, {**nobody, "teamPosition": "MIDDLE"}])
    lines = [([A, "b"], json.dumps(twice)), (["x", None], json.dumps(match(2, [participant("y"), participant("z", "")]))), ([A], "{broken")]
    raw = curate.promote(spark.createDataFrame(lines, "owners array<string>, document string"), "owners", ingested_at=F.lit("now"))
    columns = ["match_id", "puuid", "team_position", "win", "kda", "cs"]
    people = curate.participants(raw, together=True, mark=True, document=schemas.document_of(columns))
    found = curate.both_facts(people, columns, columns[:-1])
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(found[0]) == rows(curate.flatten_matches(raw, columns)) and found[0].count() == 3
    assert rows(found[1]) == rows(curate.flatten_peers(raw, columns=columns[:-1])) and found[1].count() == 4
