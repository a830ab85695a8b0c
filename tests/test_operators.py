import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from scrimlens.functions import expressions as X, filters
from scrimlens.operators import backlog, compare, peers, quantiles, segments, series, state
from scrimlens.operators.metrics import SHARE, Metric
from scrimlens.operators.summarize import coverage, summarize


def _random_facts(spark, seed=3, entities=9, rows=400):
    rng = random.Random(seed)
    data = []
    for i in range(rows):
        # one entity owns a third of all rows
        e = "hot" if rng.random() < 0.33 else f"e{rng.randrange(entities)}"
        value = None if rng.random() < 0.1 else rng.gauss(50, 9)
        data.append((i, e, rng.choice("AB"), value, rng.random() < 0.5))
    return spark.createDataFrame(data, "id int, entity string, role string, x double, won boolean")


def test_leave_one_out_equals_the_explicit_join(spark):
    facts = _random_facts(spark)
    metrics = [Metric("x")]
    got = {(r.role, r.entity): r for r in peers.compare_to_peers(facts, facts, "entity", "role", metrics).collect()}
    rows = facts.collect()
    assert len(got) == len({(r.role, r.entity) for r in rows})
    for (role, entity), r in got.items():
        rest = [q.x for q in rows if q.role == role and q.entity != entity]
        known = [x for x in rest if x is not None]
        assert r.group_n_b == len(rest) and r.n_b == len(known)
        assert r.peers == len({q.entity for q in rows if q.role == role and q.entity != entity})
        assert r.mean_b == pytest.approx(statistics.mean(known), rel=1e-12)
        assert r.sd_b == pytest.approx(statistics.stdev(known), rel=1e-11)


def test_leave_one_out_keeps_digits_far_from_zero(spark):
    base = 1e9
    rows = [("a", "T", base + d) for d in (0.0, 1.0, 2.0)] + [("b", "T", base + d) for d in (5.0, 7.0)] + [("c", "T", base + 1.5)]
    df = spark.createDataFrame(rows, "entity string, role string, x double")
    got = {r.entity: r for r in peers.compare_to_peers(df, df, "entity", "role", [Metric("x")]).collect()}
    assert got["c"].sd_b == pytest.approx(statistics.stdev([0, 1, 2, 5, 7]), rel=1e-6)


def test_peer_pool_without_the_entity_and_alone_in_its_role(spark):
    own = spark.createDataFrame([("me", "T", 1.0), ("me", "T", 2.0), ("solo", "J", 3.0)], "entity string, role string, x double")
    pool = spark.createDataFrame([("p", "T", 4.0), ("q", "T", 6.0), ("solo", "J", 3.0)], "entity string, role string, x double")
    got = {r.entity: r for r in peers.compare_to_peers(own, pool, "entity", "role", [Metric("x")]).collect()}
    assert set(got) == {"me"}
    assert (got["me"].n_b, got["me"].mean_b, got["me"].peers) == (2, 5.0, 2)


@pytest.mark.parametrize("far", [0.0, 1e9])
def test_match_peers_equal_the_explicit_join(spark, far):
    rng = random.Random(5)
    rows = [(m, f"p{rng.randrange(12)}", rng.choice("AB"), far + rng.gauss(5, 2)) for m in range(60) for _ in range(6)]
    df = spark.createDataFrame(rows, "m int, entity string, role string, x double")
    got = {(r.role, r.entity): r for r in peers.match_peers(df, df, "entity", "role", "m", [Metric("x")]).collect()}
    for (role, entity), r in got.items():
        mine = {m for m, e, ro, _ in rows if e == entity and ro == role}
        rest = [x for m, e, ro, x in rows if m in mine and ro == role and e != entity]
        assert r.n_b == len(rest)
        if len(rest) > 1:
            assert r.mean_b == pytest.approx(statistics.mean(rest)) and r.sd_b == pytest.approx(statistics.stdev(rest))


def _windows(spark, shift, n=60, sd=1.0):
    """Two windows whose metric d has the given shift; mean and spread are exact."""
    rows = []
    z = (np.arange(n) - (n - 1) / 2)
    z = z / z.std(ddof=1) * sd
    for day, mean in ((10, 5.0 + shift), (40, 5.0)):
        rows += [("p", day, i % 2 == 0, float(mean + v), float(5 + v)) for i, v in enumerate(z)]
    df = spark.createDataFrame(rows, "puuid string, back int, win boolean, d double, flat double")
    ts = F.expr("timestamp_ntz'2025-01-01 00:00:00' - make_dt_interval(back)")
    return df.withColumn("ts", ts)


METRICS = [Metric("d", "lower"), Metric("flat")]


def test_windows_nothing_moved(spark):
    rows = compare.compare_windows(_windows(spark, 0.0), ["puuid"], METRICS, "ts", "2025-01-01", 30, "win").collect()
    assert {r.metric for r in rows} == {"win_rate", "d", "flat"}
    assert all(r.verdict == "noise" and not r.significant and r.enough for r in rows)


def test_windows_one_hint(spark):
    # p is about 0.04 for d alone: below 0.05 but not below 0.05 / 3
    rows = {r.metric: r for r in compare.compare_windows(
        _windows(spark, 0.375), ["puuid"], METRICS, "ts", "2025-01-01", 30, "win").collect()}
    assert 0.0167 < rows["d"].p < 0.05
    assert rows["d"].verdict == "hint" and not rows["d"].significant and rows["d"].direction == "worse"
    report = compare.compare_windows(_windows(spark, 0.375), ["puuid"], METRICS, "ts", "2025-01-01", 30, "win")
    over = compare.window_overview(_windows(spark, 0.375), report, ["puuid"], "ts", "2025-01-01", 30, "win").first()
    assert over.hints == ["d"] and over.significant_metrics == [] and over.note == "stable"


def test_rounded_decisions_move_the_boundary(spark):
    # exact d of 0.196 is below the small band; rounded to 0.20 it is not
    rows = [(0.196, 5000, 1.0), (0.0, 5000, 1.0)]
    sides = spark.createDataFrame(
        [("e", "m", "higher", "mean", 5000, 0.196, 1.0, None, 5000, 0.0, 1.0, None)],
        "e string, metric string, sense string, kind string, n_a long, mean_a double, sd_a double, hits_a long, "
        "n_b long, mean_b double, sd_b double, hits_b long")
    assert len(rows) == 2
    assert compare.judge(sides, ["e"]).first().relevant is False
    assert compare.judge(sides, ["e"], decide_on_rounded=True).first().relevant is True


def test_window_missing_and_partial_coverage(spark):
    df = _windows(spark, 0.0).where("back = 10")
    assert compare.compare_windows(df, ["puuid"], METRICS, "ts", "2025-01-01", 30).count() == 0
    empty = compare.compare_windows(df, ["puuid"], METRICS, "ts", "2025-01-01", 30)
    assert compare.window_overview(df, empty, ["puuid"], "ts", "2025-01-01", 30, "win").first().note == "window_missing"
    gaps = _windows(spark, 0.0).withColumn("flat", F.when(F.col("flat") > 5, F.col("flat")))
    got = {r.metric: r.partial_coverage for r in compare.compare_windows(
        gaps, ["puuid"], METRICS, "ts", "2025-01-01", 30, "win").collect()}
    assert got == {"win_rate": False, "d": False, "flat": True}


def test_outcome_split_sample_and_order(spark):
    rows = [("p", i % 2 == 0, 9.0 if i % 2 == 0 else 5.0, (5.4 if i % 2 == 0 else 5.0) + (i % 5) / 10, float(i % 7)) for i in range(80)]
    rows += [("few", i > 1, 1.0, 1.0, 1.0) for i in range(20)]
    df = spark.createDataFrame(rows, "e string, win boolean, dragons double, cs double, same double").withColumn(
        "dragons", F.col("dragons") + F.rand(1) * 2)
    got = compare.compare_outcomes(df, ["e"], [Metric("dragons"), Metric("cs"), Metric("same")], "win").collect()
    assert {r.e for r in got} == {"p"}
    ordered = [r.metric for r in sorted(got, key=lambda r: -abs(r.d))]
    assert ordered[0] == "dragons"
    assert {r.metric: r.guidance for r in got}["same"] == "same_in_both"
    assert {r.e: r.status for r in compare.outcome_sample(df, ["e"], "win").collect()} == {"p": "ok", "few": "insufficient_sample"}


def test_share_metric_uses_the_share_spread(spark):
    df = spark.createDataFrame([("e", i < 20, i % 4 == 0 or i < 10) for i in range(40)], "e string, win boolean, first boolean")
    r = compare.compare_outcomes(df, ["e"], [Metric("first", kind=SHARE)], "win").first()
    assert r.mean_a == pytest.approx(r.hits_a / 20) and r.sd_a == pytest.approx(math.sqrt(r.mean_a * (1 - r.mean_a)))
    assert r.dof is None and 0 < r.p < 1


def test_pool_changes(spark):
    rows = [("u", "new", 5)] * 4 + [("u", "gone", 40)] * 4 + [("u", "both", 5)] * 3 + [("u", "both", 40)] * 3 + [("u", "rare", 5)]
    df = spark.createDataFrame(rows, "u string, c string, back int").withColumns(
        {"ts": F.expr("timestamp_ntz'2025-01-01 00:00:00' - make_dt_interval(back)"), "win": F.lit(True)})
    got = {r.c: r for r in compare.pool_changes(df, ["u"], "c", "ts", "2025-01-01", 30, "win").collect()}
    assert {k: v.status for k, v in got.items()} == {"new": "new", "gone": "dropped", "both": "constant"}
    assert got["new"].p is None and not got["new"].significant and got["both"].p == 1.0


def test_group_vs_rest_equals_direct_counts(spark):
    facts = _random_facts(spark, seed=11)
    got = {r.entity: r for r in compare.group_vs_rest(facts, ["entity"], "won").collect()}
    rows = facts.collect()
    for e, r in got.items():
        rest = [q for q in rows if q.entity != e]
        assert (r.rest_n, r.rest_hits) == (len(rest), sum(q.won for q in rest))
    within = compare.group_vs_rest(facts, ["entity"], "won", least=1, within=["role"]).collect()
    assert len(within) == len({(q.role, q.entity) for q in rows})


@pytest.mark.parametrize("accuracy", [20_000, 100])
def test_exact_quantiles(spark, accuracy):
    """The low accuracy forces the bracket path: groups are larger than the sketch."""
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.4 else f"g{rng.randrange(4)}",
             None if rng.random() < 0.05 else rng.choice([rng.gauss(0, 1), 7.0])) for _ in range(6000)]
    df = spark.createDataFrame(rows + [(None, 1.0), (None, 2.0)], "g string, x double")
    for upper in (False, True):
        got = quantiles.exact_quantiles(df, ["g"], ["x"], [0.0, 0.25, 0.5, 0.9, 1.0], upper, accuracy).collect()
        for r in got:
            values = sorted(x for g, x in (rows + [(None, 1.0), (None, 2.0)]) if g == r.g and x is not None)
            assert r.n == len(values)
            want = values[min(int(r.share * len(values)), len(values) - 1)] if upper else float(np.quantile(values, r.share))
            assert r.value == pytest.approx(want, rel=1e-12, abs=1e-12), (r, upper)
    approx = {r.g: r.value for r in quantiles.approx_percentiles(df.where("g = 'hot'"), ["g"], ["x"], [0.5]).collect()}
    assert approx["hot"] in {x for g, x in rows if g == "hot"}


def test_previous_row_across_slices(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["hot", "hot", "a", "b", None]), rng.choice([None, rng.randrange(50)]), i, rng.randrange(3)) for i in range(500)]
    df = spark.createDataFrame(rows, "e string, t int, id int, v int")
    plain = {r.id: r.previous for r in series.with_previous(df, "e", ["t", "id"], ["v", "id"]).collect()}
    sliced = {r.id: r.previous for r in series.with_previous(df, "e", ["t", "id"], ["v", "id"], [F.floor(F.col("t") / 7)]).collect()}
    assert plain == sliced and len(sliced) == 500


def _points(spark, rows):
    return spark.createDataFrame(
        [("p", m, lp, t, d, w, l) for m, lp, w, l, t, d in rows],
        "puuid string, moment long, lp int, tier string, division string, wins int, losses int")


def _progress(spark, rows, **kw):
    points = _points(spark, rows)
    deltas = series.rating_deltas(points, **kw)
    return series.rating_progress(points, deltas).first(), deltas


def _simulated(seed, n=60):
    """A rating series with runs of games between the points, and what can be told from it."""
    rng = random.Random(seed)
    lp, won, lost, tier, at = 400, 40, 35, "GRANDMASTER", 10
    rows, gains, losses, ambiguous = [(at, lp, won, lost, tier, "I")], [], [], 0
    for _ in range(n):
        at += rng.randint(1, 9)
        kind = rng.choice(["win", "win", "loss", "both", "rank"])
        step = rng.choice([14, 14, 15, 41]) if kind == "win" else -rng.choice([11, 12])
        if kind == "win":
            won, lp = won + 1, lp + step
            gains.append(step)
        elif kind == "loss":
            lost, lp = lost + 1, lp + step
            losses.append(-step)
        elif kind == "both":
            won, lost, lp = won + 1, lost + 1, lp + 3
            ambiguous += 1
        else:
            won, lp, tier = won + 1, lp + 200, "MASTER" if tier == "GRANDMASTER" else "GRANDMASTER"
        rows.append((at, lp, won, lost, tier, "I"))
    return rows, gains, losses, ambiguous


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rating_progress_of_simulated_series(spark, seed):
    rows, gains, losses, ambiguous = _simulated(seed)
    got, deltas = _progress(spark, rows)
    assert (got.points, got.gains, got.losses, got.ambiguous, got.measurable) == (len(rows), len(gains), len(losses), ambiguous, True)
    assert (got.gain_median, got.loss_median) == (float(np.median(gains)), float(np.median(losses)))
    bonus = [g for g in gains if g >= 1.7 * np.median(gains)]
    assert got.bonus_gains == len(bonus)
    assert {(r.amount, r.times) for r in series.bonus_gains(deltas).collect()} == {(g, bonus.count(g)) for g in bonus}


def test_a_single_point_measures_nothing(spark):
    got, _ = _progress(spark, _simulated(4)[0][:1])
    assert (got.points, got.gains, got.losses, got.measurable) == (1, 0, 0, False)


def test_division_promotion_is_a_reset_unless_asked_otherwise(spark):
    rows = [(1, 95, 10, 10, "GOLD", "II"), (2, 5, 11, 10, "GOLD", "I")]
    assert _progress(spark, rows)[0].gains == 0
    assert _progress(spark, rows, division_matters=False)[0].gains == 1


def test_change_points_keep_the_first_and_compare_null_safe(spark):
    m = ("MASTER", "I")
    df = _points(spark, [(1, 300, 1, 1, *m), (2, 300, 2, 1, *m), (3, 310, 3, 1, *m), (4, 310, 3, 2, "GM", None), (5, 310, 3, 2, None, None)])
    kept = series.change_points(df, "puuid", ["moment"], ["lp", "tier"], [series.by_epoch_day("moment")])
    assert sorted(r.moment for r in kept.collect()) == [1, 3, 4, 5]


def test_league_cutoffs_and_gaps(spark):
    rng = random.Random(15)
    seats = [(p, league, rng.randint(200, 1900)) for p in ("north", "south") for league in ("grandmaster", "challenger") for _ in range(rng.randint(2, 9))]
    cut = state.league_cutoffs(spark.createDataFrame(seats, "platform string, league string, lp int"), "platform", "league", "lp")
    want = {}
    for p, league, _ in seats:
        points = sorted(x for q, other, x in seats if (q, other) == (p, league))
        want[p, league] = points[0], len(points), float(points[len(points) // 2])
    assert {(r.platform, r.league): (r.cutoff, r.seats, r.median) for r in cut.collect()} == want
    players = [(f"m{i}", rng.choice(["north", "south"]), "MASTER", rng.randint(0, 2000)) for i in range(12)]
    players += [("low", "north", "EMERALD", 55), ("far", "island", "CHALLENGER", 990)]
    gaps = {(r.p, r.league): r.missing for r in state.cutoff_gaps(
        spark.createDataFrame(players, "p string, platform string, tier string, lp int"), cut, "platform", "tier", "lp").collect()}
    expected = {(who, league): max(want[where, league][0] - lp, 0) if tier == "MASTER" else None
                for who, where, tier, lp in players if where != "island" for league in ("grandmaster", "challenger")}
    assert gaps == {**expected, ("far", None): None}  # a platform without cutoffs keeps its player


def test_stale_keys(spark):
    stored = spark.createDataFrame([("fresh", 1000), ("old", 1000 - 6 * 3600)], "k string, updated_at long")
    wanted = spark.createDataFrame([("fresh",), ("old",), ("new",)], "k string")
    assert {r.k for r in state.stale_keys(stored, wanted, "k", F.lit(1000)).collect()} == {"old", "new"}


def test_rank_map_keeps_both_queues_and_prefers_solo(spark):
    rng = random.Random(16)
    entries, newest = [], {}
    for version in range(1, 6):
        for queue in ("RANKED_SOLO_5x5", "RANKED_FLEX_SR"):
            rank = (rng.choice(["SILVER", "GOLD", "EMERALD"]), rng.choice(["I", "II"]), rng.randint(0, 99), rng.randint(1, 80), rng.randint(1, 80))
            entries.append(("p", queue, *rank, version))
            newest[queue] = rank
    entries.append(("p", "ARENA", "WOOD", "IV", 7, 0, 0, 1))
    rng.shuffle(entries)
    df = spark.createDataFrame(entries, "puuid string, queue string, tier string, division string, lp int, wins int, losses int, updated_at long")
    rows = state.rank_rows(state.rank_map(df)).orderBy("place", "queue").collect()
    assert [r.queue for r in rows] == ["RANKED_SOLO_5x5", "ARENA", "RANKED_FLEX_SR"]
    for r in (rows[0], rows[2]):
        assert (r.tier, r.division, r.lp, r.wins, r.losses) == newest[r.queue]
        assert r.win_pct == pytest.approx(100 * r.wins / (r.wins + r.losses))
    assert rows[1].win_pct is None


def test_patch_touches_only_its_fields(spark):
    cur = spark.createDataFrame([("a", "r1", "ids"), ("b", "r2", "ids")], "k string, ranks string, ids string")
    upd = spark.createDataFrame([("a", "new"), ("c", "new")], "k string, ranks string")
    got = {r.k: (r.ranks, r.ids) for r in state.patch(cur, upd, ["k"], ["ranks"]).collect()}
    assert got == {"a": ("new", "ids"), "b": ("r2", "ids"), "c": ("new", None)}


def test_processed_ids_keep_the_last_in_text_order(spark):
    ids = spark.createDataFrame([("p", f"LA2_{i}") for i in range(150)], "k string, id string")
    kept = state.processed_ids(ids.where("id < 'LA2_5'"), ids, "k", "id").first().processed_ids
    assert kept == sorted(f"LA2_{i}" for i in range(150))[-100:]


def test_backlog(spark):
    a = spark.createDataFrame([(f"M_{i}",) for i in range(8)], "id string")
    waiting = backlog.pending(a, a.where("id < 'M_4'"), ["id"])
    assert [r.id for r in backlog.next_batch(waiting, [F.desc("id")], 2).collect()] == ["M_7", "M_6"]
    with pytest.raises(ValueError):
        backlog.next_batch(waiting, [F.desc("id")], 501)
    report = backlog.run_report(spark.createDataFrame([("error",), ("existing",)], "result string")).first()
    assert report.failed and report.errors == 1
    assert not backlog.run_report(spark.createDataFrame([("error",), ("new",)], "result string")).first().failed


def test_top_k_is_limited_before_the_shuffle(spark):
    df = spark.range(100).withColumn("e", F.col("id") % 3)
    plan = state.newest_per_entity(df, ["e"], [F.desc("id")], 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_labels_and_ids(spark):
    df = spark.createDataFrame([("LA2_123",), ("_1",), ("EUW1_",), ("plain",), (None,)], "m string")
    assert [r.p for r in df.select(X.platform_of("m").alias("p")).collect()] == ["la2", None, None, None, None]
    q = spark.createDataFrame([(420,), (1710,), (77,)], "q int")
    assert [r.q for r in q.select(X.queue_label("q").alias("q")).collect()] == ["ranked solo/duo", "Arena", "queue 77"]
    v = spark.createDataFrame([("16.17.3",), ("16.9",), ("x",)], "v string")
    rows = v.withColumn("s", X.short_version("v")).withColumn("minor", X.version_number("s", 2)).collect()
    assert [(r.s, r.minor) for r in rows] == [("16.17", 17), ("16.9", 9), (None, None)]
    n = spark.createDataFrame([("ana", "LAS"), (None, ""), ("", "X")], "n string, t string")
    assert [r.x for r in n.select(X.riot_id("n", "t").alias("x")).collect()] == ["ana#LAS", "?#?", "?#X"]


def test_rounding_and_times(spark):
    df = spark.createDataFrame([(2.7,), (2.5,), (-2.5,), (3.0,), (None,)], "x double")
    assert [r.x for r in df.select(X.rounded_int(F.col("x")).alias("x")).collect()] == [3, 3, -3, 3, None]
    edges = [2**31 - 1.0, 2**31 - 0.5, -2**31 - 0.25, 2.0**31, -2.0**31, 0.49999999999999994, 2.4999999999999996, 1e300, float("nan"), float("inf")]
    edges = spark.createDataFrame([(x,) for x in edges], "x double").select(
        X.rounded_int(F.col("x")).alias("got"), F.round("x").try_cast("int").alias("want"))
    assert [r.got for r in edges.collect()] == [r.want for r in edges.collect()]
    at = spark.createDataFrame([(1756771200999,)], "ms long").select(X.played_at("ms").alias("t"))
    assert str(at.first().t) == "2025-09-02 00:00:00"
    back = at.select(X.epoch_seconds("t").alias("s"), *X.date_keys("t")).first()
    assert (back.s, back.year, back.month, back.day) == (1756771200, "2025", "09", "02")


def test_filters(spark):
    df = spark.createDataFrame([("TOP",), ("",), (None,)], "r string")
    assert filters.with_role(df, "r").count() == 1
    with pytest.raises(ValueError):
        filters.checked_days(True)
    with pytest.raises(ValueError):
        filters.checked_days(4000)
    ts = spark.sql("select timestamp_ntz'2025-01-01 12:00:00' ts union all select timestamp_ntz'2024-12-01 12:00:00'")
    assert ts.where(filters.since("ts", "2025-01-02T00:00:00.9", 5)).count() == 1


def test_state_bucket_and_coverage(spark):
    df = spark.createDataFrame([(501,), (500,), (-501,), (None,)], "d int")
    assert [r.s for r in df.select(segments.state_bucket("d").alias("s")).collect()] == ["ahead", "even", "behind", "even"]
    cov = coverage(df.withColumn("g", F.lit(1)), ["g"], ["d"]).first()
    assert (cov.group_n, cov.n, cov.partial_coverage) == (4, 3, True)


def test_summary_of_many_metrics_has_one_exchange(spark):
    facts = _random_facts(spark)
    plan = summarize(facts, ["role"], [Metric("x"), Metric("won", kind=SHARE)])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
