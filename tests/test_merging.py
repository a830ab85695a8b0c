"""Selection in rounds and merged moments: the same numbers as from all values at once, however the rows are dealt."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scrimlens.functions.moments import merge_moments, merged
from scrimlens.operators import curate, peers, quantiles
from scrimlens.operators.metrics import Metric
from tests.fixtures import landed, match, participant


@pytest.mark.parametrize("upper", [False, True])
def test_selection_in_rounds_equals_sorting(spark, upper):
    """Slices of twenty values: a hot group of thousands takes several rounds and is ranked slice by slice."""
    rng = random.Random(8)
    rows = [("hot" if rng.random() < 0.6 else f"g{rng.randrange(3)}", rng.choice([rng.gauss(0, 1), rng.randrange(5) * 1.0]),
             None if rng.random() < 0.1 else rng.expovariate(1)) for _ in range(9000)]
    rows += [("empty", None, None), (None, 3.0, 1.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(7)
    shares = [0.0, 0.1, 0.5, 0.75, 1.0]
    for accuracy in (20_000, 200):
        got = quantiles.exact_quantiles(df, ["g"], ["x", "y"], shares, upper, accuracy, slice_values=20).collect()
        assert len(got) == 6 * 2 * len(shares)
        for r in got:
            values = sorted(v for g, x, y in rows for v in [x if r.metric == "x" else y] if g == r.g and v is not None)
            assert r.n == len(values)
            if not values:
                assert r.value is None
                continue
            want = values[min(int(r.share * len(values)), len(values) - 1)] if upper else float(np.quantile(values, r.share))
            assert r.value == pytest.approx(want, rel=1e-12, abs=1e-12), (r, upper, accuracy)


def test_a_hot_bracket_is_ranked_in_many_slices(spark, monkeypatch):
    kept = {}
    narrowed = quantiles._narrowed

    def spied(*args):
        kept["rows"] = narrowed(*args)
        return kept["rows"]

    monkeypatch.setattr(quantiles, "_narrowed", spied)
    df = spark.range(50_000).select(F.lit("hot").alias("g"), (F.hash("id") / 7.0).alias("x"))
    quantiles.exact_quantiles(df, ["g"], ["x"], [0.25, 0.5, 0.75], accuracy=100_000, slice_values=1000).collect()
    sizes = kept["rows"].groupBy("slot", "slice").count().collect()
    assert len(sizes) >= 3 and max(r["count"] for r in sizes) <= 1000
    assert sum(r["count"] for r in sizes) < 10_000  # slices without a wanted rank are gone


def test_merged_moments_in_numpy():
    rng = np.random.default_rng(3)
    values = [rng.normal(1e9, 3, size=(int(rng.integers(0, 40)), 2)) for _ in range(12)]
    n = np.array([[len(v)] * 2 for v in values])
    mean = np.array([v.mean(axis=0) if len(v) else [0.0, 0.0] for v in values])
    m2 = np.array([((v - v.mean(axis=0)) ** 2).sum(axis=0) if len(v) else [0.0, 0.0] for v in values])
    got = merged(n, mean, m2, np.array([0, 5]))
    for i, part in enumerate((values[:5], values[5:])):
        whole = np.concatenate(part)
        assert got[0][i].tolist() == [len(whole)] * 2
        assert np.allclose(got[1][i], whole.mean(axis=0), rtol=1e-15) and np.allclose(got[2][i], ((whole - whole.mean(axis=0)) ** 2).sum(axis=0), rtol=1e-6)


def test_merge_over_partitions_and_batches(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["hot", "hot", "hot", None, "a"]), rng.randrange(3), rng.gauss(100, 1), rng.gauss(-5, 9)) for _ in range(4000)]
    df = spark.createDataFrame(rows, "role string, k int, x double, y double").repartition(6)
    parts = df.select("role", "k", F.lit(1).cast("bigint").alias("rows"), F.array(F.lit(1).cast("bigint"), F.lit(1).cast("bigint")).alias("n"),
                      F.array("x", "y").alias("mean"), F.array(F.lit(0.0), F.lit(0.0)).alias("m2"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        got = {(r.role, r.k): r for r in merge_moments(parts, ["role", "k"], ["rows"]).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = df.groupBy("role", "k").agg(F.count("*").alias("n"), F.avg("x").alias("x"), F.avg("y").alias("y"), F.var_pop("x").alias("vx"), F.var_pop("y").alias("vy"))
    rows = want.collect()
    assert len(rows) == len(got) == 9
    for r in rows:
        g = got[r.role, r.k]
        assert g.rows == r.n and list(g.n) == [r.n] * 2 and g.mean == pytest.approx([r.x, r.y])
        assert g.m2 == pytest.approx([r.vx * r.n, r.vy * r.n])


def test_peers_stay_wide_until_the_join(spark):
    """Values far from zero keep their spread, and no long row exists before both sides are joined."""
    rng = random.Random(6)
    rows = [(rng.choice(["TOP", "MID"]), f"p{rng.randrange(6)}", 1e8 + rng.gauss(0, 1), rng.gauss(0, 5)) for _ in range(800)]
    facts = spark.createDataFrame(rows, "role string, who string, x double, y double")
    metrics = [Metric("x"), Metric("y", "lower")]
    report = peers.compare_to_peers(facts, facts, "who", "role", metrics)
    for r in report.collect():
        col = 2 if r.metric == "x" else 3
        own = [q[col] for q in rows if q[0] == r.role and q[1] == r.who]
        rest = [q[col] for q in rows if q[0] == r.role and q[1] != r.who]
        assert (r.n_a, r.n_b, r.group_n_b) == (len(own), len(rest), len(rest))
        assert r.sd_a == pytest.approx(np.std(own, ddof=1), rel=1e-6) and r.sd_b == pytest.approx(np.std(rest, ddof=1), rel=1e-6)
        assert r.mean_b == pytest.approx(np.mean(rest), rel=1e-14)
    moments = peers.entity_moments(facts, ["role", "who"], metrics)
    assert moments.count() == len({(q[0], q[1]) for q in rows})


def test_one_copy_of_a_match_is_parsed(spark):
    people = [participant("a"), participant("b"), participant("b", kills=99), participant("c", role="")]
    docs = landed(("a", match(1, people)), ("b", match(1, people)), ("b", match(2, people[1:2])))
    raw = curate.promote(spark.createDataFrame(docs, "puuid string, document string"))
    got = curate.flatten_peers(raw)
    assert sorted((r.match_id, r.puuid, r.kills) for r in got.collect()) == [("LA2_1", "a", 5), ("LA2_1", "b", 5), ("LA2_2", "b", 5)]
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
