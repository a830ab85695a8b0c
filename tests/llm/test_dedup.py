"""Exact, near and substring dedup against brute force, on awkward rows and on random families of copies."""

import random

import numpy as np
import pytest

from scrimlens.llm import ngram_join
from scrimlens.llm.exact import drop_copies, exact_dedup
from scrimlens.llm.ngram_join import PrefixTree, keep_one, near_classes
from scrimlens.llm.substrings import drop_repeats, repeated_spans, span_digests
from tests.llm import brute
from tests.llm.conftest import AWKWARD


def families(seed, documents=120):
    """Documents that copy, edit and quote each other."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(documents):
        kind = rng.random()
        if rows and kind < 0.25:
            text = rng.choice(rows)[1]
        elif rows and kind < 0.6:
            text = rng.choice(rows)[1].split()
            for _ in range(rng.randint(1, 4)):
                if text:
                    text[rng.randrange(len(text))] = rng.choice(words)
            text = " ".join(text)
        else:
            text = " ".join(rng.choices(words, k=rng.randint(0, 90)))
            if rows and kind > 0.85:
                quote = rng.choice(rows)[1].split()
                text += " " + " ".join(quote[: rng.randint(0, 40)]) + " " + " ".join(quote[-25:])
        rows.append((i * 3 + 1, text))
    rows.append((5000, "a b c d e " * 12))
    return rows


DISTINCT = [(i, t) for i, t in AWKWARD if i is not None and i != 11]


@pytest.mark.parametrize("keep", ["min", "max"])
def test_exact_dedup_awkward(awkward, keep):
    got = exact_dedup(awkward, keep=keep).collect()
    assert len(got) == len(AWKWARD)
    pick = min if keep == "min" else max
    want = brute.same_texts([(-1 if i is None else i, t) for i, t in AWKWARD], pick)
    for r in got:
        keep_id, size = want[-1 if r.doc_id is None else r.doc_id]
        assert (r.keep_id, r.group_size) == (None if keep_id == -1 else keep_id, size)
        assert r.kept == (r.doc_id == r.keep_id)


def test_exact_dedup_spreads_and_joins_large_groups(spark, table):
    rows = [(i, "same text everywhere" if i % 3 else f"own text {i % 50}") for i in range(900)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup(table(rows).repartition(6), keep="max").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == brute.same_texts(rows, max)


def test_drop_copies(awkward, empty):
    got = drop_copies(awkward)
    assert got.columns == awkward.columns
    ids = sorted((r.doc_id for r in got.collect()), key=str)
    assert ids == sorted([1, 2, 4, 6, 8, 9, 10, None, 11, 12, 13, 15], key=str)  # 7 equals the null id, 3 and 14 equal 2
    assert drop_copies(empty).count() == exact_dedup(empty).count() == 0


def test_drop_copies_under_repeated_ids(table):
    """A row whose id is kept for another text is still a copy of its own text."""
    rows = [(1, "B"), (5, "A"), (5, "B"), (5, "A"), (7, None), (7, ""), (None, "A")]
    left = lambda keep: sorted((str(r.doc_id), r.text or "") for r in drop_copies(table(rows), keep=keep).collect())
    assert left("min") == [("1", "B"), ("7", ""), ("None", "A")]
    assert left("max") == [("5", "A"), ("5", "B"), ("7", "")]


def test_near_classes_awkward(awkward, table, empty):
    want = brute.near_classes(DISTINCT)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_classes(table(DISTINCT)).collect()}
    assert got == want
    every = near_classes(awkward).collect()
    assert len(every) == len(AWKWARD)
    assert {r.component_id for r in every if r.doc_id in (7, 8, None)} == {None}
    assert near_classes(empty).count() == 0


@pytest.mark.parametrize("chunk", [None, 150])
def test_near_classes_random(table, monkeypatch, chunk):
    if chunk:  # clusters that do not fit into one task
        monkeypatch.setattr(ngram_join, "CHUNK_GRAMS", chunk)
    rows = families(7)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_classes(table(rows).repartition(5)).collect()}
    assert got == brute.near_classes(rows)


def test_wide_clusters_join_in_bounded_groups(table, monkeypatch):
    """One family of near copies over several chunks: no task gets more than about two chunks of it."""
    rng = random.Random(21)
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join([*base[: (k := rng.randrange(100))], f"v{i % 7}", *base[k + 1 :]])) for i in range(60)]
    near = ngram_join._near

    def bounded(share, of):
        inner = near(share, of)

        def run(got):
            grams = sum(map(len, got.column("grams").to_pylist()))
            assert grams <= 3000, f"{grams} n-grams in a group"
            return inner(got)

        return run

    monkeypatch.setattr(ngram_join, "CHUNK_GRAMS", 1000)
    monkeypatch.setattr(ngram_join, "_near", bounded)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_classes(table(rows)).collect()}
    assert got == brute.near_classes(rows) and {c for _, c in got.values()} == {0}


def test_prefix_tree_finds_what_pairs_find():
    rng = np.random.default_rng(3)
    sets = [np.array(sorted(rng.choice(40, size=rng.integers(5, 25), replace=False))) for _ in range(60)]
    n = np.array([len(s) + int(rng.integers(0, 3)) for s in sets])
    tree = PrefixTree(sets, n, 3, 5)
    for i in range(len(sets)):
        got = sorted(tree.links(tree.sets[i], int(tree.n[i]), np.arange(len(sets)), i))
        want = []
        for j in range(len(sets)):
            both = len(np.intersect1d(tree.sets[i], tree.sets[j]))
            if j != i and 5 * both >= 3 * (tree.n[i] + tree.n[j] - both):
                want.append(j)
        assert got == want


def test_keep_one(table):
    rows = families(11)
    want = sorted(i for i, (_, c) in brute.near_classes(rows).items() if i == c)
    got = keep_one(table(rows))
    assert sorted(r.doc_id for r in got.collect()) == want
    assert len(got.columns) == len(table(rows).columns)


def test_spans_awkward(awkward, table, empty):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in span_digests(table(DISTINCT)).collect()}
    assert got == brute.repeats(DISTINCT)
    every = {r.doc_id: r.n_removed for r in span_digests(awkward).collect()}
    assert every[None] == 0 and every[7] == 23  # the null id comes first
    assert span_digests(empty).count() == 0


def test_spans_random(table):
    rows = families(5)
    found = repeated_spans(table(rows).repartition(4))
    got = {r.id: r for r in found.collect()}
    want = brute.repeats(rows)
    digests = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in span_digests(table(rows)).collect()}
    assert digests == want
    for i, text in rows:
        assert sum(s.length for s in got[i].spans) == want[i][1]
        assert got[i].cleaned.split() == got[i].kept_words.split()
        if not want[i][1]:
            assert got[i].cleaned == text


def test_drop_repeats_keeps_columns_and_rows(awkward):
    got = drop_repeats(awkward)
    assert got.columns == awkward.columns and got.count() == len(AWKWARD)
    assert {r.text for r in got.where("doc_id IN (2, 14)").collect()} == {None}
