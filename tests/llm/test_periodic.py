"""Periodic runs against brute force over periods, on words, on awkward tables and on the planted query."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from scrimlens.llm import queries
from scrimlens.llm.periodic import SuffixArray, periodic_runs, word_runs
from tests.llm.brute import WORD
from tests.llm.conftest import AWKWARD

SF_DIR = "/root/testdata/sf0.001"


def brute_runs(words, copies=4, least=6):
    """(start, length, period) of every run, period by period."""
    out = {}
    for q in range(1, len(words) // copies + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, copies * q):
                out.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def repetitive(rng):
    letters, words = rng.randint(1, 4), []
    while rng.random() < 0.85:
        words += [rng.randrange(letters) for _ in range(rng.randint(1, 7))] * rng.choice([1, 1, 2, 3, 4, 5, 8])
    return words


def test_word_runs_equal_brute_force():
    rng = random.Random(5)
    for _ in range(800):
        docs = [repetitive(rng) for _ in range(rng.randint(1, 4))]
        copies, least = rng.choice([2, 3, 4, 4]), rng.choice([2, 6, 6])
        firsts = np.cumsum([0] + [len(d) for d in docs])
        symbols = np.array([r * 100 + x for r, d in enumerate(docs) for x in d], np.int64)
        want = [(s + int(firsts[r]), s + n + int(firsts[r]), q) for r, d in enumerate(docs) for s, n, q in brute_runs(d, copies, least)]
        assert word_runs(symbols, firsts, copies, least) == want


def test_suffix_array_orders_all_suffixes_when_pairs_count():
    rng = random.Random(9)
    words = [rng.randrange(3) for _ in range(200)]
    array = SuffixArray(np.array(words), np.full(200, 200), 2)
    order = sorted(range(200), key=lambda i: words[i:])
    assert array.suffixes.tolist() == order
    for j in range(1, 200):
        a, b = words[order[j - 1] :], words[order[j] :]
        assert array.common[j] == next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_one_word_over_and_over_is_linear():
    assert word_runs(np.zeros(300_000, np.int64), np.array([0, 300_000])) == [(0, 300_000, 1)]


def test_awkward(awkward, empty):
    got = periodic_runs(awkward).collect()
    assert len(got) == len(AWKWARD)
    want = {}
    for i, t in AWKWARD:
        words = WORD.findall(t or "")
        runs = brute_runs(words) if len(words) < 10_000 else []
        want[i] = len(words), runs, collapsed(words, runs)
    for r in got:
        n, runs, text = want[r.doc_id]
        assert r.n_words == n and [(x.start, x.length, x.period) for x in r.runs] == runs and r.collapsed == text
        assert (r.best is None) == (not runs)
    assert {r.best.length for r in got if r.doc_id == 12} == {50}
    assert periodic_runs(empty).count() == 0


def test_neighbouring_texts_do_not_touch(table):
    """Runs end with their text even where the next text goes on with the same words."""
    rows = [(1, "a b a b a b a b"), (2, "a b a b a b a b a"), (3, "b a"), (4, "x\ty x y")]
    got = {r.doc_id: r for r in periodic_runs(table(rows).coalesce(1)).collect()}
    assert [tuple(x) for x in got[1].runs] == [(0, 8, 2)] and [tuple(x) for x in got[2].runs] == [(0, 9, 2)]
    assert got[3].runs == [] and got[1].collapsed == got[2].collapsed == "a b" and got[4].collapsed == "x y x y"


def test_best_compares_exactly(table):
    text = " ".join("a b c".split() * 4 + ["|"] + ["d", "e"] * 6 + ["|"] + ["f"] * 6)
    best = periodic_runs(table([(1, text)])).first().best
    assert (best.start, best.length, best.period) == (13, 12, 2)  # 12 / 2 equals 6 / 1 and starts earlier


def test_query_plants_and_digests(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    got = {r.doc_id: r for r in queries.op13_periodic_runs(spark, SF_DIR).collect()}
    assert len(got) == len(docs)
    planted = 0
    for d in docs:
        words, h = WORD.findall(d.text or ""), zlib.crc32(str(d.doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
            planted += 1
        runs = brute_runs(words)
        r = got[d.doc_id]
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
        if runs:
            s, k, q = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]))
            assert (r.start, r.length, r.period, r.exponent_milli) == (s, k, q, 1000 * k // q)
        else:
            assert (r.start, r.length, r.period, r.exponent_milli) == (None,) * 4
    assert planted


def test_copies_below_two_are_refused(awkward):
    with pytest.raises(ValueError):
        periodic_runs(awkward, copies=1)
