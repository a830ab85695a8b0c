"""Context-triggered piecewise hashing of documents.

A rolling hash over the last seven bytes ends a chunk wherever it hits its trigger, so boundaries depend on content and not on
position. Each chunk gives one character of the signature. The trigger's block size follows the length of the text; the
signature at twice that size comes along, so that texts whose block sizes are a factor of two apart can still be compared.
Likeness is one less the edit distance of the signatures by their length, the best of the block sizes in common.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrimlens.llm.common import id_in, id_out, mix, powers

WINDOW = 7
LEAST_BLOCK = 4
MOST = 64  # characters of a signature
_ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_U = np.uint64
_BASE = 0x5851F42D4C957F2D
_BYTES = mix((np.arange(256, dtype=_U) + _U(77)) * _U(0x9E3779B97F4A7C15))


class _Rolled:
    """Rolling hash at each byte and prefix sums for the chunks' hashes, shared by all block sizes of one text."""

    def __init__(self, data: bytes) -> None:
        values = _BYTES[np.frombuffer(data, np.uint8)]
        n = len(values)
        rolling = np.zeros(n, _U)
        for back in range(min(WINDOW, n)):
            rolling[back:] += values[: n - back] * _U(pow(_BASE, back, 1 << 64))
        self.rolling = (rolling ^ (rolling >> _U(32))) & _U(0xFFFFFFFF)
        up, self.down = powers(n)
        self.sums = np.concatenate([np.zeros(1, _U), np.cumsum(values * up[:n])])

    def signature(self, block: int) -> str:
        n = len(self.rolling)
        if not n:
            return ""
        ends = np.flatnonzero(self.rolling % _U(block) == _U(block - 1)) + 1
        if len(ends) >= MOST:
            ends = ends[: MOST - 1]  # the last chunk takes what is left, as in the published scheme
        if not len(ends) or ends[-1] < n:
            ends = np.append(ends, n)
        begins = np.concatenate([[0], ends[:-1]])
        # Make the sum independent of the chunk's place, then take six bits.
        raw = (self.sums[ends] - self.sums[begins]) * self.down[begins]
        return _ALPHABET[(mix(raw) >> _U(58)).astype(np.int64)].tobytes().decode()


def fingerprint(text: str) -> str:
    """block:signature:signature at twice the block. Equal texts have equal fingerprints; an empty text has 4::."""
    data = text.encode("utf-8", "surrogatepass")
    rolled = _Rolled(data)
    block = LEAST_BLOCK
    while block * MOST < len(data):
        block *= 2
    found = rolled.signature(block)
    while block > LEAST_BLOCK and len(found) < MOST // 2:
        block //= 2
        found = rolled.signature(block)
    return f"{block}:{found}:{rolled.signature(2 * block)}"


def edit_distances(left: list[str], right: list[str]) -> np.ndarray:
    """Levenshtein distance of pairs of strings of up to 64 ASCII characters, all pairs at once (bit-parallel by column)."""
    n = len(left)
    lens = np.array([len(x) for x in left], np.int64)
    wide = np.zeros((n, MOST), np.uint8)
    other = np.zeros((n, MOST), np.uint8)
    for row, (a, b) in enumerate(zip(left, right, strict=True)):
        wide[row, : len(a)] = np.frombuffer(a.encode(), np.uint8)
        other[row, : len(b)] = np.frombuffer(b.encode(), np.uint8)
    lens_b = np.array([len(x) for x in right], np.int64)
    one = _U(1)
    bits = one << np.arange(MOST, dtype=_U)
    above = np.full(n, ~_U(0))  # vertical steps that add one
    below = np.zeros(n, _U)
    top = one << np.maximum(lens - 1, 0).astype(_U)
    score = lens.copy()
    for j in range(int(lens_b.max(initial=0))):
        here = j < lens_b
        equal = np.where(wide == other[:, j : j + 1], bits, _U(0)).sum(axis=1, dtype=_U)
        x = equal | below
        d = (((x & above) + above) ^ above) | x
        plus, minus = below | ~(d | above), above & d
        score += np.where(here & (plus & top != 0), 1, 0) - np.where(here & (minus & top != 0), 1, 0)
        plus, minus = (plus << one) | one, minus << one
        above, below = np.where(here, minus | ~(x | plus), above), np.where(here, plus & x, below)
    return np.where(lens == 0, lens_b, score)


def likeness(left: list[str], right: list[str]) -> np.ndarray:
    """0 to 1 for pairs of fingerprints; 1 when equal, 0 when no block size is common."""
    pairs: list[tuple[int, str, str]] = []
    for row, (a, b) in enumerate(zip(left, right, strict=True)):
        (n, s, t), (m, u, v) = a.split(":"), b.split(":")
        n, m = int(n), int(m)
        if n == m:
            pairs += [(row, s, u), (row, t, v)]
        elif n == 2 * m:
            pairs.append((row, s, v))
        elif m == 2 * n:
            pairs.append((row, t, u))
    out = np.zeros(len(left))
    if pairs:
        rows, first, second = map(list, zip(*pairs, strict=True))
        longest = np.array([max(len(x), len(y)) for x, y in zip(first, second, strict=True)])
        near = 1 - edit_distances(first, second) / np.maximum(longest, 1)
        np.maximum.at(out, np.array(rows), np.where(longest > 0, near, 0))
    return np.where([a == b for a, b in zip(left, right, strict=True)], 1.0, out)


def edited(text: str, following: str) -> str:
    """The last half of the code points (rounded down) replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_OUT = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def neighbour_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one of the next larger id, after the last the first; equal ids follow each other by text, a null id
    is the smallest, a null text is empty. A single document is its own next. Ranges of ids are dealt out by splitters from all
    ids, and each range also gets the first document of the following range, so neighbours meet without ordering the table in one
    place. Equal texts have equal fingerprints, a text of any length has one, other columns are not read, an empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(id_in(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.expr(f"approx_percentile(id, array({','.join(str((i + 1) / parts) for i in range(parts))}), {100 * parts})")).first()[0]
    cuts = np.unique(np.array(cuts or [0], np.int64))

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, ids.to_numpy(), "left").astype(np.int32))

    # The first document of each range; one small row a range.
    firsts = rows.select("id", range_of("id").alias("range")).groupBy("range").agg(F.min("id").alias("id")).collect()
    ranges = sorted((r["range"], r["id"]) for r in firsts)
    before = {first: ranges[i - 1][0] for i, (_, first) in enumerate(ranges)}  # the range that also needs it
    order = {first: int(i == 0) for i, (_, first) in enumerate(ranges)}

    @F.pandas_udf("array<struct<range int, late int>>")
    def places(ids: pd.Series) -> pd.Series:
        own = np.searchsorted(cuts, ids.to_numpy(), "left")
        return pd.Series([
            [{"range": int(r), "late": 0}] + ([{"range": before[i], "late": 1 + order[i]}] if i in before else [])
            for r, i in zip(own, ids.tolist(), strict=True)])

    dealt = rows.select("id", "text", F.explode(places("id")).alias("to")).select("id", "text", "to.range", "to.late")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c.split()[0], {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[c.split()[1]]) for c in _OUT.split(", ")])
        held: list[tuple[int, str, str]] = []  # document and fingerprint that wait for the next one
        waiting: tuple | None = None
        at = None
        taken = False  # whether the range's following document has been met

        def result() -> pa.RecordBatch:
            ids, texts, prints, changed, following = map(list, zip(*held, strict=True))
            held.clear()
            second = [fingerprint(x) for x in changed]
            return pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array([len(x) for x in texts], pa.int64()),
                pa.array([hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in changed]),
                pa.array(prints), pa.array(second), pa.array(likeness(prints, second)), pa.array(likeness(prints, following))], schema=schema)

        for batch in batches:
            for doc, text, place, late in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "range", "late")), strict=True):
                if place != at:
                    at, waiting, taken = place, None, False
                if taken:
                    continue
                now = fingerprint(text)
                if waiting is not None:
                    held.append((waiting[0], waiting[1], waiting[2], edited(waiting[1], text), now))
                waiting, taken = (doc, text, now), late > 0
                if len(held) >= 500:
                    yield result()
        if held:
            yield result()

    sorted_rows = dealt.repartition("range").sortWithinPartitions("range", "late", "id", "text")
    return sorted_rows.select("id", "text", "range", "late").mapInArrow(run, _OUT).select(
        id_out("id").alias(id_col), *[c.split()[0] for c in _OUT.split(", ")[1:]])
