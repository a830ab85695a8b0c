"""What several corpus operators need: ids, Arrow text views, word hashes, cut lineage, connected components."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Stands for a null id inside the operators, so that such a row keeps its place; results show null again.
NO_ID = -(2**63)
_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
_BYTE_BASE = _U(0x5851F42D4C957F2D)


def id_in(column: str) -> Column:
    """The id as a long, a null as the smallest long."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def id_out(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.when(column != NO_ID, column)


def _shared_folder(df: DataFrame) -> str:
    """The session's checkpoint folder; one of our own only where none is set and all runs on one machine."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if shared is None and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint in the shared folder."""
    _shared_folder(df)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage with a table of its own in the shared folder."""
    path = f"{_shared_folder(df)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def block_count(docs: DataFrame, text: str, block_bytes: int) -> int:
    """In how many blocks of about `block_bytes` bytes of text the documents fall."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(1, -(-total // block_bytes))


#: What this Python worker remembers for the tasks to come, by operator.
_REMEMBERED: dict[tuple, object] = {}
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def tidy(keep: tuple | None = None) -> None:
    """At the start of a task or group: a worker serves one operator after another, so what it remembers for others is dropped, and
    what the work before has freed goes back to the system, as numpy's arrays and Arrow's buffers else stay with the worker."""
    for key in [k for k in _REMEMBERED if k != keep]:
        del _REMEMBERED[key]
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def remembered(make: Callable[..., object], *args: object) -> object:
    """One `make(*args)` a worker, until the worker begins something else."""
    key = (make, *args)
    if key not in _REMEMBERED:
        tidy()
        _REMEMBERED[key] = make(*args)
    return _REMEMBERED[key]


class Recent(dict):
    """What a worker remembers, in two generations: when the young one is full it becomes the old one, from which what is asked for
    again moves back. Frequent keys stay, memory is bounded by two generations."""

    def __init__(self, old: dict | None = None) -> None:
        super().__init__()
        self.old = old if old is not None else {}
        if isinstance(old, Recent):
            old.old = {}

    def __missing__(self, key: object) -> object:
        value = self[key] = dict.pop(self.old, key)
        return value

    def unseen(self, keys: set) -> list:
        """Of some keys those that neither generation has."""
        old = self.old
        return [k for k in keys if k not in self and k not in old]  # a difference of sets would walk through all that is known

    def turned(self, most: int) -> "Recent":
        """This, or a new generation after it once it has more than `most` keys."""
        return Recent(self) if len(self) > most else self


# ---------------------------------------------------------------------------------------------- text in Arrow batches


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batches, cut between rows so that a text column has about `most` bytes; a longer text comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_view(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
            yield batch.slice(first, last - first)
            first = last


def text_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column without copies; a null is empty."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, at - at[0]


# ------------------------------------------------------------------------------------------------------- word hashes

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS = {"up": np.ones(1, _U), "down": np.ones(1, _U)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit over all (shift, multiply, shift)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _letters(lane: int, fold: bool) -> np.ndarray:
    """A fixed random word per byte; with `fold` A-Z count as a-z."""
    table = mix((np.arange(256, dtype=_U) + _U(1 + 1000 * lane)) * _ODD) | _U(1)
    if fold:
        table[65:91] = table[97:123]
    return table


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base, at least n of them, and of its inverse."""
    if len(_POWERS["up"]) < n:
        inverse = _U(pow(int(_BYTE_BASE), -1, 1 << 64))
        size = 1 << max(16, (n - 1).bit_length())
        for name, base in (("up", _BYTE_BASE), ("down", inverse)):
            steps = np.full(size, base, _U)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps)
    return _POWERS["up"], _POWERS["down"]


def byte_hashes(data: np.ndarray, starts: np.ndarray, lane: int = 0) -> np.ndarray:
    """64-bit hashes of the stretches of text that begin at these places and end before the next blank or line feed."""
    up, down = powers(len(data))
    letters = _letters(lane, False)
    letters[[0x20, 0x0A]] = 0
    return mix(np.add.reduceat(letters[data] * up[: len(data)], starts) * down[starts])


class Words:
    """The words [^\\x20\\x09-\\x0D]+ of a column of texts: row of each, byte places and 64-bit hashes by lane."""

    def __init__(self, column: pa.Array, fold: bool = False) -> None:
        self.data, self.offsets = text_view(column)
        self.fold = fold
        inside = ~_SPACE[self.data]
        edge = np.zeros(len(self.data) + 1, bool)
        edge[self.offsets] = True
        before = np.empty_like(inside)
        before[:1], before[1:] = False, inside[:-1]
        self.starts = np.flatnonzero(inside & (~before | edge[:-1]))
        after = np.empty_like(inside)
        after[-1:], after[:-1] = False, inside[1:]
        self.ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.counts = np.diff(np.searchsorted(self.starts, self.offsets))
        self.rows = np.repeat(np.arange(len(self.counts)), self.counts)
        #: Place of each row's first word, and past its last.
        self.firsts = np.concatenate([[0], np.cumsum(self.counts)])

    def hashes(self, lane: int = 0) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(0, _U)
        up, down = powers(len(self.data))
        letters = _letters(lane, self.fold)
        letters[_SPACE] = 0
        values = letters[self.data] * up[: len(self.data)]
        return mix(np.add.reduceat(values, self.starts) * down[self.starts])


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` words that begin at each place; the last size - 1 places have none."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, _U)
    total = np.zeros(n, _U)
    for j in range(size):
        total += words[j : j + n] * mix(np.array([j + 1], _U) * _ODD)[0]
    return mix(total + _U(size))


# ----------------------------------------------------------------------------------------------- connected components


#: Edges of a partition at least, so that a small graph is not written as many tiny files in each round.
EDGES_A_FILE = 50_000


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 64) -> DataFrame:
    """(node, component) with the smallest node of each component, for every node that an edge names.

    Alternates large-star and small-star steps; a hub's edges are halved by partial aggregates before they are shuffled, and
    the work of a round is proportional to the edges. Raises when the rounds do not suffice.
    """
    current = settle(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL").distinct())
    nodes = current.select(F.col("u").alias("node")).union(current.select(F.col("v").alias("node"))).distinct()
    current = current.where("u <> v")
    files = max(1, -(-current.count() // EDGES_A_FILE))
    before = None
    for _ in range(most_rounds):
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        star = large.join(small, "u").select(
            F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.u", "e.v").where("u <> v").distinct()
        current = settle(star.coalesce(files))
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return nodes.join(current.groupBy("u").agg(F.min("v").alias("m")), F.col("node") == F.col("u"), "left").select(
                "node", F.coalesce("m", "node").alias("component"))
        before = state
    raise RuntimeError(f"components still change after {most_rounds} rounds")
