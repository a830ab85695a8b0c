"""Periodic runs of words by an enhanced suffix array and the branching-tandem test.

A batch of documents has one suffix array (prefix doubling over words that are told apart by document), its inverse and the
lengths of common prefixes. For each interval of that array with common depth d the suffixes outside its largest child look
whether the suffix d words on, or d words back, lies in the same interval: that is a square of period d. Squares whose next word
breaks the period end a run. They are rotated to the left while the words agree, and squares of one run merge to its smallest
period. Intervals are pairs of places in the array; no tree is built. A document stands alone, so nothing is shuffled.

A run of k periods begins at k suffixes of its interval at least, so groups of fewer suffixes are left unsorted: their common
prefix is then only known as long enough, and no interval of k suffixes or more depends on it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrimlens.llm.common import Words, id_in, id_out, slices

COPIES, WORDS = 4, 6
_OPEN = np.iinfo(np.int32).max
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_OUT = pa.schema([("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("best", _RUN), ("collapsed", pa.string())])


class SuffixArray:
    """Suffixes of a batch of documents in order, `place` of each suffix, and `common[j]`, the depth between places j - 1 and j.

    `symbols` are numbers that differ between documents; `ends` says for each word where its document ends. Groups of fewer
    than `least` suffixes stay as they are, with an open depth between them.
    """

    def __init__(self, symbols: np.ndarray, ends: np.ndarray, least: int) -> None:
        n = len(symbols)
        self.ends, self.suffixes = ends, np.argsort(symbols, kind="stable")
        ordered = symbols[self.suffixes]
        new = np.ones(n, bool)
        new[1:] = ordered[1:] != ordered[:-1]
        self.common = np.where(new, 0, _OPEN).astype(np.int32)
        rank = np.empty(n, np.int32)
        rank[self.suffixes] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        places = _in_groups(np.arange(n), new, least)
        #: Places that can belong to an interval of `least` suffixes.
        self.wide, length, levels = places, 1, [rank.copy()]
        while len(places):
            at = self.suffixes[places]
            after = at + length
            inside = after < ends[at]
            second = np.where(inside, rank[np.minimum(after, n - 1)] + 1, 0)
            both = rank[at].astype(np.int64) * (n + 1) + second
            order = np.argsort(both, kind="stable")
            both, at = both[order], at[order]
            self.suffixes[places] = at
            new = np.ones(len(places), bool)
            new[1:] = both[1:] != both[:-1]
            split = places[new]
            split = split[self.common[split] == _OPEN]
            self.common[split] = self._depths(split, length, levels)
            rank[at] = np.maximum.accumulate(np.where(new, places, 0))
            levels.append(rank.copy())
            places = _in_groups(places, new, least)
            length *= 2
        self.place = np.empty(n, np.int64)
        self.place[self.suffixes] = np.arange(n)

    def _depths(self, split: np.ndarray, length: int, levels: list[np.ndarray]) -> np.ndarray:
        """Common words of neighbours that agree in `length` words and differ within twice as many: halves from long to short."""
        a, b = self.suffixes[split - 1], self.suffixes[split]
        depth, last = np.full(len(split), length, np.int64), len(self.ends) - 1
        for k in range(len(levels) - 2, -1, -1):
            x, y = a + depth, b + depth
            same = (x < self.ends[a]) & (y < self.ends[b])
            same &= levels[k][np.minimum(x, last)] == levels[k][np.minimum(y, last)]
            depth += same.astype(np.int64) << k
        return depth

    def intervals(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Intervals of `least` suffixes or more: first and last place, depth; and their children: interval, first place, size."""
        depth = self.common[self.wide]
        inner = np.flatnonzero((depth > 0) & (depth < _OPEN))
        before, after = _smaller(depth, inner)
        wide = after - before >= least
        inner, before, after = inner[wide], before[wide], after[wide]
        order = np.lexsort((inner, after, before))  # borders between the children of one interval, side by side
        inner, before, after = inner[order], before[order], after[order]
        first = np.ones(len(inner), bool)
        first[1:] = (before[1:] != before[:-1]) | (after[1:] != after[:-1])
        heads = np.flatnonzero(first)
        owner = np.cumsum(first) - 1
        low, high = before[heads], after[heads]
        # Children begin at the interval's first place and at each border.
        n = len(inner) + len(heads)
        begins, child_of = np.empty(n, np.int64), np.empty(n, np.int64)
        lead = np.zeros(n, bool)
        lead[heads + np.arange(len(heads))] = True
        begins[lead], begins[~lead] = low, inner
        child_of[lead], child_of[~lead] = np.arange(len(heads)), owner
        stops = np.append(begins[1:], 0)
        stops[np.append(np.flatnonzero(lead)[1:] - 1, n - 1) if n else []] = high
        # Places are consecutive within a group of equal first words, so the difference of places is a size.
        return self.wide[low], self.wide[low] + (high - low) - 1, depth[inner[heads]].astype(np.int64), child_of, self.wide[begins], stops - begins


def _in_groups(places: np.ndarray, new: np.ndarray, least: int) -> np.ndarray:
    """The places whose group, begun by `new`, has `least` members or more."""
    sizes = np.diff(np.append(np.flatnonzero(new), len(places)))
    return places[np.repeat(sizes >= least, sizes)]


def _smaller(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest place before, and after, with a smaller value: steps of falling powers of two over a table of range minima."""
    n = len(values)
    borders = np.append(np.flatnonzero(values == 0), n)
    levels = [values]
    while n and 1 << len(levels) <= int(np.diff(borders).max(initial=0)):
        half, below = 1 << (len(levels) - 1), levels[-1]
        levels.append(np.minimum(below[:-half], below[half:]) if len(below) > half else below[:0])
    own, left, right = values[at], at.copy(), at + 1
    for k in range(len(levels) - 1, -1, -1):
        table, step = levels[k], 1 << k
        if len(table):
            down, up = left - step, right
            left -= step * ((down >= 0) & (table[np.maximum(down, 0)] >= own))
            fits = up + step <= n
            right += step * (fits & (table[np.where(fits, up, 0)] >= own))
    return left - 1, right


def word_runs(symbols: np.ndarray, firsts: np.ndarray, copies: int = COPIES, least: int = WORDS) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs of at least `copies` periods and `least` words, places counted over the whole batch.

    `symbols` are the words as numbers that differ between documents, `firsts` where each document begins, and the end.
    """
    if len(symbols) < max(copies, least):
        return []
    counts = np.diff(firsts)
    starts, ends = np.repeat(firsts[:-1], counts), np.repeat(firsts[1:], counts)
    array = SuffixArray(symbols, ends, copies)
    low, high, depth, child_of, child_first, child_size = array.intervals(copies)
    if not len(low):
        return []
    heads = np.flatnonzero(np.append(True, child_of[1:] != child_of[:-1]))
    largest = child_size == np.repeat(np.maximum.reduceat(child_size, heads), np.diff(np.append(heads, len(child_of))))
    tops = np.flatnonzero(largest)
    small = np.ones(len(child_of), bool)
    small[tops[np.append(True, child_of[tops[1:]] != child_of[tops[:-1]])]] = False  # one largest child of each interval
    size = child_size[small]
    own = np.repeat(child_of[small], size)
    i = array.suffixes[np.repeat(child_first[small] - np.cumsum(size) + size, size) + np.arange(size.sum())]

    def together(at: np.ndarray, own: np.ndarray) -> np.ndarray:
        place = array.place[at]
        return (low[own] <= place) & (place <= high[own])

    on, back = i + depth[own], i - depth[own]
    on_ok = np.flatnonzero(on < ends[i])
    on_ok = on_ok[together(on[on_ok], own[on_ok])]
    back_ok = np.flatnonzero(back >= starts[i])
    back_ok = back_ok[together(back[back_ok], own[back_ok])]
    at, own = np.concatenate([i[on_ok], back[back_ok]]), np.concatenate([own[on_ok], own[back_ok]])
    period = depth[own]
    end, last = at + 2 * period, len(symbols) - 1
    breaks = (end == ends[at]) | (symbols[np.minimum(end, last)] != symbols[at + period])
    at, own, period, end = at[breaks], own[breaks], period[breaks], end[breaks]
    for _ in range(copies - 2):  # whole periods to the left: the same interval again
        at = at - period
        ok = np.flatnonzero(at >= starts[end - 1])
        ok = ok[together(at[ok], own[ok])]
        at, own, period, end = at[ok], own[ok], period[ok], end[ok]
    if not len(at):
        return []
    order = np.lexsort((period, end))
    found: list[tuple[int, int, int]] = []
    ends_, lots = np.unique(end[order], return_index=True)
    for e, periods, ats in zip(ends_.tolist(), np.split(period[order], lots[1:]), np.split(at[order], lots[1:]), strict=True):
        while len(periods):  # the smallest period first; what repeats it is the same run
            q = int(periods[0])
            start = _rotated(symbols, int(starts[e - 1]), int(ats[0]), q)
            if e - start >= least:
                found.append((start, e, q))
            other = (periods % q != 0) | (2 * periods > e - start)
            other[0] = False
            periods, ats = periods[other], ats[other]
    return sorted(found, key=lambda r: (r[0], r[2]))


def _rotated(symbols: np.ndarray, first: int, at: int, period: int) -> int:
    """Where a square at `at` comes to rest when it is rotated to the left, in blocks of growing length."""
    block = 64
    while at > first:
        low = max(first, at - block)
        differ = np.flatnonzero(symbols[low:at] != symbols[low + period : at + period])
        if len(differ):
            return low + int(differ[-1]) + 1
        at, block = low, block * 2
    return at


def _best(runs: list[dict]) -> dict | None:
    """Greatest length / period, compared exactly; then the smallest start, then the smallest period (the order of the list)."""
    best = None
    for r in runs:
        if best is None or r["length"] * best["period"] > best["length"] * r["period"]:
            best = r
    return best


def _collapse(words: Words, gone: np.ndarray) -> pa.Array:
    """Words that stay, joined by one space, as a column: the bytes between them are masked out."""
    data = words.data.copy()
    keep = np.flatnonzero(~gone)
    rows = words.rows[keep]
    followed = np.append(rows[1:] == rows[:-1], False) if len(keep) else np.zeros(0, bool)
    stops = words.ends[keep] + followed
    data[words.ends[keep][followed]] = 0x20
    marks = np.zeros(len(data) + 1, np.int8)
    marks[words.starts[keep]] = 1
    marks[stops] -= 1  # where a word begins at another's stop, both go on as one stretch
    inside = np.cumsum(marks[:-1], dtype=np.int8).astype(bool)
    offsets = np.concatenate([[0], np.cumsum(inside)])[words.offsets].astype(np.int32)
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data[inside].tobytes()))


def _scan(copies: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = Words(batch.column("text"))
            _, number = np.unique(words.hashes(), return_inverse=True)
            symbols = words.rows * (len(words.starts) + 1) + number.reshape(-1)
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            marks = np.zeros(len(words.starts) + 1, np.int64)
            for start, end, period in word_runs(symbols, words.firsts, copies, least):
                row = int(words.rows[start])
                found[row].append({"start": start - int(words.firsts[row]), "length": end - start, "period": period})
                marks[start + period] += 1
                marks[end] -= 1
            gone = np.cumsum(marks[:-1]) > 0
            columns = [
                pa.array(words.counts, pa.int64()), pa.array(found, _OUT.field("runs").type), pa.array([_best(r) for r in found], _RUN),
                _collapse(words, gone)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], schema=pa.schema([batch.schema.field("id"), *_OUT]))

    return run


def periodic_runs(docs: DataFrame, copies: int = COPIES, least: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, runs, best, collapsed.

    Words are [^\\x20\\x09-\\x0D]+, compared by 64 bits of a hash within a document, numbered from 0. A run is a stretch of
    words (start, length, smallest period) of at least `copies` periods and `least` words that no neighbouring word extends;
    `runs` has all of them by start, then period. `best` is the run with the greatest exact length / period (ties: smallest start,
    then period), null where there is none. `collapsed` joins by one space the words that no run covers after its first period.

    A null or empty text has no words, no runs and an empty `collapsed`; a null id stays null. Each row stands alone: repeated
    rows and ids give a row each, other columns are not read, an empty table gives an empty result. A text is read whole
    whatever its length; it alone decides the memory of its task (about 30 times its words in 8-byte numbers).
    """
    if copies < 2:
        raise ValueError("a run has two periods or more")
    rows = docs.select(id_in(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    run = "struct<start: long, length: long, period: long>"
    shape = f"id long, n_words long, runs array<{run}>, best {run}, collapsed string"
    return rows.mapInArrow(_scan(copies, least), shape).select(id_out("id").alias(id_col), "n_words", "runs", "best", "collapsed")
