"""Substring dedup by relative Lempel-Ziv parsing.

The documents are dealt into blocks, and every block is a reference for all others. Each window of 20 words picks the smallest of
its ten-word hashes as its anchor, so equal windows have equal anchors. Round one finds the anchors that several blocks hold,
round two looks up the windows at such anchors in the index of all blocks, which names the first document that holds each, and
round three parses: from left to right a document is cut into factors, the longest stretches of words whose windows all occur
earlier; windows that lie across the border of two factors are looked up like all others. Factors are removed.

The texts are moved once and read by all three rounds. Blocks send each range of hashes one packed row, and get back one bit for each
hash they sent.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrimlens.llm.blocks import HASH_BITS, packed, range_cuts, unpacked
from scrimlens.llm.common import Words, block_count, gram_hashes, id_in, id_out, mix, slices, tidy

_U = np.uint64
WINDOW = 20  # words; an anchor is a hash of half as many
#: Bytes of text for each block of documents, and for each range of anchors and of windows.
BLOCK_BYTES, ANCHOR_BYTES, WINDOW_BYTES = 4 << 20, 16 << 20, 8 << 20
_HASHES = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("size", pa.int64()), ("first", pa.binary()), ("steps", pa.binary()), ("more", pa.binary()), ("docs", pa.binary())])
_HASHES_SQL = "part long, block long, size long, first binary, steps binary, more binary, docs binary"
_BITS = pa.schema([("round", pa.int32()), ("block", pa.int64()), ("part", pa.int64()), ("bits", pa.binary())])
_BITS_SQL = "round int, block long, part long, bits binary"


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    if not rows:
        return schema.empty_table()
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _smaller(left: np.ndarray, left_at: np.ndarray, right: np.ndarray, right_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = min(len(left), len(right))
    take = left[:n] <= right[:n]
    return np.where(take, left[:n], right[:n]), np.where(take, left_at[:n], right_at[:n])


class Block:
    """The windows of a block of documents, in the order of id and text: anchor, row, first word, and 128-bit hash."""

    def __init__(self, table: pa.Table, window: int) -> None:
        order = pc.sort_indices(table.select(["id", "text"]), sort_keys=[("id", "ascending"), ("text", "ascending")])
        self.table = table.take(order).combine_chunks()
        self.ids = self.table.column("id").to_numpy()
        half = window // 2
        anchors, spots, rows, starts, wide = [], [], [], [], ([], [])
        done = spot = 0
        self.counts = np.zeros(len(self.ids), np.int64)
        for batch in slices(iter(self.table.select(["text"]).to_batches()), "text", 1 << 20):
            words = Words(batch.column("text"))
            self.counts[done : done + batch.num_rows] = words.counts
            n = len(words.starts) - window + 1
            if n > 0:
                whole = words.rows[:n] == words.rows[window - 1 :]
                grams = [gram_hashes(words.hashes(lane), half) for lane in (0, 1)]
                least, at, reach = grams[0], np.arange(len(grams[0])), 1
                while 2 * reach <= window - half + 1:  # leftmost minimum of 1, 2, 4, 8 places, then of all of a window
                    least, at = _smaller(least, at, least[reach:], at[reach:])
                    reach *= 2
                far = window - half + 1 - reach
                least, at = _smaller(least[:n], at[:n], least[far:], at[far:])
                anchors.append(least[whole] >> _U(64 - HASH_BITS))
                spots.append(at[whole] + spot)
                spot += len(words.starts)
                rows.append(words.rows[:n][whole] + done)
                starts.append((np.arange(n) - words.firsts[words.rows[:n]])[whole])
                for lane in (0, 1):
                    last = grams[lane][window - half :]
                    wide[lane].append(mix(grams[lane][:n] * _U(0x9E3779B97F4A7C15) + last[:n] * _U(0xC2B2AE3D27D4EB4F))[whole])
            done += batch.num_rows
        join = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
        self.anchors, self.rows, self.starts = join(anchors, _U), join(rows, np.int64), join(starts, np.int64)
        self.wide = join(wide[0], _U), join(wide[1], _U) >> _U(32)
        # Windows at one place of one anchor follow each other; an anchor of several places is held several times by this block.
        spots = join(spots, np.int64)
        fresh = np.flatnonzero(np.concatenate([[True], spots[1:] != spots[:-1]])) if len(spots) else np.zeros(0, np.int64)
        self.values, counts = np.unique(self.anchors[fresh], return_counts=True)
        self.often = counts > 1

    def candidates(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows at shared anchors by hash: their places, sorted by hash and then by place, and which are the first of their
        hash, with the group of each."""
        known = (shared | self.often)[np.searchsorted(self.values, self.anchors)] if len(self.anchors) else np.zeros(0, bool)
        places = np.flatnonzero(known)
        a, b = self.wide[0][places], self.wide[1][places]
        places = places[np.lexsort((b, a))]
        a, b = self.wide[0][places], self.wide[1][places]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(places) else np.zeros(0, bool)
        return places, new, np.cumsum(new) - 1


def _bits(cuts: np.ndarray, rows: list[dict]) -> np.ndarray:
    """The answers to all hashes that a block has sent, in their order."""
    out = np.zeros(cuts[-1], bool)
    for r in rows:
        a, b = cuts[r["part"]], cuts[r["part"] + 1]
        out[a:b] = np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=b - a).astype(bool)
    return out


def _first(value: int) -> bytes:
    return int(value).to_bytes(8, "little")


def _sent(hashes: np.ndarray, ranges: int, bits: int, block: int, more: np.ndarray | None = None, docs: np.ndarray | None = None) -> list[tuple]:
    cuts = range_cuts(hashes, ranges, bits)
    out = []
    for part in np.flatnonzero(np.diff(cuts)).tolist():
        here = slice(cuts[part], cuts[part + 1])
        first, steps = packed(hashes[here])
        out.append((part, block, here.stop - here.start, _first(first), steps, None if more is None else more[here].astype(np.uint32).tobytes(), None if docs is None else docs[here].tobytes()))
    return out


def _received(rows: list[dict]) -> np.ndarray:
    return np.concatenate([unpacked(int.from_bytes(r["first"], "little"), r["steps"], r["size"]) for r in rows])


def _answers(rows: list[dict], flags: np.ndarray, number: int) -> pa.Table:
    out, place = [], 0
    for r in rows:
        here = flags[place : place + r["size"]]
        place += r["size"]
        if here.any():
            out.append((number, r["block"], r["part"], np.packbits(here).tobytes()))
    return _batch(out, _BITS)


def _shared_anchors(table: pa.Table) -> pa.Table:
    tidy()
    rows = table.to_pylist()
    hashes = _received(rows)
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    same = ordered[1:] == ordered[:-1]
    flags = np.zeros(len(hashes), bool)
    flags[order[1:]] |= same
    flags[order[:-1]] |= same
    return _answers(rows, flags, 1)


def _earlier_windows(table: pa.Table) -> pa.Table:
    """Of each window the block with the smallest document keeps it; the others learn that theirs come later."""
    tidy()
    rows = table.to_pylist()
    hashes = _received(rows)
    more = np.concatenate([np.frombuffer(r["more"], np.uint32) for r in rows])
    docs = np.concatenate([np.frombuffer(r["docs"], np.int64) for r in rows])
    order = np.lexsort((docs, more, hashes))
    a, b = hashes[order], more[order]
    flags = np.zeros(len(hashes), bool)
    flags[order[1:]] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    return _answers(rows, flags, 2)


def repeated_spans(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: all its columns in `row`, and n_words, n_removed, spans, kept_words, cleaned.

    Every window of `window` (even) consecutive words [^\\x20\\x09-\\x0D]+ that starts earlier elsewhere, in a smaller id or earlier
    in the same text, is covered by a span (first word, length). Windows are compared as they are in the input, by 96 bits of
    hashes. `kept_words` joins the other words by one space; `cleaned` is the text without the spans and the white space after
    each, untouched where nothing repeats. A null text has no words and stays null. A null id is the smallest id, and rows
    repeated under one id come one after the other by text, so the later is cleared of what the earlier holds. An empty table
    gives an empty result.
    """
    if window % 2 or window < 4:
        raise ValueError("the window needs an even number of words, four or more")
    spark = docs.sparkSession
    parts = max(block_count(docs, text_col, BLOCK_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))
    anchor_ranges, window_ranges = block_count_of(parts, BLOCK_BYTES, ANCHOR_BYTES), block_count_of(parts, BLOCK_BYTES, WINDOW_BYTES)
    rows = docs.select(id_in(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(parts)))
    dealt = rows.repartition(parts, "block")

    def send_anchors(table: pa.Table) -> pa.Table:
        tidy()
        block = Block(table, window)
        return _batch(_sent(block.values, anchor_ranges, HASH_BITS, table.column("block")[0].as_py()), _HASHES)

    def parsed(docs_: pa.Table, bits: pa.Table) -> tuple[Block, np.ndarray, np.ndarray, np.ndarray, list[dict]]:
        tidy()
        block = Block(docs_, window)
        rows_ = bits.to_pylist()
        shared = _bits(range_cuts(block.values, anchor_ranges), [r for r in rows_ if r["round"] == 1])
        return block, *block.candidates(shared), [r for r in rows_ if r["round"] == 2]

    def send_windows(docs_: pa.Table, bits: pa.Table) -> pa.Table:
        if not docs_.num_rows:
            return _HASHES.empty_table()
        block, places, new, _, _ = parsed(docs_, bits)
        first = places[new]
        return _batch(_sent(block.wide[0][first], window_ranges, 64, docs_.column("block")[0].as_py(), block.wide[1][first], block.ids[block.rows[first]]), _HASHES)

    out = pa.schema([("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))), ("kept_words", pa.string()), ("cleaned", pa.string())])

    def parse(docs_: pa.Table, bits: pa.Table) -> pa.Table:
        if not docs_.num_rows:
            return pa.schema([*docs_.select(["id", "row"]).schema, *out]).empty_table()
        block, places, new, group, answers = parsed(docs_, bits)
        first = places[new]
        cuts = range_cuts(block.wide[0][first], window_ranges, 64)
        later = _bits(cuts, answers)[group] | ~new if len(places) else np.zeros(0, bool)
        hits = np.sort(places[later])
        ends = np.searchsorted(block.rows[hits], np.arange(len(block.ids) + 1))
        found = []
        for i, text in enumerate(block.table.column("text").to_pylist()):
            found.append(_cut(text, int(block.counts[i]), block.starts[hits[ends[i] : ends[i + 1]]], window))
        kept = block.table.select(["id", "row"])
        added = _batch(found, out)
        return pa.Table.from_arrays([*kept.columns, *added.columns], schema=pa.schema([*kept.schema, *out]))

    row_type = rows.schema["row"].dataType.simpleString()
    anchors = dealt.groupBy("block").applyInArrow(send_anchors, _HASHES_SQL)
    shared = anchors.groupBy("part").applyInArrow(_shared_anchors, _BITS_SQL)
    windows = dealt.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(send_windows, _HASHES_SQL)
    earlier = windows.groupBy("part").applyInArrow(_earlier_windows, _BITS_SQL)
    result = dealt.groupBy("block").cogroup(shared.unionByName(earlier).groupBy("block")).applyInArrow(
        parse, f"id long, row {row_type}, n_words long, n_removed long, spans array<struct<start: long, length: long>>, kept_words string, cleaned string")
    return result.withColumn("id", id_out("id"))


def block_count_of(parts: int, block_bytes: int, range_bytes: int) -> int:
    return max(1, -(-parts * block_bytes // range_bytes))


def _cut(text: str | None, n: int, hits: np.ndarray, window: int) -> tuple:
    """Factors of one document from the windows that come later than their equals."""
    if not len(hits):
        return n, 0, [], " ".join(_words(text or "")), text
    gap = np.flatnonzero(np.diff(hits) > window)  # factors that touch are one
    firsts, lasts = hits[np.concatenate([[0], gap + 1])], hits[np.concatenate([gap, [len(hits) - 1]])] + window
    data = (text or "").encode("utf-8", "surrogatepass")
    words = Words(pa.array([text], pa.string()))
    gone = np.zeros(n, bool)
    pieces, at = [], 0
    for a, b in zip(firsts.tolist(), lasts.tolist(), strict=True):
        gone[a:b] = True
        pieces.append(data[at : words.starts[a]])
        at = int(words.starts[b]) if b < n else len(data)
    pieces.append(data[at:])
    kept = [data[s:e] for s, e in zip(words.starts[~gone].tolist(), words.ends[~gone].tolist(), strict=True)]
    spans = [{"start": a, "length": b - a} for a, b in zip(firsts.tolist(), lasts.tolist(), strict=True)]
    return n, int(gone.sum()), spans, b" ".join(kept).decode("utf-8", "surrogatepass"), b"".join(pieces).decode("utf-8", "surrogatepass")


_BLANKS = str.maketrans({c: " " for c in "\t\n\x0b\x0c\r"})


def _words(text: str) -> Iterator[str]:
    return (w for w in text.translate(_BLANKS).split(" ") if w)


def span_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """id, n_words, n_removed, spans, kept_sha256 of each document."""
    return repeated_spans(docs, window, id_col, text_col).select(
        F.col("id").alias(id_col), "n_words", "n_removed", "spans", F.sha2(F.col("kept_words").cast("binary"), 256).alias("kept_sha256"))


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents with their columns, repeated passages taken out of the text; none is dropped."""
    found = repeated_spans(docs, window, id_col, text_col)
    return found.select(*[F.col("cleaned").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
