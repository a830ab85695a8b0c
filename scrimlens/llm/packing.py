"""Packing of tokenised documents into sequences by harmonic classes.

A piece of r tokens belongs to class k = capacity // r, and each bin of class k takes k pieces, so that a bin is done when it has
its fixed number of pieces. Documents may be cut, so a rest that would leave a gap in its class gives a piece of just the next
smaller class's slot and the remainder is classed again. Every task packs what it reads, without a shuffle.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrimlens.llm.common import Recent, byte_hashes, id_in, id_out, remembered, slices, text_view

PIECES = "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_NAMES = [c.split()[0] for c in PIECES.split(", ")]
#: Distinct chunks of text whose ids a worker remembers, beyond which those that did not come again are dropped, and words of
#: plain letters in each of two generations.
REMEMBERED, LETTERS = 800_000, 400_000


class Chunks:
    """Token ids of texts. The vocabulary drops white space, so chunks between blanks and line feeds stand alone.

    The chunks of a batch are told apart by two 64-bit hashes of their bytes; a chunk met for the first time is encoded and its ids go
    to the end of one long array, so that the ids of a whole batch are one gather. A chunk of Latin letters, with one comma or
    full stop after it at most, is left alone by the vocabulary's normal form and split but for its case: its letters are encoded
    without these two steps, once for all spellings. A text that may hold one of the vocabulary's own markers (such as that of
    the end of a text) is encoded as a whole, with the markers' ids.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.marks = {m: array("I", self.tokenizer.encode(m, add_special_tokens=False).ids).tobytes() for m in ",."}
        added = self.tokenizer.get_added_tokens_decoder()
        markers = [t.content for t in added.values()]
        #: Text and id of a marker, which stands after each chunk where many are encoded at once.
        self.stop = next(((t.content, i) for i, t in added.items()), None)
        self.marker = re.compile("|".join(map(re.escape, markers)), re.IGNORECASE).search if markers else lambda _: None
        self.letters = Recent()
        #: By first hash the chunk's number; by number the second hash, the place of its ids and whether it came again.
        self.number: dict[int, int] = {}
        self.check, self.begin, self.seen = np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, bool)
        self.ids = np.zeros(0, np.uint32)

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        low = [c[:-1].lower() if c[-1] in self.marks else c.lower() for c in chunks]
        simple = [
            w.isalpha() and (w.isascii() or max(w) < "\u0180") and len(w) == len(c) - (c[-1] in self.marks) for w, c in zip(low, chunks, strict=True)]
        other = [c for c, s in zip(chunks, simple, strict=True) if not s]
        whole = dict(zip(other, self.ids_of(self.tokenizer, other), strict=True))
        self.letters = self.letters.turned(LETTERS)
        new = self.letters.unseen({w for w, s in zip(low, simple, strict=True) if s})
        self.letters.update(zip(new, self.ids_of(self.plain, new), strict=True))
        return [self.letters[w] + self.marks.get(c[-1], b"") if s else whole[c] for c, w, s in zip(chunks, low, simple, strict=True)]

    def ids_of(self, tokenizer: object, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk as bytes. Chunks are encoded 512 at a time, with a marker after each, which costs less than an
        encoding for each; where that does not give back as many markers, one by one."""
        single = lambda part: [array("I", got.ids).tobytes() for got in tokenizer.encode_batch_fast(part, add_special_tokens=False)]
        out: list[bytes] = []
        for first in range(0, len(chunks), 8192):
            parts = [chunks[i : i + 512] for i in range(first, min(first + 8192, len(chunks)), 512)]
            if self.stop is None:
                out += [ids for part in parts for ids in single(part)]
                continue
            text, stop = self.stop
            lines = [[w for chunk in part for w in (chunk, text)] for part in parts]
            for part, got in zip(parts, tokenizer.encode_batch_fast(lines, is_pretokenized=True, add_special_tokens=False), strict=True):
                ids = np.array(got.ids, np.uint32)
                ends = np.flatnonzero(ids == stop)
                if len(ends) != len(part):  # a chunk holds the marker itself
                    out += single(part)
                    continue
                data, begins = ids.tobytes(), np.concatenate([[0], ends[:-1] + 1])
                out += [data[a:b] for a, b in zip((4 * begins).tolist(), (4 * ends).tolist(), strict=True)]
        return out

    def forget(self) -> None:
        """Keep the chunks that came again since the last time; most are met once only."""
        kept = np.flatnonzero(self.seen)
        place = np.cumsum(self.seen) - 1
        self.number = {h: int(place[n]) for h, n in self.number.items() if self.seen[n]}
        lengths = np.diff(self.begin)[kept]
        self.ids = self.ids[_ranges(self.begin[kept], lengths)]
        self.begin, self.check, self.seen = np.concatenate([[0], np.cumsum(lengths)]), self.check[kept], np.zeros(len(kept), bool)

    def numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Numbers of chunks given by places in the bytes; new ones are encoded first."""
        if not len(starts):
            return np.zeros(0, np.int64)
        first, second = (byte_hashes(data, starts, lane) for lane in (0, 1))
        keys, where, which = np.unique(first, return_index=True, return_inverse=True)
        check = second[where]
        found = np.fromiter(map(self.number.get, keys.tolist(), repeat(-1)), np.int64, len(keys))
        known = np.zeros(len(keys), bool)
        known[found >= 0] = self.check[found[found >= 0]] == check[found >= 0]
        self.seen[found[known]] = True
        new = np.flatnonzero(~known)
        if len(new):
            found[new] = self.taken_in(data, starts[where[new]], ends[where[new]], check[new])
            self.number.update(zip(keys[new].tolist(), found[new].tolist(), strict=True))
        out = found[which.reshape(-1)]
        odd = np.flatnonzero(self.check[out] != second)  # other chunks of the same first hash stay unlisted
        if len(odd):
            out[odd] = self.taken_in(data, starts[odd], ends[odd], second[odd])
        return out

    def taken_in(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, check: np.ndarray) -> np.ndarray:
        """Numbers of chunks that are encoded now."""
        text = data.tobytes()
        ids = self.encode_chunks([text[a:b].decode("utf-8", "surrogatepass") for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
        out = np.arange(len(ids)) + len(self.check)
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum([len(i) // 4 for i in ids])])
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(ids), np.uint32)])
        self.check = np.concatenate([self.check, check])
        self.seen = np.concatenate([self.seen, np.zeros(len(ids), bool)])
        return out

    def encode(self, column: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text of a column as unsigned 32-bit numbers; a null is empty."""
        if len(self.check) > REMEMBERED:
            self.forget()
        data, offsets = text_view(column)
        inside = (data != 0x20) & (data != 0x0A)
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        numbers = self.numbers(data, starts, ends)
        lengths = self.begin[numbers + 1] - self.begin[numbers]
        ids = self.ids[_ranges(self.begin[numbers], lengths)]
        cuts = np.concatenate([[0], np.cumsum(lengths)])[np.searchsorted(starts, offsets)]
        bars = np.unique(np.searchsorted(offsets, np.flatnonzero(data == 0x7C), "right") - 1)
        marked = {i: t for i in bars.tolist() if (t := column[i].as_py()) and self.marker(t)}
        for i in range(len(column)):
            if i in marked:
                yield np.array(self.tokenizer.encode(marked[i], add_special_tokens=False).ids, np.uint32)
            else:
                yield ids[cuts[i] : cuts[i + 1]]


def _ranges(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of ranges one after the other."""
    total = np.cumsum(lengths)
    return np.repeat(begins - total + lengths, lengths) + np.arange(total[-1] if len(total) else 0)


def chunks_of(path: str) -> Chunks:
    """One a Python worker, so that what one task has met serves the next."""
    return remembered(Chunks, path)


class Harmonic:
    """Open bins by class; `add` yields (sequence, pieces of (document, start, length)) for each bin that is done."""

    def __init__(self, capacity: int, slack: float, classes: int) -> None:
        self.capacity, self.slack, self.classes = capacity, slack, classes
        self.open: dict[int, list[tuple]] = defaultdict(list)

    def cut(self, n: int) -> Iterator[tuple[int, int]]:
        """(class, length) of the pieces of a document of n tokens."""
        while n > 0:
            if n >= self.capacity:
                yield 1, self.capacity
                n -= self.capacity
                continue
            k = min(self.capacity // n, self.classes)
            if self.capacity // k - n > max(1, self.slack * n) and k < self.classes:
                slot = self.capacity // (k + 1)  # fills its place in the next class without a gap
                yield k + 1, slot
                n -= slot
            else:
                yield k, n
                n = 0

    def add(self, doc: object, n: int) -> Iterator[list[tuple]]:
        start = 0
        for k, length in self.cut(n):
            here = self.open[k]
            here.append((doc, start, length))
            start += length
            if len(here) == k:
                yield self.open.pop(k)

    def rest(self) -> Iterator[list[tuple]]:
        """What is left in open bins: joined, cut at the capacity, and the last sequences at powers of two, which need no padding."""
        left = [p for k in sorted(self.open) for p in self.open[k]]
        total = sum(p[2] for p in left)
        sizes = [self.capacity] * (total // self.capacity) + [1 << b for b in range(self.capacity.bit_length(), -1, -1) if total % self.capacity >> b & 1]
        for size in sizes:
            bin_: list[tuple] = []
            while size:
                doc, start, length = left.pop(0)
                take = min(size, length)
                bin_.append((doc, start, take))
                if take < length:
                    left.insert(0, (doc, start + take, length - take))
                size -= take
            yield bin_
        self.open.clear()


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 2048, slack: float = 0.01, classes: int = 256,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    `tokenizer` is the path of a vocabulary file that drops white space; each document is its ids and then `end_id`. Null and
    empty texts are the end id alone. Rows repeated under one id are packed each by itself. A piece that would leave more than
    `slack` of its length unused is cut. Sequences are numbered by task and place; an empty table gives no pieces. Other columns
    are not read; of equal texts each is packed. A text is encoded whole, and its ids are in memory until its last piece is out.
    """
    schema = pa.schema([(n, pa.int64()) for n in _NAMES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, bins = chunks_of(tokenizer), Harmonic(capacity, slack, classes)
        end = np.array([end_id], np.uint32)
        sequence = TaskContext.get().partitionId() << 33
        out: list[tuple] = []

        def emit(done: list[tuple]) -> None:
            nonlocal sequence
            offset = 0
            for doc, start, length in done:
                number, doc_id, n, ids = doc
                piece = ids[start : start + length]
                out.append((doc_id, start, length, zlib.crc32(piece.astype("<u4").tobytes()), n, sequence, offset))
                offset += length
            sequence += 1

        def table() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=schema)
            out.clear()
            return got

        number = 0
        for batch in slices(batches, "text"):
            ids = batch.column("id").to_pylist()
            for doc_id, data in zip(ids, chunks.encode(batch.column("text")), strict=True):
                number += 1
                data = np.concatenate([data, end])  # its own, as the batch's ids need not wait for an open bin
                doc = (number, doc_id, len(data), data)
                for done in bins.add(doc, doc[2]):
                    emit(done)
            if len(out) > 4096:
                yield table()
        for done in bins.rest():
            emit(done)
        if out:
            yield table()

    rows = docs.select(id_in(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, PIECES).select(id_out("id").alias(id_col), *_NAMES[1:])
