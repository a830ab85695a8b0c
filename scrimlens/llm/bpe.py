"""Byte-level BPE as a lazily determinised finite-state transducer, and streaming decoding.

Encoding rests on one fact about merges by rank: tokens t1 ... tn are the encoding of their bytes exactly if each neighbouring
pair (ti, ti+1) is the encoding of its own bytes. So every prefix of a text has just one last token: the one whose predecessor, the
last token of the shorter prefix, is compatible with it. The transducer reads bytes; its state is the set of live prefixes, those at
whose end a longer token may still begin. Tokens on which all live prefixes agree are emitted at once; this lookahead is bounded
by the vocabulary, not by the text. States and steps are made when a text first needs them, so a later step is one lookup.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrimlens.llm.common import Recent, id_in, id_out, slices

#: States and words that a worker keeps before it starts anew; both only repeat work when they are dropped.
MOST_STATES = 300_000
REMEMBERED = 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(word): int(rank) for word, rank in (line.split() for line in lines if line.strip())}


class Transducer:
    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        #: Beginnings of tokens that are shorter than the token.
        self.openings = {t[:i] for t in ranks for i in range(1, len(t))}
        self.edges: dict[int, dict[bytes, list[tuple[bytes, int]]]] = {1: {}, 2: {}}
        # A token that its own bytes do not encode to never appears.
        self.usable = {t for t in ranks if len(t) == 1 or self.merged(t) == [t]}
        self.reset()

    def reset(self) -> None:
        #: A state is its live prefixes, shortest first: last token, bytes since then, tokens not emitted yet.
        start = ((b"", b"", ()),)
        self.states: list[tuple[tuple[bytes, bytes, tuple[bytes, ...]], ...]] = [start]
        self.number = {start: 0}
        #: By state: byte -> (next state, ids to emit). And the ids to emit at the end of the text.
        self.steps: list[dict[int, tuple[int, tuple[int, ...]]]] = [{}]
        self.flush: list[tuple[int, ...]] = [()]

    def merged(self, data: bytes) -> list[bytes]:
        """The definition: join the neighbours of the lowest rank, leftmost first."""
        return self.history(data)[0]

    def history(self, data: bytes) -> tuple[list[bytes], list[tuple[int, bytes]], list[tuple[int, bytes]]]:
        """The merged parts of a few bytes, and what the first and the last part were before, with the ranks of their merges."""
        parts = [data[i : i + 1] for i in range(len(data))]
        left, right = [(-1, parts[0])], [(-1, parts[-1])]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            if at == 0:
                left.append((rank, parts[0]))
            if at == len(parts) - 1:
                right.append((rank, parts[-1]))
        return parts, left, right

    def edge(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """What stood at the left (1) or right (2) end of a token while it was merged, each with the rank that ended it."""
        found = self.edges[side].get(token)
        if found is None:
            past = self.history(token)[side]
            found = self.edges[side][token] = [(part, past[i + 1][0] if i + 1 < len(past) else 1 << 60) for i, (_, part) in enumerate(past)]
        return found

    def follows(self, left: bytes, right: bytes) -> bool:
        """Whether two tokens stay apart: no merge over their border comes before the merges that end its two sides. Of equal
        ranks the left one comes first."""
        if not left:
            return True
        key = (left, right)
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) > MOST_STATES * 5:
                self.pairs.clear()
            found, get = True, self.ranks.get
            for a, a_ends in self.edge(left, 2):
                for b, b_ends in self.edge(right, 1):
                    rank = get(a + b)
                    if rank is not None and rank < a_ends and rank <= b_ends:
                        found = False
            self.pairs[key] = found
        return found

    def step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """Make the step: the live prefixes of a state are those at whose end a token may still begin, by the bytes since then."""
        live = self.states[state]
        new, openings, usable = bytes((byte,)), self.openings, self.usable
        follow: list[tuple[bytes, bytes, tuple[bytes, ...]]] = []
        ending = None
        for last, since, chain in live:
            token = since + new
            if ending is None and token in usable and self.follows(last, token):
                ending = (token, b"", (*chain, token))
            if token in openings:
                follow.append((last, token, chain))
        follow.append(ending)
        shared = follow[0][2]
        for _, _, chain in follow:
            while shared != chain[: len(shared)]:
                shared = shared[:-1]
        key = tuple((last, since, chain[len(shared) :]) for last, since, chain in follow) if shared else tuple(follow)
        number = self.number.get(key)
        if number is None:
            number = self.number[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
            self.flush.append(tuple(self.ranks[t] for t in key[-1][2]))
        found = self.steps[state][byte] = number, tuple(self.ranks[t] for t in shared)
        return found

    def encode(self, data: bytes) -> list[int]:
        if len(self.states) > MOST_STATES:
            self.reset()
        steps, state, out = self.steps, 0, []
        for byte in data:
            found = steps[state].get(byte) or self.step(state, byte)
            state, ready = found
            if ready:
                out += ready
        out += self.flush[state]
        return out


class Encoder:
    """Ids of texts; each match of the pattern goes through the transducer by itself.

    A blank between two other characters always starts a match. Texts are cut there, and the ids of pieces seen before are looked
    up; a text with other white space at such a place is matched as a whole.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import regex

        self.find = regex.compile(pattern).findall
        self.machine = Transducer(ranks)
        self.known = Recent()

    def matched(self, text: str) -> str:
        ids: list[int] = []
        for word in self.find(text):
            ids += self.machine.encode(word.encode("utf-8", "surrogatepass"))
        return " ".join(map(str, ids))

    def encode_text(self, text: str) -> str:
        """The ids in decimals with a space between."""
        first, *pieces = text.split(" ")
        known = self.known = self.known.turned(REMEMBERED)
        for piece in known.unseen(set(pieces)):
            if not piece or piece[0].isspace() or piece[-1].isspace():
                return self.matched(text)
            known[piece] = self.matched(" " + piece)
        if pieces and (not first or first[-1].isspace()):
            return self.matched(text)
        start = self.matched(first)
        return " ".join([start, *map(known.__getitem__, pieces)] if start else map(known.__getitem__, pieces))


class Decoder:
    """Bytes and text of a stream of ids. A character may be split over tokens and over calls: the UTF-8 state machine holds
    what is incomplete until its last byte comes; bytes that are no UTF-8 become U+FFFD in the text, never in the bytes."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.tokens = {str(rank): token for token, rank in ranks.items()}
        self.start()

    def start(self) -> None:
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[str | int]) -> tuple[bytes, str]:
        data = b"".join(map(self.tokens.__getitem__, map(str, ids)))
        return data, self.machine.decode(data)

    def finish(self) -> str:
        return self.machine.decode(b"", True)

    def decode_text(self, ids: str, block: int = 1 << 16) -> tuple[str, str]:
        """Text, and sha256 of the bytes, of ids in decimals; works through blocks of ids."""
        self.start()
        digest, parts, pieces = hashlib.sha256(), [], ids.split(" ") if ids else []
        for first in range(0, len(pieces), block):
            data = b"".join(map(self.tokens.__getitem__, pieces[first : first + block]))
            digest.update(data)
            parts.append(self.machine.decode(data))
        parts.append(self.finish())
        return "".join(parts), digest.hexdigest()


@lru_cache(maxsize=4)
def coders(ranks: str, pattern: str) -> tuple[Encoder, Decoder]:
    """One pair a Python worker, so that the states found in one task serve the next."""
    table = read_ranks(ranks)
    return Encoder(table, pattern), Decoder(table)


def encode_documents(
    docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """One row per document: id, n_tokens, ids_sha256, decoded_sha256, round_trip, and with `with_ids` the ids themselves.

    `ranks` is the path of a rank file, `pattern` splits the text. A null text is empty: no ids, and the hash of nothing. Ids are
    decoded again and `round_trip` says whether the text came back. Each row stands alone, so repeated rows and ids, ties and
    other columns have no influence.
    """
    fields = [("id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("round_trip", pa.bool_())]
    fields += [("ids", pa.list_(pa.int32()))] if with_ids else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = coders(ranks, pattern)
        for batch in slices(batches, "text"):
            rows = []
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = encoder.encode_text(text or "")
                back, sha = decoder.decode_text(ids)
                row = (doc, ids.count(" ") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), sha, back == (text or ""))
                rows.append((*row, [int(i) for i in ids.split(" ")] if ids else []) if with_ids else row)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), fields, strict=True)], schema=pa.schema(fields))

    shape = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean" + ", ids array<int>" * with_ids
    rows = docs.select(id_in(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, shape).select(id_out("id").alias(id_col), *[n for n, _ in fields[1:]])
