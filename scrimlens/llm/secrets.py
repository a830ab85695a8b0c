"""Secrets in texts: three fixed patterns, and formats inferred from labelled credentials.

For each kind of credential the labelled examples make a prefix tree with counts. States whose endings, next classes of characters
and next characters agree statistically (Hoeffding bounds, down the whole subtree) are merged, which leaves a small deterministic
probabilistic automaton: a literal tag stays a chain, a random part becomes a loop. The same is done for ordinary tokens. Every
candidate, a run of credential characters, is scored by how much likelier a format makes it than ordinary tokens are.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrimlens.llm.common import id_in, id_out, slices, text_view

# The three base patterns, on bytes and so with ASCII letters only, and the least lengths of what they find.
ASSIGN = re.compile(rb"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
KEYWORD = re.compile(rb"(?i)passw|secret|token|api_?key")
LEAST = {"assign": 8, "access": 16, "hex": 32}

_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_ALNUM = _DIGITS + _LOWER + _LOWER.upper()
_URL64, _BASE64 = _ALNUM + "-_", _ALNUM + "+/"
# Published formats of credentials, as literals and (alphabet, least, most) characters.
FORMATS: list[tuple[str, list]] = [
    ("aws_session_id", ["ASIA", (_LOWER.upper() + "234567", 16, 16)]),
    ("aws_secret", [(_BASE64, 40, 40)]),
    ("github", [("pousr", "gh{}_"), (_ALNUM, 36, 36)]),
    ("github_fine", ["github_pat_", (_ALNUM, 22, 22), "_", (_ALNUM, 59, 59)]),
    ("gitlab", ["glpat-", (_URL64, 20, 20)]),
    ("google", ["AIza", (_URL64, 35, 35)]),
    ("jwt", ["eyJ", (_URL64, 17, 60), ".eyJ", (_URL64, 20, 200), ".", (_URL64, 43, 86)]),
    ("npm", ["npm_", (_ALNUM, 36, 36)]),
    ("sendgrid", ["SG.", (_URL64, 22, 22), ".", (_URL64, 43, 43)]),
    ("slack", [("bpars", "xox{}-"), (_DIGITS, 10, 13), "-", (_DIGITS, 10, 13), "-", (_ALNUM, 24, 32)]),
    ("stripe", [("sr", "{}k_live_"), (_ALNUM, 24, 24)]),
]
# Words that ordinary tokens are put together from.
_PLAIN = """the and for with from this that have not are was were will would can could should about after before between under over
    into only other some such than then there these they their when where which while who your our file name path user data list
    item page test main core util http https www com org net html index value token key count size type class method function
    return import export module package version release build config setting default option message error warning information
    development international understanding communication transformation responsibility characteristics implementation""".split()

ALPHA, EXAMPLES, MARGIN = 0.01, 400, 12.0


def labelled(examples: int = EXAMPLES, seed: int = 11) -> Iterator[tuple[str, str | None]]:
    """A table of (text, kind): credentials of every format drawn by rule, and ordinary tokens, whose kind is None."""
    rng = random.Random(seed)
    for kind, parts in FORMATS:
        for _ in range(examples):
            yield "".join(_drawn(rng, part) for part in parts), kind
    for _ in range(4 * examples):
        words = rng.choices(_PLAIN, k=rng.randint(2, 7))
        style = rng.randrange(6)
        if style == 0:
            words = [w.capitalize() if rng.random() < 0.7 else w for w in words]
        elif style == 1:
            words = [w.upper() for w in words]
        if rng.random() < 0.4:
            words.insert(rng.randint(1, len(words)), str(rng.randrange(10 ** rng.randint(1, 8))))
        yield ("" if style in (0, 5) else rng.choice("_-./")).join(words), None


def _drawn(rng: random.Random, part: str | tuple) -> str:
    if isinstance(part, str):
        return part
    if len(part) == 2:  # one letter of several in a literal
        return part[1].format(rng.choice(part[0]))
    return "".join(rng.choices(part[0], k=rng.randint(*part[1:])))


# ------------------------------------------------------------------------------------------------------ automata


def _class(byte: int) -> str:
    c = chr(byte)
    for name, letters in (("0", _DIGITS), ("a", "abcdef"), ("g", _LOWER), ("A", "ABCDEF"), ("G", _LOWER.upper())):
        if c in letters:
            return name
    return c


CLASSES = [_class(b) for b in range(256)]
_MEMBERS = Counter(CLASSES)


@dataclass
class State:
    total: int = 0
    ends: int = 0
    seen: Counter = field(default_factory=Counter)  # next characters
    next: dict[str, "State"] = field(default_factory=dict)  # by class of the next character


class Automaton:
    """Probabilistic automaton over classes of characters; a state also knows its characters within each class."""

    def __init__(self, examples: Iterable[str], alpha: float = ALPHA) -> None:
        self.root, lengths = State(), Counter()
        for text in examples:
            lengths[len(text)] += 1
            state = self.root
            for byte in text.encode():
                state.total += 1
                state.seen[byte] += 1
                state = state.next.setdefault(CLASSES[byte], State())
            state.total += 1
            state.ends += 1
        #: Loops forget lengths: formats seen in a few lengths only have those, others three quarters of the shortest at least.
        self.lengths = set(lengths) if len(lengths) <= 4 else None
        self.least = min(lengths, default=0) * (4 if self.lengths else 3) // 4
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        states = self._merged()
        self.size = len(states)
        self._costs(states)

    def _merged(self) -> list[State]:
        """States that stay. The state seen most often is next: it joins the compatible one whose frequencies are nearest, or stays."""
        stay, ids = [self.root], {id(self.root)}
        while True:
            fringe = [(s.next[c], s, c) for s in stay for c in sorted(s.next) if id(s.next[c]) not in ids]
            if not fringe:
                return stay
            state, parent, c = max(fringe, key=lambda x: x[0].total)
            by_overlap = sorted(stay, key=lambda s: -_overlap(s, state))
            near = next((s for s in by_overlap if self._compatible(s, state)), None)
            if near is None:
                stay.append(state)
                ids.add(id(state))
            else:
                parent.next[c] = near
                self._fold(near, state)

    def _compatible(self, a: State, b: State) -> bool:
        pairs = [(a, b)]
        while pairs:
            a, b = pairs.pop()
            slack = self.bound * (a.total**-0.5 + b.total**-0.5)
            if slack < 1:
                if abs(a.ends / a.total - b.ends / b.total) > slack:
                    return False
                for x in a.seen.keys() | b.seen.keys():
                    if abs(a.seen[x] / a.total - b.seen[x] / b.total) > slack:
                        return False
                for c in a.next.keys() | b.next.keys():
                    if abs(_of_class(a, c) / a.total - _of_class(b, c) / b.total) > slack:
                        return False
            pairs += [(a.next[c], b.next[c]) for c in a.next.keys() & b.next.keys()]
        return True

    def _fold(self, into: State, tree: State) -> None:
        pairs = [(into, tree)]
        while pairs:
            a, b = pairs.pop()
            a.total, a.ends = a.total + b.total, a.ends + b.ends
            a.seen.update(b.seen)
            for c, child in b.next.items():
                if c in a.next:
                    pairs.append((a.next[c], child))
                else:
                    a.next[c] = child

    def _costs(self, states: list[State]) -> None:
        """Log probabilities by state: of each byte whose class goes on, with half a count for characters not seen, and of the end."""
        number = {id(s): i for i, s in enumerate(states)}
        self.steps: list[dict[int, tuple[int, float]]] = []
        self.stop: list[float] = []
        for s in states:
            step = {}
            for byte in range(256):
                c = CLASSES[byte]
                if c in s.next:
                    of_class = _of_class(s, c)
                    chance = of_class / s.total * (s.seen[byte] + 0.5) / (of_class + 0.5 * _MEMBERS[c])
                    step[byte] = number[id(s.next[c])], math.log(chance)
            self.steps.append(step)
            self.stop.append(math.log(s.ends / s.total) if s.ends else -math.inf)
        del self.root  # the costs are all that scoring needs, and small enough to travel

    def log_likelihood(self, text: bytes) -> float:
        """Of the text as a whole; minus infinity for another length or a step that no example took."""
        if len(text) < self.least or self.lengths is not None and len(text) not in self.lengths:
            return -math.inf
        state, total = 0, 0.0
        for byte in text:
            got = self.steps[state].get(byte)
            if got is None:
                return -math.inf
            state, cost = got
            total += cost
        return total + self.stop[state]


def _overlap(a: State, b: State) -> float:
    """Common part of the frequencies of next characters and the end."""
    return min(a.ends / a.total, b.ends / b.total) + sum(min(a.seen[x] / a.total, n / b.total) for x, n in b.seen.items())


def _of_class(state: State, c: str) -> int:
    return sum(n for byte, n in state.seen.items() if CLASSES[byte] == c)


class Formats:
    """An automaton for each kind, in the order of the table, and one for ordinary tokens."""

    def __init__(self, table: Iterable[tuple[str, str | None]], alpha: float = ALPHA, margin: float = MARGIN) -> None:
        by_kind: dict[str | None, list[str]] = {}
        for text, kind in table:
            by_kind.setdefault(kind, []).append(text)
        plain = by_kind.pop(None, [])
        self.kinds = {kind: Automaton(texts, alpha) for kind, texts in by_kind.items()}
        self.plain = Automaton(plain, alpha)
        self.plain.lengths, self.plain.least = None, 0
        #: A step that ordinary tokens never take costs them this much.
        self.rare = math.log(0.5 / max(1, len(plain)) / 64)
        self.margin = margin
        self.least = min((a.least for a in self.kinds.values()), default=1)

    def plain_likelihood(self, text: bytes) -> float:
        state, total = 0, 0.0
        for byte in text:
            got = self.plain.steps[state].get(byte)
            state, cost = got if got is not None else (0, self.rare)
            total += cost
        return total + max(self.plain.stop[state], self.rare)

    def best(self, text: bytes) -> tuple[str, float] | None:
        """The likeliest kind and its margin in natural logarithms over ordinary tokens, None if no format takes the text."""
        likely = [(a.log_likelihood(text), kind) for kind, a in self.kinds.items()]
        top, kind = max(likely, key=lambda x: x[0], default=(-math.inf, ""))
        return None if top == -math.inf else (kind, top - self.plain_likelihood(text))


# ------------------------------------------------------------------------------------------------------ texts

_CREDENTIAL = np.zeros(256, bool)
_CREDENTIAL[[ord(c) for c in _ALNUM + "+/_.-"]] = True
_HEX = np.zeros(256, bool)
_HEX[[ord(c) for c in "0123456789abcdef"]] = True


def _long_runs(inside: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of marked bytes within rows, of a least length."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets] = True
    before, after = np.zeros(len(inside), bool), np.zeros(len(inside), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    ok = ends - starts >= least
    return starts[ok], ends[ok]


def _base_spans(data: bytes, view: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(start, end, place of the kind, start of the credential) in bytes of the batch; a pattern never crosses rows."""
    found = []
    for place, (prefilter, pattern, group) in enumerate(((KEYWORD, ASSIGN, 2), (re.compile(b"AKIA"), ACCESS, 0))):
        least = list(LEAST.values())[place]
        rows = np.unique(np.searchsorted(offsets, np.fromiter((m.start() for m in prefilter.finditer(data)), np.int64), "right") - 1)
        for row in rows.tolist():
            low, high = int(offsets[row]), int(offsets[row + 1])
            found += [(low + m.start(), low + m.end(), place, low + m.start(group))
                      for m in pattern.finditer(data[low:high]) if m.end(group) - m.start(group) >= least]
    return found + [(a, b, 2, a) for a, b in zip(*(x.tolist() for x in _long_runs(_HEX[view], offsets, LEAST["hex"])), strict=True)]


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("format", pa.string()), ("score", pa.float64())])


def _scan(formats: Formats):
    kinds, margin = [*LEAST, *formats.kinds], formats.margin

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 8 << 20):
            view, offsets = text_view(batch.column("text"))
            data = view.tobytes()
            spans = [(a, b, place, formats.best(data[c:b].rstrip(b"."))) for a, b, place, c in _base_spans(data, view, offsets)]
            known: dict[bytes, tuple[str, float] | None] = {}
            for a, b in zip(*(x.tolist() for x in _long_runs(_CREDENTIAL[view], offsets, formats.least)), strict=True):
                while b > a and data[b - 1] in b".-":  # the end of a sentence, not of a token
                    b -= 1
                text = data[a:b]
                if text not in known:
                    known[text] = formats.best(text)
                if known[text] is not None and known[text][1] >= margin:
                    spans.append((a, b, kinds.index(known[text][0], len(LEAST)), known[text]))
            rows: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            if spans:
                inner = np.concatenate([[0], np.cumsum((view & 0xC0) == 0x80)])  # bytes that go on with a character
                spans.sort(key=lambda s: (s[0], s[2], s[1]))
                owners = np.searchsorted(offsets, [s[0] for s in spans], "right") - 1
                reach = -1
                cover = sorted((a, b) for a, b, place, _ in spans if place < len(LEAST))
                at = 0
                for (a, b, place, best), row in zip(spans, owners.tolist(), strict=True):
                    while at < len(cover) and cover[at][0] <= a:
                        reach, at = max(reach, cover[at][1]), at + 1
                    if place >= len(LEAST) and b <= reach:
                        continue  # a base span has it
                    low = int(offsets[row])
                    place_of = lambda x: x - low - int(inner[x] - inner[low])
                    rows[row].append({"kind": kinds[place], "start": place_of(a), "end": place_of(b), "base": place < len(LEAST),
                                      "format": best and best[0], "score": best and best[1]})
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(rows, pa.list_(_SPAN))], ["id", "spans"])

    return run


@lru_cache(maxsize=4)
def _formats(table: tuple[tuple[str, str | None], ...] | None, alpha: float, margin: float) -> Formats:
    """Learned once, from a small table of labels; the costs travel with the tasks."""
    return Formats(labelled() if table is None else table, alpha, margin)


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table: list[tuple[str, str | None]] | None = None,
    alpha: float = ALPHA, margin: float = MARGIN,
) -> DataFrame:
    """One row per document: id, spans (kind, start, end, base, format, score), in code points, end exclusive, by start, kind, end.

    Base spans are the matches of the three patterns, leftmost and not overlapping within a kind, whose value has the least
    length: `assign` (the whole assignment, 8 characters of value), `access` (16), `hex` (32). They stay whatever their score.
    Added spans are runs of [A-Za-z0-9+/_.-] without a sentence's end, which an automaton of a kind makes `margin` (natural
    logarithms) likelier than ordinary tokens are, unless they lie in a base span. `format` and `score` tell for every span the
    likeliest format and that margin, null where no format takes it. `table` has labelled (text, kind) examples, kind None for
    ordinary tokens; by default :func:`labelled`. `alpha` is the level of the tests that merge states.

    A null or empty text has no spans; a null id stays null. Each row stands alone: repeated rows and ids give a row each, other
    columns are not read, an empty table gives an empty result. A very long text is read whole, in one piece.
    """
    rows = docs.select(id_in(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    shape = "id long, spans array<struct<kind: string, start: long, end: long, base: boolean, format: string, score: double>>"
    formats = _formats(None if table is None else tuple(table), alpha, margin)
    return rows.mapInArrow(_scan(formats), shape).select(id_out("id").alias(id_col), "spans")
