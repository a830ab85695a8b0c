"""Toxicity of documents: a noisy-channel decoder restores disguised words, a lexicon learned from labels scores the text.

A disguised stretch becomes a lattice of characters: a sign may stand for a letter (leetspeak), a gap between parts may be nothing
(spacing), and a letter that repeats may be fewer (repetition). Viterbi finds the path that a character trigram model of the
whole corpus likes best, over the whole stretch, whatever its length.

Only paths that can end in the lexicon matter. Whatever the decoder may do to a stretch, its skeleton stays the same: signs as
letters, repeated letters once, gaps left out. So an automaton of the skeletons of the lexicon runs over the skeleton of the text
and finds every place where a path could hold a word, a beginning or an ending of the lexicon; the decoder works on these places.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrimlens.llm.common import id_in, id_out, settle, slices, tidy

#: Labelled rows that the lexicon is learned from at most; beyond, a sample by the hash of the id.
TRAINING_ROWS = 20_000
#: Stems and words in the lexicon at most, the best supported first; a parameter of the model.
LEXICON = 20_000
# Signs and the letters they stand for.
_LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t"}
#: Log probabilities of the channel: a sign for a letter or as it stands (alone between gaps), a letter again, a letter too
#: many (beside a third, beside one), a gap inside a word (with blanks, without), a gap without blanks between words.
SIGN_READ, SIGN_KEPT, SIGN_KEPT_ALONE, AGAIN, MANY, TWICE, BLANKS_INSIDE, GAP_INSIDE, GAP_KEPT = -1.5, -0.5, -3.0, -1.0, -0.1, -3.0, -0.5, 0.0, -3.0
_WORD = re.compile(r"\w+")
#: Bytes of text whose skeleton is made at once; its arrays take some fifty times as much.
SLICE_BYTES = 1 << 19

# -------------------------------------------------------------------------------------------- character language model

#: Classes of characters: 0 for what is no letter, the Latin letters up to U+017F, and one for all other letters.
_CLASSES = np.zeros(0x180, np.int64)
for _code in range(0x180):
    if chr(_code).isalpha() and len(chr(_code).lower()) == 1 and ord(chr(_code).lower()) < 0x180:
        _CLASSES[_code] = 1 + sorted({ord(chr(c).lower()) for c in range(0x180) if chr(c).isalpha() and len(chr(c).lower()) == 1 and ord(chr(c).lower()) < 0x180}).index(ord(chr(_code).lower()))
OTHER = int(_CLASSES.max()) + 1
SYMBOLS = OTHER + 1


def classes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(codes < 0x180, _CLASSES[np.minimum(codes, 0x17F)], OTHER)


@lru_cache(maxsize=10_000)
def letter_class(letter: str) -> int:
    return int(classes(letter)[0])


def character_counts(docs: DataFrame, text: str) -> DataFrame:
    """Trigrams of character classes over all texts: (code, n). A task adds up what it reads before anything is moved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in slices(batches, "text"):
            c = classes("\n\n".join(["", *(t or "" for t in batch.column("text").to_pylist()), ""]))
            # Between words one boundary is enough.
            c = c[np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])]
            if len(c) > 2:
                total += np.bincount((c[:-2] * SYMBOLS + c[1:-1]) * SYMBOLS + c[2:], minlength=SYMBOLS**3)
        code = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(code, pa.int64()), pa.array(total[code], pa.int64())], names=["code", "n"])

    return docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


class Characters:
    """Log probabilities of a character class after two others, with a share of the bigrams and of the letters."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray) -> None:
        tri = np.zeros(SYMBOLS**3)
        tri[codes] = counts
        tri = tri.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
        bi, one = tri.sum(0), tri.sum((0, 1)) + 1
        p = one / one.sum()
        p2 = (bi + 5 * p) / (bi.sum(1, keepdims=True) + 5)
        p3 = (tri + 5 * p2[None]) / (tri.sum(2, keepdims=True) + 5)
        self.log = np.ascontiguousarray(np.log(p3).astype(np.float32))

    def restore(self, stretch: str) -> str:
        """The best path through the lattice of a stretch, with a boundary at both ends."""
        log = memoryview(self.log.reshape(-1))
        units = [m.group() for m in _UNIT.finditer(stretch.lower())]
        #: Two last classes -> (log probability, what was written last, the path before).
        paths: dict[tuple[int, int], tuple] = {(0, 0): (0.0, "", None)}
        for i, unit in enumerate(units):
            left, right = units[i - 1] if i else " ", units[i + 1] if i + 1 < len(units) else " "
            choices: list[tuple[str, float]] = []  # what the unit may stand for, with the channel's log probability
            if unit in _LEET:
                choices += [(letter, SIGN_READ) for letter in _LEET[unit]]
                choices.append((unit, SIGN_KEPT_ALONE if _is_gap(left) and _is_gap(right) and len(units) > 1 else SIGN_KEPT))
            elif _is_gap(unit):
                blank = any(c.isspace() for c in unit)
                choices += [(" ", 0.0 if blank else GAP_KEPT), ("", BLANKS_INSIDE if blank else GAP_INSIDE)]
            elif unit.isalpha():
                repeated = left == unit
                choices.append((unit, AGAIN if repeated else 0.0))
                if repeated:
                    choices.append(("", MANY if right == unit or i > 1 and units[i - 2] == unit else TWICE))
            else:
                choices.append((unit, 0.0))
            following: dict[tuple[int, int], tuple] = {}
            numbered = [(letter, cost, letter_class(letter) if letter.isalpha() else 0) for letter, cost in choices]
            for (a, b), path in paths.items():
                place, score = (a * SYMBOLS + b) * SYMBOLS, path[0]
                for letter, cost, c in numbered:
                    if not letter:
                        state, now = (a, b), score + cost
                    else:
                        state = (b, c) if c or b else (a, b)
                        now = score + cost + (log[place + c] if c or b else -1.0)
                    if state not in following or now > following[state][0]:
                        following[state] = (now, letter, path)
            paths = following
        path = max(((p[0] + log[(a * SYMBOLS + b) * SYMBOLS], p) for (a, b), p in paths.items()), key=lambda x: x[0])[1]
        written = []
        while path is not None:
            written.append(path[1])
            path = path[2]
        return "".join(reversed(written))


# ------------------------------------------------------------------------------------------------------- skeletons

_GAP, _LETTER, _SIGN, _END = 0, 1, 2, 3


def _kind(code: int) -> int:
    c = chr(code)
    if c in _LEET:
        return _SIGN
    return _END if c == "\n" else _LETTER if c.isalnum() else _GAP


#: What a character is in a skeleton, and the letter it counts as; those beyond the table are gaps.
_KINDS = np.array([_kind(c) for c in range(0x10000)], np.uint8)
_AS = np.arange(0x10000, dtype=np.uint32)
for _sign, _letters in _LEET.items():
    _AS[ord(_sign)] = ord(_letters[0])
_AS[ord("l")] = ord("i")  # 1, ! and | stand for both
_UNIT = re.compile(rf"[{''.join(map(re.escape, _LEET))}]|[^\W_]|(?:(?![{''.join(map(re.escape, _LEET))}])[\W_])+")


def _is_gap(unit: str) -> bool:
    return not unit[0].isalnum() and unit not in _LEET


class Skeleton:
    """Skeleton of lower-case text: one character for each run of letters that count alike, over signs and gaps; lines end it."""

    def __init__(self, low: str) -> None:
        codes = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
        inside = codes < 0x10000
        kinds = np.where(inside, _KINDS[np.where(inside, codes, 0)], _GAP).astype(np.uint8)
        kept = np.flatnonzero(kinds != _GAP)
        letters = _AS[codes[kept]]
        new = np.ones(len(kept), bool)
        new[1:] = (letters[1:] != letters[:-1]) | (letters[1:] == 10)
        begins = np.flatnonzero(new)
        self.text = letters[new].tobytes().decode("utf-32-le", "surrogatepass")
        plain = np.zeros(len(codes) + 2, bool)
        plain[1:-1] = kinds == _LETTER
        starts, ends = ~plain[kept], ~plain[kept + 2]  # the character before, or behind, is no plain letter
        far = np.int64(len(codes) + 1)
        none = np.zeros(0, np.int64)
        #: By place in the skeleton: last place in the text where a token begins, first where one ends (-1 and far: none), last place.
        self.begin = np.maximum.reduceat(np.where(starts, kept, -1), begins) if len(begins) else none
        self.end = np.minimum.reduceat(np.where(ends, kept, far), begins) if len(begins) else none
        self.first, self.last, self.far = kept[begins], kept[np.append(begins[1:], len(kept)) - 1] if len(begins) else none, far
        self.signs = np.concatenate([[0], np.cumsum(kinds == _SIGN)])


def skeleton(word: str) -> str:
    return Skeleton(word).text


EQUAL, BEGINS, ENDS = 1, 2, 4


class Finder:
    """Words of texts that may hit the lexicon: plain ones, and what the decoder makes of stretches that could hide one."""

    def __init__(self, characters: Characters, lexicon: frozenset[str], remembered: int = 20_000) -> None:
        self.characters, self.remembered = characters, remembered
        self.known: dict[str, list[str]] = {}
        shapes: dict[str, int] = {}
        for feature in lexicon:
            if shape := skeleton(feature[1:].lower()):
                shapes[shape] = shapes.get(shape, 0) | {"=": EQUAL, "<": BEGINS, ">": ENDS}[feature[0]]
        self.automaton = ahocorasick.Automaton()
        for shape, how in shapes.items():
            self.automaton.add_word(shape, (len(shape), how))
        if shapes:
            self.automaton.make_automaton()

    def __reduce__(self):  # the automaton is built again where it is used
        return _rebuilt, (self.characters, self.shapes())

    def shapes(self) -> tuple[tuple[str, int], ...]:
        return tuple((shape, how) for shape, (_, how) in self.automaton.items())

    def restored(self, stretch: str) -> list[str]:
        got = self.known.get(stretch)
        if got is None:
            if len(self.known) > self.remembered:
                self.known.clear()
            got = self.known[stretch] = _WORD.findall(self.characters.restore(stretch))
        return got

    def words(self, texts: list[str]) -> list[set[str]]:
        """For each text the words at places where its skeleton holds something of the lexicon."""
        out: list[set[str]] = [set() for _ in texts]
        if not len(self.automaton):
            return out
        lows = [t.lower() for t in texts]
        low = "\n".join(lows)
        bones = Skeleton(low)
        found = [(end - size + 1, end, how) for end, (size, how) in self.automaton.iter(bones.text)]
        if not found:
            return out
        p, q, how = np.array(found).T
        begin, end, last = bones.begin[p], bones.end[q], bones.last[q]
        equal = (how & EQUAL > 0) & (begin >= 0) & (end < bones.far)
        begins, ends = (how & BEGINS > 0) & (begin >= 0), (how & ENDS > 0) & (end < bones.far)
        use = np.flatnonzero(equal | begins | ends)
        lines = np.cumsum([0, *(len(t) + 1 for t in lows)])
        for i in use.tolist():
            row = int(np.searchsorted(lines, bones.first[p[i]], "right")) - 1
            start = int(begin[i]) if equal[i] or begins[i] else int(bones.first[p[i]])
            if last[i] - start == q[i] - p[i] and bones.signs[last[i] + 1] == bones.signs[start]:
                out[row].add(_whole(low, start))  # nothing is disguised there
                continue
            for a, b in self._spans(low, int(begin[i]), int(end[i]), int(bones.first[p[i]]), int(last[i]), bool(equal[i]), bool(begins[i]), bool(ends[i])):
                out[row].update(self.restored(low[a:b]))
                if word := _WORD.fullmatch(low, a, b):
                    out[row].add(word.group())  # also as it stands
        return out

    @staticmethod
    def _spans(low: str, begin: int, end: int, first: int, last: int, equal: bool, begins: bool, ends: bool) -> list[tuple[int, int]]:
        """Stretches to look at: the whole tokens of the match, and with one token more where a beginning or an ending goes on."""
        spans = []
        if equal and begin <= end:
            spans.append((_left(low, begin), _right(low, end + 1)))
        if begins and begin <= last:
            stop = _right(low, _token_end(low, last + 1))
            spans += [(_left(low, begin), stop), (_left(low, begin), _right(low, _next_token(low, stop)))]
        if ends and first <= end:
            start = _left(low, _token_start(low, first))
            spans += [(start, _right(low, end + 1)), (_left(low, _token_before(low, start)), _right(low, end + 1))]
        return list(dict.fromkeys(spans))


def _rebuilt(characters: Characters, shapes: tuple[tuple[str, int], ...]) -> Finder:
    finder = Finder(characters, frozenset())
    for shape, how in shapes:
        finder.automaton.add_word(shape, (len(shape), how))
    if shapes:
        finder.automaton.make_automaton()
    return finder


def _whole(low: str, at: int) -> str:
    """The word around a place."""
    while at > 0 and (low[at - 1].isalnum() or low[at - 1] == "_"):
        at -= 1
    word = _WORD.match(low, at)
    return word.group() if word else ""


def _left(low: str, a: int) -> int:
    """Over the signs before a token."""
    while a > 0 and low[a - 1] in _LEET:
        a -= 1
    return a


def _right(low: str, b: int) -> int:
    while b < len(low) and low[b] in _LEET:
        b += 1
    return b


def _token_end(low: str, b: int) -> int:
    while b < len(low) and (low[b].isalnum() or low[b] in _LEET):
        b += 1
    return b


def _token_start(low: str, a: int) -> int:
    while a > 0 and (low[a - 1].isalnum() or low[a - 1] in _LEET):
        a -= 1
    return a


def _next_token(low: str, b: int) -> int:
    at = b
    while at < len(low) and low[at] != "\n" and not (low[at].isalnum() or low[at] in _LEET):
        at += 1
    return _token_end(low, at) if at < len(low) and low[at] != "\n" else b


def _token_before(low: str, a: int) -> int:
    at = a
    while at > 0 and low[at - 1] != "\n" and not (low[at - 1].isalnum() or low[at - 1] in _LEET):
        at -= 1
    return _token_start(low, at) if at > 0 and low[at - 1] != "\n" else a


# ------------------------------------------------------------------------------------------------- lexicon and scores


def features(word: str) -> list[str]:
    """A word, and its beginnings and ends of four to six letters."""
    out = ["=" + word]
    for k in (4, 5, 6):
        if len(word) > k:
            out += ["<" + word[:k], ">" + word[-k:]]
    return out


def _held_out(column: str) -> F.Column:
    return F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0


def _feature_counts(rows: DataFrame, known: frozenset[str] | None) -> DataFrame:
    """Documents that have each feature in the words as they stand; with `known` only of these features. Added up by task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        total: Counter[str] = Counter()

        def table() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["feature", "n"])
            total.clear()
            return got

        for batch in slices(batches, "text"):
            for text in batch.column("text").to_pylist():
                found = {f for w in set(_WORD.findall((text or "").lower())) for f in features(w)}
                total.update(found if known is None else found & known)
            if len(total) > 300_000:
                yield table()
        if total:
            yield table()

    return rows.select("text").mapInArrow(run, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))


class Scale:
    """Chance of a document by its words of the lexicon: how many there are, their joint weight, and the document's length. A logistic
    curve through the labelled documents that have such words; one that has none scores 0."""

    def __init__(self, shares: dict[str, float], weights: np.ndarray | None = None, remembered: int = 300_000) -> None:
        self.shares, self.weights, self.remembered = shares, weights, remembered
        self.known: dict[str, float] = {}

    def hits(self, words: set[str]) -> dict[str, float]:
        """Words with a share of toxic documents."""
        if len(self.known) > self.remembered:
            self.known.clear()
        out = {}
        for word in words:
            share = self.known.get(word)
            if share is None:
                share = self.known[word] = max(self.shares.get(f, 0.0) for f in features(word))
            if share:
                out[word] = share
        return out

    @staticmethod
    def row(hits: dict[str, float], words: int) -> list[float]:
        return [1.0, math.log(len(hits)), min(20.0, -sum(math.log(1 - p) for p in hits.values())), math.log(max(words, 1))]

    def score(self, words: set[str], length: int) -> tuple[float, list[str]]:
        """Chance and hits of a text of so many words, of which these may hit."""
        hits = self.hits(words) if words else {}
        if not hits or self.weights is None:
            return 0.0, []
        return float(1 / (1 + np.exp(-np.clip(np.dot(self.weights, self.row(hits, length)), -30, 30)))), sorted(hits)

    def fit(self, rows: np.ndarray, toxic: np.ndarray, rounds: int = 30) -> None:
        """Newton's method with a small penalty, so that labels that one line separates give finite weights."""
        weights, penalty = np.zeros(rows.shape[1]), np.diag([0.01, *[0.1] * (rows.shape[1] - 1)])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
            slope = rows.T @ (p - toxic) + penalty @ weights
            weights = weights - np.linalg.solve((rows * (p * (1 - p))[:, None]).T @ rows + penalty, slope)
        self.weights = weights


def _found(batch: pa.RecordBatch, finder: Finder) -> Iterator[tuple[set[str], int]]:
    """Of each text the words that may hit the lexicon, and its number of words where there are any."""
    texts = [t or "" for t in batch.column("text").to_pylist()]
    for text, words in zip(texts, finder.words(texts), strict=True):
        yield words, sum(1 for _ in _WORD.finditer(text)) if words else 0


def _evidence(rows: DataFrame, finder: Finder, scale: Scale) -> DataFrame:
    """The scale's rows of labelled documents with words of the lexicon."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        for batch in slices(batches, "text", SLICE_BYTES):
            out = []
            for toxic, (words, n) in zip(batch.column("toxic").to_pylist(), _found(batch, finder), strict=True):
                if words and (hits := scale.hits(words)):
                    out.append((toxic, scale.row(hits, n)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in out], pa.bool_()), pa.array([r for _, r in out], pa.list_(pa.float64()))], names=["toxic", "row"])

    return rows.select("toxic", "text").mapInArrow(run, "toxic boolean, row array<double>")


def learn(docs: DataFrame, labels: DataFrame, characters: Characters, id_col: str, text_col: str, label_col: str, most: int) -> tuple[Finder, Scale]:
    """Features of toxic documents with their share of toxic ones, and the scale of what documents have of them."""
    usable = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~_held_out(id_col)).select(F.col(id_col).cast("long").alias("label_id"), (F.col(label_col) == 1).alias("toxic"))
    rows = usable.count()
    share = min(1.0, most / max(rows, 1))
    usable = usable.where(F.pmod(F.xxhash64("label_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    # The labels of the sample are bounded by `most`, so they may be sent to every task; the sample is taken out of the documents once.
    sample = settle(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(usable), F.col("id") == F.col("label_id")).select("text", "toxic"))
    sizes = {r["toxic"]: r["count"] for r in sample.select("toxic").groupBy("toxic").count().collect()}
    bad, good = sizes.get(True, 0), sizes.get(False, 0)
    if not bad or not good:
        return Finder(characters, frozenset()), Scale({})
    base = bad / (bad + good)
    positive = _feature_counts(sample.where("toxic"), None).where(F.col("n") >= 3).orderBy(F.desc("n"), "feature").limit(10 * LEXICON).collect()
    counts = {r["feature"]: r["n"] for r in positive}
    negative = {r["feature"]: r["n"] for r in _feature_counts(sample.where("NOT toxic"), frozenset(counts)).collect()}
    kept = {}
    for feature, n in counts.items():
        m = negative.get(feature, 0)
        p = (n + 0.5) / (n + m + 1)
        # Log likelihood ratio against the base rate, high enough for this many features.
        ratio = n * math.log(p / base) + m * math.log((1 - p) / (1 - base))
        if p >= 0.8 and ratio > math.log(max(len(counts), 2)) + 4:
            kept[feature] = (ratio, p)
    best = sorted(kept, key=lambda f: (-kept[f][0], f))[:LEXICON]
    scale = Scale({f: kept[f][1] for f in best})
    finder = Finder(characters, frozenset(scale.shares))
    rows = _evidence(sample, finder, scale).collect()  # a row a document of the bounded sample at most
    if rows:
        scale.fit(np.array([r["row"] for r in rows]), np.array([r["toxic"] for r in rows], float))
    return finder, scale


def toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    training_rows: int = TRAINING_ROWS,
) -> DataFrame:
    """One row per document: id, held_out, score (0 to 1), predicted (1 from a score of 0.5), hits (the words that count).

    Learns from labelled rows whose crc32 of the id in decimals is no multiple of five, at most about `training_rows` of them; ids
    and labels are never inputs of a score. The score is a chance by how many words the lexicon holds and how toxic they are. A null or
    empty text scores 0.0, a table without labels scores everything 0.0, an empty table gives an empty result. Each row is scored
    by itself, so repeated rows and ids change nothing but how often a label counts; a text is read whole however long it is,
    other columns are not read. A null id is not held out.
    """
    counted = character_counts(docs, text_col).toPandas()  # at most SYMBOLS ** 3 rows
    characters = Characters(counted["code"].to_numpy(np.int64), counted["n"].to_numpy(np.float64))
    finder, scale = learn(docs, labels, characters, id_col, text_col, label_col, training_rows)
    out = pa.schema([("id", pa.int64()), ("score", pa.float64()), ("hits", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        for batch in slices(batches, "text", SLICE_BYTES):
            scores, hits = zip(*(scale.score(words, n) for words, n in _found(batch, finder)), strict=True)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores, pa.float64()), pa.array(hits, pa.list_(pa.string()))], schema=out)

    rows = docs.select(id_in(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    scored = rows.mapInArrow(run, "id long, score double, hits array<string>").withColumn("id", id_out("id"))
    return scored.select(
        F.col("id").alias(id_col), F.coalesce(_held_out("id"), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "hits")


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how: object) -> DataFrame:
    """The documents that are not predicted toxic, all columns. An id that several documents carry goes if one of them does."""
    gone = toxicity(docs, labels, id_col, text_col, **how).where("predicted = 1").select(F.col(id_col).alias("gone")).distinct()
    return docs.join(gone, docs[id_col].eqNullSafe(gone.gone), "left_anti")
