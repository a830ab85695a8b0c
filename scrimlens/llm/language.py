"""Language identification by unigram pieces with all segmentations summed.

A language is a distribution over the pieces of a fixed public vocabulary. The chance of a word is the sum over every way to cut
it into pieces, by the forward algorithm; a text's is the product over its words. The distributions are learned by expectation
and maximisation over a sample of texts with known languages. Distinct words go through the algorithm together, as arrays.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrimlens.llm.common import id_in, id_out, mix, settle, slices

#: Documents of each language that the distributions are learned from at most; beyond, a sample by the hash of the id.
TRAINING_DOCS = 2_000
#: Letters of the longest words that the distributions are learned from; longer ones are scored like all others, whole.
LEARNED_LETTERS = 24
#: Places of words in one go of the forward algorithm, and the letters after which its sums are scaled again.
TOGETHER, RESCALED = 1 << 18, 8
REMEMBERED = 400_000
_WORD = re.compile(r"[^\W\d_]+")
_U = np.uint64
_BASE = _U(0x5851F42D4C957F2D)
_UNKNOWN = 1e-9  # a letter that no piece holds
#: What the table says of a stretch that is no piece: nothing begins with it, or longer pieces do. The first is also the place of
#: unknown letters, the last row of the chances.
_NONE, _BEGINNING = -1, -2


def read_pieces(path: str) -> list[str]:
    """Pieces of a sentencepiece vocabulary that letters make up, small letters only; ▁ stands for the beginning of a word."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return sorted({p for p in found if p == p.lower() and (p[p[0] == "▁" :].isalpha() or p == "▁")})


class Pieces:
    """Numbers of all pieces inside words: by word, first letter and length. A table of hashes with open places finds them; it
    also knows the beginnings of pieces, so that a stretch no piece goes on with is followed no further."""

    def __init__(self, pieces: list[str]) -> None:
        self.pieces, self.longest = pieces, max(map(len, pieces), default=1)
        numbers = dict.fromkeys((p[:i] for p in pieces for i in range(1, len(p))), _BEGINNING)
        numbers |= {p: i for i, p in enumerate(pieces)}
        self.bits = max(8, (4 * len(numbers)).bit_length())
        self.keys = np.zeros(1 << self.bits, _U)
        self.numbers = np.full(1 << self.bits, _NONE, np.int32)
        self.probes = 1
        for key, number in zip(self._hashes(list(numbers)).tolist(), numbers.values(), strict=True):
            at, step = key >> (64 - self.bits), 0
            while self.numbers[(at + step) & ((1 << self.bits) - 1)] != _NONE:
                step += 1
            self.keys[(at + step) & ((1 << self.bits) - 1)] = key
            self.numbers[(at + step) & ((1 << self.bits) - 1)] = number
            self.probes = max(self.probes, step + 1)

    @staticmethod
    def codes(words: list[str], width: int) -> np.ndarray:
        data = np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
        return data.reshape(len(words), width)

    def _hashes(self, pieces: list[str]) -> np.ndarray:
        if not pieces:
            return np.zeros(0, _U)
        codes = self.codes(pieces, self.longest)
        out = np.zeros(len(pieces), _U)
        for i in range(self.longest):
            out = np.where(codes[:, i] > 0, out * _BASE + codes[:, i].astype(_U) + _U(1), out)
        return mix(out)

    def find(self, keys: np.ndarray) -> np.ndarray:
        place = (keys >> _U(64 - self.bits)).astype(np.int64)
        out = np.full(len(keys), _NONE, np.int32)
        for step in range(self.probes):
            at = (place + step) & ((1 << self.bits) - 1)
            out = np.where((self.keys[at] == keys) & (out == _NONE), self.numbers[at], out)
        return out

    def lattice(self, words: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(begin, end, rows, pieces) for all places of words with the boundary before them, by rising begin."""
        width = max(map(len, words))
        codes = self.codes(words, width).astype(_U)
        lengths = np.array([len(w) for w in words])
        for begin in range(width):
            rows = np.flatnonzero(lengths > begin)
            rolling = np.zeros(len(rows), _U)
            for end in range(begin + 1, min(width, begin + self.longest) + 1):
                long = lengths[rows] >= end
                rows, rolling = rows[long], rolling[long]
                if not len(rows):
                    break
                rolling = rolling * _BASE + codes[rows, end - 1] + _U(1)
                numbers = self.find(mix(rolling))
                if end == begin + 1:
                    yield begin, end, rows, np.where(numbers >= 0, numbers, _NONE)  # a single letter may be unknown
                elif (found := numbers >= 0).any():
                    yield begin, end, rows[found], numbers[found]
                on = numbers != _NONE
                rows, rolling = rows[on], rolling[on]


def _together(words: list[str]) -> Iterator[np.ndarray]:
    """Places of words of about the same length, so many at a time that their letters fill the room."""
    lengths = np.array([len(w) for w in words])
    order = np.argsort(lengths, kind="stable")
    first = 0
    while first < len(order):
        rows = max(1, TOGETHER // (int(lengths[order[first]]) + 1))
        rows = max(1, min(rows, TOGETHER // (int(lengths[order[min(first + rows, len(order)) - 1]]) + 1)))
        yield order[first : first + rows]
        first += rows


def split_words(text: str) -> list[str]:
    """Words as ▁ and small letters."""
    return ["▁" + word for word in _WORD.findall(text.lower())]


class Model:
    def __init__(self, pieces: list[str], languages: list[str], chances: np.ndarray) -> None:
        """chances: by piece and language, and a last row for unknown letters."""
        self.table, self.languages, self.chances = Pieces(pieces), languages, chances

    def log_chances(self, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language, all segmentations summed."""
        out = np.empty((len(words), len(self.languages)))
        longest = self.table.longest
        for part in _together(words):
            chosen = [words[i] for i in part]
            lengths, every = np.array([len(w) for w in chosen]), np.arange(len(chosen))
            ahead = np.zeros((int(lengths.max()) + 1, len(chosen), len(self.languages)))
            ahead[0] = 1
            taken = np.zeros(len(chosen))  # logarithms of what the sums were divided by
            scaled = 0
            for begin, end, rows, numbers in self.table.lattice(chosen):
                if begin >= scaled + RESCALED:
                    # The sums that are still open are divided by the largest of them; those of ended words stay as they are.
                    open_, scaled = np.flatnonzero(lengths > begin), begin
                    window = ahead[begin : begin + longest + 1, open_]
                    most = window.max(axis=(0, 2))
                    ahead[begin : begin + longest + 1, open_] = window / most[:, None]
                    taken[open_] += np.log(most)
                ahead[end, rows] += ahead[begin, rows] * self.chances[numbers]
            out[part] = np.log(np.maximum(ahead[lengths, every], 1e-300)) + taken[:, None]
        return out

    def expected(self, words: list[str], counts: np.ndarray, language: int) -> np.ndarray:
        """How often each piece is expected in the words of one language, by forward and backward sums."""
        total = np.zeros(len(self.chances))
        chance = self.chances[:, language]
        for part in _together(words):
            chosen = [words[i] for i in part]
            steps = list(self.table.lattice(chosen))
            size = max(map(len, chosen)) + 1
            ahead, back = np.zeros((size, len(chosen))), np.zeros((size, len(chosen)))
            lengths, every = np.array([len(w) for w in chosen]), np.arange(len(chosen))
            ahead[0] = 1
            back[lengths, every] = 1
            for begin, end, rows, numbers in steps:
                ahead[end, rows] += ahead[begin, rows] * chance[numbers]
            for begin, end, rows, numbers in reversed(steps):
                back[begin, rows] += back[end, rows] * chance[numbers]
            weight = counts[part] / np.maximum(ahead[lengths, every], 1e-300)
            for begin, end, rows, numbers in steps:
                total += np.bincount(numbers % len(total), ahead[begin, rows] * chance[numbers] * back[end, rows] * weight[rows], len(total))
        return total


def _chances(counts: np.ndarray) -> np.ndarray:
    smooth = counts + 0.1
    out = smooth / smooth.sum(0)
    return np.concatenate([out, np.full((1, out.shape[1]), _UNKNOWN)])


def learn(docs: DataFrame, pieces: list[str], usable: Column, id_col: str, text_col: str, lang_col: str, most: int, rounds: int) -> Model | None:
    rows = docs.where(usable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    sizes = {r["lang"]: r["count"] for r in rows.groupBy(F.col(lang_col).alias("lang")).count().collect()}
    if not sizes:
        return None
    languages = sorted(sizes)
    draw = F.pmod(F.xxhash64(id_col), F.lit(1 << 20))
    share = F.create_map(*[x for lang in languages for x in (F.lit(lang), F.lit(int(min(1.0, most / sizes[lang]) * (1 << 20))))])
    sample = rows.where(draw < share[F.col(lang_col)]).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found: Counter[tuple[str, str]] = Counter()
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found.update((lang, w) for w in split_words(text) if len(w) <= LEARNED_LETTERS)
            if found:
                langs, words = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(langs), pa.array(words), pa.array(list(found.values()), pa.int64())], names=["lang", "word", "n"])

    words = settle(sample.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")))
    model = Model(pieces, languages, _chances(np.ones((len(pieces), len(languages)))))
    for _ in range(rounds):
        counts = np.zeros((len(pieces), len(languages)))
        for r in words.mapInArrow(_expect(model), "lang int, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect():
            counts[r["piece"], r["lang"]] = r["n"]  # at most pieces times languages rows
        model = Model(pieces, languages, _chances(counts))
    return model


def _expect(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(model.languages), len(model.chances)))
        for batch in batches:
            langs = np.array([model.languages.index(x) for x in batch.column("lang").to_pylist()], np.int64)
            words, n = batch.column("word").to_pylist(), batch.column("n").to_numpy().astype(float)
            for i in np.unique(langs).tolist():
                mine = np.flatnonzero(langs == i)
                total[i] += model.expected([words[j] for j in mine], n[mine], i)
        lang, piece = np.nonzero(total[:, :-1])
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(piece, pa.int32()), pa.array(total[lang, piece])], names=["lang", "piece", "n"])

    return run


class Scorer:
    """Log probabilities of texts; those of words seen before are looked up."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.known: dict[str, int] = {}
        self.rows = np.zeros((0, len(model.languages)))

    def texts(self, texts: list[str]) -> list[tuple[str, float]]:
        split = [split_words(t) for t in texts]
        new = list(set().union(*split) - self.known.keys())
        if len(self.known) + len(new) > REMEMBERED:
            self.known, new = {}, list(set().union(*split))
            self.rows = self.rows[:0]
        if new:
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            self.rows = np.concatenate([self.rows, self.model.log_chances(new)])
        out = []
        for text, words in zip(texts, split, strict=True):
            if not any(map(str.isalpha, text)):
                out.append(("und", 0.0))
                continue
            total = self.rows[np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))].sum(0)
            best = int(total.argmax())
            out.append((self.model.languages[best], float(1 / np.exp(total - total[best]).sum())))
        return out


def identify(
    docs: DataFrame, pieces: str, held_out: Column | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    training_docs: int = TRAINING_DOCS, rounds: int = 3,
) -> DataFrame:
    """One row per document: id, held_out, lang_pred, score.

    `pieces` is the path of a sentencepiece vocabulary. Learns from documents outside `held_out` with a language, an id and a text,
    about `training_docs` of each language at most; language and id are no inputs of a prediction. lang_pred is a learned
    language, `und` with score 0.0 for null texts and texts without a letter, or when nothing could be learned. The score is the
    language's chance among the learned ones; of equal languages the first by name wins. Each row is predicted by itself,
    repeated ones alike; other columns are not read, an empty table gives an empty result. All pieces of small letters of the
    vocabulary count, and words of any length are scored whole, all their segmentations summed.
    """
    held_out = F.lit(False) if held_out is None else held_out
    model = learn(docs, read_pieces(pieces), ~held_out, id_col, text_col, lang_col, training_docs, rounds)
    rows = docs.select(id_in(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if model is None:
        return rows.select(id_out("id").alias(id_col), "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in slices(batches, "text"):
            langs, scores = zip(*scorer.texts(batch.column("text").to_pylist()), strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(run, "id long, held_out boolean, lang_pred string, score double").select(id_out("id").alias(id_col), "held_out", "lang_pred", "score")
