"""Tokens, packing, fingerprints, languages, toxicity, licences and pages."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scrimlens.llm.bpe import Decoder, Encoder, Transducer, encode_documents, read_ranks
from scrimlens.llm.fingerprint import edit_distances, edited, fingerprint, likeness, neighbour_fingerprints
from scrimlens.llm.html_text import extract, main_text
from scrimlens.llm.language import Model, Pieces, _chances, identify
from scrimlens.llm.licences import TEMPLATES, Matcher, scan
from scrimlens.llm.packing import Harmonic, pack
from scrimlens.llm.toxicity import SYMBOLS, Characters, Finder, classes, drop_toxic, features, skeleton, toxicity
from tests.llm.brute import levenshtein
from tests.llm.conftest import AWKWARD

RANKS, WORDS, PIECES = (public_tokenizers.path(x) for x in ("byte_bpe_50k.tiktoken", "word_bpe_49k.json", "piece_bpe_32k.model"))
SIGNS = ["a", "b", "the", " ", "  ", "\n", "é", "日本", "!", "?", "0", "12", "\U0001f600", "́", "'s", "abab" * 5, "=", "====", "\t", "\xa0", "x" * 40]


def random_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 25))) for _ in range(n)]


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(RANKS)


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


# ---------------------------------------------------------------------------------------------------------- byte BPE


def test_encoder_equals_tiktoken(ranks, reference):
    encoder = Encoder(ranks, public_tokenizers.PATTERN)
    for text in [*random_texts(4000), "ab" * 20_000, " " * 5000 + "x", *(t or "" for _, t in AWKWARD)]:
        assert [int(i) for i in encoder.encode_text(text).split()] == reference.encode_ordinary(text)


def test_transducer_on_small_vocabularies():
    rng = random.Random(4)
    for _ in range(30):
        ranks = {bytes([c]): i for i, c in enumerate(b"abc")}
        tokens = list(ranks)
        while len(ranks) < 14:
            new = rng.choice(tokens) + rng.choice(tokens)
            if new not in ranks:
                ranks[new] = len(ranks)
                tokens.append(new)
        machine = Transducer(ranks)
        for _ in range(100):
            data = bytes(rng.choices(b"abc", k=rng.randint(0, 14)))
            want = [ranks[t] for t in machine.merged(data)] if data else []
            assert machine.encode(data) == want, (ranks, data)


def test_streaming_decoder_holds_split_characters(ranks, reference):
    decoder = Decoder(ranks)
    text = "日本語 😀 é plain"
    ids = reference.encode_ordinary(text)
    got = [decoder.feed([i]) for i in ids]
    assert "".join(t for _, t in got) + decoder.finish() == text
    assert b"".join(b for b, _ in got) == text.encode()
    decoder.start()
    assert decoder.feed(reference.encode_ordinary("é")[:1])[1] in ("", "é")


def test_encode_documents(awkward, empty, reference):
    got = encode_documents(awkward, RANKS, public_tokenizers.PATTERN).collect()
    assert len(got) == len(AWKWARD) and all(r.round_trip for r in got)
    by = {r.doc_id: r for r in got}
    for i, text in AWKWARD:
        ids = reference.encode_ordinary(text or "")
        assert by[i].n_tokens == len(ids)
        assert by[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert by[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert encode_documents(empty, RANKS, public_tokenizers.PATTERN).count() == 0


# ----------------------------------------------------------------------------------------------------------- packing


def test_harmonic_bins_hold_their_number():
    bins = Harmonic(2048, 0.01, 256)
    rng = random.Random(2)
    pieces = []
    for doc in range(500):
        n = rng.choice([1, 2, 300, 1024, 2047, 2048, 2049, 5000, rng.randint(1, 9000)])
        for done in bins.add(doc, n):
            assert sum(p[2] for p in done) <= 2048
            assert len(done) == 2048 // max(p[2] for p in done)
            pieces += done
    for done in bins.rest():
        size = sum(p[2] for p in done)
        assert size & (size - 1) == 0
        pieces += done
    for doc in range(500):
        mine = sorted(p[1:] for p in pieces if p[0] == doc)
        assert mine[0][0] == 0 and all(a + b == c for (a, b), (c, _) in zip(mine, mine[1:], strict=False))


def test_chunks_encoded_together_have_their_own_ids():
    """More than one line of chunks, with markers, white space and rare signs among them, as encoded one by one."""
    from scrimlens.llm import packing

    chunks = packing.Chunks(WORDS)
    odd = ["<|endoftext|>", "a<|startoftext|>b<|startoftext|>", "<|ENDOFTEXT|>", "\t", "\u00a0", "\ud55c\uad6d", "e\u0301", "\U0001f600x", "can't", "12,5", "..."]
    words = [f"{a}{b}{n}" for a in ("ab", "Zuerst", "na\u00efve", "x-") for b in ("", "ing", "'s") for n in range(60)]
    for asked in (words, words + odd, odd + words, odd, [], ["one"]):
        for tokenizer in (chunks.tokenizer, chunks.plain):
            want = [np.array(tokenizer.encode(c, add_special_tokens=False).ids, np.uint32).tobytes() for c in asked]
            assert chunks.ids_of(tokenizer, asked) == want
    calls = []
    tokenizer = chunks.tokenizer

    class Counted:
        def encode_batch_fast(self, texts, **options):
            calls.append(len(texts))
            return tokenizer.encode_batch_fast(texts, **options)

    assert len(chunks.ids_of(Counted(), words)) == 720 and calls == [2]


def check_packing(rows, got):
    tokenizer = Tokenizer.from_file(WORDS)
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in rows}
    for i, want in ids.items():
        mine = sorted((r for r in got if r.doc_id == i), key=lambda r: r.start)
        assert sum(r.length for r in mine) == len(want) and mine[0].start == 0
        for r in mine:
            assert r.doc_tokens == len(want)
            assert r.ids_crc32 == zlib.crc32(np.array(want[r.start : r.start + r.length], "<u4").tobytes())
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    padding = 0
    for parts in sequences.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + b == c for (a, b), (c, _) in zip(parts, parts[1:], strict=False))
        size = sum(p[1] for p in parts)
        assert size <= 2048
        padding += 0 if size & (size - 1) == 0 else 2048 - size
    return padding / max(1, sum(map(len, ids.values())))


def test_pack(awkward, table, empty):
    rows = [(i, t) for i, t in AWKWARD if i != 11]
    assert check_packing(rows, pack(table(rows), WORDS).collect()) < 0.05
    assert sum(r.length for r in pack(awkward, WORDS).where("doc_id = 11").collect()) == 4
    odd = list(enumerate(random_texts(300, 9) + ["İstanbul, Σίσυφος.", "don't, stop... now,.", "<|startoftext|> a"]))
    check_packing(odd, pack(table(odd), WORDS).collect())
    assert pack(empty, WORDS).count() == 0


def test_chunks_are_remembered_dropped_and_told_apart(monkeypatch):
    """Few places to remember, and first hashes that collide all the time: the ids stay those of the library."""
    from scrimlens.llm import packing

    library = Tokenizer.from_file(WORDS)
    texts = [*random_texts(400, 5), "a  b\n\nc", None, "", "don't, stop... now,.", "Word word, WORD. wörd", "end"]
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    monkeypatch.setattr(packing, "REMEMBERED", 40)
    for coarse in (False, True):
        if coarse:
            hashes = packing.byte_hashes
            monkeypatch.setattr(packing, "byte_hashes", lambda data, starts, lane=0: hashes(data, starts, lane) % np.uint64(3 if lane == 0 else 1 << 60))
        chunks = packing.Chunks(WORDS)
        for size in (7, 50, len(texts)):
            got = [d.tolist() for i in range(0, len(texts), size) for d in chunks.encode(pa.array(texts[i : i + size], pa.string()))]
            assert got == want
    assert len(chunks.number) <= 3


def test_markers_in_a_text_get_their_ids(table):
    marks = ["hello <|endoftext|> world", "<|startoftext|>", "a<|endoftext|>b|c", "<|ENDOFTEXT|> <|end of text|>", "x <| y |> z", "<|endoftext|>" * 300]
    rows = list(enumerate([*marks, *(m + " " + t for m, t in zip(marks * 9, random_texts(50, 3)))]))
    got = pack(table(rows), WORDS).collect()
    check_packing(rows, got)
    assert next(r.doc_tokens for r in got if r.doc_id == 0) == 4


# ------------------------------------------------------------------------------------------------------- fingerprints


def test_edit_distances():
    rng = random.Random(5)
    words = ["".join(rng.choices("ABC", k=rng.choice([0, 1, 7, 40, 63, 64]))) for _ in range(200)]
    other = ["".join(rng.choices("ABCD", k=rng.choice([0, 1, 7, 40, 63, 64]))) for _ in range(200)]
    assert edit_distances(words, other).tolist() == [levenshtein(a, b) for a, b in zip(words, other, strict=True)]


def test_fingerprints_follow_content():
    rng = random.Random(6)
    text = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(800))
    near, far = text[:2000] + "XY" + text[2000:], " ".join("".join(rng.choices("ijklmnop", k=5)) for _ in range(800))
    a, b, c = fingerprint(text), fingerprint(near), fingerprint(far)
    scores = likeness([a, a, a], [b, c, a])
    assert scores[0] > 0.9 and scores[1] < 0.3 and scores[2] == 1
    assert fingerprint("") == fingerprint("") == "4::"


def test_neighbour_fingerprints(spark, awkward, table, empty):
    rows = [(i, t or "") for i, t in AWKWARD if i is not None and i != 11] + [(100 + 7 * i, t) for i, t in enumerate(random_texts(60, 3))]
    got = {r.doc_id: r for r in neighbour_fingerprints(table(rows)).collect()}
    ordered = sorted(rows)
    for k, (i, text) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        change = edited(text, following)
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(change.encode()).hexdigest()
        assert got[i].fingerprint == fingerprint(text) and got[i].edited_fingerprint == fingerprint(change)
        assert got[i].near_next == likeness([fingerprint(text)], [fingerprint(following)])[0]
    assert neighbour_fingerprints(awkward).count() == len(AWKWARD)
    assert neighbour_fingerprints(table([(3, "alone")])).first().near_next == 1
    assert neighbour_fingerprints(empty).count() == 0


# ---------------------------------------------------------------------------------------------------------- languages


def test_forward_sums_all_segmentations():
    pieces = ["▁", "▁a", "▁ab", "a", "ab", "b", "ba", "bab"]
    counts = np.arange(1, 2 * len(pieces) + 1, dtype=float).reshape(len(pieces), 2)
    model = Model(pieces, ["x", "y"], _chances(counts))

    def total(word, k):
        if not word:
            return 1.0
        out = sum(model.chances[pieces.index(word[:n]), k] * total(word[n:], k) for n in range(1, 9) if word[:n] in pieces and n <= len(word))
        return out + (1e-9 * total(word[1:], k) if word[0] not in pieces else 0)

    words = ["▁abab", "▁b", "▁", "▁abq", "▁babba"]
    assert np.allclose(model.log_chances(words), [[np.log(total(w, k)) for k in (0, 1)] for w in words])
    expected = model.expected(words[:1], np.array([2.0]), 0)
    lengths = np.array([*map(len, pieces), 1])
    assert np.isclose((expected * lengths).sum(), 2 * len("▁abab"))
    assert Pieces(pieces).find(Pieces(pieces)._hashes(["ba", "zz"])).tolist() == [pieces.index("ba"), -1]


def test_long_words_over_the_whole_vocabulary():
    """All segmentations of words far longer than any piece, against exact fractions; pieces of any length count."""
    from fractions import Fraction

    from scrimlens.llm.language import read_pieces

    pieces = read_pieces(PIECES)
    assert max(map(len, pieces)) == 16 and "▁information" in pieces
    rng = np.random.default_rng(2)
    model = Model(pieces, ["x", "y"], _chances(rng.integers(0, 50, (len(pieces), 2)).astype(float)))
    place = {p: i for i, p in enumerate(pieces)}
    words = ["▁" + "informationtranslationbusinesssomething" * 2, "▁" + "ab" * 40, "▁zażółćгёпт" * 8, "▁a", "▁" + "日本" * 60, "▁donaudampfschifffahrtsgesellschaft"]
    for word, got in zip(words, model.log_chances(words), strict=True):
        for k in (0, 1):
            ahead = [Fraction(1)] + [Fraction(0)] * len(word)
            for end in range(1, len(word) + 1):
                for begin in range(max(0, end - 16), end):
                    at = place.get(word[begin:end])
                    if at is not None or end == begin + 1:
                        ahead[end] += ahead[begin] * Fraction(float(model.chances[-1 if at is None else at, k]))
            want = np.log(float(ahead[-1])) if float(ahead[-1]) > 1e-300 else ahead[-1].numerator.bit_length() * np.log(2) - ahead[-1].denominator.bit_length() * np.log(2)
            assert abs(got[k] - want) < (1e-9 * abs(want) if float(ahead[-1]) > 1e-300 else 1.5), (word, k)


def test_identify(spark, table, awkward, empty):
    talk = {"en": "the of and that with from this were which their", "de": "der die und nicht mit sich auf eine wird auch", "fr": "le les des une que pour dans est pas avec"}
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choices(talk[lang].split(), k=12)), lang) for i, lang in enumerate(sorted(talk) * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    got = {r.doc_id: r for r in identify(docs, PIECES, held_out).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in got)
    assert all(got[i].lang_pred == lang and 0 <= got[i].score <= 1 for i, _, lang in rows)
    odd = identify(awkward, PIECES).collect()
    assert len(odd) == len(AWKWARD)
    assert {r.lang_pred for r in odd if r.doc_id in (2, 3, 4, 13, 14)} == {"und"}
    assert {r.lang_pred for r in odd if r.doc_id not in (2, 3, 4, 13, 14)} == {"en"}
    assert identify(empty, PIECES).count() == 0


# ----------------------------------------------------------------------------------------------------------- toxicity


def characters(text):
    c = classes(text)
    c = c[np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])]
    codes, counts = np.unique((c[:-2] * SYMBOLS + c[1:-1]) * SYMBOLS + c[2:], return_counts=True)
    return Characters(codes, counts)


def test_restore_disguised_words():
    model = characters("  " + "the moron and the idiot are a worthless stupid clown of a loser in the trash " * 20)
    for disguised, word in [("1d10t", "idiot"), ("m0r0n", "moron"), ("i d i o t", "idiot"), ("s.t.u.p.i.d", "stupid"), ("cl0wnnn", "clown"), ("tr@$h", "trash")]:
        assert model.restore(disguised) == word


LEXICON = "moron idiot worthless stupid dumbass clown loser trash".split()
DISGUISES = [
    ("dumba$$", "dumbass"), ("idi07", "idiot"), ("idio+", "idiot"), ("iidiot", "idiot"), ("idiioott", "idiot"), ("i..d..i..o..t", "idiot"),
    ("i - d - i - o - t", "idiot"), ("i  d  i  o  t", "idiot"), ("id iot", "idiot"), ("i.diot", "idiot"), ("i_d iot", "idiot"), ("mor*on", "moron"),
    ("i    d    i    o    t", "idiot"), ("i/d/i/o/t", "idiot"), ("id\u200biot", "idiot"), ("i\u200bd\u200bi\u200bo\u200bt", "idiot"), ("m0r0n", "moron"),
    ("x" * 70 + " 1d10t", "idiot"), ("idi" + "o" * 400 + "t", "idiot"), ("s" * 90 + "tupid", "stupid"), ("STU.P1D", "stupid"), ("wor th less", "worthless")]


@pytest.fixture(scope="module")
def finder():
    model = characters("  " + "the moron and the idiot are a worthless stupid dumbass clown of a loser in the trash " * 20)
    return Finder(model, frozenset(f for w in LEXICON for f in features(w)))


def test_words_behind_wider_disguises(finder):
    for disguised, word in DISGUISES:
        texts = [disguised, "", f"and the {disguised} in the trash", f"and {disguised}"]
        found = finder.words(texts)
        assert [word in f for f in found] == [True, False, True, True], disguised
        assert "trash" in found[2] or word == "trash"
    plain = finder.words(["clown of a loser!", "the cl0wn's", "a lotion, closer to it", "the\nid\niot"])
    assert [w & set(LEXICON) for w in plain] == [{"clown", "loser"}, {"clown"}, set(), set()] and plain[0] == {"clown", "loser"}


def test_skeleton_is_kept_by_every_path(finder):
    """What the decoder writes has the skeleton of what it read, so nothing that it could find is passed over."""
    rng = random.Random(4)
    for _ in range(400):
        text = "".join(rng.choices([*"idotmrnabcsu", "0", "1", "$", "!", "|", " ", "  ", ".", "-", "oo", "\u200b"], k=rng.randint(0, 14)))
        assert skeleton(finder.characters.restore(text)) == skeleton(text)


def test_viterbi_equals_all_paths(finder):
    """The lattice of short stretches written out path by path."""
    from itertools import product

    from scrimlens.llm import toxicity as t

    model, rng = finder.characters, random.Random(6)

    def choices(units, i):
        u, left, right = units[i], units[i - 1] if i else " ", units[i + 1] if i + 1 < len(units) else " "
        if u in t._LEET:
            alone = left == " " and right == " " and len(units) > 1
            return [(x, t.SIGN_READ) for x in t._LEET[u]] + [(u, t.SIGN_KEPT_ALONE if alone else t.SIGN_KEPT)]
        if u == " ":
            return [(" ", 0.0), ("", t.BLANKS_INSIDE)]
        many = right == u or i > 1 and units[i - 2] == u
        return [(u, t.AGAIN if left == u else 0.0)] + ([("", t.MANY if many else t.TWICE)] if left == u else [])

    for _ in range(150):
        raw = rng.choices("idotms1$ ", k=rng.randint(1, 7))
        units = [u for i, u in enumerate(raw) if not (u == " " and i and raw[i - 1] == " ")]
        best = {}
        for path in product(*(choices(units, i) for i in range(len(units)))):
            a, b, score = 0, 0, 0.0
            for letter, cost in path:
                score += cost
                if letter:
                    c = int(classes(letter)[0]) if letter.isalpha() else 0
                    score += float(model.log[a, b, c]) if c or b else -1.0
                    a, b = (b, c) if c or b else (a, b)
            score += float(model.log[a, b, 0])
            text = "".join(x for x, _ in path)
            best[text] = max(best.get(text, -1e9), score)
        got = model.restore("".join(units))
        assert best[got] >= max(best.values()) - 1e-4, (units, got)


def toxic_rows():
    rng = random.Random(10)
    plain = [f"calm{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(400):
        words, bad = rng.choices(plain, k=30), i % 4 == 0
        if bad:
            words[rng.randrange(30)] = rng.choice(["grumblewort", "snarkleweed"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity(spark, table, awkward, empty):
    rows, labels = toxic_rows()
    rows += [(900, "what a gr1mbl3w0rt"), (901, "you g r u m b l e w o r t"), (902, "calm1 calm2"), (903, None), (904, "")]
    marks = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity(table(rows), marks).collect()}
    assert len(got) == len(rows)
    for i, bad in labels:
        assert got[i].predicted == bad and got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
    assert got[901].predicted == 1 and got[902].predicted == 0
    assert got[903].score == got[904].score == 0
    kept = drop_toxic(table(rows), marks)
    assert {r.doc_id for r in kept.collect()}.isdisjoint({i for i, bad in labels if bad}) and kept.columns == table(rows).columns
    assert toxicity(awkward, marks).count() == len(AWKWARD)
    assert {r.score for r in toxicity(awkward, marks.limit(0)).collect()} == {0.0}
    assert toxicity(empty, marks).count() == 0


# ----------------------------------------------------------------------------------------------------------- licences


def test_licences_and_inheritance(spark, table, awkward, empty):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [
        (1, "a/LICENSE", mit), (2, "a/b/c/code", "some words\nand more"), (3, "a/b/COPYING", gpl), (4, "a/x", None), (5, "z/y", "nothing here"),
        (6, "a/b/c/own", "text first\nLicensed under CC BY-NC 4.0.\nand a tail of many other words that follow it in the file"),
        (7, None, gpl), (8, "top", "words"), (9, "a/b/OTHER", mit), (10, "a/b/deep/er/f", "")]
    filler = [(100 + i, f"z/{i}", "other plain words " * 5) for i in range(60)]
    docs = spark.createDataFrame(rows + filler, "doc_id long, path string, text string")
    got = {r.doc_id: r for r in scan(docs).collect()}
    assert len(got) == len(rows) + len(filler)
    assert got[1].own_licence == "MIT" and got[1].is_licence_file and got[1].own_score == 1
    assert (got[2].licence, got[2].inherited_from) == ("GPL-3.0", "a/b")  # of equal cosines the smaller id
    assert (got[4].licence, got[4].inherited_from) == ("MIT", "a")
    assert got[6].own_licence == "CC-BY-NC-4.0" and not got[6].is_licence_file and got[6].inherited_from is None
    assert got[7].licence == "GPL-3.0" and got[5].licence is None and got[8].licence is None
    assert got[10].inherited_from == "a/b"
    assert scan(awkward, path="source").count() == len(AWKWARD)
    assert scan(empty, path="source").count() == 0


def test_light_lines_cannot_match():
    matcher = Matcher({None: 1000, "the": 900, "license": 20, "under": 300}, 0.6)
    rng = random.Random(12)
    light = sorted(set(matcher.weight) - matcher.heavy)
    for _ in range(300):
        assert matcher.line(rng.choices(light, k=rng.randint(1, 12))) is None


def test_licences_among_other_words():
    """A statement inside a long line, at its end, or over a line break."""
    matcher = Matcher({None: 1000, "the": 900, "this": 600, "work": 80, "free": 60, "software": 40, "by": 500, "under": 300, "version": 30}, 0.6)
    rng = random.Random(14)
    for name, texts in TEMPLATES.items():
        for text in texts:
            for before, after in [(5, 0), (0, 10), (53, 0), (70, 90)]:
                line = " ".join([*rng.choices(["lorem", "ipsum", "dolor", "sit"], k=before), text, *rng.choices(["amet", "elit", "sed"], k=after)])
                assert matcher.text(line)[0] == name
            assert matcher.text("lorem ipsum " + text.replace(" ", "\n", 1) + " dolor sit amet")[0] == name
    got = matcher.text("Copyright (c) 2020 by Jane Doe and others. Licensed under the Apache License, Version 2.0.")
    assert got[:2] == ("Apache-2.0", 1.0)
    assert matcher.text("lorem ipsum dolor sit amet " * 30 + "under the sit")[0] is None


# -------------------------------------------------------------------------------------------------------------- pages

PAGE = """<html><head><title>no</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a>
<li><a href=/n>News</a></ul></nav><div id="cookie-notice">We use cookies on this site to make it better for all of you</div><article><h1>A &amp; B</h1>
<p><b>First <a href=x>linked</a>   words&nbsp;here.<br><p>Short.</p><script>var t="</p>";</script><aside>See also</aside><div class="ad">Buy now</div>
<form><label>Mail</label><button>Send</button></form><section id="comments"><article><p>I like this article very much indeed</p></article></section>
</article><div class="sidebar"><p>Some long text that is about something else entirely and has many words</p></div><footer>&copy; me</footer>"""


def test_main_text():
    assert main_text(PAGE) == "A & B\nFirst linked words here.\nShort."
    assert main_text("") == main_text("<script>x") == main_text("<nav><a>a</a></nav>") == ""
    plain = "<ul><li><a href=a>Home</a></li><li><a href=b>About</a></li></ul><p>" + "word " * 50 + "<p>" + "more " * 40 + "</p><div>tail of a page</div>"
    assert main_text(plain).startswith("word word") and "Home" not in main_text(plain)
    assert main_text("<article><p>cut &am").endswith("cut &am")


def test_main_text_in_wrappers():
    inner = "<h1>Title</h1><p>" + "word " * 50 + "</p><p>" + "more " * 40 + "</p>"
    want = "Title\n" + ("word " * 50).strip() + "\n" + ("more " * 40).strip()
    around = '<nav><a href=a>Home</a></nav>%s<div class="sidebar"><p>' + "aside " * 30 + "</p></div><footer>me</footer>"
    for wrapper in ['div class="content-sidebar-wrap"', 'div class="has-sidebar"', 'div id="page" class="no-comments"', 'section class="search-results"', 'div class="post hidden-xs"', 'div class="comments-wrap"']:
        close = "</" + wrapper.split()[0] + ">"
        for tag in ("article", "main"):
            assert main_text(around % f"<{wrapper}><{tag}>{inner}</{tag}>{close}") == want, (wrapper, tag)
    for wrapper in ["content-sidebar-wrap", "has-sidebar", "post hidden-xs"]:
        assert "word word" in main_text(around % f'<div class="{wrapper}">{inner}</div>') and "aside" not in main_text(around % f'<div class="{wrapper}">{inner}</div>')
    assert "word word" in main_text(f'<div class="search-results">{inner}</div>')
    comments = '<section id="comments">' + "<article><p>" + "reply " * 60 + "</p></article>" + "<article><p>so it is</p></article></section>"
    assert main_text(f"<div>{inner}</div>{comments}").endswith("more") and main_text(f"<article>{inner}</article>{comments}") == want
    assert main_text("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> be so.</p></article>") == "Let x=2 be so."


def test_extract(spark):
    rows = [(1, "u", PAGE, "x"), (2, None, None, "x"), (2, "v", "", "x"), (None, "w", "<p>" + "long " * 200_000, "x")]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string, id string")).collect()
    assert len(got) == 4
    by = {r.url: r for r in got}
    assert by["u"].n_chars == len(by["u"].text) and by[None].text == "" and by["w"].n_chars == 999_999 and by["w"].page_id is None
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_pages_that_close_nothing_take_linear_time():
    import time

    from scrimlens.llm.html_text import text_blocks

    def seconds(html):
        began = time.process_time()
        text_blocks(html)
        return time.process_time() - began

    for piece in ("<div>x", "<div class=ad><article>x y", "<section id=main-nav><p>a</q>"):
        small, large = seconds(piece * 3000), seconds(piece * 24_000)
        assert large < 30 * max(small, 0.01), piece  # eight times the text; sixty-four times if each block looked at its whole path


def test_a_worker_remembers_for_one_operator_at_a_time():
    """What a worker keeps for packing goes when it begins a task of another operator, and is made anew afterwards."""
    import gc
    import weakref

    import pyarrow as pa
    import public_tokenizers

    from scrimlens.llm import common, packing, substrings

    path = public_tokenizers.path("word_bpe_49k.json")
    chunks = packing.chunks_of(path)
    assert packing.chunks_of(path) is chunks
    kept = weakref.ref(chunks)
    del chunks
    substrings._shared_anchors(pa.Table.from_arrays(
        [pa.array([0]), pa.array([0]), pa.array([1]), pa.array([bytes(8)]), pa.array([b""]), pa.array([None], pa.binary()), pa.array([None], pa.binary())],
        schema=substrings._HASHES))
    gc.collect()
    assert kept() is None
    assert packing.chunks_of(path) is not None and len(common._REMEMBERED) == 1
