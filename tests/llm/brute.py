"""The contracts of the corpus operators by brute force, for small tables."""

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, size=5):
    words = WORD.findall(fold(text))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def near_classes(rows, size=5, share=75, of=100):
    """Rows as (id, text) with distinct ids: id -> (set size, class)."""
    sets = {i: shingles(t, size) for i, t in rows}
    top = {i: i for i in sets}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if of * both >= share * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((root(a), root(b)))
                    top[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def repeats(rows, window=20):
    """Rows as (id, text) in order: id -> (words, removed, sha of the kept words)."""
    seen, out = set(), {}
    for i, text in rows:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for a in range(len(words) - window + 1):
            run = tuple(words[a : a + window])
            if run in seen:
                gone[a : a + window] = [True] * window
            seen.add(run)
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[i] = len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()
    return out


def same_texts(rows, keep=max):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    return {i: (keep(groups[t or ""]), len(groups[t or ""])) for i, t in rows}


def levenshtein(a, b):
    line = list(range(len(b) + 1))
    for i, x in enumerate(a):
        following = [i + 1]
        for j, y in enumerate(b):
            following.append(min(line[j + 1] + 1, following[j] + 1, line[j] + (x != y)))
        line = following
    return line[-1]
