"""Plain Python that several test modules hold the operators against."""

import re
from collections import Counter

from filingloom.llm.jaccard import shingles

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGES = [(3, "a b c d e f", "x"), (3, "a b c d e f", "x"), (None, "a b c d e f", "y"), (7, "a b c d e f", "z"), (8, None, "z"), (9, "", None), (9, "zz yy xx ww vv uu", "q"), (10, "zz yy xx ww vv uu", "q")]


def plain_measures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(x in lines[:i] for i, x in enumerate(lines)), len(repeated),
            len(lines), len(re.findall("[A-Za-z]", text)), len(re.findall("[A-Z]", text)))


def closest(rows, k, num, den):
    """doc_id -> (set size, smallest id reachable), by comparing all pairs."""
    sets = {i: set(shingles(t, k).tolist()) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if den * common >= num * (len(sets[a]) + len(sets[b]) - common):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def family(rng, n, words, edits):
    """Texts that differ from one another by a few words each, as chains of copies do."""
    base = [f"w{rng.randrange(400)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(rng.choice(out) if out and rng.random() < 0.5 else base)
        for _ in range(rng.randrange(edits + 1)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(50)}"
        out.append(own)
    return [" ".join(t) for t in out]


def kept_lines(rows, least):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    holders = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            holders.setdefault(key(x), set()).add(i)
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least or len(holders[key(x)]) < 2 or min(holders[key(x)]) == i]
        out.setdefault(i, []).append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return {i: sorted(v) for i, v in out.items()}
