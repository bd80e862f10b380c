"""Plain versions of the operators, one document at a time, for comparison."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text, k=5):
    w = WORDS.findall(lower_ascii(text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(rows, percent):
    """``{doc_id: component}`` by comparing all documents that share a shingle."""
    sets = {d: shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            holders[g].append(d)
    shared = Counter()
    for ds in holders.values():
        for i, a in enumerate(ds):
            for b in ds[i + 1 :]:
                shared[a, b] += 1
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {d: root(d) for d in sets}, {d: len(s) for d, s in sets.items()}


def base_figures(text):
    text = text or ""
    words = WORDS.findall(text)
    lines, seen, dups = text.split("\n"), set(), 0
    for line in lines:
        if WORDS.search(line):
            dups += line in seen
            seen.add(line)
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    covered = {p for at in windows.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(covered)


def targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """``{source: target}`` by sharing the excess again until no source is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        if not free:
            return fixed
        out = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if out[s] > cap * sizes[s]]
        if not over:
            return fixed | out
        fixed |= {s: cap * sizes[s] for s in over}


def tokens(text):
    """Words, marks and single letters of scripts without blanks, in lower case, with a mark before each capital."""
    out, word = [], ""
    for c in text + " ":
        alone = "\u3000" <= c < "\u3100" or "\u3400" <= c < "\ua000"
        if (c.isalnum() or c == "_") and not alone:
            word += c
            continue
        for w in (word, "" if c.isspace() else c):
            if w:
                out += ["<cap>", w.lower()] if w[0].isupper() else [w.lower()]
        word = ""
    return out


def kneser_ney(pairs, vocabulary, discounts):
    """Scores a list of tokens by modified Kneser-Ney of ``pairs``, its own pairs taken off; ``vocabulary`` tokens can follow."""
    total, kinds, leaders = Counter(), defaultdict(Counter), Counter()
    for (a, b), n in pairs.items():
        total[a] += n
        kinds[a][min(n, 3)] += 1
        leaders[b] += 1
    high, low = discounts(np.array(list(pairs.values()))), discounts(np.array(list(leaders.values())))
    rest = min(sum(low[min(n, 3) - 1] for n in leaders.values()) / len(pairs), 1)

    def score(row):
        own = Counter(zip(row, row[1:]))
        left = {p: max(pairs[p] - n, 0) for p, n in own.items()}
        gone = [p for p, n in left.items() if n == 0]
        out = []
        for a, b in zip(row, row[1:]):
            k, types = leaders[b] - sum(p[1] == b for p in gone), len(pairs) - len(gone)
            p = ((k - low[min(k, 3) - 1] if k else 0) / types + rest / vocabulary) if types else 1 / vocabulary
            t = total[a] - sum(n for q, n in own.items() if q[0] == a)
            if t > 0:
                c = left[a, b]
                weight = min(sum(high[i - 1] * n for i, n in kinds[a].items()) / total[a], 1)
                p = (c - high[min(c, 3) - 1] if c else 0) / t + weight * p
            out.append(np.log(min(p, 1)))
        return out

    return score
