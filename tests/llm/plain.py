"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

LAST = 2**63 - 1
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def order(doc_id):
    return LAST if doc_id is None else doc_id


def kept_words(rows, size=13):
    """(doc_id, words, True for each that goes) of every row."""
    least = {}
    for doc, text in rows:
        w = words(text)
        for i in range(len(w) - size + 1):
            key = tuple(w[i : i + size])
            least[key] = min(least.get(key, LAST), order(doc))
    out = []
    for doc, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if least[tuple(w[i : i + size])] < order(doc):
                gone[i : i + size] = [True] * size
        out.append((doc, w, gone))
    return out


def substring(rows, size=13):
    return [(d, len(w), sum(g), sha(" ".join(x for x, y in zip(w, g) if not y))) for d, w, g in kept_words(rows, size)]


def base_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    w = words(text)
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {k for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def targets(sizes):
    """Target words of each source, by sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, out, left = 1.5 * sum(sizes.values()), {}, set(names)
    while left:
        level = (total - sum(out.values())) / sum(weight[s] for s in left)
        over = [s for s in left if level * weight[s] > 2 * sizes[s]]
        if not over:
            out |= {s: level * weight[s] for s in left}
            break
        out |= {s: 2.0 * sizes[s] for s in over}
        left -= set(over)
    return out


def shingles(text):
    w = words((text or "").translate(LOWER))
    return set() if not w else {tuple(w)} if len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def groups(rows, link=85):
    """(doc_id, n_shingles, component's place among rows) with links of `link` % and over."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for i, found in enumerate(sets):
        common = Counter(j for s in found for j in where[s])
        for j, n in common.items():
            if 100 * n >= link * (len(found) + len(sets[j]) - n):
                parent[max(root(i), root(j))] = min(root(i), root(j))
        for s in found:
            where[s].append(i)
    return [(doc, len(sets[i]), root(i)) for i, (doc, _) in enumerate(rows)]


def near_duplicates(rows):
    found, least = groups(rows), {}
    for doc, _, root in found:
        least[root] = min(least.get(root, LAST), order(doc))
    return [(doc, n, None if least[root] == LAST else least[root]) for doc, n, root in found]
