"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def base(text):
    text = text or ""
    w = words(text)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(w)
    return {
        "n_words": n,
        "word_chars": sum(map(len, w)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": n < 10 or 100 * len(covered) > 20 * n,
    }


def keepers(rows, limits):
    """Positions of the rows (id, text, host) that pass the quality rules."""
    norm = [[" ".join(WORD.findall(x)).lower() for x in (t or "").split("\n") if WORD.search(x)] for _, t, _ in rows]
    ids, first, hosts = defaultdict(set), {}, Counter(h for *_, h in rows)
    for (i, _, h), lines in zip(rows, norm, strict=True):
        for x in set(lines) if i is not None else ():
            ids[h, x].add(i)
            first[h, x] = min(i, first.get((h, x), i))
    out = []
    for k, ((i, t, h), lines) in enumerate(zip(rows, norm, strict=True)):
        n = len(words(t))
        gone = sum(
            len(x.split(" "))
            for x in lines
            if len(ids[h, x]) >= limits.min_docs
            and 100 * len(ids[h, x]) > limits.max_share_pct * hosts[h]
            and first.get((h, x)) != i
        )
        depleted = gone and (n - gone < limits.min_left_words or 100 * (n - gone) < limits.min_left_pct * n)
        if not base(t)["base_failed"] and not depleted:
            out.append(k)
    return out


def exact(rows):
    """id -> (keep_id, group_size, sha256) of rows (id, text) with distinct ids."""
    groups = defaultdict(list)
    for i, t in rows:
        groups["".join(words(t))].append((-len(t or ""), i is None, i))
    out = {}
    for text, members in groups.items():
        keep = min(members, key=lambda m: (m[0], m[1], m[2] or 0))[2]
        for *_, i in members:
            out[i] = (keep, len(members), hashlib.sha256(text.encode()).hexdigest())
    return out


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingle_set(text, width):
    w = words(fold(text))
    width = min(width, len(w))
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if w else frozenset()


def near(rows, width, pct=80):
    """id -> smallest id reachable, over rows (id, text) with distinct ids."""
    sets = {i: shingle_set(t, width) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= pct * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def repeats(texts, depth):
    """Per text: the bytes left and the number of removed runs."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + depth] for d in data for i in range(len(d) - depth + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - depth + 1):
            if seen[d[i : i + depth]] > 1:
                gone[i : i + depth] = [True] * depth
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((bytes(b for b, g in zip(d, gone, strict=True) if not g), runs))
    return out


def targets(sizes, weights=(5, 2, 1), budget=1.5, epochs=2):
    """Water filling by repeated sharing, over a dict source -> size."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), budget * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level >= epochs * sizes[s]}
        if not full:
            return target | {s: weight[s] * level for s in free}
        target |= {s: float(epochs * sizes[s]) for s in full}
        left -= sum(epochs * sizes[s] for s in full)
        free -= full
    return target
