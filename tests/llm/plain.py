"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
RUN = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def components(ids, links):
    up = {i: i for i in ids}

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {i: top(i) for i in ids}


def shingles(text, words):
    own = RUN.findall(ascii_lower(text or ""))
    return {tuple(own[i : i + words]) for i in range(max(1, len(own) - words + 1))} if own else set()


def near_duplicates(docs, words, percent):
    """docs: {id: text}; {id: (set size, component)}"""
    sets = {d: shingles(t, words) for d, t in docs.items()}
    places, links = {}, []
    for d, own in sets.items():
        shared = Counter()
        for s in own:
            for e in places.setdefault(s, []):
                shared[e] += 1
            places[s].append(d)
        links += [(d, e) for e, n in shared.items() if 100 * n >= percent * (len(own) + len(sets[e]) - n)]
    root = components(sets, links)
    return {d: (len(sets[d]), root[d]) for d in sets}


def contamination(docs, items, window=10):
    """docs and items: {id: text}; {id: (words, hit words, items, digest)}"""
    windows = {}
    for i, text in items.items():
        own = WORD.findall(ascii_lower(text or ""))
        for s in range(max(1, len(own) - window + 1)) if own else ():
            windows.setdefault(tuple(own[s : s + window]), set()).add(i)
    sizes = {len(w) for w in windows}
    out = {}
    for d, text in docs.items():
        own, hit, found = WORD.findall(ascii_lower(text or "")), set(), set()
        for n in sizes:
            for s in range(len(own) - n + 1):
                if (w := tuple(own[s : s + n])) in windows:
                    hit |= set(range(s, s + n))
                    found |= windows[w]
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out[d] = (len(own), len(hit), len(found), digest)
    return out


def targets(sizes, weights=(1, 2, 3), most=3):
    """sizes: [(source, size)]; {source: target}, by sharing the excess again and again."""
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    size, total = dict(order), sum(n for _, n in order)
    full = set()
    while True:
        rest = total - sum(most * size[s] for s in full)
        open_ = [s for s in size if s not in full]
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > most * size[s] + 1e-9}
        if not over:
            return {s: float(most * size[s]) if s in full else share[s] for s in size}
        full |= over


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


def collocations(rows, least=100, top=2000):
    """rows: [(lang, text)]; sorted [(lang, rank, phrase, a, l, r, n, score)]"""
    counts = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", ascii_lower(text or "")):
            own = re.findall("[^ \t]+", piece)
            for k in range(1, 6):
                for i in range(len(own) - k + 1):
                    counts["und" if lang is None else lang][tuple(own[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        n = sum(x for p, x in f.items() if len(p) == 1)
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in frequent.items():
            for i in range(len(p)):
                for m in range(2, len(p) - i + 1):
                    if m < len(p):
                        longer[p[i : i + m]] = max(longer[p[i : i + m]], a)
        rated = []
        for p, a in frequent.items():
            if longer[p] < a:
                score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                rated.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(rated)[:top])]
    return sorted(out)


def alignment(docs, a_encode, a_bytes, b_encode, b_bytes):
    """docs: {id: text}; {id: (n_a, n_b, n_groups, n_links, n_best, count_sum, digest)}"""
    found, counts = {}, Counter()
    for d, text in docs.items():
        want = b" " + (text or "").encode()
        a, b = (a_encode(" " + text), b_encode(text)) if text else ([], [])
        parts = [[of[i] for i in ids] for ids, of in ((a, a_bytes), (b, b_bytes))]
        if not text or any(b"".join(p) != want for p in parts):
            continue
        ends = [_ends(p) for p in parts]
        listed, links, i, j = [], [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            x, y = ends[0].index(end, i) + 1, ends[1].index(end, j) + 1
            listed.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            links.append((a[x - 1], b[y - 1]))
            i, j = x, y
        counts.update(links)
        found[d] = len(a), len(b), links, hashlib.sha256(";".join(listed).encode()).hexdigest()
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    out = dict.fromkeys(docs, (0, 0, 0, 0, 0, 0, ""))
    for d, (n_a, n_b, links, digest) in found.items():
        out[d] = n_a, n_b, len(links), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), digest
    return out


def _ends(parts):
    out, total = [], 0
    for p in parts:
        total += len(p)
        out.append(total)
    return out


def blocks(sign, widths):
    """The blocks of a signature but one, lowest bits first."""
    sign, out = sign % 2**64, []
    for w in widths:
        out.append(sign % 2**w)
        sign >>= w
    return {(i, *out[:i], *out[i + 1 :]) for i in range(len(out))}
