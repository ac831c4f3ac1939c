"""Plain-Python versions of the operators, for small inputs."""

from __future__ import annotations

import itertools
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def quality(rows, min_docs, max_share, min_left, min_words=50, max_repeat=50):
    """``{(host, text): (figures...)}`` of operator 1; rows are (doc_id, host, text)."""
    first = {}
    for i, host, text in rows:
        key = (host, text or "")
        if key not in first or first[key] is None or (i is not None and i < first[key]):
            first[key] = i if i is not None else first.get(key)
    norm = lambda line: " ".join(WORD.findall(line.lower()))
    held, carrier, hosts = Counter(), {}, Counter(h for h, _ in first)
    for (host, text), i in first.items():
        for line in {norm(x) for x in text.split("\n")} - {""}:
            held[host, line] += 1
            old = carrier.get((host, line))
            carrier[host, line] = i if old is None else old if i is None else min(i, old)
    often = {k for k, n in held.items() if n > max(min_docs, max_share * hosts[k[0]])}
    out = {}
    for (host, text), i in first.items():
        ws = WORD.findall(text)
        grams = defaultdict(list)
        for k in range(len(ws) - 2):
            grams[tuple(ws[k : k + 3])].append(k)
        covered = {k + d for at in grams.values() if len(at) > 1 for k in at for d in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        gone = [x for x in text.split("\n") if (host, norm(x)) in often and carrier[host, norm(x)] != i]
        removed = sum(len(WORD.findall(x)) for x in gone)
        failed = len(ws) < min_words or 100 * len(covered) > max_repeat * len(ws)
        out[host, text] = (
            len(ws), sum(map(len, ws)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            len(covered), removed, failed, not failed and len(ws) - removed >= min_left * len(ws),
            "\n".join(x for x in text.split("\n") if x not in gone),
        )
    return out


def bag(text):
    ws = WORD.findall((text or "").lower())
    if not ws:
        return Counter()
    return Counter(tuple(ws[k : k + 5]) for k in range(len(ws) - 4)) if len(ws) >= 5 else Counter([tuple(ws)])


def jaccard(a, b):
    both = sum((a & b).values())
    either = sum(a.values()) + sum(b.values()) - both
    return both / either if either else 1.0


def classes(texts, least=0.8):
    """The class number of every text (null: empty): components of similar ones."""
    texts = [t or "" for t in texts]
    bags = {t: bag(t) for t in texts}
    up = {t: t for t in bags}

    def top(t):
        while up[t] != t:
            t = up[t]
        return t

    for a, b in itertools.combinations(bags, 2):
        if bags[a] and bags[b] and jaccard(bags[a], bags[b]) >= least:
            up[top(a)] = top(b)
    return [top(t) for t in texts]


KEY = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in KEY.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def merge(units, pairs, skip):
    """One unit by the plainest agenda: the best pair, again and again.
    ``pairs(a, b)`` gives (rank, id) or None, ``skip(start, middle, end)``."""
    spans = [(k, k + 1, u) for k, u in enumerate(units)]
    while True:
        best = None
        for k in range(len(spans) - 1):
            (s, m, a), (_, e, b) = spans[k], spans[k + 1]
            got = pairs(a, b)
            if got and not skip(s, m, e) and (best is None or got[0] < best[0]):
                best = (got[0], k, got[1])
        if best is None:
            return [u for _, _, u in spans]
        k = best[1]
        spans[k : k + 2] = [(spans[k][0], spans[k + 1][1], best[2])]


def segments(s):
    """All maximal segments by their definition: the best one (of equals the
    shortest), then the same to its left and right."""
    if not len(s):
        return []
    best, where = 0.0, None
    for a in range(len(s)):
        total = 0.0
        for b in range(a, len(s)):
            total += s[b]
            if total > best or where and total == best and b + 1 - a < where[1] - where[0]:
                best, where = total, (a, b + 1)
    if where is None:
        return []
    a, b = where
    return segments(s[:a]) + [(a, b, best)] + [(x + b, y + b, z) for x, y, z in segments(s[b:])]
