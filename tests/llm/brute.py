"""Plain versions of the contracts, for small tables."""

import base64
import collections
import hashlib
import re
import zlib

WORD = re.compile("[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(text or "")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def base_rules(text):
    w = words(text)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    n = collections.Counter(windows)
    hit = {j for i, x in enumerate(windows) if n[x] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
        len(hit), len(w) < 20 or 100 * len(hit) > 30 * len(w),
    )


def covered(texts, length):
    """For each sequence, which of its elements repeated windows cover."""
    n = collections.Counter(tuple(t[i : i + length]) for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        hit = set()
        for i in range(len(t) - length + 1):
            if n[tuple(t[i : i + length])] > 1:
                hit.update(range(i, i + length))
        out.append(hit)
    return out


def passages(docs, length):
    w = [words(t) for _, t in docs]
    return [
        (d, len(x), len(hit), hashlib.sha256(" ".join(y for i, y in enumerate(x) if i not in hit).encode()).hexdigest())
        for (d, _), x, hit in zip(docs, w, covered(w, length))
    ]


def strings(docs, length):
    raw = [(t or "").encode() for _, t in docs]
    out = []
    for (d, _), x, hit in zip(docs, raw, covered(raw, length)):
        left = bytes(b for i, b in enumerate(x) if i not in hit)
        out.append((d, len(x), len(hit), sum(i - 1 not in hit for i in hit), hashlib.sha256(left).hexdigest()))
    return out


def contamination(docs, items, span):
    windows = collections.defaultdict(set)
    for i, t in items:
        w = ITEM_WORD.findall(lowered(t))
        n = min(span, len(w))
        for j in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[j : j + n])].add("" if i is None else str(i))
    out = []
    for d, t in docs:
        w, hit, of = ITEM_WORD.findall(lowered(t)), set(), set()
        for n in {len(k) for k in windows}:
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in windows:
                    hit.update(range(j, j + n))
                    of |= windows[tuple(w[j : j + n])]
        out.append((d, len(w), len(hit), len(of), hashlib.sha256(",".join(sorted(of)).encode()).hexdigest(), bool(hit)))
    return out


def near(docs, n, percent):
    """doc_id, set size, component, kept; every pair is compared."""
    sets = []
    for _, t in docs:
        w = words(lowered(t))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    head = {d: d for d, _ in docs if d is not None}

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    for i, (a, _) in enumerate(docs):
        for j, (b, _) in enumerate(docs[:i]):
            if None in (a, b) or not sets[i] or not sets[j]:
                continue
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                x, y = find(a), find(b)
                head[max(x, y)] = min(x, y)
    return [
        (d, len(s), None if d is None else find(d), d is None or find(d) == d) for (d, _), s in zip(docs, sets)
    ]


def archives(pages):
    top = {}
    for i, _, h in pages:
        top[h or ""] = max(top.get(h or "", i), i)
    out = []
    for i, _, h in pages:
        raw = (h or "").encode()
        first = top[h or ""] == i
        out.append((
            i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
            "response" if first else "revisit", None if first else top[h or ""],
        ))
    return out


def crc(text):
    return zlib.crc32((text or "").encode())
