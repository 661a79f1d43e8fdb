"""Plain re-computations of the operators on small data."""

import hashlib
import math
import re
import zlib
from collections import Counter

LOWER = {i: i + 32 for i in range(65, 91)}


def words(text, lower=False):
    text = (text or "").translate(LOWER) if lower else (text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]


def repeated_words(rows, window=20):
    """rows (doc_id, text) -> list of (doc_id, n_words, n_removed, sha)."""
    first, where = {}, []
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            first[k] = min(first.get(k, (d, i)), (d, i))
    for d, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < (d, i):
                gone[i:i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        where.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(where)


def repeated_bytes(rows, window=100):
    first, out = {}, []
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - window + 1):
            k = b[i:i + window]
            first[k] = min(first.get(k, (d, i)), (d, i))
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if first[b[i:i + window]] < (d, i):
                gone[i:i + window] = b"\1" * window
        spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def shingles(text, k=5):
    w = words(text, True)
    if len(w) >= k:
        return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
    return {tuple(w)} if w else set()


def near_dups(rows):
    """doc_id -> smallest doc_id reachable over links."""
    sets = {}
    for d, t in rows:
        sets.setdefault(d, []).append(shingles(t))
    inv, count = {}, Counter()
    flat = [(d, s) for d, ss in sets.items() for s in ss]
    for n, (_, s) in enumerate(flat):
        for x in s:
            for m in inv.setdefault(x, []):
                count[m, n] += 1
            inv[x].append(n)
    top = {d: d for d in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x
    for (m, n), c in count.items():
        (a, s), (b, t) = flat[m], flat[n]
        if 100 * c >= 75 * (len(s) + len(t) - c):
            x, y = find(a), find(b)
            top[max(x, y)] = min(x, y)
    return {d: find(d) for d in sets}


def leaks(docs, items):
    """{(doc_id, item_id): best similarity, start} of item-sized windows."""
    grams = {}
    df = Counter()
    for k, t in items:
        w = words(t, True)
        g = [tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))] if w else []
        if g:
            grams[k] = (len(w), g)
            df.update(set(g))
    weight = lambda x: round(64 / (1 + math.log(df[x]))) if df[x] else 64       # noqa: E731
    out = {}
    for d, t in docs:
        w = words(t, True)
        for k, (n, g) in grams.items():
            size = min(5, n)
            own = [tuple(w[i:i + size]) for i in range(len(w) - size + 1)]
            best = (0.0, 0)
            ci = Counter(g)
            for s in range(max(1, len(own) - len(g) + 1)):
                cw = Counter(own[s:s + len(g)])
                if not cw.keys() & ci.keys():
                    continue
                both = set(cw) | set(ci)
                lo = sum(weight(x) * min(cw[x], ci[x]) for x in both)
                hi = sum(weight(x) * max(cw[x], ci[x]) for x in both)
                best = max(best, (lo / hi, -s))
            if best[0] >= 0.75:
                out[d, k] = (best[0], -best[1])
    return out


def base_scores(rows):
    """rows -> list of (doc_id, held_out, n_tokens, n_known, train_tokens, base)."""
    c = Counter()
    bucket = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10
    for d, t in rows:
        if bucket(d) != 0:
            c.update([*words(t, True), ""])
    n, v = sum(c.values()), len(c)
    den = math.log10(n + 0.1 * (v + 1))
    out = []
    for d, t in rows:
        w = [*words(t, True), ""]
        out.append((d, bucket(d) == 0, len(w), sum(c[x] > 0 for x in w), n, sum(math.log10(c[x] + 0.1) - den for x in w)))
    return out


def top_k(rows, k=20, every=20):
    vec = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        vec.append((i, [math.floor(64 * x) for x in v]))
    out = []
    for i, q in {i: min(v for j, v in vec if j == i) for i, _ in vec if i % every == 0}.items():
        best = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in vec if j != i)[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    return sorted(out)
