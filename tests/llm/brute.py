"""Plain Python versions of the operators' results, over rows (id, text)."""

import base64
import hashlib
import re
import zlib

import numpy as np

LOWER = {c: c + 32 for c in range(65, 91)}


def blank_words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def shingles(text, k=5):
    w = blank_words((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def near_duplicates(rows, percent=75):
    """Sorted (doc_id, n_shingles, component_id); every pair of rows is compared."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    members = {}
    for i, (d, _) in enumerate(rows):
        members.setdefault(find(i), []).append(d)
    least = {r: min((d for d in ids if d is not None), default=None) for r, ids in members.items()}
    return [(d, len(sets[i]), least[find(i)] if sets[i] else d) for i, (d, _) in enumerate(rows)]


def substring_dedup(rows, window=50):
    first = {}
    for d, t in rows:
        w = blank_words(t)
        for i in range(len(w) - window + 1) if d is not None else ():
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, t in rows:
        w = blank_words(t)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1) if d is not None else ():
            if first[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def plain_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def contamination(rows, items, window=10):
    windows = {}
    for item, text in items:
        w = plain_words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for d, t in rows:
        w = plain_words(t)
        hit, found = [False] * len(w), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (got := windows.get(tuple(w[i : i + n]))) is not None:
                    hit[i : i + n] = [True] * n
                    found |= got
        names = sorted(str(x) for x in found if x is not None)
        out.append((d, len(w), sum(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), any(hit)))
    return out


def token_files(rows, library, end_id=2):
    out, start = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, end_id]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def round_trip(rows, library):
    out = []
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        out.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    return out


def warc(rows):
    groups = {}
    for page, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(page)
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        first = min((p for p in groups[raw] if p is not None), default=None)
        revisit = first is not None and page != first
        out.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", first if revisit else None))
    return out


def nearest(rows, k=10, every=100):
    """{query id: [(vec_id, distance)]} of rows (id, vector) that take part."""
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        out[int(ids[i])] = [(int(ids[j]), float(d[j])) for j in np.lexsort((ids, d)) if ids[j] != ids[i]][:k]
    return out
