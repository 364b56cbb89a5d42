"""The operators on a few rows by the plainest means."""

import hashlib


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def by_id(rows):
    """Rows with an id in order; texts as bytes."""
    return sorted((i, (t or "").encode()) for i, t in rows if i is not None)


def windows(rows, width=13):
    """{(id, text): (words, removed, kept text)}"""
    known, first = by_id(rows), {}
    for i, t in known:
        w = t.split()
        for k in range(len(w) - width + 1):
            first.setdefault(tuple(w[k : k + width]), i)
    out = {}
    for i, t in ((i, (t or "").encode()) for i, t in rows):
        w = t.split()
        gone = [False] * len(w)
        for k in range(len(w) - width + 1 if i is not None else 0):
            if first[tuple(w[k : k + width])] < i:
                gone[k : k + width] = [True] * width
        out[i, t] = len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g)
    return out


def strings(rows, length=100):
    seen, out = set(), {}
    for i, t in by_id(rows):
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            s = t[k : k + length]
            if s in seen:
                gone[k : k + length] = b"\1" * length
            seen.add(s)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.setdefault((i, t), []).append((len(t), sum(gone), spans, bytes(x for x, g in zip(t, gone) if not g)))
    return out


def line_key(line):
    return line.strip(b" \t\n\x0b\x0c\r").lower()


def lines(rows, min_chars=20, min_docs=3):
    low = float("-inf")
    holders = {}
    every = [(low if i is None else i, (t or "").encode()) for i, t in rows]
    for i, t in every:
        for k in {line_key(x) for x in t.split(b"\n")}:
            if len(k.decode()) >= min_chars:
                holders.setdefault(k, []).append(i)
    out = {}
    for i, t in every:
        own = t.split(b"\n")
        stay = [x for x in own if len(h := holders.get(line_key(x), [])) < min_docs or max(h) == i]
        out[None if i == low else i, t] = len(own), len(own) - len(stay), b"\n".join(stay)
    return out


def shingles(text, words):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()


def similar(rows, words, percent):
    """{id: smallest id reached} of rows with an id."""
    sets = [(i, shingles(t, words)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in sets:
        for j, b in sets:
            if j < i and a and b and 100 * len(a & b) >= percent * len(a | b):
                a_root, b_root = find(i), find(j)
                root[max(a_root, b_root)] = min(a_root, b_root)
    return {i: find(i) for i in root}


def substring_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)
