"""Plain Python statements of the operators' results, for small tables."""
from __future__ import annotations

import hashlib
import random
import re

import xxhash

LAST = (1 << 63) - 1


def sha(b) -> str:
    return hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


def az(text) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def spark_words(text) -> list[str]:
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def simhash(text, shingle=4) -> int:
    w = spark_words(az(text))
    if not w:
        return 0
    grams = [" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(items: list[tuple], radius=4) -> list:
    """items (id, fingerprint) -> smallest id of each item's group."""
    root = list(range(len(items)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(items)):
        for j in range(i):
            if bin(items[i][1] ^ items[j][1]).count("1") <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(items):
        r = find(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return [least.get(find(i)) for i in range(len(items))]


def repeated_bytes(rows: list[tuple], span: int) -> list[tuple]:
    """(n_bytes, n_removed, n_spans, kept) by row; rows (id, text)."""
    bodies = [(LAST if d is None else d, (t or "").encode()) for d, t in rows]
    seen, removed = {}, {}

    def rank(x):                            # of one id, the smaller text hash is earlier
        h = xxhash.xxh64_intdigest(x[1], 42)
        return x[0], h - (1 << 64) if h >> 63 else h
    for key in sorted(set(bodies), key=rank):
        b, mark = key[1], bytearray(len(key[1]))
        for p in range(len(b) - span + 1):
            if seen.setdefault(b[p:p + span], (key, p)) != (key, p):
                mark[p:p + span] = b"\1" * span
        removed[key] = mark
    out = []
    for key in bodies:
        mark, b = removed[key], key[1]
        kept = bytes(x for x, m in zip(b, mark) if not m)
        out.append((len(b), sum(mark), sum(1 for p in range(len(b)) if mark[p] and not (p and mark[p - 1])), kept))
    return out


def deduplicated_lines(rows: list[tuple], run: int, words: int = 50) -> list[tuple]:
    """(n_lines, n_removed, n_runs, text) by row; rows (id, text), ids distinct."""
    seen, whole, out = {}, {}, {}
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0])):
        d, t = rows[i]
        lines = (t or "").split("\n")
        at = [j for j, x in enumerate(lines) if spark_words(x)]
        gone = set(range(len(at))) if whole.setdefault(t or "", i) != i else set()
        for k in range(1, run + 1):
            for s in range(len(at) - k + 1):
                w = tuple(lines[j] for j in at[s:s + k])
                if k < run and sum(len(spark_words(x)) for x in w) < words:
                    continue
                if seen.setdefault(w, (i, s)) != (i, s):
                    gone |= set(range(s, s + k))
        drop = {at[g] for g in gone}
        kept = t if not gone else "" if len(gone) == len(at) else "\n".join(x for j, x in enumerate(lines) if j not in drop)
        out[i] = (len(at), len(gone), sum(1 for g in gone if g - 1 not in gone), kept)
    return [out[i] for i in range(len(rows))]


def bench_words(text) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", az(text))


def contamination(docs: list, items: list[tuple], span=10) -> list[tuple]:
    """(n_words, n_hit, sorted item ids as strings) by text."""
    grams = {}
    for d, t in items:
        w = bench_words(t)
        m = min(span, len(w))
        for i in range(len(w) - m + 1 if w else 0):
            grams.setdefault(tuple(w[i:i + m]), set()).add(d)
    out = []
    for t in docs:
        w, hit, ids = bench_words(t), set(), set()
        for m in {len(g) for g in grams}:
            for i in range(len(w) - m + 1):
                if tuple(w[i:i + m]) in grams:
                    hit |= set(range(i, i + m))
                    ids |= grams[tuple(w[i:i + m])]
        out.append((len(w), len(hit), sorted(str(x) for x in ids if x is not None)))
    return out


def texts(seed=1, n=60) -> list:
    """Hard texts: null, empty, blank, long, copies, near copies, shared lines and passages."""
    r = random.Random(seed)
    word = lambda: r.choice("the of Über naïve and ÉTÉ 日本 alpha Beta gamma x1 don't ½ run sun".split()) + r.choice(["", "a", "ing", "é"])
    line = lambda k: " ".join(word() for _ in range(k))
    shared = [line(12) for _ in range(6)]
    passage = line(40)
    out = [None, "", " \t\n\x0b ", "one", "\0\0", "a" * 700, "ab" * 400, "\n\n\n", "!!! ??? ###", "\x1c x\x85y　z"]
    while len(out) < n:
        kind = r.random()
        if kind < 0.2 and len(out) > 14:
            out.append(r.choice(out))
        elif kind < 0.5 and len(out) > 14 and (t := r.choice(out)):
            w = t.split(" ")
            w[r.randrange(len(w))] = word()
            out.append(" ".join(w))
        else:
            lines = [line(r.randint(1, 25)) for _ in range(r.randint(1, 6))]
            if r.random() < 0.6:
                k = r.randrange(3)
                lines[r.randrange(len(lines) + 1):0] = shared[k:k + r.randint(1, 4)]
            if r.random() < 0.3:
                lines.insert(0, line(3) + " " + passage + " " + line(2))
            out.append("\n".join(lines))
    out.append(" ".join(line(30) for _ in range(400)))
    return out
