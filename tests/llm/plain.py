"""Plain single-process versions of the corpus operators, to hold the Spark ones against."""
from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANK = " \t\n\x0b\x0c\r"


def lines(rows, min_docs):
    """rows: (id, text) -> list of (id, n_lines, n_dropped, kept text)."""
    seen = Counter()
    split = [(i, (t or "").split("\n")) for i, t in rows]
    key = lambda x: x.strip(BLANK).translate(UP)
    for _, ls in split:
        seen.update({key(x) for x in ls} - {""})
    gone = {k for k, n in seen.items() if n >= min_docs}
    return [(i, len(ls), sum(key(x) in gone for x in ls), "\n".join(x for x in ls if key(x) not in gone)) for i, ls in split]


def topk(rows, is_query, k):
    usable = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable.append((i, [math.floor(1024 * x) for x in v]))
    out = []
    for q, a in usable:
        if is_query(q):
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return out


def warc(rows):
    first = {}
    for i, html in rows:
        p = (html or "").encode()
        old = first.get(p, "none")
        if old == "none" or old is None or (i is not None and i < old):
            first[p] = i
    out = []
    for i, html in rows:
        p = (html or "").encode()
        response = i == first[p]
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if response else "revisit", None if response else first[p]))
    return out


class Ppm:
    """One language's byte contexts of up to ``depth`` bytes; escape method C, frozen."""

    def __init__(self, texts, depth=3):
        self.depth, self.next = depth, defaultdict(Counter)
        for t in texts:
            b = b"\n\n\n" + t.encode()
            for i in range(3, len(b)):
                for d in range(depth + 1):
                    self.next[b[i - d: i]][b[i]] += 1

    def bits(self, context, byte, kept):
        if not context:
            seen = self.next[b""]
            lower = 8.0
        else:
            lower = None
            seen = self.next.get(context)
            if seen is None or (len(context) == 3 and context not in kept):
                return self.bits(context[1:], byte, kept)
        n, d = sum(seen.values()), len(seen)
        if n == 0:
            return 8.0
        if byte in seen:
            return math.log2((n + d) / seen[byte])
        return math.log2((n + d) / d) + (lower if lower is not None else self.bits(context[1:], byte, kept))

    def total(self, text, kept):
        b = b"\n\n\n" + text.encode()
        return sum(self.bits(b[i - 3: i], b[i], kept) for i in range(3, len(b)))


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UP))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i: i + 5]) for i in range(max(1, len(w) - 4)))


def jaccard(rows, percent=80):
    """(id, n, smallest id of the component) by comparing all pairs."""
    sets = [(i, shingle_set(t)) for i, t in rows]
    up = list(range(len(sets)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                up[find(a)] = find(b)
    least = {}
    for j, (i, s) in enumerate(sets):
        r = find(j)
        least[r] = i if least.get(r) is None else (least[r] if i is None else min(least[r], i))
    return [(i, len(s), least[find(j)] if s else i) for j, (i, s) in enumerate(sets)]


def benchmark_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UP))


def overlaps(docs, items, window=13):
    places = defaultdict(set)
    for item, text in items:
        w = benchmark_words(text)
        m = min(window, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            places[tuple(w[i: i + m])].add(item)
    sizes = {len(g) for g in places}
    out = []
    for i, text in docs:
        w = benchmark_words(text)
        hit, found = set(), set()
        for m in sizes:
            for s in range(len(w) - m + 1):
                if (g := tuple(w[s: s + m])) in places:
                    hit.update(range(s, s + m))
                    found |= places[g]
        out.append((i, len(w), len(hit), sorted({str(x) for x in found if x is not None})))
    return out


def edf(weights):
    """Slots of each source within a period: simulated slot by slot."""
    period, done, out = sum(weights), [0] * len(weights), [[] for _ in weights]
    for t in range(period):
        due = [(math.ceil(Fraction((done[i] + 1) * period, a)), i) for i, a in enumerate(weights) if done[i] < a and Fraction(done[i] * period, a) <= t]
        i = min(due)[1]
        out[i].append(t)
        done[i] += 1
    return out


def fim(i, text, seed=42):
    """(n, form, prefix_chars, middle_chars, output) of one row."""
    t = text or ""
    h = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    a, b, c, d = (int(h[8 * j: 8 * j + 8], 16) for j in range(4))
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", t)
    n = len(units)
    if not t or "<P>" in t or "<S>" in t or "<M>" in t or c % 100 >= 50:
        return n, "plain", None, None, t
    low, high = sorted((a % (n + 1), b % (n + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if d % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def collocations(rows, least=30, cover=80, top=2000):
    """rows: (lang, text) -> list of (lang, rank, phrase, a, l, r, n, score)."""
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UP)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for m in range(1, 5):
                f[lang].update(tuple(w[i: i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        hidden = set()
        for p, a in candidates.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    if 100 * a >= cover * candidates[p[i: i + m]]:
                        hidden.add(p[i: i + m])
        scored = []
        for p, a in candidates.items():
            if p not in hidden:
                score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, total[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return out
