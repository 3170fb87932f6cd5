"""Brute-force versions of the operators' results, straight from their definitions."""

import hashlib
import re
from collections import Counter, defaultdict

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def low(text):
    return (text or "").translate(LOWER)


def exact(rows):
    """Result rows (doc_id, keep_id, group_size, kept, sha), sorted; of rows that share the kept id one is kept."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[low(t)].append(i)
    out = []
    for text, ids in groups.items():
        ids = sorted(ids, key=lambda i: (i is not None, i or 0))
        out += [(i, ids[-1], len(ids), n == len(ids) - 1, sha(text)) for n, i in enumerate(ids)]
    return out


def near(rows, k=4, percent=80):
    """(doc_id, n_shingles, component_id) of rows with distinct ids."""
    sets = {}
    for i, t in rows:
        w = SPACED.findall(low(t))
        sets[i] = frozenset(tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def contaminated(text, bench, window=10):
    """(n_words, hit words, item ids) of a text."""
    found = defaultdict(set)
    for i, t in bench:
        w = PLAIN.findall(low(t))
        n = min(window, len(w))
        for a in range(len(w) - n + 1) if n else ():
            found[tuple(w[a : a + n])].add(str(i) if i is not None else "")
    w = PLAIN.findall(low(text))
    hit, items = set(), set()
    for n in {len(x) for x in found}:
        for a in range(len(w) - n + 1):
            own = found.get(tuple(w[a : a + n]))
            if own:
                hit.update(range(a, a + n))
                items |= own
    return len(w), hit, items


def repeats(rows, length=50):
    """(doc_id, n_bytes, n_removed, n_spans, sha of the rest) of every row."""
    last = 1 << 63
    rows = [(last if i is None else i, i, (t or "").encode()) for i, t in rows]
    first = {}
    for key, _, b in rows:
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            first[w] = min(first.get(w, key), key)
    out = []
    for key, i, b in rows:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if first[b[s : s + length]] < key:
                gone[s : s + length] = b"\1" * length
        spans = sum(1 for x in range(len(b)) if gone[x] and (x == 0 or not gone[x - 1]))
        out.append((i, len(b), sum(gone), spans, sha(bytes(c for c, g in zip(b, gone) if not g))))
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        x = int(c) * (1 + i % 2)
        total += x // 10 + x % 10
    return total % 10 == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def private(text):
    """kind:start:end of the fixed patterns, in order."""
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(out)]


def targets(rows, weights=(5, 2, 1), most=3):
    """source: (size, target) from (source, text) rows, resharing until none is above."""
    sizes = Counter()
    for source, text in rows:
        sizes[source] += len(SPACED.findall(text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[n % len(weights)] for n, s in enumerate(order)}
    full = set()
    while True:
        rest = [s for s in order if s not in full]
        left = sum(sizes.values()) - sum(most * sizes[s] for s in full)
        share = sum(weight[s] for s in rest)
        target = {s: most * sizes[s] if s in full else left * weight[s] / share for s in order}
        above = {s for s in rest if target[s] > most * sizes[s]}
        if not above:
            return {s: (sizes[s], target[s]) for s in order}
        full |= above


def phrases(text):
    """(n_words, starts, labels) of the base phrases."""
    known = {"mit": ["mit", "license"], "apache": ["apache", "license"], "gpl": ["general", "public", "license"]}
    words = PLAIN.findall(low(text))
    starts, labels = [], set()
    for label, phrase in known.items():
        for i in range(len(words)):
            if words[i : i + len(phrase)] == phrase:
                starts.append(i)
                labels.add(label)
    return len(words), starts, labels
