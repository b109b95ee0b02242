"""Slow, plain versions of the contracts, written apart from the operators."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def secret_row(text):
    text = text or ""
    kinds = {
        "assign": r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        "access": r"AKIA[A-Z0-9]+",
        "hex": r"[0-9a-f]+",
    }
    found = []
    for rank, (kind, pattern) in enumerate(kinds.items()):
        pattern = pattern.replace("((?:", "((?i:") if kind == "assign" else pattern
        for m in re.finditer(pattern, text):
            good = len(m.group(2)) >= 6 if kind == "assign" else len(m.group()) >= (20 if kind == "access" else 24)
            if good:
                found.append((m.start(), rank, m.end(), kind))
    count = Counter(f[3] for f in found)
    base = ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))
    return count["assign"], count["access"], count["hex"], sha(base), base


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def license_row(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
    starts, labels = [], set()
    for phrase, label in (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")):
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def statistics_row(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            inside |= {i, i + 1, i + 2}
    n = len(words)
    failed = n < 50 or 100 * len(inside) > 50 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), failed


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def components(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def near_duplicate_rows(docs):
    """docs: list of (id, text); returns id -> (size, component)."""
    sets = {i: shingles(t) for i, t in docs}
    where: dict = {}
    links = set()
    for i, s in sets.items():
        near = Counter(j for x in s for j in where.get(x, ()))
        links |= {(j, i) for j, n in near.items() if 100 * n >= 75 * (len(s) + len(sets[j]) - n)}
        for x in s:
            where.setdefault(x, []).append(i)
    found = components(sets, links)
    return {i: (len(s), found[i]) for i, s in sets.items()}


def repeated_bytes(texts, width=200):
    """Per text: bytes, removed, runs, digest of what is left."""
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + width] for d in data for i in range(len(d) - width + 1))
    out = []
    for d in data:
        covered = bytearray(len(d))
        for i in range(len(d) - width + 1):
            if count[d[i : i + width]] > 1:
                covered[i : i + width] = b"\1" * width
        runs = len(re.findall(b"\1+", bytes(covered)))
        kept = bytes(b for b, c in zip(d, covered, strict=True) if not c)
        out.append((len(d), sum(covered), runs, sha(kept)))
    return out


def edit_distance(a, b, limit):
    """The distance, or ``limit + 1`` if it is larger."""
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        if min(row) > limit:
            return limit + 1
    return min(row[-1], limit + 1)


def crc(value) -> int:
    return zlib.crc32(str(value).encode())
