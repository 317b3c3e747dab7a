"""Plain Python versions of the operators' definitions."""

from __future__ import annotations

import hashlib
import math
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, width):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return set()
    if len(words) < width:
        return {tuple(words)}
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def near(docs, width, percent):
    """{id: (n_shingles, component)}"""
    sets = {i: shingles(t, width) for i, t in docs}
    by = {}
    for i, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(i)
    common = {}
    for ids in by.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1 :]:
                common[a, b] = common.get((a, b), 0) + 1
    links = [(a, b) for (a, b), n in common.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]
    comp = components(sets, links)
    return {i: (len(s), comp[i]) for i, s in sets.items()}


def repeats(rows, width):
    """For (id, sequence) rows in order of id: the covered places of each row."""
    seen = {}
    for i, seq in sorted(rows, key=lambda r: r[0]):
        for k in range(len(seq) - width + 1):
            w = seq[k : k + width]
            seen[w] = min(seen.get(w, (i, k)), (i, k))
    out = []
    for i, seq in rows:
        gone = bytearray(len(seq))
        for k in range(len(seq) - width + 1):
            if seen[seq[k : k + width]] < (i, k):
                gone[k : k + width] = b"\1" * width
        out.append(gone)
    return out


def word_dedup(docs, width=20):
    """{id: (n_words, n_removed, kept_sha256)}"""
    rows = [(i, tuple(WORD.findall(t or ""))) for i, t in docs]
    out = {}
    for (i, words), gone in zip(rows, repeats(rows, width)):
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out[i] = (len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def byte_dedup(docs, width=100):
    """{id: (n_bytes, n_removed, n_spans, kept_sha256)}"""
    rows = [(i, (t or "").encode()) for i, t in docs]
    out = {}
    for (i, data), gone in zip(rows, repeats(rows, width)):
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def vectors(rows, threshold):
    """{id: (n_links, component)} of (id, vector, label) rows."""
    def usable(v, label):
        return label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    good = {i: (v, label) for i, v, label in rows if usable(v, label)}
    links = []
    ids = list(good)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            (x, p), (y, q) = good[a], good[b]
            if p == q and len(x) == len(y):
                dot = sum(s * t for s, t in zip(x, y))
                if dot / math.sqrt(sum(s * s for s in x)) / math.sqrt(sum(t * t for t in y)) >= threshold:
                    links.append((a, b))
    n = {i: 0 for i, _, _ in rows}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    comp = components(n, links)
    return {i: (n[i], comp[i]) for i in n}


def targets(sizes, weights=(5, 2, 1), most=3):
    """{source: target} of {source: size}."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in stopped)
        heavy = sum(weight[s] for s in order if s not in stopped)
        share = {s: left * weight[s] / heavy if heavy else 0.0 for s in order}
        above = {s for s in order if s not in stopped and share[s] > most * sizes[s] + 1e-9}
        if not above:
            return {s: most * sizes[s] if s in stopped else share[s] for s in order}
        stopped |= above


def edited(docs):
    """{id: edited text} of (id, text) rows."""
    rows = sorted(docs)
    out = {}
    for k, (i, text) in enumerate(rows):
        text, follow = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        out[i] = text[: len(text) - half] + follow[:half]
    return out


FAR_MARKS = set("\u2026\u3002\uff01\uff0e\uff1f\uff61\u061f\u06d4\u0964\u0965\u1362\u1367\u0589")


def paragraphs(text):
    """Cut after line ends; from 24 code points on after marks or a code point that comes again two or three on; or after 160."""
    out, start = [], 0
    while start < len(text):
        end = min(len(text), start + 160)
        for at in range(start, end):
            c, long = text[at], at - start >= 23
            follow = text[at + 1 : at + 4].split("\n")[0]
            if c == "\n" or long and c in ".!?":
                end = at + 1
                while end < len(text) and text[end] in ("\n.!?" if long else "\n"):
                    end += 1
                break
            if long and (c in FAR_MARKS or c in follow[1:]):
                end = at + 1
                break
        out.append(text[start:end])
        start = end
    return out


def merkle(text):
    """(root, sections of paragraph hashes, sections of paragraphs)."""
    cut = paragraphs(text)
    leaves = [hashlib.md5(p.encode()).hexdigest() for p in cut]
    ends = [i + 1 for i, h in enumerate(leaves) if h[0] == "0" or i == len(leaves) - 1]
    groups = list(zip([0, *ends[:-1]], ends))
    nodes = [hashlib.md5("".join(leaves[a:b]).encode()).hexdigest() for a, b in groups]
    shown = [[h[:8] for h in leaves[a:b]] for a, b in groups]
    return hashlib.sha256("".join(nodes).encode()).hexdigest(), shown, [cut[a:b] for a, b in groups]


def fingerprint(text):
    root, shown, _ = merkle(text)
    return root + ":" + "/".join(".".join(s) for s in shown)
