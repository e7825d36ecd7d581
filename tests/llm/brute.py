"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def rows(folder: str, table: str) -> list[dict]:
    return pq.read_table(f"{folder}/{table}.parquet").to_pylist()


def top_k(vectors: list[dict], k: int = 5, every: int = 50) -> dict[int, list[tuple[int, int]]]:
    ids = np.array([v["vec_id"] for v in vectors])
    data = np.floor(256 * np.array([v["embedding"] for v in vectors], dtype=np.float64)).astype(np.int64)
    found = {}
    for i in np.flatnonzero(ids % every == 0):
        score = data @ data[i]
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[i]][:k]
        found[int(ids[i])] = [(int(ids[j]), int(score[j])) for j in order]
    return found


def removed(docs: list[dict], length: int = 50) -> dict[int, tuple]:
    seen: dict[bytes, int] = {}
    found = {}
    for doc in sorted(docs, key=lambda d: d["doc_id"]):
        raw = (doc["text"] or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if seen.setdefault(raw[i:i + length], doc["doc_id"]) < doc["doc_id"]:
                gone[i:i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        spans = len([r for r in bytes(gone).split(b"\0") if r])
        found[doc["doc_id"]] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return found


def shingles(text: str | None, size: int) -> set[tuple[str, ...]]:
    words = WORD.findall((text or "").translate(UPPER))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def near(docs: list[dict], size: int, percent: int = 80) -> dict[int, tuple[int, int]]:
    sets = {d["doc_id"]: shingles(d["text"], size) for d in docs}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    where = defaultdict(list)
    shared: dict[tuple[int, int], int] = defaultdict(int)
    for i in sorted(sets):
        for s in sets[i]:
            for j in where[s]:
                shared[j, i] += 1
            where[s].append(i)
    for (j, i), both in shared.items():
        if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    return {i: (len(s), root(i)) for i, s in sets.items()}


def capped_targets(sizes: dict, weights=(5.0, 2.0, 1.0), most: float = 3.0) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, held = float(sum(sizes.values())), {}
    while True:
        rest = total - sum(held.values())
        open_ = [s for s in order if s not in held]
        share = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = [s for s in open_ if share[s] > most * sizes[s]]
        if not over:
            return held | share
        held |= {s: most * sizes[s] for s in over}


def places(text: list, own: list, align, threshold: float = 0.8) -> list[tuple[float, int, int]]:
    """Where a template stands in a text, both lists of words: windows from every start, the best first."""
    slack, hits = max(2, len(own) // 4), set()
    for start in range(len(text)):
        best = align(text[start:start + len(own) + slack], own)
        for stop in range(start + len(own) + 2 * slack, len(text) + slack, slack):
            # a match that has come to the template's last word does not go on
            at_edge = best and best[-1][0] >= stop - start - 2 * slack and best[-1][1] + 1 < len(own)
            longer = align(text[start:stop], own)
            if len(best) < threshold * len(own) or not at_edge or len(longer) <= len(best):
                break
            best = longer
        if best and len(best) >= threshold * len(own):
            hits.add((len(best) / len(own), start + best[0][0], start + best[-1][0]))
    chosen = []
    for hit in sorted(hits, key=lambda p: (-p[0], p[2] - p[1], p[1])):
        if all(hit[2] < p[1] or p[2] < hit[1] for p in chosen):
            chosen.append(hit)
    return chosen


def phrase_counts(docs: list[dict]) -> dict[str, Counter]:
    """Of each language how often each run of one to four words occurs within pieces."""
    counts = defaultdict(Counter)
    for d in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (d["text"] or "").translate(UPPER)):
            own = re.findall(r"[^\x20\x09]+", piece)
            for i in range(len(own)):
                for k in range(1, min(4, len(own) - i) + 1):
                    counts["und" if d["lang"] is None else d["lang"]][tuple(own[i:i + k])] += 1
    return counts


def collocations(docs: list[dict], least: int, top: int) -> list[tuple]:
    found = []
    for lang, f in phrase_counts(docs).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        held = defaultdict(int)
        for p, a in often.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    held[p[i:i + k]] = max(held[p[i:i + k]], a)
        rows = []
        for p, a in often.items():
            if 100 * held[p] < 80 * a:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        found += [(lang, i + 1, p.decode(), -a, left, right, n, -score)
                  for i, (score, a, p, left, right) in enumerate(sorted(rows)[:top])]
    return found


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def best_documents(docs: list[tuple], items: list[tuple], k: int = 10) -> list[tuple]:
    """From (doc_id, text) and (item_id, text)."""
    counts = [(i, Counter(TERM.findall((t or "").translate(UPPER)))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    total = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    weight = {t: math.floor(1000 * math.log((2 * len(counts) + 2) / (2 * n + 1))) for t, n in df.items()}
    found = []
    for item, text in items:
        terms = TERM.findall((text or "").translate(UPPER))
        scored = []
        for i, c in counts:
            m = 25 + 75 * sum(c.values()) * len(counts) // total
            score = sum(weight[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if score:
                scored.append((-score, i is None, i))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        found += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(scored[:k])]
    return found


def discriminant_scores(x: np.ndarray, quality: np.ndarray, new: np.ndarray, pooled: float, around: float) -> np.ndarray:
    """Posteriors of class 1 under two normal densities with shrunken covariances."""
    common = sum(np.cov(x[quality == k].T, bias=True) * (quality == k).sum() for k in (0, 1)) / len(x)
    logs = []
    for k in (0, 1):
        own = x[quality == k]
        cov = (1 - pooled) * np.cov(own.T, bias=True) + pooled * common
        cov = (1 - around) * cov + around * np.trace(cov) / len(cov) * np.eye(len(cov))
        away = new - own.mean(axis=0)
        distance = np.einsum("ij,jk,ik->i", away, np.linalg.inv(cov), away)
        logs.append(np.log(len(own) / len(x)) - 0.5 * (np.linalg.slogdet(cov)[1] + distance))
    return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))
