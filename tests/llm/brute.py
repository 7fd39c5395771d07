"""Plain versions of the operators for small inputs."""

from __future__ import annotations

import hashlib
import re

import numpy as np

LOW = {i: i + 32 for i in range(65, 91)}


class Sets:
    """Union-find that keeps the least member as the root."""

    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def link(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def repeats(docs: dict[int, str | None], size: int) -> dict:
    seen, out = set(), {}
    for k in sorted(docs):
        raw = (docs[k] or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - size + 1):
            if raw[i : i + size] in seen:
                gone[i : i + size] = True
            seen.add(raw[i : i + size])
        gone = gone[: len(raw)]
        runs = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(gone) else 0
        out[k] = (len(raw), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(raw, np.uint8)[~gone])).hexdigest())
    return out


def near(docs: dict[int, str | None], words: int) -> dict:
    sets = {}
    for k, text in docs.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
        sets[k] = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} - {()}
    groups = Sets(docs)
    keys = sorted(docs)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                groups.link(a, b)
    return {k: (len(sets[k]), groups.find(k), groups.find(k) == k) for k in docs}


def lines(docs: dict[int, str | None]) -> dict:
    first: dict[str, tuple[int, int]] = {}
    for k in sorted(docs):
        for n, x in enumerate((docs[k] or "").split("\n")):
            if x.strip():
                first.setdefault(x.strip(), (k, n))
    sets = {x: {x[i : i + 5] for i in range(max(1, len(x) - 4))} for x in first}
    by_place = {place: x for x, place in first.items()}
    groups, every = Sets(by_place), sorted(by_place)
    for i, a in enumerate(every):
        for b in every[i + 1 :]:
            s, t = sets[by_place[a]], sets[by_place[b]]
            n = len(s & t)
            if n and 100 * n >= 80 * (len(s) + len(t) - n):
                groups.link(a, b)
    out = {}
    for k, text in docs.items():
        split = (text or "").split("\n")
        kept = [x for n, x in enumerate(split) if not x.strip() or groups.find(first[x.strip()]) == (k, n)]
        out[k] = (sum(bool(x.strip()) for x in split), len(split) - len(kept), "\n".join(kept))
    return out


def kneser_ney(rows: list[tuple[str | None, str]], order: int = 4, discount: float = 0.75):
    """Log-probability per character of a text of lower-case letters and spaces under a language, learned from rows."""

    def runs(text):
        clean = " ".join("".join(x if x.isalpha() else " " for x in text or "").split())
        padded = " " * (order - 1) + clean + " "
        return [padded[i : i + order] for i in range(len(clean) + 1)] if clean else []

    counts: dict = {}
    for text, lang in rows:
        for x in runs(text):
            own = counts.setdefault(lang, [{} for _ in range(order + 1)])
            own[order][x] = own[order].get(x, 0) + 1
    for own in counts.values():
        for n in range(order - 1, 0, -1):
            for x in own[n + 1]:
                own[n][x[1:]] = own[n].get(x[1:], 0) + 1
    floor = 1 / (len({x for own in counts.values() for x in own[1]}) + 1)

    def p(own, x):
        if not x:
            return floor
        same = [c for y, c in own[len(x)].items() if y[:-1] == x[:-1]]
        if not same:
            return p(own, x[1:])
        return max(own[len(x)].get(x, 0) - discount, 0) / sum(same) + discount * len(same) / sum(same) * p(own, x[1:])

    return lambda text, lang: np.mean([np.log(p(counts[lang], x)) for x in runs(text)])


def vectors(rows: list[tuple[int, list | None]]) -> dict:
    good = [(i, np.array(v, float)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    groups, n = Sets([i for i, _ in rows]), dict.fromkeys([i for i, _ in rows], 0)
    for p, (a, x) in enumerate(good):
        for b, y in good[p + 1 :]:
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.9:
                n[a], n[b] = n[a] + 1, n[b] + 1
                groups.link(a, b)
    return {i: (n[i], groups.find(i), groups.find(i) == i) for i, _ in rows}
