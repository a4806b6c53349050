"""The contracts in plain Python, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def substring_dedup(docs: dict, window: int = 20) -> dict:
    seen, out = set(), {}
    for i in sorted(docs):
        found = words(docs[i])
        gone = np.zeros(len(found), bool)
        for k in range(len(found) - window + 1):
            key = tuple(found[k : k + window])
            if key in seen:
                gone[k : k + window] = True
            seen.add(key)
        out[i] = (len(found), int(gone.sum()), sha(" ".join(w for w, g in zip(found, gone) if not g)))
    return out


def mixing_targets(sizes: dict) -> dict:
    """source -> target, by resharing until nothing is above three times its size."""
    order = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, stopped = dict.fromkeys(order, 0.0), set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in stopped)
        total = sum(weight[s] for s in order if s not in stopped)
        for s in order:
            target[s] = 3.0 * sizes[s] if s in stopped else left * weight[s] / total
        above = {s for s in order if s not in stopped and target[s] > 3 * sizes[s]}
        if not above:
            return target
        stopped |= above


def luhn(number: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(number)):
        x = int(c) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


PERSONAL = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(only_digits(m)) <= 19 and luhn(only_digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(only_digits(m)) <= 15),
)


def personal_data(text: str | None) -> tuple:
    counts, spans = [], []
    for kind, pattern, valid in PERSONAL:
        found = [f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(pattern, text or "") if valid(m[0])]
        counts.append(len(found))
        spans += found
    return (*counts, sha(",".join(spans))), spans


def one_edit(x: tuple, y: tuple) -> bool:
    if len(x) > len(y):
        x, y = y, x
    if len(y) - len(x) > 1:
        return False
    k = 0
    while k < len(x) and x[k] == y[k]:
        k += 1
    return x[k + 1 :] == y[k + 1 :] if len(x) == len(y) else x[k:] == y[k + 1 :]


def line_dedup(docs: dict, least: int = 8) -> dict:
    seen: dict[tuple, None] = {}
    drop: dict = defaultdict(dict)
    for i in sorted(docs):
        for k, line in enumerate((docs[i] or "").split("\n")):
            found = tuple(words(line))
            if not found:
                continue
            if found in seen:
                drop[i][k] = False
            elif len(found) >= least and any(len(z) >= least and one_edit(found, z) for z in seen):
                drop[i][k] = True
            seen[found] = None
    out = {}
    for i, text in docs.items():
        lines = (text or "").split("\n")
        kept = "\n".join(line for k, line in enumerate(lines) if k not in drop[i])
        near = sum(drop[i].values())
        out[i] = (sum(bool(words(line)) for line in lines), len(drop[i]) - near, near, sha(kept))
    return out


def fingerprint(text: str | None) -> int:
    import xxhash

    found = words(lower(text))
    shingles = [" ".join(found[k : k + 3]) for k in range(len(found) - 2)] or ([" ".join(found)] if found else [])
    counts = [0] * 64
    for shingle in shingles:
        h = xxhash.xxh64(shingle.encode(), seed=42).intdigest()
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def near_duplicates(prints: dict) -> dict:
    """id -> smallest id reachable by links of at most two bits."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def kneser_ney(docs: dict) -> tuple[dict, int]:
    """id -> (held out, tokens, known, base, score), training tokens."""
    tokens = {i: [*words(lower(t)), "</s>"] for i, t in docs.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    count, pairs = Counter(), Counter()
    for i, found in tokens.items():
        if not held[i]:
            count.update(found)
            pairs.update(zip(["<s>", *found], found))
    n, v, contexts = sum(count.values()), len(count), Counter(w for _, w in pairs)

    def discounts(values) -> list[float]:
        m = Counter(values)
        y = m[1] / (m[1] + 2 * m[2]) if m[1] else 0.0
        found = [k - (k + 1) * y * m[k + 1] / m[k] if m[k] else 0.0 for k in (1, 2, 3)]
        return [0.0, *(d if 0 < d < k else k / 2 for k, d in zip((1, 2, 3), found))]

    d1, d2 = discounts(contexts.values()), discounts(pairs.values())
    total, mass = Counter(), Counter()
    for (u, _), k in pairs.items():
        total[u] += k
        mass[u] += d2[min(k, 3)]
    rest = sum(d1[min(k, 3)] for k in contexts.values()) / len(pairs) if pairs else 1.0

    def p(u: str, w: str) -> float:
        low = (contexts[w] - d1[min(contexts[w], 3)]) / len(pairs) if contexts[w] else 0.0
        low += rest / (v + 1)
        k = pairs[u, w]
        return (k - d2[min(k, 3)]) / total[u] * (k > 0) + mass[u] / total[u] * low if total[u] else low

    out = {}
    for i, found in tokens.items():
        base = sum(log10((count[w] + 1) / (n + v + 1)) for w in found)
        score = sum(log10(p(u, w)) for u, w in zip(["<s>", *found], found))
        out[i] = (held[i], len(found), sum(count[w] > 0 for w in found), base, score)
    return out, n


def quality(text: str | None) -> tuple:
    found, body = words(text), text or ""
    windows = Counter(zip(found, found[1:], found[2:]))
    covered = {k + j for k, w in enumerate(zip(found, found[1:], found[2:])) if windows[w] > 1 for j in range(3)}
    spoken = [line for line in body.split("\n") if words(line)]
    n = len(found)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", body)), len(spoken) - len(set(spoken)), len(covered), failed


def spelling(rows: list[tuple]) -> dict:
    """word -> (form, root, n, n_near, form_n) of (doc_id, text) rows."""
    n: Counter = Counter()
    for i, text in rows:
        for found in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            found = lower(found)
            h = zlib.crc32(f"{'' if i is None else i}:{found}".encode())
            if h % 31 == 0:
                found = found[: h % len(found)] + found[h % len(found) + 1 :]
            n[found] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}
    holes = defaultdict(set)  # a word with one letter left out, marked or closed up
    for w in n:
        for k in range(len(w)):
            holes[w[:k] + "?" + w[k + 1 :]].add(w)
            holes[w[:k] + w[k + 1 :]].add(w)
    near = defaultdict(set)
    for hole, found in holes.items():
        if "?" in hole:
            for w in found:
                near[w] |= found - {w}
        elif hole in n:
            for w in found:
                near[w].add(hole)
                near[hole].add(w)
    form = {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda x: (-n[x], x))
            if n[best] >= 10 * n[w]:
                form[w] = best
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n[w], len(near[w]), n.get(form.get(w)))
    return out


def clusters(rows: list[tuple], count: int, rounds: int, scale: int = 256) -> list[tuple]:
    """(vec_id, cluster, distance, cluster inertia, inertia, digest) in whole numbers, row by row."""
    from math import floor

    vectors = [(i, [floor(scale * x) for x in v]) for i, v in rows]
    first = sorted((sha(f"2:{i}"), v) for i, v in vectors if i is not None)[:count]
    centroids = [v for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        member = defaultdict(list)
        for _, v in vectors:
            member[nearest(v)[1]].append(v)
        for k, found in member.items():
            centroids[k] = [sum(column) // len(found) for column in zip(*found)]
    done = [(i, *reversed(nearest(v))) for i, v in vectors]
    part = Counter()
    for _, k, d in done:
        part[k] += d
    return [(i, k, d, part[k], sum(part.values()), sha(",".join(map(str, centroids[k])))) for i, k, d in done]


def best_fit(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[tuple, int]]:
    """Best fit, longest first, on counts: groups of alike sequences share each step."""
    gaps: dict[int, list[tuple[tuple, int]]] = {}
    for k in range(len(sizes) - 1, -1, -1):
        size, rest, made = int(sizes[k]), int(counts[k]), []
        while rest:
            fitting = [g for g in gaps if g >= size]
            if fitting:
                gap = min(fitting)
                key, often = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
                used = min(rest, often)
                if used < often:
                    gaps.setdefault(gap, []).append((key, often - used))
                gaps.setdefault(gap - size, []).append(((*key, k), used))
                rest -= used
            else:
                each = capacity // size
                full, more = divmod(rest, each)
                if full:
                    made.append((capacity - each * size, ((k,) * each, full)))
                if more:
                    made.append((capacity - more * size, ((k,) * more, 1)))
                rest = 0
        for gap, group in made:
            gaps.setdefault(gap, []).append(group)
    out = []
    for groups in gaps.values():
        for key, often in groups:
            times = {k: key.count(k) for k in key}
            out.append((tuple(sorted(times.items())), often))
    return out


def value_trust(edges: list[tuple], rounds: int = 3, min_seeds: int = 3, min_confidence: float = 0.7, min_trust: float = 0.8) -> dict:
    """Bootstrapping on distinct edges (pattern, kind, value, seed): trust by (value, kind)."""
    trusted: dict = {}
    for _ in range(rounds):
        confident = {}
        for pattern in {e[0] for e in edges}:
            around = [e for e in edges if e[0] == pattern]
            weight = [1.0 if seed or kind == -1 else trusted.get((value, kind), 0.0) for _, kind, value, seed in around]
            for k in range(4):
                support = sum(w for w, e in zip(weight, around) if e[1] == k)
                if support >= min_seeds and support / (sum(weight) + 1) >= min_confidence:
                    confident[pattern, k] = support / (sum(weight) + 1)
        doubts: dict = {}
        for pattern, kind, value, seed in edges:
            if not seed and (pattern, kind) in confident:
                doubts[value, kind] = doubts.get((value, kind), 1.0) * (1 - confident[pattern, kind])
        trusted = {key: 1 - doubt for key, doubt in doubts.items() if 1 - doubt >= min_trust}
    return trusted
