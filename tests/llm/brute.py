"""Brute-force versions of the operators, one text or pair at a time."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def low(text):
    return (text or "").translate(_LOW)


def shingles(text, width=5):
    w = WORD.findall(low(text))
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def components(docs: dict) -> dict:
    """id -> (n_shingles, least id reachable); docs: id -> text."""
    sets = {k: shingles(t) for k, t in docs.items()}
    parent = {k: k for k in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    held = defaultdict(list)
    for k in sorted(sets):
        common = Counter(o for g in sets[k] for o in held[g])
        for g in sets[k]:
            held[g].append(k)
        for o, c in common.items():
            if 100 * c >= 75 * (len(sets[k]) + len(sets[o]) - c):
                a, b = root(o), root(k)
                parent[max(a, b)] = min(a, b)
    return {k: (len(sets[k]), root(k)) for k in docs}


def kept_words(docs: dict, width=13) -> dict:
    words, first = {k: WORD.findall(t or "") for k, t in docs.items()}, {}
    for k in sorted(words):
        for i in range(len(words[k]) - width + 1):
            first.setdefault(tuple(words[k][i:i + width]), k)
    out = {}
    for k, w in words.items():
        gone = set()
        for i in range(len(w) - width + 1):
            if first[tuple(w[i:i + width])] < k:
                gone.update(range(i, i + width))
        out[k] = (len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def kept_lines(docs: dict) -> dict:
    first, order = {}, []
    for k in sorted(docs):
        for line in (docs[k] or "").split("\n"):
            s = frozenset(WORD.findall(line))
            if s and s not in first:
                first[s] = len(order)
                order.append(s)
    held, dead = defaultdict(list), set()
    for i, s in enumerate(order):
        common = Counter(j for w in s for j in held[w])
        for w in s:
            held[w].append(i)
        if any(4 * c >= 3 * (len(s) + len(order[j]) - c) for j, c in common.items()):
            dead.add(i)
    out, seen = {}, set()
    for k in sorted(docs):
        lines, keep = (docs[k] or "").split("\n"), []
        for line in lines:
            s = frozenset(WORD.findall(line))
            if not s or (first[s] not in seen and first[s] not in dead):
                keep.append(line)
            if s:
                seen.add(first[s])
        out[k] = (len(lines), len(lines) - len(keep), sha("\n".join(keep)))
    return out


def contamination(docs: dict, items: dict) -> dict:
    win = defaultdict(set)
    for k, t in items.items():
        w = ITEM.findall(low(t))
        for i in range(max(1, len(w) - 12) if w else 0):
            win[tuple(w[i:i + 13])].add(str(k))
    sizes, out = {len(k) for k in win}, {}
    for k, t in docs.items():
        w, hit, names = ITEM.findall(low(t)), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in win:
                    hit.update(range(i, i + n))
                    names |= win[tuple(w[i:i + n])]
        out[k] = (len(w), len(hit), len(names), sha(",".join(sorted(names))),
                  len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


def quality_base(text) -> tuple:
    text = text or ""
    w, seen, dup = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    count, covered = Counter(tuple(w[j:j + 3]) for j in range(len(w) - 2)), set()
    for j in range(len(w) - 2):
        if count[tuple(w[j:j + 3])] > 1:
            covered |= {j, j + 1, j + 2}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def targets(sizes: dict, most=3) -> dict:
    """source -> target by sharing the excess again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        w = sum(weight[s] for s in free)
        goal = {s: left * weight[s] / w for s in free}
        over = {s for s in free if goal[s] > most * sizes[s]}
        if not over:
            return {s: goal.get(s, most * sizes[s]) for s in order}
        capped |= over


def word_runs(words: list, least=12) -> list:
    """(start, length, period) of every run, by start, then period."""
    n, out = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(least, 2 * p):
                out.setdefault((i, j + p), p)
            i = j + 1
    return sorted((s, e - s, p) for (s, e), p in out.items())


def runs_row(words: list) -> tuple:
    found, gone = word_runs(words), set()
    for s, n, p in found:
        gone.update(range(s + p, s + n))
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    top = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(found), *top, sha("".join(f"{s},{n},{p}\n" for s, n, p in found)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def divergences(rows: list, least_docs=10, top=10) -> set:
    """(lang, source, part, item, value, rank); rows: (lang, source, text)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    out, term = set(), re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    for lang in {r[0] for r in rows}:
        counts, docs = defaultdict(Counter), Counter()
        for lg, source, text in rows:
            if lg == lang:
                c = Counter(term.findall(low(text)))
                counts[source].update(c)
                docs.update(c.keys())
        kept = [t for t, n in docs.items() if n >= least_docs]
        whole = sum(counts.values(), Counter())

        def share(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p, q = {s: share(c) for s, c in counts.items()}, share(whole)

        def price(a, b):
            return (a - b) ** 2 // (a + b)

        for s in counts:
            pairs = [(o, sum(price(p[s][t], p[o][t]) for t in kept)) for o in counts if o != s]
            terms = [(t, price(p[s][t], q[t])) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, i, v, k) for k, (i, v) in enumerate(items[:most], 1)}
    return out
