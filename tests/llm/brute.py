"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import math
import re
from itertools import combinations

import xxhash

ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return (text or "").encode().lower().decode()


def words(text):
    return WORD.findall(text or "")


def contamination(docs, items, window=10):
    """Per row: words, hit words, sorted items."""
    known = {}
    for item, text in items:
        w = ITEM_WORD.findall(lower(text))
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            known.setdefault(tuple(w[k : k + n]), set()).add(str(item))
    out = []
    for doc_id, text in docs:
        w, hit, found = ITEM_WORD.findall(lower(text)), set(), set()
        for n in {len(gram) for gram in known}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in known:
                    hit |= set(range(k, k + n))
                    found |= known[tuple(w[k : k + n])]
        out.append((doc_id, len(w), len(hit), sorted(found)))
    return out


def kept_without_repeats(docs, window=20):
    """Per row: words, removed words, kept text. Rows with one id do not precede one another."""
    low = -(2**63)
    earliest = {}
    for doc_id, text in docs:
        w = words(text)
        for k in range(len(w) - window + 1):
            gram, key = tuple(w[k : k + window]), low if doc_id is None else doc_id
            earliest[gram] = min(earliest.get(gram, key), key)
    out = []
    for doc_id, text in docs:
        w, gone, seen = words(text), set(), set()
        for k in range(len(w) - window + 1):
            gram = tuple(w[k : k + window])
            if gram in seen or earliest[gram] < (low if doc_id is None else doc_id):
                gone |= set(range(k, k + window))
            seen.add(gram)
        out.append((doc_id, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def fingerprint(text, size=3):
    w = words(lower(text))
    n = max(1, len(w) - size + 1) if w else 0
    votes = [0] * 64
    for k in range(n):
        h = xxhash.xxh64_intdigest(" ".join(w[k : k + size]).encode(), 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > n)


def groups(nodes, linked):
    """Root of every node, the smallest it can reach."""
    root = {node: node for node in nodes}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(root), 2):
        if linked(a, b):
            a, b = sorted((top(a), top(b)))
            root[b] = a
    return {node: top(node) for node in root}


def jaccard(a, b, size=5):
    def shingles(text):
        w = words(lower(text))
        return {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()

    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Targets of a list of source sizes in order, sharing what is above the limit until none is."""
    left, fixed = share * sum(sizes), {}
    while True:
        open_ = [i for i in range(len(sizes)) if i not in fixed]
        weight = sum(weights[i % len(weights)] for i in open_)
        rest = left - sum(fixed.values())
        over = [i for i in open_ if rest * weights[i % len(weights)] / weight > most * sizes[i] + 1e-9]
        if not over:
            return [fixed.get(i, rest * weights[i % len(weights)] / weight if weight else 0) for i in range(len(sizes))]
        fixed |= {i: most * sizes[i] for i in over}


BASE_PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(text):
    digits = [int(c) for c in text if c.isdigit()][::-1]
    total = sum(d if i % 2 == 0 else (2 * d) // 10 + (2 * d) % 10 for i, d in enumerate(digits))
    return 12 <= len(digits) <= 19 and total % 10 == 0


def personal_data(text):
    found = []
    for order, (kind, pattern) in enumerate(BASE_PII.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            valid = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                "card": luhn(m.group()),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if valid:
                found.append((m.start(), order, m.end(), kind))
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A
)


def secrets(text):
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


LETTERS, NUMBERS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
ALPHABETS = [
    ("[0-9]+", NUMBERS), ("[a-z]+", LETTERS), ("[A-Z]+", LETTERS.upper()), ("[A-Za-z]+", LETTERS.upper() + LETTERS),
    ("[0-9a-f]+", NUMBERS + "abcdef"), ("[0-9A-F]+", NUMBERS + "ABCDEF"), ("[A-Z2-7]+", LETTERS.upper() + "234567"),
    ("[0-9a-z]+", NUMBERS + LETTERS), ("[0-9A-Z]+", NUMBERS + LETTERS.upper()),
    ("[0-9A-Za-z]+", NUMBERS + LETTERS.upper() + LETTERS), ("[0-9A-Za-z_-]+", LETTERS.upper() + LETTERS + NUMBERS + "-_"),
    (".*", LETTERS.upper() + LETTERS + NUMBERS + "+/-_="),
]


def randomness(token):
    """p of the battery, and the length that decides the token's range."""
    body = token.rstrip("=")
    n = len(body)
    alphabet = next(a for pattern, a in ALPHABETS if re.fullmatch(pattern, body))
    k, words = len(alphabet), body.isalpha()
    x = [alphabet.index(c) + 1 for c in body]

    def tail(z):
        z = max(-8.0, min(8.0, z))
        return 1 / (1 + math.exp(1.5976 * z + 0.070565992 * z**3))

    chi = sum(x.count(v) ** 2 for v in set(x)) * k / n - n
    df = k - 1
    uniform = ((max(chi, 0) / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    high = [c.lower() in "aeiou" if words else v > k / 2 for c, v in zip(body, x)]
    n1 = sum(high)
    mean = 2 * n1 * (n - n1) / n + 1
    runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
    spread = math.sqrt(max((mean - 1) * (mean - 2) / max(n - 1, 1), 1e-9))
    along = abs(runs - mean) / spread if 0 < n1 < n else 8.0
    frequent = sum(c.lower() in "etaoinsrhl" for c in body) if words else n1
    share = 10 / 26 if words else (k - k // 2 - (k % 2 > 0)) / k
    root = (frequent - n * share) / math.sqrt(n * share * (1 - share))
    centre = sum(x) / n
    var = sum((v - centre) ** 2 for v in x)
    lagged = sum((a - centre) * (b - centre) for a, b in zip(x, x[1:]))
    serial = abs(lagged / var + 1 / n) * math.sqrt(n) if var > 0 else 8.0
    p = [tail(uniform), 2 * tail(along), tail(root) if words else 2 * tail(abs(root)), 2 * tail(serial)]
    h = -sum(math.log(min(1.0, max(v, 1e-12))) for v in p)
    return min(1.0, math.exp(-h) * (1 + h + h * h / 2 + h**3 / 6)), n


def random_spans(texts, rate=0.05):
    """Per text the tokens for which randomness is not rejected, apart from the base spans."""
    found = []
    for t, text in enumerate(texts):
        for m in re.finditer(r"[A-Za-z0-9+/_=-]+", text or ""):
            if len(m.group()) >= 20:
                p, n = randomness(m.group())
                step = min(math.floor(-math.log(max(p, 1e-12)) * 20), 400)
                found.append((sum(n >= low for low in (32, 48, 64)), step, t, m.start(), m.end()))
    limits = {}
    for stratum in {f[0] for f in found}:
        steps = sorted((f[1] for f in found if f[0] == stratum), reverse=True)
        passing = [s for s in steps if math.exp(-s / 20) <= rate * sum(x >= s for x in steps) / len(steps)]
        limits[stratum] = min(passing, default=401)
    out = [[] for _ in texts]
    for stratum, step, t, start, end in found:
        apart = all(end <= a or b <= start for _, a, b in secrets(texts[t]))
        if step < limits[stratum] and apart:
            out[t].append(("random", start, end))
    return out
