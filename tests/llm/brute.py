"""Plain definitions that the operators are held against."""

import hashlib
import math
import re
from collections import Counter

import xxhash

ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")


def secret_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in HEX.finditer(text) if m.end() - m.start() >= 24]
    return sorted(found)


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def pii_spans(text):
    text, found = text or "", []
    for rank, (kind, pattern) in enumerate((("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE))):
        for m in pattern.finditer(text):
            digits = [c for c in m.group() if c in "0123456789"]
            if kind == "ip" and max(map(int, m.group().split("."))) > 255:
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            found.append((rank, m.start(), m.end(), kind))
    return sorted(found)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def simhash(text, n=4):
    words = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    n = min(n, len(words))
    hashes = [xxhash.xxh64(" ".join(words[i : i + n]).encode(), seed=42).intdigest() for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_roots(texts, radius=4):
    """The smallest id that links reach, of every id."""
    prints, root = {i: simhash(t) for i, t in texts.items()}, {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in texts:
        for b in texts:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in texts}


def mix_copies(texts, sources, weights=(5, 2, 1), share=1.5, repeat=2):
    """How often the mix takes each document; a document without words is left to the caller."""
    size = {i: len(WORDS.findall(t or "")) for i, t in texts.items()}
    by_source = {}
    for i in texts:
        by_source.setdefault(sources[i], []).append(i)
    names = sorted(by_source, key=lambda s: (s is None, s))
    total = {s: sum(size[i] for i in by_source[s]) for s in names}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, budget, free = {}, share * sum(total.values()), set(names)
    while True:
        level = (budget - sum(target.values())) / (sum(weight[s] for s in free) or 1)
        full = {s for s in free if weight[s] * level >= repeat * total[s]}
        if not full:
            break
        target.update({s: repeat * total[s] for s in full})
        free -= full
    target.update({s: weight[s] * level for s in free})
    served = []
    for s in names:
        at = 0
        for lap in range(repeat):
            for i in sorted(by_source[s], key=lambda i: (sha(f"42:{i}:{hashlib.md5((texts[i] or '').encode()).hexdigest()}"), size[i])):
                at += size[i]
                if size[i]:
                    served.append((at / target[s], s is None, s or "", at, i))
    copies, left = Counter(), math.floor(sum(target.values()) + 0.5)
    for *_, i in sorted(served):
        copies[i] += size[i] <= left or (left > 0 and size[i] <= 2 * left)
        left -= size[i]
    return copies
