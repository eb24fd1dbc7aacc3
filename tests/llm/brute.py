"""The operators' contracts, worked out the plain way on small inputs."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import xxhash


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def pii(text: str | None) -> list[str]:
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append(f"{kind}:{m.start()}:{m.end()}")
    return found


def line_dedup(docs: list[tuple], min_docs: int = 3, min_chars: int = 20) -> list[tuple]:
    key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    holders: dict[str, set] = {}
    for doc, text in docs:
        for line in (text or "").split("\n"):
            if doc is not None and len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs or doc == max(holders[key(x)])]
        out.append((doc, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def contamination(docs: list[tuple], items: list[tuple], span: int = 10) -> list[tuple]:
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = words(text)
        n = min(span, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if items := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= {str(x) for x in items if x is not None}
        out.append((doc, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def fingerprint(text: str | None) -> int:
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def near_duplicates(docs: list[tuple]) -> list[tuple]:
    fps = [fingerprint(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least: dict[int, int | None] = {}
    for i, (doc, _) in enumerate(docs):
        old = least.get(find(i))
        least[find(i)] = doc if old is None else old if doc is None else min(old, doc)
    return [(doc, format(fps[i], "016x"), least[find(i)]) for i, (doc, _) in enumerate(docs)]


def substrings(docs: list[tuple], span: int = 50) -> list[tuple]:
    rank = lambda doc: float("inf") if doc is None else doc
    least: dict[bytes, float] = {}
    for doc, text in docs:
        b = (text or "").encode()
        for i in range(len(b) - span + 1):
            s = b[i : i + span]
            least[s] = min(least.get(s, float("inf")), rank(doc))
    out = []
    for doc, text in docs:
        b = (text or "").encode()
        gone = np.zeros(len(b) + 1, dtype=bool)
        for i in range(len(b) - span + 1):
            if least[b[i : i + span]] < rank(doc):
                gone[i : i + span] = True
        gone = gone[: len(b)]
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((doc, len(b), int(gone.sum()), int((gone & ~np.r_[False, gone[:-1]]).sum()), sha(kept)))
    return out


def nearest(rows: list[tuple], asks, k: int = 10) -> list[tuple]:
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    sizes = [len(v) for _, v in good]
    size = max(set(sizes), key=lambda s: (sizes.count(s), s)) if sizes else 0
    good = sorted(x for x in good if len(x[1]) == size)
    out = []
    for q, v in good:
        if asks(q):
            others = [(float(np.sqrt(((np.array(o) - np.array(v)) ** 2).sum())), i) for i, o in good if i != q]
            out += [(q, r, i, round(d, 9)) for r, (d, i) in enumerate(sorted(others)[:k], 1)]
    return out
