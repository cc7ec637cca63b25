"""Plain Python versions of the operators, for small tables."""

import hashlib
import re

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NON_SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def decontaminate(docs, items, size=13):
    windows = {}
    for item, text in items:
        w = ALNUM.findall(lower(text))
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add(str(item))
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w = ALNUM.findall(lower(text))
        hit, found = set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[k : k + n]))) is not None:
                    hit.update(range(k, k + n))
                    found |= own
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return out


def licence_places(docs, base):
    out = []
    for doc, text in docs:
        w = ALNUM.findall(lower(text))
        found = [(k, label) for p, label in base.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        at = [k for k, _ in found]
        labels = ",".join(sorted({x for _, x in found}))
        out.append((doc, len(w), len(found), min(at, default=None), max(at, default=None), labels))
    return out


def near_duplicates(docs, part=85, whole=100, size=3):
    sets, owners = {}, {}
    for doc, text in docs:
        w = NON_SPACE.findall(lower(text))
        s = frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()
        sets.setdefault(doc, []).append(s)
        if doc is not None:
            for x in s:
                owners.setdefault(x, set()).add(doc)
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for doc in sets:
        near = set()
        for s in sets[doc]:
            for x in s:
                near |= owners.get(x, set()) if doc is not None else set()
        for other in near - {doc}:
            for s in sets[doc]:
                for t in sets[other]:
                    common = len(s & t)
                    if s and whole * common >= part * (len(s) + len(t) - common):
                        a, b = find(doc), find(other)
                        root[max(a, b)] = min(a, b)
    out = []
    for doc, own in sets.items():
        for s in own:
            comp = find(doc) if doc is not None else None
            out.append((doc, len(s), comp, doc is None or comp == doc))
    return out


def repeated_substrings(docs, length=200):
    seen = {}
    texts = [(doc, (text or "").encode()) for doc, text in docs]
    for _, t in texts:
        for k in range(len(t) - length + 1):
            s = hash(t[k : k + length])
            seen[s] = seen.get(s, 0) + 1
    out = []
    for doc, t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if seen[hash(t[k : k + length])] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((doc, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out
