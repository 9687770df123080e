"""Plain single-machine versions of the contract columns, straight from their definitions."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WHITE = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def letters(text):
    return LETTERS.findall((text or "").translate(UPPER))


def white(text):
    return WHITE.findall(text or "")


def op1(docs):
    phrases = [("mit", ["mit", "license"]), ("apache", ["apache", "license"]),
               ("gpl", ["general", "public", "license"])]
    for doc_id, text in docs:
        words = letters(text)
        places, found = [], set()
        for label, phrase in phrases:
            for i in range(len(words)):
                if words[i : i + len(phrase)] == phrase:
                    places.append(i)
                    found.add(label)
        yield (doc_id, len(words), len(places), min(places, default=None),
               max(places, default=None), ",".join(sorted(found)))


def op2(docs):
    for doc_id, text in docs:
        text = text or ""
        words = white(text)
        grams = Counter(zip(words, words[1:], words[2:]))
        covered = set()
        for i in range(len(words) - 2):
            if grams[tuple(words[i : i + 3])] > 1:
                covered |= {i, i + 1, i + 2}
        lines = [x for x in text.split("\n") if WHITE.search(x)]
        n, r = len(words), len(covered)
        yield (doc_id, n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
               len(lines) - len(set(lines)), r, n < 50 or 100 * r > 50 * n)


RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
         ("com/fr/", "allow"), ("com/de/", "block")]


def op3(pages):
    for page_id, url in pages:
        host = path = ""
        if url is not None and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.split(r"[/?#]", rest, maxsplit=1)[0].translate(UPPER)
            path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        fits = []
        for rule, verdict in RULES:
            h, p = rule.split("/", 1)
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
                fits.append((len(rule), rule, verdict))
        best = max(fits, default=(0, None, None))
        yield page_id, host, path, best[1], best[2]


def op4(docs, width=200):
    texts = [(d, (t or "").encode()) for d, t in docs]
    seen = Counter(t[i : i + width] for _, t in texts for i in range(len(t) - width + 1))
    for doc_id, t in texts:
        keep = bytearray(b"\1" * len(t))
        for i in range(len(t) - width + 1):
            if seen[t[i : i + width]] > 1:
                keep[i : i + width] = bytes(width)
        spans = sum(1 for i in range(len(t)) if not keep[i] and (i == 0 or keep[i - 1]))
        kept = bytes(c for c, k in zip(t, keep) if k)
        yield doc_id, len(t), len(t) - len(kept), spans, sha(kept)


def op5(docs, items, width=10):
    windows = defaultdict(set)
    for item_id, text in items:
        words = letters(text)
        for i in range(max(1, len(words) - width + 1) if words else 0):
            windows[tuple(words[i : i + width])].add(item_id)
    lengths = sorted({len(w) for w in windows})
    for doc_id, text in docs:
        words = letters(text)
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                items_ = windows.get(tuple(words[i : i + n]))
                if items_ is not None:
                    hit.update(range(i, i + n))
                    found |= {x for x in items_ if x is not None}
        listed = ",".join(sorted(map(str, found)))
        yield doc_id, len(words), len(hit), len(found), sha(listed), bool(hit)


def op7(docs):
    for doc_id, text in docs:
        raw = (text or "").encode()
        yield doc_id, len(raw) + 16, zlib.crc32(raw)


def shingles(text, width=3):
    words = WHITE.findall((text or "").translate(UPPER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def op8(docs, width=3, percent=85):
    docs = [(d, shingles(t, width)) for d, t in docs]
    parent = {d: d for d, _ in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for n, (_, s) in enumerate(docs):
        for x in s:
            holders[x].append(n)
    for n, (d, s) in enumerate(docs):
        shared = Counter(m for x in s for m in holders[x] if m < n)
        for m, both in shared.items():
            e, t = docs[m]
            if 100 * both >= percent * (len(s) + len(t) - both):
                a, b = root(d), root(e)
                parent[max(a, b)] = min(a, b)
    for d, s in docs:
        yield d, len(s), root(d), root(d) == d


def op10(docs, width=13):
    first = {}
    split = [(d, white(t)) for d, t in docs]
    for d, words in split:
        for i in range(len(words) - width + 1):
            w = tuple(words[i : i + width])
            first[w] = min(first.get(w, d), d)
    for d, words in split:
        gone = set()
        for i in range(len(words) - width + 1):
            if first[tuple(words[i : i + width])] < d:
                gone.update(range(i, i + width))
        kept = [w for i, w in enumerate(words) if i not in gone]
        yield d, len(words), len(gone), sha(" ".join(kept))
