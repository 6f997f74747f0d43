"""The contracts of the queries, word for word and without any index."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def base_spans(text):
    patterns = [
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
    ]
    out = []
    for k, pattern in enumerate(patterns):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            double = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            ok = [
                True, k == 1 and all(int(p) <= 255 for p in m[0].split(".")),
                12 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in double) % 10 == 0,
                9 <= len(digits) <= 15,
            ][k]
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def personal(rows):
    for i, t in rows:
        spans = base_spans(t or "")
        text = ",".join(f"{('email', 'ip', 'card', 'phone')[k]}:{a}:{b}" for a, k, b in spans)
        yield (i, *(sum(s[1] == k for s in spans) for k in range(4)), sha(text))


def repeated_bytes(rows, window=200):
    docs = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[p : p + window] for _, b in docs for p in range(len(b) - window + 1))
    for i, b in docs:
        gone = bytearray(len(b))
        for p in range(len(b) - window + 1):
            if seen[b[p : p + window]] > 1:
                gone[p : p + window] = b"\1" * window
        kept = bytes(x for x, g in zip(b, gone) if not g)
        yield i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept)


def repeated_words(rows, window=35):
    docs = [(i, re.findall(WORD, t or "")) for i, t in rows]
    seen = Counter(tuple(w[p : p + window]) for _, w in docs for p in range(len(w) - window + 1))
    for i, w in docs:
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if seen[tuple(w[p : p + window])] > 1:
                gone[p : p + window] = [True] * window
        yield i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))


def token_ids(rows, encode):
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = encode(t or "") + [0]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def fingerprint(text, n=3):
    import xxhash

    words = re.findall(WORD, lower(text or ""))
    shingles = [" ".join(words[k : k + n]) for k in range(len(words) - n + 1)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, most=2):
    """The component of each distinct fingerprint, named by one of them."""
    parent = {f: f for f in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    known = sorted(parent)
    for i, a in enumerate(known):
        for b in known[i + 1 :]:
            if (a ^ b).bit_count() <= most:
                parent[find(a)] = find(b)
    return {f: find(f) for f in known}


def near_copies(rows):
    prints = [(i, fingerprint(t)) for i, t in rows]
    root = components({f for _, f in prints})
    least = defaultdict(list)
    for i, f in prints:
        if i is not None:
            least[root[f]].append(i)
    return [(i, f"{f:016x}", min(least[root[f]], default=None)) for i, f in prints]


def benchmark_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def overlaps(rows, items, window=13):
    windows = defaultdict(set)
    for i, t in items:
        w = benchmark_words(t)
        size = min(window, len(w))
        for p in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[p : p + size])].add("" if i is None else str(i))
    sizes = {len(w) for w in windows}
    for i, t in rows:
        w = benchmark_words(t)
        hit, found = [False] * len(w), set()
        for size in sizes:
            for p in range(len(w) - size + 1):
                of = windows.get(tuple(w[p : p + size]))
                if of:
                    found |= of
                    hit[p : p + size] = [True] * size
        n = sum(hit)
        yield i, len(w), n, len(found), sha(",".join(sorted(found))), n > 0 and 20 * n >= len(w)


def exact_copies(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[sha(re.sub(SPACE, " ", t or ""))].append(i)
    out = []
    for digest, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        left = 1
        for i in ids:
            kept = i == keep and left == 1
            left -= kept
            out.append((i, keep, len(ids), kept, digest))
    return out


# ------------------------------------------------------------------ languages

_FULL = (1 << 64) - 1


def _bucket(gram, buckets=1 << 16):
    """The bucket of an n-gram of bytes: its polynomial hash, spread, cut to the number of buckets."""
    x = (sum((b + 1) * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, b in enumerate(gram)) + len(gram)) & _FULL
    x = ((x ^ (x >> 31)) * 0x9E3779B97F4A7C15) & _FULL
    x = ((x ^ (x >> 29)) * 0xD6E8FEB86659FD93) & _FULL
    return (x ^ (x >> 32)) % buckets


def _grams(word, known):
    if word not in known:
        framed = b"\0" + word + b"\0"
        known[word] = [_bucket(framed[i : i + n]) for n in (1, 2, 3, 4) for i in range(len(framed) - n + 1)]
    return known[word]


def _folded_words(text):
    data = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    return re.findall(rb"[a-z\x80-\xff]+", data)


def _proportions(likely, times, share, rounds):
    for _ in range(rounds):
        joint = likely * share
        joint *= (times / joint.sum(1))[:, None]
        share = joint.sum(0) / times.sum()
    return share, float((times * np.log((likely * share).sum(1))).sum())


def languages(rows, held=1, folds=3):
    """For rows (id, text, lang): id, held out, predicted language and its proportion, one document after the other."""
    counts, known = {}, {}

    def out_of_sample(i):
        return i is not None and zlib.crc32(str(i).encode()) % folds == held

    for i, text, lang in rows:
        if lang is not None and text is not None and not out_of_sample(i):
            of_lang = counts.setdefault(lang, np.full(1 << 16, 0.5))
            for word in _folded_words(text):
                for b in _grams(word, known):
                    of_lang[b] += 1
    names = sorted(counts)
    shares = [np.log(counts[n] / counts[n].sum()) for n in names]
    found = []
    for i, text, _ in rows:
        words = Counter(_folded_words(text))
        if not names or not words or not any(c.isalpha() for c in text):
            found.append((i, out_of_sample(i), "und", 0.0))
            continue
        times = np.array(list(words.values()), float)
        logs = np.array([[sum(s[b] for b in _grams(w, known)) / 4 for s in shares] for w in words])
        likely = np.exp(np.maximum(logs - logs.max(1, keepdims=True), -200))
        share, reached = _proportions(likely, times, np.full(len(names), 1 / len(names)), 12)
        active = set(range(len(names)))
        while len(active) > 1:
            least = min(active, key=lambda k: (share[k], -k))
            tried = np.array([max(share[k], 1e-6) if k in active - {least} else 0.0 for k in range(len(names))])
            tried, gained = _proportions(likely, times, tried / tried.sum(), 6)
            if gained + 0.5 * np.log(times.sum() + 1) < reached:
                break
            share, reached = tried, gained
            active.remove(least)
        best = int(np.argmax(share))
        found.append((i, out_of_sample(i), names[best], min(float(share[best]), 1.0)))
    return found
