"""Plain versions of what the operators compute, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter

WS = "[\x20\x09-\x0d]"


def words(text):
    return [w for w in re.split(WS + "+", text or "") if w]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def held(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n == 0


def secrets(text):
    text, found = text or "", []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end()))
    for k, pattern, least in ((1, "AKIA[A-Z0-9]+", 20), (2, "[0-9a-f]+", 24)):
        found += [(m.start(), k, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return sorted(found)


def spans(found):
    return ",".join(f"{('assign', 'access', 'hex', 'entropy')[k]}:{a}:{b}" for a, k, b in found)


def fingerprint(text, n=4):
    import xxhash

    w = words(lower(text or ""))
    if not w:
        return 0
    each = [" ".join(w[k : k + n]) for k in range(len(w) - n + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in each]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(prints, radius=4):
    """prints: id -> bits. id -> the least id that is reached."""
    up = {i: i for i in prints}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(prints)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = sorted((top(i), top(j)))
                up[b] = a
    return {i: top(i) for i in ids}


def kept_lines(docs):
    """docs: [(id, text)] with ids apart. id -> (lines, dropped, text left)."""
    key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    first, count = {}, Counter()
    for i, t in docs:
        for k in {key(x) for x in (t or "").split("\n")}:
            first[k] = min(first.get(k, i), i)
            count[k] += 1
    out = {}
    for i, t in docs:
        lines = (t or "").split("\n")
        left = [x for x in lines if len(key(x)) < 10 or count[key(x)] < 2 or first[key(x)] == i]
        out[i] = (len(lines), len(lines) - len(left), "\n".join(left))
    return out


def overlaps(text, item, window=13, least=0.8, min_words=5, verbatim_below=8):
    """(start, matched, window) of the best alignment of an item with a text, without seeds; None if there is none."""
    from math import ceil

    def split(t):
        return [w for w in re.sub(r"[\W_]+", " ", (t or "").lower()).split(" ") if w]

    w, b = split(text), split(item)
    if len(b) < min_words:
        return None
    size, best = min(window, len(b)), None
    for shift in range(-len(b) + 1, len(w)):
        same = [0 <= shift + j < len(w) and w[shift + j] == b[j] for j in range(len(b))]
        most = max(sum(same[j : j + size]) for j in range(len(b) - size + 1))
        if best is None or most > best[1]:
            best = (shift, most, size)
    need = len(b) if len(b) < verbatim_below else ceil(round(least * size, 9))
    return best if best and best[1] >= need else None


def metrics(text):
    """n_words, n_repeat_words, and whether the rules fail."""
    w = words(text)
    grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    many = Counter(grams)
    covered = {k + j for k, g in enumerate(grams) if many[g] > 1 for j in range(3)}
    return len(w), len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)


def rejected_hosts(rows, max_rate=0.8):
    """rows: (host, failed). The hosts whose rate, shrunk with a beta prior fitted by moments, is above max_rate."""
    by = {}
    for h, f in rows:
        n, k = by.get(h, (0, 0))
        by[h] = (n + 1, k + f)
    n, k = sum(x[0] for x in by.values()), sum(x[1] for x in by.values())
    mean, rates = k / n, [b / a for a, b in by.values()]
    m = sum(rates) / len(rates)
    extra = sum((r - m) ** 2 for r in rates) / len(rates) - mean * (1 - mean) * sum(1 / a for a, _ in by.values()) / len(by)
    weight = min(max(mean * (1 - mean) / extra - 1, 1.0), 1e4) if extra > 0 else 1e4
    return {h for h, (a, b) in by.items() if (b + mean * weight) / (a + weight) > max_rate}
