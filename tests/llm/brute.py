"""Plain versions that the operators are held against, and rows with odd cases."""

import hashlib
import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def joined(ids, pairs):
    """Smallest id that each id reaches."""
    parent = {i: i for i in ids}
    for a, b in pairs:
        a, b = find(parent, a), find(parent, b)
        parent[max(a, b)] = min(a, b)
    return {i: find(parent, i) for i in ids}


def simhash(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(text)
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


ASSIGN = re.compile(
    r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def secrets(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    spans.sort()
    said = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)
    counts = [sum(s[1] == k for s in spans) for k in range(3)]
    return spans, (*counts, hashlib.sha256(said.encode()).hexdigest())


def documents(spark, texts, extra=()):
    """Documents with the given texts (ids from 0, ``lang`` and ``source`` null), and whole rows besides."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(i, t, None, None, None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, *extra], schema)
