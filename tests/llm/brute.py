"""Plain Python versions of the operators, written from their definitions."""

import hashlib
import math
import re
import struct
import zlib
from fractions import Fraction

import xxhash

SPACES = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(data):
    return hashlib.sha256(data).hexdigest()


def words(text):
    return re.findall(ALNUM, ascii_lower(text))


def near_items(text, items, window, slop):
    """Items with a window whose words all stand within ``slop`` of their places from some start."""
    own = words(text)
    found = set()
    for item, wanted in items:
        w = words(wanted)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            for start in range(-slop - n, len(own) + slop + 1):
                if all(w[i + k] in own[max(0, start + k - slop) : max(0, start + k + slop + 1)] for k in range(n)):
                    found.add(str(item))
    return sorted(found)


def contaminated(docs, items, window=13):
    words = lambda t: re.findall(ALNUM, ascii_lower(t))
    wanted = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            wanted.setdefault(tuple(w[i : i + n]), set()).add(str(item) if item is not None else "")
    lengths = {len(k) for k in wanted}
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (own := tuple(w[i : i + n])) in wanted:
                    hit.update(range(i, i + n))
                    found |= wanted[own]
        ids = sorted(found)
        out.append((doc, len(w), len(hit), len(ids), sha(",".join(ids).encode()), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def simhash(text):
    w = re.findall(SPACES, ascii_lower(text))
    runs = [w[i : i + 3] for i in range(len(w) - 2)] if len(w) >= 3 else [w] if w else []
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near(docs, distance=2):
    prints = [simhash(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                parent[root(i)] = root(j)
    names = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            names[root(i)] = min(doc, names.get(root(i), doc))
    return [(doc, f"{prints[i]:016x}", names.get(root(i))) for i, (doc, _) in enumerate(docs)]


def shards(docs, n=16):
    def shard(key, n):
        score = lambda s: int(hashlib.md5(f"{'' if key is None else key}:{s}".encode()).hexdigest()[:13], 16)
        return max(range(n), key=lambda s: (score(s), -s))

    return [
        (doc, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "key", shard(doc, n), shard(doc, n + 1))
        for doc, t in docs
    ]


def deduplicated(docs, window=13):
    first = {}
    split = [(doc, re.findall(SPACES, text or "")) for doc, text in docs]
    for doc, w in split:
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if doc is not None:
                first[key] = min(doc, first.get(key, doc))
    out = []
    for doc, w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if doc is not None and first[tuple(w[i : i + window])] < doc:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), sha(kept.encode())))
    return out


def scaled(rows, scale=256):
    """(vec_id, whole numbers) of the usable rows."""
    usable = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    size = max((len(v) for _, v in usable), default=0)
    return [(i, [math.floor(scale * c) for c in v]) for i, v in usable if len(v) == size]


def whitened(rows, k=4):
    """n, deviation by vec_id and the exact covariance matrix of the distinct vectors."""
    usable = scaled(rows)
    points = sorted({tuple(v) for _, v in usable})
    n, d = len(points), len(points[0])
    sums = [sum(p[i] for p in points) for i in range(d)]
    off = [[n * p[i] - sums[i] for i in range(d)] for p in points]
    cov = [[Fraction(sum(o[i] * o[j] for o in off), n**3) for j in range(d)] for i in range(d)]
    return n, [(i, sum((n * c - s) ** 2 for c, s in zip(v, sums))) for i, v in usable], cov


def prefix_nodes(rows):
    """Every prefix of the forked conversations, from rows of (conv_id, turn, role, text)."""
    own = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((role or "", text or ""))
    forks = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        forks[c] = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:])
    members = {}
    for c, turns in forks.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, own_members in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(own_members) - 1) * len(node[-1][1].encode()) if node else 0
    return [
        (
            min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children.get(node, [])), leaves[node], saved[node],
            sha(",".join(str(c) for c in sorted(m) if len(forks[c]) == len(node)).encode()),
        )
        for node, m in members.items()
    ]


def ids_bytes(ids):
    return b"".join(struct.pack("<I", i) for i in ids)


def base_quality(text):
    w = re.findall(SPACES, text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(SPACES, line):
            dup += line in seen
            seen.add(line)
    runs, repeat = {}, set()
    for i in range(len(w) - 2):
        runs.setdefault(tuple(w[i : i + 3]), []).append(i)
    for places in runs.values():
        if len(places) > 1:
            for i in places:
                repeat.update((i, i + 1, i + 2))
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(w) < 50 or 100 * len(repeat) > 50 * len(w)
    return len(w), sum(map(len, w)), symbols, dup, len(repeat), failed
