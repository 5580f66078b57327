"""Plain-Python counterparts of the operators, for small inputs."""

import re

import xxhash

WS = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in WS.split(text or "") if w]


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def simhash(text, k=3):
    w = words(ascii_lower(text))
    if not w:
        return 0
    sh = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def simhash_components(rows, bits=3):
    """rows of (doc_id, text) -> list of (doc_id, hex, component)."""
    fps = [simhash(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return [(d, f"{fps[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows)]
