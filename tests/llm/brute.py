"""Plain versions that the operators are held against."""

import re
from collections import Counter, defaultdict

import xxhash


def simhash(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    """Smallest reachable index of each node."""
    root = list(range(len(nodes)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(nodes)):
        for j in range(i):
            if linked(nodes[i], nodes[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(nodes))]


def line_dedup(docs, min_docs=3, least=20):
    """docs: list of (doc_id, text) with distinct ids -> {doc_id: kept text}."""
    def key(line):
        line = line.strip(" \t\n\x0b\x0c\r")
        return re.sub("[A-Z]", lambda m: m.group().lower(), line)

    holders = defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least:
                holders[key(line)].add(i)
    keeper = {k: max(v) for k, v in holders.items() if len(v) >= min_docs}
    return {i: "\n".join(x for x in (t or "").split("\n") if keeper.get(key(x), i) == i) for i, t in docs}


def contained(text, items, size=5, least=0.8):
    """Item ids with a window of the item's size at the least similarity."""
    words = re.findall(r"\w+", (text or "").lower())

    def shingles(w):
        k = min(size, len(w))
        return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else Counter()

    out = {}
    for item_id, item in items:
        own = re.findall(r"\w+", (item or "").lower())
        if not own or not words:
            continue
        k, a = min(size, len(own)), shingles(own)
        for s in range(max(1, len(words) - len(own) + 1)):
            window = words[s:s + len(own)]
            b = Counter(tuple(window[i:i + k]) for i in range(len(window) - k + 1))
            similarity = sum((a & b).values()) / max(1, sum((a | b).values()))
            if similarity >= least and similarity > out.get(item_id, 0):
                out[item_id] = similarity
    return out
