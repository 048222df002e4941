"""Plain-Python versions of the operators' contracts, for small inputs."""

import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def components(nodes, links):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    least = {}
    for x in nodes:
        r = find(x)
        least[r] = min(least.get(r, x), x)
    return {x: least[find(x)] for x in nodes}


def shingle_set(text, n):
    words = WORDS.findall(lower_ascii(text or ""))
    if not words:
        return set()
    if len(words) < n:
        return {tuple(words)}
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def jaccard_components(docs, n=4, num=85, den=100):
    """docs: {id: text}; returns {id: (set size, component)}."""
    sets = {i: shingle_set(t, n) for i, t in docs.items()}
    where = {}
    for i, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(i)
    seen, links = set(), []
    for ids in where.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1:]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    both = len(sets[a] & sets[b])
                    if den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                        links.append((a, b))
    comp = components(list(docs), links)
    return {i: (len(sets[i]), comp[i]) for i in docs}
