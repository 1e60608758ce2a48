"""What operators should give, text by text in plain Python, from the weights they learnt."""

import math
import re

import xxhash


def noisy_or(model, text):
    """Toxicity: one less the product of the sentences' chances to be clean."""
    clean = 1.0
    for s in [s for s in re.split(r"[.!?\n]+", (text or "").lower()) if re.search(r"[^\W\d_]", s)] or [""]:
        z = model.bias
        for w in re.findall(r"[^\W\d_]+", s):
            z += sum(model.weights.get(f, 0.0) for f in [w] + [w[:k] + "-" for k in range(3, 7) if k < len(w)])
        clean *= 1 - 1 / (1 + math.exp(-z))
    return 1 - clean


def bins_of(model, x):
    """Quality: the bin of each feature of a description."""
    size = model.edges.shape[1] + 1
    return [i * size + sum(1 for e in model.edges[i].tolist() if e <= x[i]) for i in range(len(x))]


def quality(model, x):
    return 1 / (1 + math.exp(-4 * (model.bias + sum(model.weights[b] for b in bins_of(model, x)))))


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def classes(n, linked):
    """Of each of n items, the smallest one reachable over links."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
