"""Plain reference computations for small tables."""

from collections import Counter

import numpy as np


class Groups:
    """Connected components with the smallest member as name."""

    def __init__(self, nodes):
        self.parent = {node: node for node in nodes}

    def root(self, node):
        while self.parent[node] != node:
            node = self.parent[node]
        return node

    def link(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


def shingles(text):
    words = (text or "").lower().split()
    width = min(5, len(words))
    return Counter(tuple(words[i : i + width]) for i in range(len(words) - width + 1)) if words else Counter()


def overlap(a, b):
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 0.0


def cosine(a, b):
    a, b = np.asarray(a, dtype=float), np.asarray(b, dtype=float)
    return float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))
