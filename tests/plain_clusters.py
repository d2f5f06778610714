"""Measures of clusters of a graph."""

from collections import defaultdict


def modularity(edges, label, resolution=1.0):
    """Of undirected weighed edges; a loop counts for both of its ends."""
    degree, inside, total = defaultdict(float), 0.0, 0.0
    for a, b, w in edges:
        degree[a] += w
        degree[b] += w
        total += 2 * w
        inside += 2 * w * (label[a] == label[b])
    mass = defaultdict(float)
    for x, d in degree.items():
        mass[label[x]] += d
    return inside / total - resolution * sum(m * m for m in mass.values()) / total**2


def connected(edges, label):
    """Whether every cluster hangs together by its own edges."""
    up = {x: x for x in label}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b, _ in edges:
        if label[a] == label[b]:
            up[top(a)] = top(b)
    return len({top(x) for x in label}) == len(set(label.values()))
