"""Brute-force helpers for the training-data tests."""


def brute_components(items, linked):
    """items: (id, value); the smallest id reachable from each item."""
    n = len(items)
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(items[i][1], items[j][1]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i in range(n):
        r = find(i)
        if items[i][0] is not None:
            least[r] = min(least.get(r, items[i][0]), items[i][0])
    return [least.get(find(i)) for i in range(n)]
