"""Deep-shallow sorting of suffixes: multikey quicksort to a shallow depth, then blind tries."""

from __future__ import annotations

from collections.abc import Iterator

#: Bytes that multikey quicksort compares at once, and the depth at which blind tries take over.
STEP, SHALLOW = 8, 64


def lcp(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix; `start` bytes are known to agree."""
    high = min(len(a), len(b))
    if a[start:high] == b[start:high]:
        return high
    low, step = start, 16
    while a[low : low + step] == b[low : low + step]:
        low += step
        step *= 2
    high = min(high, low + step)
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def blind_trie(strings: list[bytes], items: list[int], depth: int) -> list[int]:
    """items in order of their strings, which agree up to `depth`.

    An inner node is [depth, {byte: child}], -1 standing for a string's end; a leaf is a list of equal strings'
    items under a None depth. A string descends by its branching bytes alone to some leaf, one comparison with
    that leaf gives the common prefix, and the string enters where that prefix ends.
    """
    root = [None, [items[0]]]
    for item in items[1:]:
        s = strings[item]
        n = len(s)
        node = root
        while node[0] is not None:
            children = node[1]
            node = children.get(s[node[0]] if node[0] < n else -1) or next(iter(children.values()))
        other = strings[node[1][0]]
        shared = lcp(s, other, depth)
        if shared == n == len(other):
            node[1].append(item)
            continue
        mine, theirs = s[shared] if shared < n else -1, other[shared] if shared < len(other) else -1
        parent, node = None, root
        while node[0] is not None and node[0] < shared:
            parent, node = node, node[1][s[node[0]]]
        if node[0] == shared:
            node[1][mine] = [None, [item]]
            continue
        split = [shared, {theirs: node, mine: [None, [item]]}]
        if parent is None:
            root = split
        else:
            parent[1][s[parent[0]]] = split
    out, stack = [], [root]
    while stack:
        at, held = stack.pop()
        if at is None:
            out += held
        else:
            stack += [held[c] for c in sorted(held, reverse=True)]
    return out


def deep_shallow(strings: list[bytes], shallow: int = SHALLOW) -> list[int]:
    """Indices of strings in lexicographic order; equal strings in any order."""
    out: list[int] = []
    stack: list[tuple[list[int], int]] = [(list(range(len(strings))), 0)]
    while stack:
        items, depth = stack.pop()
        if len(items) < 2:
            out += items
            continue
        if depth >= shallow:
            out += blind_trie(strings, items, depth)
            continue
        pivot = strings[items[len(items) // 2]][depth : depth + STEP]
        less, same, more = [], [], []
        for i in items:
            key = strings[i][depth : depth + STEP]
            (same if key == pivot else less if key < pivot else more).append(i)
        stack.append((more, depth))
        if len(pivot) < STEP:  # the strings end here and are equal
            stack += [([i], depth) for i in same]
        else:
            stack.append((same, depth + STEP))
        stack.append((less, depth))
    return out


def nodes(heights: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of the inner nodes of at least depth `least` of the trie over sorted strings,
    deepest first along each path; heights[i] is the common prefix of the strings i and i+1."""
    stack: list[tuple[int, int]] = []  # (depth, first string)
    for i, h in enumerate([*heights, -1]):
        first = i
        while stack and stack[-1][0] > h:
            depth, first = stack.pop()
            if depth >= least:
                yield depth, first, i
        if not stack or stack[-1][0] < h:
            stack.append((h, first))
