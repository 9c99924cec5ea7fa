"""Deep-shallow sorting of byte strings: multikey quicksort to a shallow depth, blind tries below it.

``deep_shallow(strings)`` returns the sorted order and the common prefix length of each string with its
predecessor. A string that is a prefix of another comes first; equal strings keep the order of their indices.
"""

from __future__ import annotations

SHALLOW = 32    # bytes that multikey quicksort looks at
SMALL = 24      # groups up to this size go to a blind trie at once


def common_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, given that the first ``start`` bytes agree."""
    n = min(len(a), len(b))
    while start < n:
        m = min(n, start + 512)
        x, y = a[start:m], b[start:m]
        if x != y:
            d = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
            return m - (d.bit_length() + 7) // 8
        start = m
    return n


def blind_trie(strings: list[bytes], members: list[int], depth: int) -> tuple[list[int], list[int]]:
    """Sorted ``members`` (all agree in ``depth`` bytes) and their common prefix lengths, the first one's ``depth``.

    A node is [depth, {byte: child}], -1 standing for the end of a string; a leaf is the list of equal strings. A
    string goes down by branching bytes alone, is compared once with the leaf it reaches, and is put in where it
    leaves the path.
    """
    root: list = [members[0]]   # a leaf
    for i in members[1:]:
        s = strings[i]
        node = root
        while type(node[-1]) is dict:
            d, kids = node
            kid = kids.get(s[d] if d < len(s) else -1)
            node = next(iter(kids.values())) if kid is None else kid
        other = strings[node[0]]
        split = common_prefix(s, other, depth)
        if split == len(s) == len(other):
            node.append(i)
            continue
        mine, its = (s[split] if split < len(s) else -1), (other[split] if split < len(other) else -1)
        up, node = None, root
        while type(node[-1]) is dict and node[0] < split:
            up, key = node, s[node[0]]
            node = node[1][key]
        if type(node[-1]) is dict and node[0] == split:
            node[1][mine] = [i]
            continue
        new = [split, {mine: [i], its: node}]
        if up is None:
            root = new
        else:
            up[1][key] = new
    order: list[int] = []
    lcp: list[int] = []
    stack: list[tuple[list, int]] = [(root, depth)]
    while stack:
        node, shared = stack.pop()
        if type(node[-1]) is dict:
            d, kids = node
            keys = sorted(kids, reverse=True)
            stack.extend((kids[k], d) for k in keys[:-1])
            stack.append((kids[keys[-1]], shared))
        else:
            order.extend(node)
            lcp.append(shared)
            lcp.extend([len(strings[node[0]])] * (len(node) - 1))
    return order, lcp


def deep_shallow(strings: list[bytes], depth: int = 0) -> tuple[list[int], list[int]]:
    """``depth``: bytes in which all strings are known to agree."""
    limit = depth + SHALLOW
    order: list[int] = []
    lcp: list[int] = []
    # multikey quicksort: (members, depth up to which they agree, common prefix with what is before them)
    stack = [(list(range(len(strings))), depth, depth)]
    while stack:
        group, d, shared = stack.pop()
        if not group:
            continue
        if len(group) <= SMALL or d >= limit:
            o, c = blind_trie(strings, group, d) if len(group) > 1 else (group, [d])
            order += o
            lcp += [shared, *c[1:]]
            continue
        at = [strings[i][d] if d < len(strings[i]) else -1 for i in group]
        pivot = sorted(at[:: max(1, len(at) // 9)])[min(4, (len(at) - 1) // 2)]
        less = [i for i, x in zip(group, at) if x < pivot]
        same = [i for i, x in zip(group, at) if x == pivot]
        more = [i for i, x in zip(group, at) if x > pivot]
        stack.append((more, d, d))
        if pivot < 0:    # these end here, so they are equal
            order_same, lcp_same = same, [d] * len(same)
            if less:
                raise AssertionError("nothing sorts before an end")
            order += order_same
            lcp += [shared, *lcp_same[1:]]
        else:
            stack.append((same, d + 1, d if less else shared))
            stack.append((less, d, shared))
    return order, lcp
