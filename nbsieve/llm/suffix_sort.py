"""Deep-shallow sorting of short strings: multikey quicksort over the first
bytes, blind tries for the groups whose common prefix is longer.

Strings come in groups that are ordered apart. The shallow phase works on
eight-byte words of all strings at once: every open segment takes a pivot
word, all strings are split three ways against their segment's pivot, and the
equal part moves on to the next word. Segments still open at the shallow depth
share a long prefix; comparing them word by word again would repeat that
prefix, so a blind trie orders each: it stores branching depths and bytes
only, and one string comparison per insertion corrects the blind descent.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 64    # bytes the quicksort looks at
WORD = 8

_U = np.uint64


def as_words(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(big-endian words, zero-padded; lengths)."""
    lengths = np.array([len(s) for s in strings], dtype=np.int64)
    width = max(1, -(-int(lengths.max(initial=1)) // WORD))
    flat = np.frombuffer(b"".join(s.ljust(width * WORD, b"\0") for s in strings), dtype=">u8")
    return flat.astype(_U).reshape(len(strings), width), lengths


def _shallow(words: np.ndarray, group: np.ndarray, depth_words: int):
    """(order, segment of each place): strings ordered by group and by their
    first words; strings of one segment agree in all of these."""
    n = len(group)
    order = np.argsort(group, kind="stable")
    cut = np.ones(n, dtype=bool)                 # places where a segment begins
    cut[1:] = group[order][1:] != group[order][:-1]
    depth = np.zeros(n, dtype=np.int64)          # words on which a place's segment agrees
    while True:
        segment = np.cumsum(cut) - 1
        sizes = np.bincount(segment)
        at = np.flatnonzero((sizes[segment] > 1) & (depth < depth_words))
        if not len(at):
            return order, segment
        seg, rank = np.unique(segment[at], return_inverse=True)
        begins = np.flatnonzero(cut)[seg]
        key = words[order[at], depth[at]]
        middle = begins + sizes[seg] // 2
        pivot = words[order[middle], depth[middle]]
        side = np.where(key < pivot[rank], 0, np.where(key == pivot[rank], 1, 2))
        move = np.argsort(rank * 3 + side, kind="stable")
        order[at] = order[at[move]]
        side, part = side[move], (rank * 3 + side)[move]
        new = np.ones(len(at), dtype=bool)
        new[1:] = part[1:] != part[:-1]
        cut[at] |= new
        depth[at] += side == 1


def _lcp(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


class BlindTrie:
    """Compacted trie of branching depths and bytes. A node is
    [depth, {byte: node}], a leaf (string number, ...) of equal strings; the
    end of a string branches as byte -1."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root = None

    def insert(self, i: int) -> None:
        s = self.strings[i]
        if self.root is None:
            self.root = [i]
            return
        node = self.root
        while type(node) is tuple:                # blind: look at branching bytes only
            d, kids = node
            c = s[d] if d < len(s) else -1
            node = kids[c] if c in kids else next(iter(kids.values()))
        t = self.strings[node[0]]
        if s == t:
            node.append(i)
            return
        common = _lcp(s, t)
        parent, byte, node = None, -2, self.root
        while type(node) is tuple and node[0] < common:
            parent, byte = node, s[node[0]] if node[0] < len(s) else -1
            node = parent[1][byte]
        mine = s[common] if common < len(s) else -1
        if type(node) is tuple and node[0] == common:
            node[1][mine] = [i]
            return
        theirs = t[common] if common < len(t) else -1
        split = (common, {theirs: node, mine: [i]})
        if parent is None:
            self.root = split
        else:
            parent[1][byte] = split

    def ordered(self) -> list[int]:
        out, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if type(node) is tuple:
                stack.extend(node[1][c] for c in sorted(node[1], reverse=True))
            else:
                out.extend(node)
        return out


def deep_shallow(strings: list[bytes], group: np.ndarray, shallow: int = SHALLOW):
    """(order, lcp): the strings' numbers in order of (group, string), and the
    common prefix of each with the one before it (0 where a group begins)."""
    n = len(strings)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    words, lengths = as_words(strings)
    order, segment = _shallow(words, group, min(words.shape[1], shallow // WORD))
    sizes = np.bincount(segment)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    for k in np.flatnonzero(sizes > 1).tolist():
        lo, hi = int(begins[k]), int(begins[k + 1])
        trie = BlindTrie(strings)
        for i in order[lo:hi].tolist():
            trie.insert(i)
        order[lo:hi] = trie.ordered()

    lcp = np.zeros(n, dtype=np.int64)
    for lo in range(1, n, 8192):
        a, b = order[lo - 1: min(lo + 8192, n) - 1], order[lo: lo + 8192]
        diff = words[a] ^ words[b]
        differs = diff != 0
        first = differs.argmax(axis=1)
        x = diff[np.arange(len(a)), first]
        high = np.zeros(len(x), dtype=np.int64)   # leading equal bytes of that word
        for shift in range(WORD):
            high += (x >> _U(8 * (WORD - 1 - shift))) == 0
        common = np.where(differs.any(axis=1), first * WORD + high, words.shape[1] * WORD)
        lcp[lo: lo + 8192] = np.where(group[a] == group[b], np.minimum(
            common, np.minimum(lengths[a], lengths[b])), 0)
    return order, lcp
