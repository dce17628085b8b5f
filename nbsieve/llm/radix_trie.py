"""Compressed radix trie (Patricia trie) of byte strings.

Every edge carries a run of bytes, so a trie of n strings has fewer than 2 n
nodes however long they are. A terminal node keeps the entries of its string.
The trie knows its approximate size and can give up its heaviest subtree.
"""

from __future__ import annotations

from collections.abc import Iterator

NODE_BYTES = 400            # objects of one node and its entry, besides the label


class Node:
    __slots__ = ("label", "children", "entries", "gone")

    def __init__(self, label: bytes):
        self.label = label
        self.children: dict[int, Node] = {}
        self.entries: list | None = None     # of a terminal
        self.gone = False                    # its subtree was given up


def _shared(label: bytes, key: bytes, at: int) -> int:
    """Length of the longest common prefix of ``label`` and ``key[at:]``."""
    low, high = 0, min(len(label), len(key) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if label[low:mid] == key[at + low:at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


class RadixTrie:
    def __init__(self):
        self.root = Node(b"")
        self.size = 0
        self.terminals = 0

    def entries(self, key: bytes) -> list | None:
        """The list kept at ``key``'s terminal node, made where there is none;
        None if the key lies in a subtree that was given up."""
        node, at = self.root, 0
        while True:
            if node.gone:
                return None
            if at == len(key):
                break
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = Node(key[at:])
                self.size += len(child.label) + NODE_BYTES
                node = child
                break
            if key.startswith(child.label, at):
                node = child
                at += len(child.label)
                continue
            n = _shared(child.label, key, at)
            middle = node.children[key[at]] = Node(child.label[:n])
            child.label = child.label[n:]
            middle.children[child.label[0]] = child
            self.size += NODE_BYTES
            node = middle
            at += n
        if node.entries is None:
            node.entries = []
            self.terminals += 1
        return node.entries

    def __iter__(self) -> Iterator[tuple[bytes, list]]:
        """(key, entries) of every terminal, in order of the keys."""
        return self._below(self.root, b"")

    @staticmethod
    def _below(top: Node, prefix: bytes) -> Iterator[tuple[bytes, list]]:
        waiting = [(top, prefix)]
        while waiting:
            node, key = waiting.pop()
            if node.entries is not None:
                yield key, node.entries
            for first in sorted(node.children, reverse=True):
                child = node.children[first]
                waiting.append((child, key + child.label))

    def _weights(self) -> dict[int, tuple[int, int]]:
        """(size, terminals) of the subtree of every node, by the node's id."""
        order, waiting = [], [self.root]
        while waiting:
            node = waiting.pop()
            order.append(node)
            waiting.extend(node.children.values())
        out = {}
        for node in reversed(order):
            below = [out[id(c)] for c in node.children.values()]
            out[id(node)] = (len(node.label) + NODE_BYTES + sum(b[0] for b in below),
                             (node.entries is not None) + sum(b[1] for b in below))
        return out

    def give_up(self, remember: bool) -> list[tuple[bytes, list]]:
        """Take out a heavy subtree of at most half of the trie, or one heavy
        terminal, and return its terminals; at least one terminal stays.
        With ``remember`` its place is marked, and later keys that belong
        there get None."""
        if self.terminals < 2:
            return []
        weights = self._weights()
        parent, node, prefix = None, self.root, b""
        while True:
            size, terminals = weights[id(node)]
            if parent and (terminals < 2 or (size <= self.size // 2 and terminals < self.terminals)):
                break
            parent, node = node, max((c for c in node.children.values() if weights[id(c)][1]),
                                     key=lambda c: weights[id(c)])
            prefix += node.label
        taken = list(self._below(node, prefix))
        self.terminals -= terminals
        if remember:
            node.children, node.entries, node.gone = {}, None, True
            self.size -= size - len(node.label) - NODE_BYTES
        else:
            del parent.children[node.label[0]]
            self.size -= size
        return taken
