"""A compressed trie over byte strings: every edge carries a run of bytes, every whole string ends at a node."""

from __future__ import annotations

from collections.abc import Iterator


class Node:
    __slots__ = ("label", "children", "value")

    def __init__(self, label: bytes):
        self.label, self.children, self.value = label, {}, None


def _shared(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of ``a`` and ``b[at:]``, by halving."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class RadixTrie:
    """Maps byte strings to values. Memory: the bytes of the distinct strings, shared prefixes once."""

    def __init__(self):
        self.root = Node(b"")

    def node(self, text: bytes) -> Node:
        """The node at which ``text`` ends, made if it is new (its ``value`` is then None)."""
        here, at = self.root, 0
        while at < len(text):
            child = here.children.get(text[at])
            if child is None:
                child = here.children[text[at]] = Node(text[at:])
                return child
            if text.startswith(child.label, at):
                here, at = child, at + len(child.label)
                continue
            # Part the edge where the two strings part.
            size = _shared(child.label, text, at)
            middle = Node(child.label[:size])
            here.children[text[at]] = middle
            child.label = child.label[size:]
            middle.children[child.label[0]] = child
            here, at = middle, at + size
        return here

    def terminals(self) -> Iterator[Node]:
        """Every node at which a string ends, in no particular order."""
        waiting = [self.root]
        while waiting:
            node = waiting.pop()
            if node.value is not None:
                yield node
            waiting.extend(node.children.values())
