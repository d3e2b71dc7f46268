"""A compressed trie over whole texts, with the smallest id of equal texts at its terminals."""

from __future__ import annotations

from collections.abc import Iterator


class Terminal:
    """End of a text: its smallest id and the rows that hold it."""

    __slots__ = ("least", "rows")

    def __init__(self) -> None:
        self.least: int | None = None
        self.rows: list[int] = []


class _Node:
    __slots__ = ("edge", "below", "end")

    def __init__(self, edge: bytes) -> None:
        self.edge = edge
        self.below: dict[int, _Node] = {}
        self.end: Terminal | None = None


def _shared(a: bytes, b: bytes, start: int) -> int:
    """How many leading bytes of ``a`` are those of ``b`` from ``start`` on, by halving."""
    low, high = 0, min(len(a), len(b) - start)
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[start + low : start + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class RadixTrie:
    """Every edge is as long as no text branches off it, so a path has at most as many nodes
    as texts that share a part of it."""

    def __init__(self) -> None:
        self.root = _Node(b"")

    def insert(self, text: bytes, key: int | None, row: int) -> Terminal:
        """The terminal of ``text``, with this row added."""
        node, at = self.root, 0
        while at < len(text):
            child = node.below.get(text[at])
            if child is None:
                child = node.below[text[at]] = _Node(text[at:])
                at = len(text)
            elif text.startswith(child.edge, at):
                at += len(child.edge)
            else:
                shared = _shared(child.edge, text, at)
                upper = _Node(child.edge[:shared])
                child.edge = child.edge[shared:]
                upper.below[child.edge[0]] = child
                node.below[text[at]] = upper
                child, at = upper, at + shared
            node = child
        if node.end is None:
            node.end = Terminal()
        end = node.end
        end.rows.append(row)
        if key is not None and (end.least is None or key < end.least):
            end.least = key
        return end

    def terminals(self) -> Iterator[Terminal]:
        """All terminals, from a walk without recursion."""
        waiting = [self.root]
        while waiting:
            node = waiting.pop()
            if node.end is not None:
                yield node.end
            waiting.extend(node.below.values())
