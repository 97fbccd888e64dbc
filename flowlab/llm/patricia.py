"""A compressed radix (Patricia) trie over byte strings whose terminal nodes keep the smallest
identifier and the number of copies, with spill by subtree when it outgrows its memory."""

from __future__ import annotations

import pickle
import tempfile


class _Node:
    __slots__ = ("label", "children", "owner", "copies")

    def __init__(self, label: bytes):
        self.label, self.children, self.owner, self.copies = label, {}, None, 0


def common_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix of ``a`` and ``b[start:]`` by halving."""
    lo, hi = 0, min(len(a), len(b) - start)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if b.startswith(a[lo:mid], start + lo):
            lo = mid
        else:
            hi = mid - 1
    return lo


def smallest(a, b):
    """The smaller identifier; null counts as larger than any."""
    return b if a is None else a if b is None else min(a, b)


class PatriciaOwners:
    """Insert (text, identifier, copies); read (text, smallest identifier, copies) for each
    distinct text. When the labels held exceed ``max_bytes`` the largest subtree below the
    branching byte goes to a file of this task, later inserts under that byte follow it, and
    the files are read back one subtree at a time."""

    def __init__(self, max_bytes: int = 256 << 20, branch: int = 0):
        self.max_bytes, self.branch = max_bytes, branch   # branch: position of the byte that names a subtree
        self.roots: dict[int, _Node] = {}                 # -1: texts that end before the branching byte
        self.sizes: dict[int, int] = {}
        self.files: dict[int, object] = {}
        self.held = 0

    def insert(self, text: bytes, owner, copies: int = 1) -> None:
        top = text[self.branch] if len(text) > self.branch else -1
        if top in self.files:
            pickle.dump((text, owner, copies), self.files[top])
            return
        node = self.roots.get(top)
        if node is None:
            node = self.roots[top] = _Node(b"")
            self.sizes[top] = 0
        pos = added = 0
        while pos < len(text):
            child = node.children.get(text[pos])
            if child is None:
                child = _Node(text[pos:])
                node.children[text[pos]] = child
                added, pos = len(child.label) + 200, len(text)
            elif text.startswith(child.label, pos):
                pos += len(child.label)
            else:                                          # split the edge where the texts part
                k = common_prefix(child.label, text, pos)
                upper = _Node(child.label[:k])
                child.label = child.label[k:]
                upper.children[child.label[0]] = child
                node.children[text[pos]] = upper
                child, pos = upper, pos + k
            node = child
        node.owner, node.copies = smallest(node.owner, owner), node.copies + copies
        if added:
            self.sizes[top] += added
            self.held += added
            if self.held > self.max_bytes:
                self._spill(max(self.sizes, key=self.sizes.get))

    def _spill(self, top: int) -> None:
        f = self.files[top] = tempfile.TemporaryFile()
        for record in self._terminals(self.roots.pop(top)):
            pickle.dump(record, f)
        self.held -= self.sizes.pop(top)

    @staticmethod
    def _terminals(root: _Node):
        stack = [(root, b"")]
        while stack:
            node, above = stack.pop()
            path = above + node.label
            if node.copies:
                yield path, node.owner, node.copies
            stack.extend((child, path) for child in node.children.values())

    def _records(self, f):
        f.seek(0)
        while True:
            try:
                yield pickle.load(f)
            except EOFError:
                return

    def items(self):
        """(text, owner, copies) of every distinct text, resident subtrees first."""
        for top in list(self.roots):
            yield from self._terminals(self.roots.pop(top))
        for top in list(self.files):
            f = self.files.pop(top)
            f.flush()
            first = shared = None
            one = True                                     # one distinct text: no subtree to cut further
            owner, copies = None, 0
            for text, o, c in self._records(f):
                if first is None:
                    first, shared = text, len(text)
                one = one and text == first
                shared = common_prefix(first[:shared], text)
                owner, copies = smallest(owner, o), copies + c
            if one:
                yield first, owner, copies
            else:                                          # these texts part right after their shared bytes
                below = PatriciaOwners(self.max_bytes, shared)
                for record in self._records(f):
                    below.insert(*record)
                yield from below.items()
            f.close()
