"""Double-array tries over phrases of word numbers, built and walked with numpy.

A word number is spelled in bytes (as many as the largest number needs), so a node has at most 256 children. A
node is a slot; its child along byte ``c`` is slot ``base[node] + c``, and is one if ``check`` there names the
node. ``accept`` holds the number (from 1) of the phrase that ends in a slot, or 0.
"""

from __future__ import annotations

import numpy as np

#: Nodes with at least so many children are appended at the end; smaller ones go into gaps first.
WIDE = 32


def digits(numbers: np.ndarray, width: int) -> np.ndarray:
    """Big-endian bytes of ``numbers``: one row per number, ``width`` columns."""
    shifts = np.arange(width - 1, -1, -1) * 8
    return (numbers[:, None] >> shifts) & 255


class Slots:
    """Occupied slots, and where sets of children fit."""

    def __init__(self, room: int):
        self.taken = np.zeros(max(room, 1024), bool)
        self.taken[:256] = True  # slot 0 is the root; no base is negative
        self.end, self.hint = 256, 256

    def _grow(self, need: int) -> None:
        if need > len(self.taken):
            self.taken = np.concatenate([self.taken, np.zeros(max(need - len(self.taken), len(self.taken)), bool)])

    def fit(self, children: np.ndarray) -> int:
        """A base whose slots for these ascending bytes are all free; they are taken."""
        base = -1
        if len(children) < WIDE:
            free = self.hint + np.flatnonzero(~self.taken[self.hint:min(self.hint + 1024, self.end)])[:128]
            if len(free) < 16:  # nearly full here: go on further up
                self.hint = min(self.hint + 1024, self.end)
            if len(free):
                self._grow(self.end + 512)
                bases = free - children[0]
                good = np.flatnonzero(~self.taken[bases[:, None] + children].any(axis=1))
                if len(good):
                    base = int(bases[good[0]])
        if base < 0:
            self._grow(self.end + 512)
            base = self.end - int(children[0])
        self.taken[base + children] = True
        self.end = max(self.end, base + int(children[-1]) + 1)
        return base

    def fill(self, n: int) -> np.ndarray:
        """``n`` free slots, lowest first; they are taken."""
        free = 256 + np.flatnonzero(~self.taken[256:self.end])[:n]
        more = n - len(free)
        self._grow(self.end + more)
        out = np.concatenate([free, np.arange(self.end, self.end + more)])
        self.end += more
        self.taken[out] = True
        return out


def build(phrases: np.ndarray) -> dict:
    """Trie of the rows of ``phrases`` (different rows of positive word numbers, in ascending order)."""
    n, k = phrases.shape
    width = max(1, (int(phrases.max()).bit_length() + 7) // 8) if n else 1
    spelled = digits(phrases.reshape(-1), width).reshape(n, k * width)
    slots = Slots(4 * n)
    base = np.zeros(len(slots.taken), np.int32)
    check = np.full(len(slots.taken), -1, np.int32)
    parent_of_row, parents = np.zeros(n, np.int64), np.zeros(1, np.int64)  # node of each row, slot of each node
    new = np.zeros(n, bool)
    new[:1] = True
    for level in range(k * width):
        byte = spelled[:, level]
        new[1:] |= byte[1:] != byte[:-1]
        first = np.flatnonzero(new)
        own, symbol = parent_of_row[first], byte[first]  # of each child, in order of parent and byte
        bounds = np.searchsorted(own, np.arange(len(parents) + 1))
        fan = np.diff(bounds)
        bases = np.zeros(len(parents), np.int64)
        many = np.flatnonzero(fan > 1)
        for p in many[np.argsort(-fan[many], kind="stable")].tolist():
            bases[p] = slots.fit(symbol[bounds[p]:bounds[p + 1]])
        one = np.flatnonzero(fan == 1)
        bases[one] = slots.fill(len(one)) - symbol[bounds[one]]
        room = len(slots.taken) - len(base)
        if room > 0:
            base = np.concatenate([base, np.zeros(room, np.int32)])
            check = np.concatenate([check, np.full(room, -1, np.int32)])
        base[parents] = bases
        children = bases[own] + symbol
        check[children] = parents[own]
        parent_of_row, parents = np.cumsum(new) - 1, children
    accept = np.zeros(slots.end + 256, np.int32)
    if n:
        accept[parents[parent_of_row]] = np.arange(1, n + 1)
    beyond = np.full(256, -1, np.int32)  # a step from the last slots still reads a slot
    return {"base": base[:slots.end].copy(), "check": np.concatenate([check[:slots.end], beyond]),
            "accept": accept, "width": width, "words": k}


def walk(trie: dict, numbers: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(places, phrase numbers)`` of the ``places`` in ``numbers`` where a phrase of the trie begins.

    All places advance together, a byte at a time; those without a way on drop out. Word number 0 matches nothing.
    """
    base, check, width = trie["base"], trie["check"], trie["width"]
    state = np.zeros(len(places), np.int64)
    for word in range(trie["words"]):
        number = numbers[places + word]
        known = (number > 0) & (number < 1 << 8 * width)
        places, state, number = places[known], state[known], number[known]
        for byte in range(width - 1, -1, -1):
            to = base[state] + ((number >> 8 * byte) & 255)
            on = check[to] == state
            places, state, number = places[on], to[on], number[on]
    found = trie["accept"][state]
    hit = found > 0
    return places[hit], found[hit]
