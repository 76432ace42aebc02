"""Words of UTF-8 texts as numpy and Arrow arrays: cut by a table of bytes, numbered by their exact spelling."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa

#: Kinds of bytes: part of a word, a gap between words, the end of a piece (no phrase goes across it).
WORD, GAP, END = 0, 1, 2

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_kinds(gaps: bytes, ends: bytes) -> np.ndarray:
    """Kind of each byte: all bytes not named are parts of words (bytes of non-ASCII characters always are)."""
    kinds = np.zeros(256, np.uint8)
    kinds[list(gaps)] = GAP
    kinds[list(ends)] = END
    return kinds


class Cut:
    """The words of ``data`` with A-Z lowered.

    ``words``: different words (binary array); ``ids``: number of each occurrence's word, in text order;
    ``starts``: where each occurrence begins; ``kinds``: kind of each byte.
    """

    def __init__(self, data: bytes, kinds: np.ndarray):
        low = _LOWER[np.frombuffer(data, np.uint8)]
        self.kinds = kinds[low]
        inside = self.kinds == WORD
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        self.starts, stops = edges[::2], edges[1::2]
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(stops - self.starts)])
        wide = ends[-1] >= 1 << 31
        kind, ends = (pa.large_binary(), ends) if wide else (pa.binary(), ends.astype(np.int32))
        coded = pa.Array.from_buffers(kind, len(self.starts), [None, pa.py_buffer(ends), pa.py_buffer(low[inside])]).dictionary_encode()
        self.words = coded.dictionary.cast(pa.binary())
        self.ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)

    def with_ends(self) -> np.ndarray:
        """Word numbers from 1 in text order, with a 0 wherever a piece ends between two words."""
        if not len(self.starts):
            return np.zeros(0, np.int32)
        ends_before = np.cumsum(self.kinds == END, dtype=np.int64)[self.starts]
        breaks = np.diff(ends_before, prepend=ends_before[0]) > 0
        out = np.zeros(len(self.ids) + int(breaks.sum()), np.int32)
        out[np.arange(len(self.ids)) + np.cumsum(breaks)] = self.ids + 1
        return out

    def counts(self) -> np.ndarray:
        return np.bincount(self.ids, minlength=len(self.words))


def slices(text: bytes, size: int, ends: re.Pattern):
    """``text`` in slices of about ``size`` bytes that stop at a match of ``ends``; without one it stays whole."""
    at = 0
    while len(text) - at > size:
        stop = ends.search(text, at + size)
        if not stop:
            break
        yield text[at:stop.end()]
        at = stop.end()
    yield text[at:]


def gathered(batches, key_of, size: int, held: int, ends: re.Pattern | None = None):
    """``(key, texts)`` of about ``size`` bytes together from Arrow batches with a ``text`` column.

    ``key_of(batch)`` lists each row's key. At most about ``held`` bytes of text wait at any time. With ``ends``, a
    text longer than ``size`` comes in slices that stop at a match; else every text is whole.
    """
    waiting, sizes, total = {}, {}, 0
    for b in batches:
        texts = b["text"].cast(pa.binary())
        for i, key in enumerate(key_of(b)):
            text = texts[i].as_py() or b""
            for piece in slices(text, size, ends) if ends else (text,):
                waiting.setdefault(key, []).append(piece)
                sizes[key] = sizes.get(key, 0) + len(piece) + 1
                total += len(piece) + 1
                if sizes[key] >= size:
                    total -= sizes.pop(key)
                    yield key, waiting.pop(key)
            if total >= held:  # the largest go, down to half; small ones wait for more of theirs
                for k in sorted(sizes, key=sizes.get, reverse=True):
                    if total < held // 2:
                        break
                    total -= sizes.pop(k)
                    yield k, waiting.pop(k)
    yield from waiting.items()
