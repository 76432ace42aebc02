"""Texts as numpy arrays of code points, in chunks of bounded size."""

from __future__ import annotations

import functools

import numpy as np

#: Code points handled at a time.
CHUNK = 1 << 19


@functools.cache
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _slices(text: str):
    """A text in slices of about ``CHUNK`` code points that end at white space if there is any."""
    at = 0
    while True:
        end = at + CHUNK
        if end < len(text):
            end = next((e for e in (text.find(" ", end), text.find("\n", end)) if e >= 0), len(text))
        yield text[at:end]
        if end >= len(text):
            return
        at = end


def chunks(texts):
    """``(rows, code points, row number of each, last)`` over lower-cased texts, null as empty.

    A chunk holds texts up to ``CHUNK`` code points together, or one slice of a longer text; ``rows`` are the
    positions of its texts, and the row numbers count within them. Every text ends with a space. ``last``
    is false while a long text goes on in the next chunk.
    """
    rows, parts, size = [], [], 0
    for i, t in enumerate(texts):
        t = (t or "").lower()
        if size and size + len(t) > CHUNK:
            yield _chunk(rows, parts, True)
            rows, parts, size = [], [], 0
        if len(t) > CHUNK:
            pieces = list(_slices(t))
            for k, piece in enumerate(pieces):
                yield _chunk([i], [piece], k == len(pieces) - 1)
            continue
        rows.append(i)
        parts.append(t)
        size += len(t) + 1
    if rows:
        yield _chunk(rows, parts, True)


def _chunk(rows, parts, last):
    lengths = np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts))
    points = np.frombuffer((" ".join(parts) + " ").encode("utf-32-le", "surrogatepass"), "<u4")
    return np.array(rows), points, np.repeat(np.arange(len(parts)), lengths), last


@functools.cache
def _powers(inverse: bool) -> np.ndarray:
    """Powers of an odd number modulo 2**64, or of its inverse, for every place in a chunk."""
    base = 0x5851F42D4C957F2D
    base = pow(base, -1, 1 << 64) if inverse else base
    out, n = np.ones(1, np.uint64), 1
    with np.errstate(over="ignore"):
        while n < 2 * CHUNK:
            out = np.concatenate([out, out * np.uint64(pow(base, n, 1 << 64))])
            n *= 2
    return out


def span_hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of code points; equal spans of any chunk have equal hashes."""
    up, down = _powers(False), _powers(True)
    if len(points) >= len(up):  # a slice without white space can be longer than a chunk
        return np.array([_long_hash(points[a:z]) for a, z in zip(starts.tolist(), ends.tolist())], np.uint64)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up[:len(points)])])
        return mixed((sums[ends] - sums[starts]) * down[starts])


def _long_hash(points: np.ndarray) -> int:
    up, total, n = _powers(False), 0, 0
    with np.errstate(over="ignore"):
        for a in range(0, len(points), len(up)):
            part = points[a:a + len(up)].astype(np.uint64) + np.uint64(1)
            total += int((part * up[:len(part)]).sum()) * pow(0x5851F42D4C957F2D, n, 1 << 64)
            n += len(part)
    return int(mixed(np.array([total % (1 << 64)], np.uint64))[0])


def mixed(h: np.ndarray) -> np.ndarray:
    """The 64-bit finalizer of splitmix64."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))
