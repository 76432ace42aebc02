"""Whole-text tokenization with a byte-level BPE of the ``tokenizers`` library.

A byte-level BPE splits a text into pre-tokens first and merges only inside them, so the ids of a text
are the ids of its pieces as long as every cut is a pre-token boundary. Texts are cut, by numpy and many at once, only at
such places: before white space that follows something else, and between a letter or digit and the punctuation
after it. Arrow numbers the different pieces by their bytes; each is looked up once, unknown ones go to the
library together, and numpy writes the ids in text order. A worker remembers pieces in two generations: when
the newer one is full it becomes the older one, and pieces met again move up. Texts with rarer white space, where the
cuts are not provably boundaries, are encoded whole.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

#: Kinds of bytes as far as cuts go.
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\r\n")] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".,;:!?")] = True
_PLAIN = np.zeros(256, bool)
_PLAIN[[b for b in range(128) if chr(b).isalnum()]] = True
#: Second bytes of the letters from U+00C0 to U+00FF, which all start with 0xC3 (two signs among them are none).
_LATIN = np.zeros(256, bool)
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False
#: White space of Python or of the tokenizer's pattern beyond space, tab, CR and LF.
_RARE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0  -     　]".encode().decode())
_RARE_LEAD = np.zeros(256, bool)
_RARE_LEAD[[0x0B, 0x0C, 0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3]] = True
_CUT = re.compile(rb"(?<=[^ \t\r\n])(?= )")
#: A piece that is one pre-token, so that the model alone gives its ids.
_WORD = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
#: Pieces that one generation holds (two are kept, about 50 MB together), and the longest piece worth remembering, in bytes.
REMEMBERED, LONGEST = 150_000, 48
#: Bytes of text cut into pieces at a time, and pieces given to the library at a time.
SPAN, CALL = 4 << 20, 20_000


def byte_alphabet() -> dict[int, str]:
    """Byte-level BPE writes printable Latin-1 bytes as themselves and the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.alphabet = byte_alphabet()
        self.kind = "<u2" if self.whole.get_vocab_size() <= 1 << 16 else "<u4"
        self.newer: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _remember(self, piece: bytes, ids: bytes) -> None:
        if len(self.newer) >= REMEMBERED:
            self.older, self.newer = self.newer, {}
        self.newer[piece] = ids

    def _looked_up(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece (in ``kind``); unknown words go to the model, other unknown pieces to the library together."""
        found = list(map(self.newer.get, pieces))
        others, older, wide = [], self.older, np.dtype(self.kind).itemsize
        for i in [i for i, ids in enumerate(found) if ids is None]:
            piece = pieces[i]
            ids = older.get(piece)
            if ids is None:
                if not _WORD.fullmatch(piece):
                    others.append(i)
                    continue
                spelled = piece.decode("latin-1").translate(self.alphabet)
                ids = b"".join([t.id.to_bytes(wide, "little") for t in self.model.tokenize(spelled)])
            found[i] = ids
            if len(piece) <= LONGEST:
                self._remember(piece, ids)
        for a in range(0, len(others), CALL):
            call = others[a:a + CALL]
            encoding = self.whole.encode([pieces[i].decode() for i in call], is_pretokenized=True, add_special_tokens=False)
            counts = np.bincount(np.array(encoding.word_ids, np.int64), minlength=len(call))
            ids = np.array(encoding.ids, self.kind).tobytes()
            ends = (np.cumsum(counts) * wide).tolist()
            for i, start, end in zip(call, [0, *ends], ends):
                found[i] = ids[start:end]
                if len(pieces[i]) <= LONGEST:
                    self._remember(pieces[i], found[i])
        return found

    def _pieces(self, data: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, ids of each text)`` of texts that lie one after the other in ``data``, text k from ``firsts[k]``."""
        if not len(data):
            return np.zeros(0, "<u4"), np.zeros(len(firsts), np.int64)
        space, plain = _SPACE[data], _PLAIN[data]
        plain[1:] |= _LATIN[data[1:]] & (data[:-1] == 0xC3)
        cut = space.copy()
        cut[1:] &= ~space[:-1]
        cut[1:] |= _STOP[data[1:]] & plain[:-1]
        cut[firsts[firsts < len(data)]] = True
        starts = np.flatnonzero(cut)
        offsets = np.append(starts, len(data)).astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        known = self._looked_up(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // np.dtype(self.kind).itemsize
        table, places = np.frombuffer(b"".join(known), self.kind), np.cumsum(sizes) - sizes
        piece = coded.indices.to_numpy(zero_copy_only=False)
        own = sizes[piece]
        ends = np.cumsum(own)
        ids = table[np.repeat(places[piece] - (ends - own), own) + np.arange(ends[-1])]
        before = np.concatenate([np.zeros(1, np.int64), ends])[np.searchsorted(starts, np.append(firsts, len(data)))]
        return ids.astype("<u4"), np.diff(before)

    def _whole(self, text: bytes) -> np.ndarray:
        return np.array(self.whole.encode(text.decode(), add_special_tokens=False).ids, "<u4")

    def _long(self, text: bytes) -> np.ndarray:
        """Ids of a text longer than ``SPAN`` without rare white space, slice by slice."""
        out, at = [], 0
        while at < len(text):
            cut = _CUT.search(text, at + SPAN)
            end = cut.start() if cut else len(text)
            out.append(self._pieces(np.frombuffer(text[at:end], np.uint8), np.zeros(1, np.int64))[0])
            at = end
        return np.concatenate(out)

    def _group(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(b"".join(texts), np.uint8)
        firsts = np.cumsum([0, *map(len, texts)])[:-1]
        rare = np.unique(np.searchsorted(firsts, _rare_places(data), "right") - 1)
        if not len(rare):
            return (self._long(texts[0]), None) if len(data) > SPAN and len(texts) == 1 else self._pieces(data, firsts)
        out = [self._whole(t) if k in set(rare.tolist()) else self._group([t])[0] for k, t in enumerate(texts)]
        return np.concatenate(out), np.array([len(ids) for ids in out])

    def encode_all(self, texts):
        """Per text, in order: its ids. Texts (UTF-8 bytes) are worked on in groups of about ``SPAN`` bytes."""
        group, size = [], 0

        def done():
            ids, counts = self._group(group)
            if len(group) == 1:
                return [ids]
            return np.split(ids, np.cumsum(counts)[:-1])

        for t in texts:
            if group and size + len(t) > SPAN:
                yield from done()
                group, size = [], 0
            group.append(t)
            size += len(t)
        if group:
            yield from done()

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text.encode()])).tobytes()


def _rare_places(data: np.ndarray) -> np.ndarray:
    """Where white space beyond space, tab, CR and LF starts."""
    at = np.flatnonzero(_RARE_LEAD[data])
    if not len(at):
        return at
    # the characters there, each as its UTF-8 bytes in one number
    lead, second, third = (np.append(data, np.zeros(2, np.uint8))[at + k].astype(np.int64) for k in range(3))
    return at[np.isin(np.where(lead < 0x80, lead, np.where(lead < 0xE0, lead << 8 | second, lead << 16 | second << 8 | third)), _RARE_CODES)]


_RARE_CODES = np.array([int.from_bytes(c.encode(), "big") for c in map(chr, range(0x3001)) if _RARE.match(c)])

_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
