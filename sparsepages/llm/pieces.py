"""Texts cut into pieces that no token can cross; of every slice of a batch each distinct piece is tokenized once.

A text is cut before a space, or around a line feed, that is the last of a run of
white space, and between ASCII letters or digits and signs. Byte-level vocabularies
split words there in any case; a ``sentencepiece`` model does if no piece of it has
the mark of a space behind its front, or such a letter next to such a sign.
The pieces of a slice become an Arrow dictionary, the tokenizer library gets those
that the task does not remember in one call, and the ids of the texts are gathered
by number. Texts and pieces are never shortened.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np

SLICE_BYTES = 6_000_000
REMEMBERED_BYTES = 20_000_000  # of recent pieces and what is known about them, in one task; as much of those before
LONG = 64  # bytes of pieces that are not remembered


def by_bytes(sizes, most: int = SLICE_BYTES) -> list[tuple[int, int]]:
    """Ranges of consecutive rows of about ``most`` bytes each; a longer row stands alone."""
    ranges, first, held = [], 0, 0
    for i, size in enumerate(sizes):
        if i > first and held + size > most:
            ranges.append((first, i))
            first, held = i, 0
        held += size
    if len(sizes) > first:
        ranges.append((first, len(sizes)))
    return ranges


def slices(batch, name: str = "text") -> Iterator[tuple[int, object]]:
    """First row and texts (null as empty) of the slices of an Arrow batch."""
    import pyarrow as pa
    import pyarrow.compute as pc

    texts = pc.fill_null(batch.column(name), "").cast(pa.large_string())
    for a, b in by_bytes(pc.binary_length(texts).to_pylist()):
        yield a, texts.slice(a, b - a)


def bytes_of(texts) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow array of large strings without nulls, and where each begins, then the end."""
    _, offsets, data = texts.buffers()
    starts = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[starts[0] : starts[-1]], starts - starts[0]


def binaries(data: np.ndarray, offsets: np.ndarray):
    """An Arrow array of the byte strings between ``offsets``; nothing is copied."""
    import pyarrow as pa

    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def with_space(texts):
    """Each text with a space in front; empty ones stay empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    space, nothing = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
    return pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(space, texts, nothing))


_WHITE = np.zeros(256, bool)
_WHITE[[*range(9, 14), *range(28, 33)]] = True


def _goes_on(data: np.ndarray, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Is there, at byte ``at`` of the same text, surely a character that is neither white space nor the space mark?"""
    there = ~ends[at]
    padded = np.append(data, [32, 32])
    one, two = padded[at], padded[at + 1]
    odd = _WHITE[one] | (one == 0xC2) & ((two == 0x85) | (two == 0xA0)) | (one == 0xE1) & (two == 0x9A)
    odd |= (one == 0xE2) & ((two == 0x80) | (two == 0x81) | (two == 0x96)) | (one == 0xE3) & (two == 0x80)
    return there & ~odd


_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_SIGN = ~_WORD
_SIGN[[*range(33), 39, *range(127, 256)]] = False  # without the apostrophe, which contractions join to letters


def apart(inside: list[bytes] = ()) -> np.ndarray:
    """For pairs of bytes (``first << 8 | second``): a letter or digit beside a sign, and never so in ``inside``."""
    table = (_WORD[:, None] & _SIGN[None, :] | _SIGN[:, None] & _WORD[None, :]).ravel()
    if inside:
        data = np.frombuffer(b" ".join(inside), np.uint8).astype(np.int64)
        table[data[:-1] << 8 | data[1:]] = False
    return table


class Pieces:
    """The pieces of texts: ``distinct``, the number ``codes`` of each piece among them, and ``starts`` of the texts in ``codes``."""

    def __init__(self, texts, apart: np.ndarray, whole=None):
        """``apart`` says between which bytes no token can lie, ``whole`` marks texts that must not be cut."""
        data, starts = bytes_of(texts)
        ends = np.zeros(len(data) + 1, bool)  # where a text begins or the last one ends
        ends[starts] = True
        cut = ends.copy()
        at = np.flatnonzero(data == 32)
        before = data[at - 1] if len(at) else at
        cut[at[_goes_on(data, at + 1, ends) & (before != 32) & (before != 0x81)]] = True  # 0x81 may end a space mark
        at = np.flatnonzero(data == 10)
        at = at[_goes_on(data, at + 1, ends)]
        cut[at] = cut[at + 1] = True
        at = np.flatnonzero(_SIGN[data])
        for ahead in (0, 1):
            where = at[(at + ahead > 0) & (at + ahead < len(data))] + ahead
            cut[where[apart[data[where - 1].astype(np.int64) << 8 | data[where]]]] = True
        if whole is not None:
            for i in np.flatnonzero(whole):
                cut[starts[i] + 1 : starts[i + 1]] = False
        offsets = np.flatnonzero(cut)
        if len(data) == 0:
            offsets = np.zeros(1, np.int64)
        coded = binaries(data, offsets).dictionary_encode()
        self.distinct = coded.dictionary.to_pylist()
        self.codes = coded.indices.to_numpy().astype(np.int64)
        self.starts = np.searchsorted(offsets, starts)

    def gather(self, known: list[bytes], dtype) -> tuple[np.ndarray, np.ndarray]:
        """The values that ``known`` has for each distinct piece, in the order of the texts, and where each text begins in them."""
        width = np.dtype(dtype).itemsize
        sizes = np.array([len(x) for x in known], np.int64) // width
        flat = np.frombuffer(b"".join(known), dtype)
        own = sizes[self.codes]
        ends = np.concatenate([[0], np.cumsum(own)])
        first = (np.cumsum(sizes) - sizes)[self.codes]
        return flat[np.repeat(first - ends[:-1], own) + np.arange(ends[-1])], ends[self.starts]

    def sums(self, numbers: np.ndarray) -> np.ndarray:
        """Per text, the sum of the numbers of its pieces."""
        return np.diff(np.concatenate([[0], np.cumsum(numbers[self.codes])])[self.starts])


class Remembered:
    """``make(pieces)`` for lists of pieces, remembered within one task: the recent ones, and those before them until they are replaced as a whole."""

    def __init__(self, make: Callable[[list[bytes]], list[bytes]], most: int = REMEMBERED_BYTES):
        self.make, self.most, self.known, self.before, self.held = make, most, {}, {}, 0

    def __call__(self, pieces: list[bytes]) -> list[bytes]:
        known, before = self.known, self.before
        found = [known.get(p) or before.get(p) for p in pieces]
        new = [i for i, x in enumerate(found) if x is None]
        if new:
            for i, x in zip(new, self.make([pieces[i] for i in new]), strict=True):
                found[i] = x
                if len(pieces[i]) <= LONG:
                    if self.held > self.most:
                        self.known, self.before, self.held = {}, self.known, 0
                    self.known[pieces[i]] = x
                    self.held += len(pieces[i]) + len(x) + 180
        return found


# Letters in every version of Unicode, or signs: one word of byte-level vocabularies.
_PLAIN = re.compile(r" ?(?:[A-Za-zÀ-ÖØ-öø-ÿ]+|[.,;:!?%$&*#|]+)")


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable bytes stand for themselves, the others for the letters from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}


class ByteIds:
    """Ids under a byte-level BPE file of the ``tokenizers`` library, as that library gives them without added special tokens."""

    def __init__(self, path: str, specials_are_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = specials_are_text
        self.model = self.library.model
        special = [] if specials_are_text else [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = "|".join(map(re.escape, special))
        self.letters, self.apart, self.known = byte_letters(), apart(), Remembered(self._encode)

    def _encode(self, pieces: list[bytes]) -> list[bytes]:
        out, rest = [], []
        for i, piece in enumerate(pieces):
            if _PLAIN.fullmatch(piece.decode()):
                mapped = "Ġ" + piece[1:].decode("latin-1").translate(self.letters) if piece[0] == 32 else piece.decode("latin-1").translate(self.letters)
                out.append(array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes())
            else:
                out.append(None)
                rest.append(i)
        found = self.library.encode_batch_fast([pieces[i].decode() for i in rest], add_special_tokens=False)
        for i, e in zip(rest, found, strict=True):
            out[i] = array("I", e.ids).tobytes()
        return out

    def pieces(self, texts) -> Pieces:
        """Texts that hold the string of a special token are not cut."""
        import pyarrow.compute as pc

        return Pieces(texts, self.apart, pc.match_substring_regex(texts, self.special).to_numpy(zero_copy_only=False) if self.special else None)

    def ids(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of an Arrow array of texts, and where each text begins in them, then the end."""
        cut = self.pieces(texts)
        return cut.gather(self.known(cut.distinct), "<u4")
