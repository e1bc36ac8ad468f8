"""SentencePiece encoding that keeps the place of every piece in the original bytes, and decoding.

A text is normalised by the longest prefixes that the model's compiled character
map replaces. Every byte of the normalised text records the byte of the original
that it comes from, and a piece covers the original bytes between the records of
its two ends. Segmentation runs on the normalised text, by pieces that no token
can cross.
"""

from __future__ import annotations

import re
import struct
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pieces import Pieces, Remembered, apart, slices, with_space

MARK = "▁"
_MARK = MARK.encode()


class CharMap:
    """A compiled character map: a double-array trie over bytes, then the replacements, each ended by a zero byte.

    Layout, little-endian: u32 size of the trie in bytes; the trie's units, u32
    each; the replacements. Of a unit, the lowest 8 bits and the highest are its
    label, bit 8 says that a value hangs below it, bits 10 to 31 are the offset of
    its children, times 256 if bit 9 is set; a value is the place of a replacement.
    """

    def __init__(self, packed: bytes):
        (size,) = struct.unpack_from("<I", packed)
        self.units = struct.unpack_from(f"<{size // 4}I", packed, 4)
        self.replacements = packed[4 + size :]
        self.leads = bytes(b for b in range(1, 256) if self._child(self._below(0), b))
        self.lead = re.compile(b"[" + b"".join(re.escape(bytes([b])) for b in self.leads) + b"]") if self.leads else None

    def _below(self, at: int) -> int:
        """Where the children of the unit at ``at`` are counted from."""
        unit = self.units[at]
        return at ^ ((unit >> 10) << ((unit >> 9 & 1) * 8))

    def _child(self, below: int, byte: int) -> int:
        """The place of the child for ``byte``; 0 if there is none."""
        at = below ^ byte
        return at if at < len(self.units) and self.units[at] & 0x800000FF == byte else 0

    def longest(self, text: bytes, start: int) -> tuple[int, bytes] | None:
        """Length of the longest prefix of ``text`` from ``start`` that the map replaces, and its replacement."""
        found, below, at = None, self._below(0), start
        while at < len(text):
            node = self._child(below, text[at])
            if not node:
                break
            at, below = at + 1, self._below(node)
            if self.units[node] >> 8 & 1:
                found = at - start, self.units[below] & 0x7FFFFFFF
        if found is None:
            return None
        length, place = found
        return length, self.replacements[place : self.replacements.index(b"\0", place)]


def _char_length(lead: int) -> int:
    return 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


class Normaliser:
    """Normalises UTF-8 as a model's specification says; the space mark is written as a space."""

    def __init__(self, charmap: bytes, dummy_prefix: bool, single_spaces: bool):
        self.map = CharMap(charmap) if charmap else None
        self.dummy_prefix, self.single_spaces = dummy_prefix, single_spaces
        self.plain = not single_spaces and (self.map is None or self.map.lead is None)

    def _replaced(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """``text`` under the character map, and for each byte where its source begins."""
        if self.map is None or self.map.lead is None:
            return text, np.arange(len(text), dtype=np.int64)
        parts, places, at, done = [], [], 0, 0
        while found := self.map.lead.search(text, at):
            hit = self.map.longest(text, found.start())
            if hit is None:
                at = found.start() + _char_length(text[found.start()])
                continue
            length, new = hit
            parts += [text[done : found.start()], new]
            places += [np.arange(done, found.start()), np.full(len(new), found.start())]
            at = done = found.start() + length
        parts.append(text[done:])
        places.append(np.arange(done, len(text)))
        return b"".join(parts), np.concatenate(places)

    def _head(self, text: bytes) -> int:
        """Where the text begins behind what is a single space each once normalised, if such spaces go."""
        at = 0
        while self.single_spaces and at < len(text):
            length, new = (self.map and self.map.longest(text, at)) or (1, text[at : at + 1])
            if new != b" ":
                break
            at += length
        return at

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text, and for each byte of it and its end the byte of ``text`` where its source begins."""
        new, places = self._replaced(text)
        end = len(text)
        if self.single_spaces:
            data = np.frombuffer(new, np.uint8)
            space = data == 32
            keep = ~(space & np.concatenate([[True], space[:-1]])) if len(data) else space
            new, places = data[keep].tobytes(), places[keep]
            kept = len(new)
            while new[:kept].endswith((b" ", _MARK)):  # spaces at the end go, and their source belongs to nothing
                kept -= 1 if new[kept - 1] == 32 else len(_MARK)
            if kept < len(new):
                new, end, places = new[:kept], int(places[kept]), places[:kept]
        if not new and (self.single_spaces or not text):
            return b"", np.array([end])
        if self.dummy_prefix:
            new, places = b" " + new, np.concatenate([[self._head(text)], places])
        return new, np.append(places, end)


class PieceModel:
    """A ``sentencepiece`` model taken apart: its normaliser, and the library's segmentation of normalised pieces."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        with open(path, "rb") as source:
            model = proto.ModelProto.FromString(source.read())
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        if model.trainer_spec.treat_whitespace_as_suffix or not model.normalizer_spec.escape_whitespaces:
            raise ValueError("models that end words in the space mark, or have none, are not supported")
        spec = model.normalizer_spec
        self.normaliser = Normaliser(spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces)
        # A piece with the mark after another character, or with a line feed, could lie across pieces: then texts stay whole.
        kinds = proto.ModelProto.SentencePiece
        self.joins = any(MARK in p.piece.lstrip(MARK) or "\n" in p.piece or p.type == kinds.USER_DEFINED for p in model.pieces)
        self.apart = apart([p.piece.encode() for p in model.pieces if p.type not in (kinds.BYTE, kinds.CONTROL, kinds.UNKNOWN)])
        self.byte = {i: int(p.piece[3:5], 16) for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        model.normalizer_spec.Clear()
        model.normalizer_spec.name = "identity"
        model.normalizer_spec.add_dummy_prefix = model.normalizer_spec.remove_extra_whitespaces = False
        self.segments = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        # Bytes that a token covers in a normalised piece; 0 where only the library can tell.
        odd = (kinds.UNKNOWN, kinds.BYTE)
        self.sizes = np.array([0 if p.type in odd else len(p.piece.replace(MARK, " ").encode()) for p in model.pieces], np.uint64)
        self.known = Remembered(self._coded)

    def token_bytes(self) -> list[bytes]:
        """The bytes of each entry: its piece with the mark as a space, or the byte that it stands for."""
        names = (self.library.id_to_piece(i) for i in range(self.library.get_piece_size()))
        return [bytes([self.byte[i]]) if i in self.byte else p.replace(MARK, " ").encode() for i, p in enumerate(names)]

    def _coded(self, pieces: list[bytes]) -> list[bytes]:
        """For each token of a normalised piece its id, and above it in 32 bits each the bytes that it covers; the last token of a character in single bytes covers it."""
        found = self.segments.encode([p.decode() for p in pieces])
        ids = np.fromiter(chain.from_iterable(found), np.uint64)
        ends = np.cumsum([len(x) for x in found])
        sizes = self.sizes[ids.astype(np.int64)]
        coded = (ids | sizes << np.uint64(32)).astype("<u8").tobytes()
        odd = set(np.searchsorted(ends, np.flatnonzero(sizes == 0), side="right").tolist())
        out = []
        for i, (piece, first, last) in enumerate(zip(pieces, [0, *ends[:-1].tolist()], ends.tolist(), strict=True)):
            if i in odd or _MARK in piece:
                tokens = self.segments.encode(piece.decode(), return_type="proto").pieces
                out.append(np.array([t.id | (t.end - t.begin) << 32 for t in tokens], "<u8").tobytes())
            else:
                out.append(coded[8 * first : 8 * last])
        return out

    def normalised(self, texts) -> tuple[object, list[np.ndarray] | None]:
        """Normalised texts, and the records of their bytes; None where the text is the original behind a space."""
        import pyarrow as pa

        if self.normaliser.plain and self.normaliser.dummy_prefix:
            return with_space(texts), None
        done = [self.normaliser(t.encode()) for t in texts.to_pylist()]
        return pa.array([new.decode() for new, _ in done], pa.large_string()), [places for _, places in done]

    def pieces(self, normalised) -> Pieces:
        return Pieces(normalised, self.apart, np.ones(len(normalised), bool) if self.joins else None)

    def _tokens(self, normal) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, the normalised bytes that each token covers, and where each text begins in both, then the end."""
        cut = self.pieces(normal)
        coded, starts = cut.gather(self.known(cut.distinct), "<u8")
        return (coded & np.uint64(0xFFFFFFFF)).astype("<u4"), (coded >> np.uint64(32)).astype(np.int64), starts

    def ids(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of an Arrow array of texts, and where each text begins in them, then the end."""
        ids, _, starts = self._tokens(self.normalised(texts)[0])
        return ids, starts

    def counts(self, texts) -> np.ndarray:
        """Tokens of each text; only numbers are gathered."""
        cut = self.pieces(self.normalised(texts)[0])
        return cut.sums(np.array([len(x) // 8 for x in self.known(cut.distinct)], np.int64))

    def spans(self, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids, where each text begins in them, and the first byte and the end of each piece in its original text."""
        normal, places = self.normalised(texts)
        ids, sizes, starts = self._tokens(normal)
        ends = np.cumsum(sizes)
        base = np.repeat(np.concatenate([[0], ends])[starts[:-1]], np.diff(starts))
        last, first = ends - base, ends - sizes - base
        if places is None:  # the space in front has no byte of its own
            return ids, starts, np.maximum(first - 1, 0), last - 1
        for k, own in enumerate(places):
            part = slice(starts[k], starts[k + 1])
            first[part], last[part] = own[first[part]], own[last[part]]
        return ids, starts, first, last


def decimals(ids: np.ndarray, separators: np.ndarray | int = 44) -> tuple[np.ndarray, np.ndarray]:
    """The ids in decimal, each with a separator byte behind it, and where each begins in these bytes, then the end."""
    width = len(str(int(ids.max()))) if len(ids) else 1
    text = np.empty((len(ids), width + 1), np.uint8)
    rest = ids.astype(np.int64)
    for k in range(width - 1, -1, -1):
        text[:, k] = 48 + rest % 10
        rest //= 10
    text[:, width] = separators
    digits = np.ones(len(ids), np.int64)
    for k in range(1, width):
        digits += ids >= 10**k
    shown = np.arange(width + 1)[None, :] >= (width - digits)[:, None]
    return text[shown], np.concatenate([[0], np.cumsum(digits + 1)])


def with_pieces(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, first, last, decoded``: the pieces of every whole text, the original bytes that each covers, and the decoded text.

    One row per row of ``docs``, in any number and with any ids, also null and
    repeated ones; further columns are not read. A null or empty text has no
    pieces and decodes to an empty one. ``first`` and ``last`` are 0-based places
    in the UTF-8 of the text, ``last`` exclusive. Pieces that stand for nothing of
    their own (the space in front of a text, the earlier bytes of a character in
    single bytes) are empty spans. Nothing is shuffled.
    """
    return _mapped(docs, model, id_col, text_col, "ids array<bigint>, first array<bigint>, last array<bigint>, decoded string", _pieces_of)


def piece_digests(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, n_covered``: digests of the ids, in decimal with commas, and of the decoded text.

    ``n_covered`` counts the original bytes that the pieces cover. Rows, nulls and
    further columns as in ``with_pieces``.
    """
    return _mapped(docs, model, id_col, text_col, "n_tokens bigint, ids_sha256 string, decoded_sha256 string, n_covered bigint", _digests_of)


def _pieces_of(model: PieceModel, texts) -> list:
    import pyarrow as pa

    ids, starts, first, last = model.spans(texts)
    lists = [pa.LargeListArray.from_arrays(starts, pa.array(x.astype(np.int64))).cast(pa.list_(pa.int64())) for x in (ids, first, last)]
    return [*lists, pa.array([model.library.decode(ids[a:b].tolist()) for a, b in zip(starts, starts[1:], strict=False)], pa.string())]


def _digests_of(model: PieceModel, texts) -> list:
    import hashlib

    import pyarrow as pa

    ids, starts, first, last = model.spans(texts)
    written, at = decimals(ids)
    shown, digest, at = written.tobytes(), lambda x: hashlib.sha256(x).hexdigest(), at[starts].tolist()
    listed = [digest(shown[a : max(a, b - 1)]) for a, b in zip(at, at[1:], strict=False)]
    decoded = [digest(model.library.decode(ids[a:b].tolist()).encode()) for a, b in zip(starts, starts[1:], strict=False)]
    covered = np.diff(np.concatenate([[0], np.cumsum(last - first)])[starts])
    return [pa.array(np.diff(starts)), pa.array(listed, pa.string()), pa.array(decoded, pa.string()), pa.array(covered)]


def _mapped(docs: DataFrame, path: str, id_col: str, text_col: str, schema: str, make) -> DataFrame:
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = narrow.schema["doc_id"].dataType.simpleString()
    names = [c.split()[0] for c in schema.split(", ")]

    def encode(batches):
        import pyarrow as pa

        model = PieceModel(path)
        for batch in batches:
            for first, texts in slices(batch):
                made = make(model, texts)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, len(texts)), *made], names=["doc_id", *names])

    return narrow.mapInArrow(encode, f"doc_id {id_type}, {schema}")
