"""Token ids of whole texts by a public tokenizer, remembered per piece of text.

A piece begins where both vocabularies here split a text whatever stands around the place: before
ASCII white space that follows something else, between an ASCII letter and a following ASCII digit or
mark, between a digit or a mark other than the apostrophe and a following ASCII letter, and after a
single line feed or tab. So a text's ids are those of its pieces one after the other. Pieces repeat a great deal: Arrow gives each piece of a slice a number, every
Python worker keeps the ids of the pieces it has met lately (up to a bound), and only unknown ones go
to the tokenizer. The result is the tokenizer's own on the whole text. The one case
where a cut would change it, other Unicode white space just before ASCII white space under a
vocabulary that keeps blanks, goes to the tokenizer whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from millrace.llm.texts import LOWER, byte_class, slices, worker_memory

#: Pieces handed to the tokenizer at once, as one string, and such strings of a call.
AT_ONCE, STRINGS = 64, 64


class Memory(NamedTuple):
    """Pieces one worker remembers, and bytes of text numbered together: the more, the more often a
    piece is met again."""

    pieces: int
    slice_bytes: int


#: For a job that has the worker to itself, and for one that shares it with other operators.
ROOMY, TIGHT = Memory(800_000, 12 << 20), Memory(400_000, 4 << 20)

_WIDE_BLANK = re.compile(rb"(?:\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80)[\t-\r ]")
_WIDE_LEADS = (0xC2, 0xE1, 0xE2, 0xE3)


def _kinds() -> np.ndarray:
    """By byte: 0 wide, 1 letter, 2 digit, 3 apostrophe, 4 other mark, 5 blank, 6 other white space."""
    kind = np.where(byte_class((0x80, 0xFF)), 0, 4).astype(np.uint8)
    kind[byte_class((0x41, 0x5A), (0x61, 0x7A))] = 1
    kind[byte_class((0x30, 0x39))] = 2
    kind[0x27], kind[0x20] = 3, 5
    kind[byte_class((0x09, 0x0D))] = 6
    return kind


def _splits() -> np.ndarray:
    """By two neighbouring kinds (8 * before + after): whether a piece begins between them."""
    table = np.zeros(64, bool)
    for before in range(7):
        for after in range(7):
            blank = before < 5 <= after
            into_mark = before == 1 and after in (2, 3, 4)
            into_letter = before in (2, 4) and after == 1
            table[8 * before + after] = blank or into_mark or into_letter
    return table


KIND, SPLIT = _kinds(), _splits()


class Encoder:
    """Ids of slices of texts."""

    def __init__(self, path: str, blank_matters: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        #: Whether white space has ids; else the vocabulary also takes capitals for small letters.
        self.blank_matters = blank_matters
        self.separator = b"\n" if blank_matters else b"\n|\n"
        own = self.tokenizer.encode(self.separator.decode(), add_special_tokens=False).ids
        #: Without an id of its own nothing separates, and every piece is encoded alone.
        self.separator_id = own[0] if len(own) == 1 else -1
        self.memory = ROOMY
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def whole(self, text: bytes) -> bytes:
        ids = self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _learn(self, pieces: list[bytes]) -> None:
        """Encode unknown pieces in long strings, a separator of one known id between them. Pieces that
        begin with other white space than one blank would join with a separator that is white space."""
        joined = []
        for piece in pieces:
            lead = piece[0] if piece[0] != 0x20 or len(piece) == 1 else piece[1]
            if not self.blank_matters or 0x20 < lead < 0x7F:
                joined.append(piece)
                continue
            head = piece[:8].decode("utf-8", "replace")[: 2 if piece[:1] == b" " else 1]
            if head[-1:].isspace():
                self.known[piece] = self.whole(piece)
            else:
                joined.append(piece)
        step = AT_ONCE * STRINGS
        for low in range(0, len(joined), step):
            strings = [joined[at : at + AT_ONCE] for at in range(low, min(low + step, len(joined)), AT_ONCE)]
            texts = [self.separator.join(own).decode("utf-8", "replace") for own in strings]
            for own, encoding in zip(strings, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                self._keep(own, np.array(encoding.ids, "<u4"))

    def _keep(self, pieces: list[bytes], ids: np.ndarray) -> None:
        at = np.flatnonzero(ids == self.separator_id)
        if len(at) != len(pieces) - 1:
            # A piece holds the separator's id itself.
            self.known.update((piece, self.whole(piece)) for piece in pieces)
            return
        starts, ends = [0, *(4 * at + 4).tolist()], [*(4 * at).tolist(), 4 * len(ids)]
        raw = ids.tobytes()
        for piece, start, end in zip(pieces, starts, ends, strict=True):
            self.known[piece] = raw[start:end]

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The pieces of a slice, numbered, and where each text's begin."""
        kind = KIND[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = SPLIT[kind[:-1] * np.uint8(8) + kind[1:]]
        # After white space that is no blank and stands alone, before anything else in ASCII.
        cut[2:-1] |= (kind[1:-1] == 6) & (kind[:-2] < 5) & (kind[2:] > 0) & (kind[2:] < 5)
        cut[offsets] = True
        if not self.blank_matters:
            data = LOWER[data]
        bounds = np.flatnonzero(cut)
        held = [None, pa.py_buffer(np.ascontiguousarray(bounds, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
        numbered = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, held).dictionary_encode()
        return numbered, np.searchsorted(bounds, offsets)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the slice's texts, and the offsets of each text's ids."""
        numbered, first = self._pieces(data, offsets)
        pieces = _listed(numbered.dictionary)
        values = list(map(self.known.get, pieces))
        if None in values:
            lacking = [piece for piece, value in zip(pieces, values, strict=True) if value is None]
            if len(self.known) + len(lacking) > self.memory.pieces // 2:
                # What is met again moves over from the older half; the rest is forgotten with it.
                self.older, self.known = self.known, {}
                lacking = pieces
            old = {piece: self.older[piece] for piece in lacking if piece in self.older}
            self.known.update(old)
            self._learn([piece for piece in lacking if piece not in old])
            values = list(map(self.known.get, pieces))
        width = np.array([len(v) // 4 for v in values], np.int64)
        flat = np.frombuffer(b"".join(values), "<u4")
        codes = numbered.indices.to_numpy(zero_copy_only=False)
        count = width[codes]
        total = np.concatenate([[0], np.cumsum(count)])
        begin = np.concatenate([[0], np.cumsum(width)[:-1]]) if len(width) else np.zeros(0, np.int64)
        ids = flat[np.repeat(begin[codes] - total[:-1], count) + np.arange(total[-1])]
        ends = total[first]
        if self.blank_matters and any((data == lead).any() for lead in _WIDE_LEADS):
            ids, ends = self._mended(data, offsets, ids, ends)
        return ids, ends

    def _mended(self, data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = [m.start() for m in _WIDE_BLANK.finditer(data.tobytes())]
        odd = set((np.searchsorted(offsets, at, "right") - 1).tolist())
        if not odd:
            return ids, ends
        parts = [
            np.frombuffer(self.whole(data[offsets[i] : offsets[i + 1]].tobytes()), "<u4") if i in odd else ids[ends[i] : ends[i + 1]]
            for i in range(len(offsets) - 1)
        ]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


def _listed(column: pa.LargeBinaryArray) -> list[bytes]:
    """The values of a column without nulls; slices of its buffer, several times as fast as ``to_pylist``."""
    if not len(column):
        return []
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1].tolist()
    raw = column.buffers()[2].to_pybytes()
    return [raw[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def encoder(path: str, blank_matters: bool) -> Encoder:
    """The worker's encoder for the vocabulary file at ``path``."""
    kept = worker_memory("encoders")
    if path not in kept:
        kept[path] = Encoder(path, blank_matters)
    return kept[path]


def encoded(
    batches: Iterator[pa.RecordBatch], path: str, blank_matters: bool, column: str = "text", memory: Memory = ROOMY
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """The batches in slices, with the ids of their texts and the offsets of each text's."""
    pa.default_memory_pool().release_unused()
    worker = encoder(path, blank_matters)
    worker.memory = memory
    for batch in batches:
        for part, data, offsets in slices(batch, column, memory.slice_bytes):
            yield part, *worker.encode(data, offsets)
