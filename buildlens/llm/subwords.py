"""Exact encoding through the tokenizers library, one distinct piece of text at a time.

Both kinds of tokenizer used here never join characters across certain places: byte-level BPE
splits a text before runs of white space and between letters and punctuation, and a SentencePiece
BPE has no piece in which a marker follows another character. So a text's ids are those of its
parts, cut there, end to end. Parts repeat far more than texts do: only those that a worker
hasn't met go through the library, and a bounded cache in each worker keeps their ids.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa

#: Distinct parts whose ids a worker remembers, and the bytes of them; it starts afresh beyond that. Longer parts are never kept.
CACHE_PARTS, CACHE_BYTES, LONGEST_KEPT = 400_000, 16 << 20, 256

#: ASCII bytes that some definition of white space includes.
ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[*range(0x09, 0x0E), 0x20, *range(0x1C, 0x20)]] = True


#: ASCII letters, and punctuation that never begins a contraction.
LETTER = np.zeros(256, bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
MARK = np.zeros(256, bool)
MARK[[x for x in range(0x21, 0x7F) if not chr(x).isalnum() and chr(x) != "'"]] = True

#: A part that byte-level BPE's own splitting surely leaves whole: Latin-1 letters, perhaps after a space.
ONE_WORD = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


def white_splits(data: np.ndarray) -> np.ndarray:
    """Where byte-level BPE surely splits: before white space or punctuation that follows a letter, and
    before a space or line feed that follows another character that isn't white.

    Characters of three or four bytes and those up to U+00BF count as possibly white, as some are;
    there the text just stays in one part.
    """
    cut = (data == 0x20) | (data == 0x0A)
    before = np.zeros(len(data), bool)
    before[1:] = (data[:-1] < 0x80) & ~ASCII_SPACE[data[:-1]]
    before[2:] |= (data[1:-1] >= 0x80) & (data[:-2] >= 0xC3) & (data[:-2] <= 0xDF)
    cut &= before
    letter = np.zeros(len(data), bool)
    letter[1:] = LETTER[data[:-1]]
    letter[2:] |= (data[:-2] == 0xC3) & (data[1:-1] != 0x97) & (data[1:-1] != 0xB7)
    return cut | (MARK[data] & letter)


def space_splits(data: np.ndarray) -> np.ndarray:
    """Before a space that follows neither a space nor the marker U+2581, which stands for one."""
    cut = data == 0x20
    cut[1:] &= data[:-1] != 0x20
    cut[3:] &= (data[:-3] != 0xE2) | (data[1:-2] != 0x96) | (data[2:-1] != 0x81)
    return cut


class Encoder:
    """ids of whole texts, by encoding distinct parts.

    splits(data) tells where parts begin besides at texts' beginnings, encode(parts) gives their ids.
    With by_start, a text's first part is encoded apart: encode gets it with b"\\1" before it, and
    other parts with b"\\0". A text that holds one of ``whole`` is one part.
    """

    def __init__(self, splits: Callable[[np.ndarray], np.ndarray], encode: Callable[[list[bytes]], Iterable], by_start: bool = False, whole: tuple[bytes, ...] = ()):
        self.splits, self.encode, self.by_start, self.whole = splits, encode, by_start, whole
        self._clear()

    def _clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.held = 0  # bytes of known parts
        self.flat, self.off = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64)  # with room at the end

    def _uncut(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Numbers of the texts that must stay in one part."""
        found, blob = set(), data.tobytes() if self.whole else b""
        for mark in self.whole:
            at = blob.find(mark)
            while at >= 0:
                k = int(np.searchsorted(off, at, "right")) - 1
                found.add(k)
                at = blob.find(mark, int(off[k + 1]))
        return np.array(sorted(found), np.int64)

    def __call__(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, n + 1 offsets)."""
        n = len(off) - 1
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
        cut = self.splits(data)
        for k in self._uncut(data, off).tolist():
            cut[off[k] : off[k + 1]] = False
        heads = off[:-1][off[:-1] < off[1:]]
        cut[heads] = True
        at = np.flatnonzero(cut)
        parts = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(np.append(at, len(data)).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])
        coded = parts.dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False)
        keys = coded.dictionary.to_pylist()
        if self.by_start:
            first = np.searchsorted(at, heads)
            starts, place = np.unique(code[first], return_inverse=True)
            code = code.copy()
            code[first] = len(keys) + place
            keys = [b"\0" + k for k in keys] + [b"\1" + keys[k] for k in starts.tolist()]
        flat, bounds, index = self._look_up(keys)
        index = index[code]
        sizes = bounds[index + 1] - bounds[index]
        lists = pa.LargeListArray.from_arrays(pa.array(bounds), pa.array(flat))
        ids = lists.take(pa.array(index)).flatten().to_numpy(zero_copy_only=False)
        return ids, np.concatenate(([0], np.cumsum(sizes)))[np.searchsorted(at, off)]

    def _look_up(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of known parts and of long ones, end to end; their bounds; the place of each key)."""
        long = [k for k in keys if len(k) > LONGEST_KEPT]
        short = keys if not long else [k for k in keys if len(k) <= LONGEST_KEPT]
        missing = [k for k in short if k not in self.known]
        if len(self.known) + len(missing) > CACHE_PARTS or self.held + sum(map(len, missing)) > CACHE_BYTES:
            self._clear()
            missing = short
        known = self.known
        if missing:
            ids, ends = self._encoded(missing)
            many = len(known)
            start = int(self.off[many])
            self.flat, self.off = _roomy(self.flat, start + len(ids)), _roomy(self.off, many + len(missing) + 1)
            self.flat[start : start + len(ids)] = ids
            self.off[many + 1 : many + 1 + len(missing)] = start + ends
            known.update(zip(missing, range(many, many + len(missing)), strict=True))
            self.held += sum(map(len, missing))
        many = len(known)
        bounds = self.off[: many + 1]
        flat = self.flat[: int(bounds[-1])]
        if not long:
            return flat, bounds, np.fromiter(map(known.__getitem__, keys), np.int64, len(keys))
        ids, ends = self._encoded(long)
        place = {k: many + i for i, k in enumerate(long)}
        index = np.fromiter((known[k] if len(k) <= LONGEST_KEPT else place[k] for k in keys), np.int64, len(keys))
        return np.concatenate((flat, ids)), np.concatenate((bounds, bounds[-1] + ends)), index

    def _encoded(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found, ends = array("I"), []
        for ids in self.encode(parts):
            found.extend(ids)
            ends.append(len(found))
        return np.frombuffer(found, np.uint32) if found else np.zeros(0, np.uint32), np.array(ends, np.int64)


def _roomy(x: np.ndarray, least: int) -> np.ndarray:
    """The array with room for so many entries, doubled where it is too short."""
    return x if len(x) >= least else np.concatenate((x, np.zeros(max(len(x), least - len(x)), x.dtype)))


def _byte_characters() -> dict[int, str]:
    """The printable character that byte-level BPE writes for each byte: itself, or the next from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + k) for k, b in enumerate(rest)}


_made: dict[tuple, Encoder] = {}


def byte_bpe(path: str) -> Encoder:
    """Encoder of a byte-level BPE file of the tokenizers library, with the ids that its plain call gives.

    A part that is one word needs the library's model alone; others take its whole way. Texts that hold
    an added token's words take it whole, as those are recognised before a text is split.
    """
    if ("bpe", path) not in _made:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        added = tuple(t.content.encode() for t in tokenizer.get_added_tokens_decoder().values())
        tokenize, shown, one_word = tokenizer.model.tokenize, _byte_characters(), ONE_WORD.fullmatch
        blank = shown[0x20]

        def encode(parts: list[bytes]):
            for part in parts:
                if not one_word(part):
                    yield tokenizer.encode(part.decode(), add_special_tokens=False).ids
                    continue
                if not part.isascii():
                    word = part.decode("latin-1").translate(shown)
                else:  # of its bytes only a space in front is written as another
                    word = blank + part[1:].decode() if part[0] == 0x20 else part.decode()
                yield [t.id for t in tokenize(word)]

        _made["bpe", path] = Encoder(white_splits, encode, whole=added)
        _made["bpe", path].tokenizer = tokenizer
    return _made["bpe", path]
