"""SentencePiece models on the tokenizers library.

The model file is a protocol buffer; its wire format is read here directly: pieces with scores
and kinds, the model type, and the normaliser's settings. From these the library's tokenizer is
rebuilt: normaliser (character map, extra blanks, dummy prefix), marker for blanks, merges by
score or unigram scores, and byte fallback. ``parity`` compares it with the reference
implementation, text by text.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .subwords import Encoder, _made, space_splits
from .text import raw, slices, trimmed

MARKER = "▁"
#: Kinds of pieces and model types, fixed values of the format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
SLICE = 8 << 20
SCHEMA = "doc_id long, ids array<int>, decoded string"


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_extra: bool = True
    escape: bool = True


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a message; bytes for nested and fixed-width values."""
    i, n = 0, len(data)

    def varint(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            b = data[i]
            value |= (b & 0x7F) << shift
            i, shift = i + 1, shift + 7
            if b < 0x80:
                return value, i

    while i < n:
        tag, i = varint(i)
        kind = tag & 7
        if kind == 0:
            value, i = varint(i)
        elif kind == 2:
            size, i = varint(i)
            value, i = data[i : i + size], i + size
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, i = data[i : i + size], i + size
        else:
            raise ValueError(f"wire type {kind} in a model file")
        yield tag >> 3, value


def parse(data: bytes) -> Model:
    """Pieces and settings of a model file; absent fields have the format's defaults."""
    model = Model()
    for number, value in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for k, v in _fields(value):
                if k == 1:
                    piece = v.decode()
                elif k == 2:
                    score = struct.unpack("<f", v)[0]
                elif k == 3:
                    kind = v
            model.pieces.append((piece, score, kind))
        elif number == 2:
            model.kind = dict(_fields(value)).get(3, UNIGRAM)
        elif number == 3:
            own = dict(_fields(value))
            model.charsmap = own.get(2, b"")
            model.dummy_prefix, model.remove_extra, model.escape = (bool(own.get(k, 1)) for k in (3, 4, 5))
    return model


def build(model: Model, prefix: bool = True):
    """The library's tokenizer for the model; without ``prefix`` texts get no dummy prefix."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    unknown = next((i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN), None)
    fallback = any(k == BYTE for _, _, k in model.pieces)
    if model.kind == BPE:
        vocabulary = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        usable = {p for p, _, k in model.pieces if k in (NORMAL, USER_DEFINED)}
        merges = []
        for piece, score, kind in model.pieces:
            if kind not in (NORMAL, USER_DEFINED) or len(piece) < 2:
                continue
            pairs = [(piece[:i], piece[i:]) for i in range(1, len(piece)) if piece[:i] in usable and piece[i:] in usable]
            merges += [(-score, vocabulary[a], vocabulary[b], (a, b)) for a, b in pairs]
        merges.sort(key=lambda m: m[:3])
        core = models.BPE(vocabulary, [m[3] for m in merges], unk_token=model.pieces[unknown][0] if unknown is not None else None, fuse_unk=True, byte_fallback=fallback)
    elif model.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], unknown, byte_fallback=fallback)
    else:
        raise ValueError(f"model type {model.kind} is neither unigram nor BPE")
    tokenizer = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.remove_extra:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix and prefix:
        steps.append(normalizers.Prepend(MARKER if model.escape else " "))
    if model.escape:
        steps.append(normalizers.Replace(" ", MARKER))
    if steps:
        tokenizer.normalizer = normalizers.Sequence(steps)
    tokenizer.decoder = decoders.Sequence([decoders.Replace(MARKER, " "), decoders.ByteFallback(), decoders.Fuse(), *([decoders.Strip(" ", 1, 0)] if model.dummy_prefix else [])])
    return tokenizer


def separable(model: Model) -> bool:
    """Whether a text's ids are those of its parts cut before runs of blanks: a BPE that maps no characters and has no marker after another character."""
    return (
        model.kind == BPE and not model.charsmap and not model.remove_extra and model.escape and model.dummy_prefix
        and not any(k == USER_DEFINED for _, _, k in model.pieces)
        and not any(MARKER in p.lstrip(MARKER) for p, _, _ in model.pieces)
    )


class Codec:
    """Encoder and decoder of one model in a worker."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        with open(path, "rb") as f:
            self.model = parse(f.read())
        self.whole = build(self.model)
        if separable(self.model):
            follow = build(self.model, prefix=False)

            def encode(parts: list[bytes]) -> list[list[int]]:
                out: list[list[int]] = [[]] * len(parts)
                for flag, tokenizer in ((0, follow), (1, self.whole)):
                    own = [k for k, p in enumerate(parts) if p[0] == flag]
                    for k, e in zip(own, tokenizer.encode_batch_fast([parts[k][1:].decode() for k in own], add_special_tokens=False), strict=True):
                        out[k] = e.ids
                return out

            self.encode = Encoder(space_splits, encode, by_start=True)
        else:
            self.encode = Encoder(lambda data: np.zeros(len(data), bool), lambda parts: [e.ids for e in self.whole.encode_batch_fast([p.decode() for p in parts], add_special_tokens=False)])
        written = [
            bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k in (CONTROL, UNKNOWN) else p.replace(MARKER, " ").encode() for p, _, k in self.model.pieces
        ]
        self.written = pa.array(written, pa.large_binary())
        self.sizes = np.array([len(x) for x in written], np.int64)

    def decode(self, ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of all texts end to end and offsets: pieces joined, markers as blanks, without the dummy prefix."""
        joined = self.written.take(pa.array(ids.astype(np.int32)))
        data = np.frombuffer(joined.buffers()[2] or b"", np.uint8)[: int(self.sizes[ids].sum())]
        ends = np.concatenate(([0], np.cumsum(self.sizes[ids])))[off]
        if self.model.dummy_prefix:
            first = ends[:-1][ends[:-1] < ends[1:]]
            first = first[data[first] == 0x20]
            keep = np.ones(len(data), bool)
            keep[first] = False
            gone = np.concatenate(([0], np.cumsum(~keep)))
            data, ends = data[keep], ends - gone[ends]
        return data, ends


def codec(path: str) -> Codec:
    if ("piece", path) not in _made:
        _made["piece", path] = Codec(path)
    return _made["piece", path]


def _coded(docs: DataFrame, path: str, schema: str, make) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for low, high in slices(batch, "text", SLICE):
                part = batch.slice(low, high - low)
                data, off = raw(part.column("text"))
                ids, ends = own.encode(data, off)
                yield make(own, part, data, off, ids, ends)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(trimmed(rows), schema)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded) for every row: ids of the whole text and the text they decode to.

    A null or empty text has no ids and decodes to an empty text. Rows aren't moved; repeated rows and
    null ids give a row each, an empty table none. Only doc_id and text are read.
    """

    def make(own, part, data, off, ids, ends):
        back, back_ends = own.decode(ids, ends)
        lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))
        texts = pa.array([back[a:b].tobytes().decode(errors="replace") for a, b in zip(back_ends[:-1].tolist(), back_ends[1:].tolist(), strict=True)], pa.string())
        return pa.RecordBatch.from_arrays([part.column("doc_id"), lists, texts], names=["doc_id", "ids", "decoded"])

    return _coded(docs, path, SCHEMA, make)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, decoded_crc32, round_trip) for every row, from the same encoding and decoding as ``encode``.

    Null and empty texts, repeated rows, null ids and empty tables are treated as there.
    """

    def make(own, part, data, off, ids, ends):
        back, back_ends = own.decode(ids, ends)
        little = ids.astype("<u4")
        codes = [zlib.crc32(little[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        bounds = list(zip(back_ends[:-1].tolist(), back_ends[1:].tolist(), off[:-1].tolist(), off[1:].tolist(), strict=True))
        texts = [zlib.crc32(back[a:b]) for a, b, _, _ in bounds]
        same = [b - a == d - c and np.array_equal(back[a:b], data[c:d]) for a, b, c, d in bounds]
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(np.diff(ends)), pa.array(codes, pa.int64()), pa.array(texts, pa.int64()), pa.array(same, pa.bool_())],
            names=["doc_id", "n_tokens", "ids_crc32", "decoded_crc32", "round_trip"],
        )

    return _coded(docs, path, "doc_id long, n_tokens long, ids_crc32 long, decoded_crc32 long, round_trip boolean", make)


def parity(texts: list[str], path: str) -> list[str]:
    """Texts whose ids or decoded text differ from the reference implementation's."""
    import sentencepiece

    theirs = sentencepiece.SentencePieceProcessor(model_file=path)
    own = codec(path)
    ids, ends = own.encode(*raw(pa.array(texts, pa.string())))
    back, back_ends = own.decode(ids, ends)
    wrong = []
    for k, text in enumerate(texts):
        expected = theirs.encode(text)
        mine = ids[ends[k] : ends[k + 1]].tolist()
        if mine != expected or back[back_ends[k] : back_ends[k + 1]].tobytes().decode(errors="replace") != theirs.decode(expected):
            wrong.append(text)
    return wrong
