"""Byte-level BPE encoding and decoding by a sentencepiece model that is serialised from the ranks.

A vocabulary of byte strings by rank becomes a merge-type sentencepiece model: every byte is mapped to a character of its
own, a piece is the mapped bytes of a token, its score the negative rank, its id the rank, and normalisation is the
identity without a dummy prefix or escaped blanks. The highest score merges first and the leftmost of equals, which is the
order of ranks. Texts are split by the pattern of the vocabulary, and each pre-token is encoded on its own; one that is a
token as a whole is that token, also where merges don't lead to it. Ids decode by the inverse mapping.

Texts are parted before every blank that something other than white space follows: whatever is around, a pre-token begins
there in patterns of this family, as letters, digits and marks take one blank before them, and white space leaves its last
character to what follows. Parts are remembered with their ids and bytes (a bounded number of them, which only saves time).
Texts are walked in stretches that end at such places, so that memory is that of a stretch and the ids. A map: a row in, a
row out, nothing is shuffled.

Defined results: null is encoded as the empty text, without ids; very long texts are encoded whole; rows, ids, order and
repeated rows stay as they are; an empty table stays empty. Other columns are passed through, also those named as the new
ones, which then get leading underscores (`common.fresh`); the new columns are the last two.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..shipping import ship
from .common import byte_column, fresh, int_lists, slices

#: Characters for the 256 bytes, in order from here on; none of them means anything to a sentencepiece model.
FIRST_CHAR = 0x100
#: A character that no piece has.
DIVIDER = chr(FIRST_CHAR + 256)
#: Stands for the byte FF, which no UTF-8 has; and how many pre-tokens the library gets in a string.
NO_UTF8, AT_ONCE = "\udcff", 50
#: Fields and values of the serialised model: message fields by number, BPE as model type, UNKNOWN as piece type.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
BPE, UNKNOWN = 2, 2


def read_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file: a token in base 64 and its rank on every line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def mapped(token: bytes) -> str:
    return token.decode("latin-1").translate(_MAP)


_MAP = {b: FIRST_CHAR + b for b in range(256)}
_MAP_DIVIDED = _MAP | {0xFF: FIRST_CHAR + 256}
_BACK = {FIRST_CHAR + b: b for b in range(256)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _block(field: int, content: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(content)) + content


def _piece(text: str, score: float, kind: bytes = b"") -> bytes:
    return _block(PIECES, _block(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + kind)


def serialise(ranks: Mapping[bytes, int]) -> bytes:
    """The model file of a vocabulary whose ranks are 0, 1, 2 and so on; an unknown piece, never used, has the id after them."""
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must be 0, 1, 2 and so on")
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"{len(missing)} bytes have no token")
    unknown = len(tokens)
    pieces = [_piece(mapped(t), -rank) for rank, t in enumerate(tokens)]
    pieces.append(_piece("<unk>", 0.0, _number(3, UNKNOWN)))
    trainer = _number(3, BPE) + _number(4, unknown + 1) + _number(40, unknown)
    normalizer = _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join([*pieces, _block(TRAINER, trainer), _block(NORMALIZER, normalizer)])


class ByteCodec:
    def __init__(self, ranks: Mapping[bytes, int], pattern: str, remembered: int = 500_000, stretch: int = 1 << 20):
        import numpy as np
        import regex
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(ranks))
        self.split = regex.compile(pattern).findall
        self.stretch, self.remembered, self.unknown = stretch, remembered, len(ranks)
        #: The inverse mapping, from the pieces of the model itself: the bytes of each id, where they begin in all of them, how many there are.
        self.bytes_of = [self.model.id_to_piece(i).translate(_BACK).encode("latin-1") for i in range(len(ranks))]
        self.all_bytes = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.width = np.array([len(b) for b in self.bytes_of], np.int64)
        self.begin = np.cumsum(self.width) - self.width
        #: Parts of texts, with their ids as int32.
        self.known: dict[str, bytes] = {}
        tokens = [t for t in ranks if len(t) > 1]
        ids, ends = self.merged([DIVIDER.join(map(mapped, tokens[at : at + AT_ONCE])) for at in range(0, len(tokens), AT_ONCE)])
        unreached = np.flatnonzero((np.diff(ends) != 1) | (ids[ends[:-1]] != [ranks[t] for t in tokens])) if tokens else ()
        #: Tokens that no merges lead to: they stand for pre-tokens only that equal them.
        self.whole = {tokens[k]: ranks[tokens[k]] for k in unreached}

    def merged(self, groups: list[str]):
        """(ids, where each token's ids end, from 0 on) of mapped tokens, many to a string. They are divided by a character that no
        piece has: nothing merges across it, and it comes out as the unknown id.
        """
        import numpy as np

        ids = np.concatenate([np.array([*part, self.unknown], np.int32) for part in self.model.encode(groups, num_threads=1)]) if groups else np.empty(0, np.int32)
        divided = np.flatnonzero(ids == self.unknown)
        return ids[ids != self.unknown], np.append(0, divided - np.arange(len(divided)))

    def encode_tokens(self, tokens: list[str]):
        """(ids, where each one's ids end, from 0 on) of pre-tokens, each encoded on its own."""
        import numpy as np

        join = lambda some: NO_UTF8.join(some).encode(errors="surrogateescape").decode("latin-1").translate(_MAP_DIVIDED)
        ids, ends = self.merged([join(tokens[at : at + AT_ONCE]) for at in range(0, len(tokens), AT_ONCE)])
        odd = [(k, t) for k, token in enumerate(tokens) if (t := token.encode()) in self.whole] if self.whole else []
        if odd:
            parts = np.split(ids, ends[1:-1])
            for k, t in odd:
                parts[k] = np.array([self.whole[t]], np.int32)
            ids, ends = np.concatenate(parts), np.cumsum([0, *map(len, parts)])
        return ids, ends

    def decode(self, ids) -> bytes:
        """ids: an array."""
        import numpy as np

        width = self.width[ids]
        ends = np.cumsum(width)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.begin[ids] - ends + width, width)
        return self.all_bytes[at].tobytes()

    def learn(self, first: set[str], later: set[str]) -> None:
        """Encode these parts. later: those that begin where a pre-token does, whatever is before them, so they are split end to end."""
        import numpy as np

        parts = [*later, *first]
        tokens = self.split("".join(later))
        for p in first:
            tokens += self.split(p)
        # parts end where tokens do
        last = np.searchsorted(np.cumsum([0, *map(len, tokens)]), np.cumsum([0, *map(len, parts)]))
        ids, ends = self.encode_tokens(tokens)
        packed, bounds = ids.tobytes(), (4 * ends[last]).tolist()
        self.known.update(zip(parts, map(packed.__getitem__, map(slice, bounds, bounds[1:])), strict=False))

    def stretches(self, texts: list[str]) -> Iterator[list[tuple[int, str]]]:
        """(which text, a stretch of it), as many at a time as have about the length of a stretch."""
        out, size = [], 0
        for k, text in enumerate(texts):
            at = 0
            while at < len(text):
                found = _PLACE.search(text, at + self.stretch)
                end = found.start() if found else len(text)
                out.append((k, text[at:end]))
                size, at = size + end - at, end
                if size >= self.stretch:
                    yield out
                    out, size = [], 0
        if out:
            yield out

    def convert(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """(ids as int32, the bytes that they decode to) of each text."""
        import numpy as np

        done: list[list[bytes]] = [[] for _ in texts]
        for group in self.stretches(texts):
            parted = [(k, parts_of(t)) for k, t in group]
            first = {parts[0] for _, parts in parted}
            later = set().union(*[parts for _, parts in parted])
            known = self.known
            new = later.difference(known)
            if len(known) + len(new) > self.remembered:
                known.clear()
                new = later
            new_first = first & new
            self.learn(new_first, new - new_first)
            for k, parts in parted:
                done[k].append(b"".join(map(known.__getitem__, parts)))
        out = []
        for parts in done:
            ids = b"".join(parts)
            out.append((ids, self.decode(np.frombuffer(ids, np.int32))))
        return out


_PLACE, _PARTS, _DOUBTFUL = re.compile(r" (?=\S)"), re.compile(r"(?= \S)"), re.compile(r" \s| \Z|\0")


def parts_of(text: str) -> list[str]:
    """The text, parted before every blank that something other than white space follows."""
    return _PARTS.split(text) if _DOUBTFUL.search(text) else text.replace(" ", "\0 ").split("\0")


_codecs: dict[tuple[str, str], ByteCodec] = {}


def codec(ranks_path: str, pattern: str) -> ByteCodec:
    """One per process and vocabulary."""
    key = ranks_path, pattern
    if key not in _codecs:
        _codecs[key] = ByteCodec(read_ranks(ranks_path), pattern)
    return _codecs[key]


def encode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """docs without text_col, then `ids` (array<int>) and `decoded` (the bytes that these decode to, binary).

    ranks_path must be readable on every executor.
    """
    ship(docs.sparkSession)
    kept = [f for f in docs.schema.fields if f.name != text_col]
    ids_as, decoded_as = fresh(docs.drop(text_col), "ids", "decoded")
    schema = T.StructType([*kept, T.StructField(ids_as, T.ArrayType(T.IntegerType(), False)), T.StructField(decoded_as, T.BinaryType())])

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        convert = codec(ranks_path, pattern).convert
        for part in slices(batches):
            done = convert([t or "" for t in part.column(part.num_columns - 1).to_pylist()])
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], int_lists([x[0] for x in done]), byte_column([x[1] for x in done])], names=schema.names)

    return docs.select(*[f"`{f.name}`" for f in kept], f"`{text_col}`").mapInArrow(work, schema)
