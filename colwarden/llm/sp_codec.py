"""SentencePiece encoding and decoding by a prefix table.

For merge-type (BPE) models: of all tokens that match up to a place, just one can end the encoding of that prefix, namely
the one that is compatible with the last token of the prefix before it. Two tokens are compatible if merging their joined
text gives these two again. So one sweep with an Aho-Corasick automaton stores the last token of every prefix, and ids
are read from the table backwards, in time linear in the text, whatever its length.

No piece holds anything before a space mark other than space marks, and characters that occur in no longer piece never
merge; texts are therefore cut before runs of space marks and around line feeds, and the pieces between are remembered
(a bounded number of them, which only saves time). A model where this doesn't hold is encoded uncut.

Defined results: null is encoded as the empty text, without ids; characters outside the vocabulary become byte pieces, or
the unknown id where the model has none; rows, ids, order and repeated rows stay as they are; an empty table stays empty.
Extra columns are passed through; where one has the name of a new column, whatever the case, the new one's begins with `_`.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..shipping import ship
from .common import fresh

SPACE = "▁"


class Codec:
    """Encodes and decodes as the library does, for identity-normalised BPE models with a dummy prefix."""

    def __init__(self, model_path: str, remembered: int = 600_000):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.unknown = sp.unk_id()
        size = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.rank = {pieces[i]: (-sp.get_score(i), i) for i in plain}
        self.byte_ids = {int(pieces[i][3:5], 16): i for i in range(size) if sp.is_byte(i)}
        self.text = {i: pieces[i] for i in plain}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.surface = {i: f" {chr(0x2047)} ".encode() for i in range(size) if sp.is_unknown(i)}
        self.size = size
        self.surface |= {i: p.replace(SPACE, " ").encode() for i, p in self.text.items()}
        self.automaton = ahocorasick.Automaton()
        for i in plain:
            if self.merged(pieces[i]) == [pieces[i]]:  # else it never occurs
                self.automaton.add_word(pieces[i], (len(pieces[i]), i))
        self.automaton.make_automaton()
        longer = [pieces[i] for i in plain if len(pieces[i]) > 1]
        self.cut_spaces = not any(SPACE in p.lstrip(SPACE) for p in longer)
        self.cut_lines = not any("\n" in p for p in longer)
        #: Before these marks a text may be cut, unless it holds a mark after a character that some piece has before it.
        self.marks = {m: sorted({p[k - 1] for p in longer for k in range(1, len(p)) if p[k] == m}) for m in ",."}
        self.remembered = remembered
        #: Whether two tokens stay two, by left id times size plus right id.
        self.pairs: dict[int, bool] = {}
        codec = self

        class Known(dict):
            def __missing__(self, part: str) -> tuple[bytes, bytes]:
                ids = codec.encode_part(part)
                value = array("i", ids).tobytes(), codec.decode_part(ids)
                if len(part) <= 64:
                    if len(self) >= codec.remembered:
                        self.clear()
                    self[part] = value
                return value

        #: Ids of parts, and what these ids decode to.
        self.known = Known({"": (b"", b"")})
        self.check(sp, pieces)

    def check(self, sp, pieces: list[str]) -> None:
        """Raise ValueError unless this codec agrees with the library on every piece and on what normalisers change.

        Models of another type, with another normaliser, without the dummy prefix or with symbols of their own differ here.
        """
        usable = [p.replace(SPACE, " ") for i, p in enumerate(pieces) if i in self.text]
        probes = ["".join(usable[k : k + 50]) for k in range(0, len(usable), 50)]
        probes += ["a  b ", " a", "\t a\n\nb", "ﬁ Ａ ｱ ² Å é", "The cat sat, and THE dog.", "日本語 😀"]
        for text in probes:
            ids, decoded = self.convert(text)
            want = sp.encode(text)
            if memoryview(ids).cast("i").tolist() != want or decoded.decode() != sp.decode(want):
                raise ValueError("not a merge-type model with identity normalisation and a dummy prefix")
        self.known.clear()
        self.known[""] = b"", b""

    def merged(self, text: str) -> list[str]:
        """Plain BPE, for the short texts of pair tests: the best-ranked neighbours merge, the leftmost of equals first."""
        parts = list(text)
        while len(parts) > 1:
            best = min(((self.rank[parts[k] + parts[k + 1]], k) for k in range(len(parts) - 1) if parts[k] + parts[k + 1] in self.rank), default=None)
            if best is None:
                break
            k = best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def compatible(self, left: int, right: int) -> bool:
        if len(self.pairs) >= 400_000:
            self.pairs.clear()
        a, b = self.text[left], self.text[right]
        known = self.pairs[left * self.size + right] = a + b not in self.rank and self.merged(a + b) == [a, b]
        return known

    def encode_part(self, part: str) -> list[int]:
        at = len(part)
        # of the last token of part[:e]: where it starts and its id; -1 for a character without a piece
        start, last = list(range(-1, at)), [-1] * (at + 1)
        pairs, size, filled = self.pairs, self.size, -1
        for end, (length, token) in self.automaton.iter(part):  # of matches with one end, the longest comes first
            if end == filled:
                continue
            begin = end + 1 - length
            if begin and (left := last[begin]) >= 0:
                if (fits := pairs.get(left * size + token)) is None:
                    fits = self.compatible(left, token)
                if not fits:
                    continue
            start[end + 1], last[end + 1], filled = begin, token, end
        ids: list[int] = []
        while at:
            if (token := last[at]) >= 0:
                ids.append(token)
            elif self.byte_ids:
                ids += [self.byte_ids[b] for b in reversed(part[start[at] : at].encode())]
            else:
                ids.append(self.unknown)
            at = start[at]
        ids.reverse()
        return ids

    def decode_part(self, ids: list[int]) -> bytes:
        """UTF-8 of the ids' text, the dummy prefix not yet taken off. Bytes that make no character become U+FFFD, one each."""
        surface = self.surface
        if all(map(surface.__contains__, ids)):
            return b"".join([surface[i] for i in ids])
        out, run = [], bytearray()

        def flush() -> None:
            while run:
                for width in range(1, 5):
                    try:
                        run[:width].decode()
                    except UnicodeDecodeError:
                        continue
                    out.append(bytes(run[:width]))
                    del run[:width]
                    break
                else:
                    out.append("�".encode())
                    del run[:1]

        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            flush()
            out.append(surface.get(i, b""))
        flush()
        return b"".join(out)

    def parts(self, text: str) -> list[str]:
        marked = SPACE + text.replace(" ", SPACE)
        if not (self.cut_spaces and self.cut_lines):
            return [marked]
        if SPACE + SPACE in marked or "\0" in marked:
            import re

            return re.findall(rf"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+", marked)
        cut = marked.replace(SPACE, "\0" + SPACE).replace("\n", "\0\n\0")
        for mark, glued in self.marks.items():
            if not any(x + mark in marked for x in glued):
                cut = cut.replace(mark, "\0" + mark)
        return cut.split("\0")

    def convert(self, text: str | None) -> tuple[bytes, bytes]:
        """(ids as int32, decoded text in UTF-8)."""
        if not text:
            return b"", b""
        parts = [self.known[p] for p in self.parts(text)]
        ids, decoded = b"".join([p[0] for p in parts]), b"".join([p[1] for p in parts])
        return ids, decoded[1:] if decoded[:1] == b" " else decoded

    def decode(self, ids: list[int]) -> str:
        text = self.decode_part(ids)
        return (text[1:] if ids and self.text.get(ids[0], "").startswith(SPACE) else text).decode()


_codecs: dict[str, Codec] = {}


def codec(model_path: str) -> Codec:
    """One per process and model."""
    if model_path not in _codecs:
        _codecs[model_path] = Codec(model_path)
    return _codecs[model_path]


def encode(docs: DataFrame, model_path: str, text_col: str = "text", ids_as: str = "ids", decoded_as: str = "decoded", rows: int = 256) -> DataFrame:
    """docs without text_col, with its ids (array<int>) and the text that these decode to. A map: nothing is shuffled.

    model_path must be readable on every executor. rows: batch size of what is returned, which bounds memory. The new
    columns are the last two.
    """
    ship(docs.sparkSession)
    kept = [f for f in docs.schema.fields if f.name != text_col]
    ids_as, decoded_as = fresh(docs.drop(text_col), ids_as, decoded_as)
    schema = T.StructType([*kept, T.StructField(ids_as, T.ArrayType(T.IntegerType(), False)), T.StructField(decoded_as, T.StringType())])

    def work(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        convert = codec(model_path).convert
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                done = [convert(t) for t in part.column(part.num_columns - 1).to_pylist()]
                ends = lambda i, unit: pa.py_buffer(np.concatenate([[0], np.cumsum([len(x[i]) // unit for x in done], dtype=np.int64)]).astype(np.int32))
                values = b"".join([x[0] for x in done])
                ids = pa.ListArray.from_buffers(pa.list_(pa.field("element", pa.int32(), False)), len(done), [None, ends(0, 4)], children=[pa.Array.from_buffers(pa.int32(), len(values) // 4, [None, pa.py_buffer(values)])])
                text = pa.StringArray.from_buffers(len(done), ends(1, 1), pa.py_buffer(b"".join([x[1] for x in done])))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], ids, text], names=schema.names)

    return docs.select(*[f"`{f.name}`" for f in kept], f"`{text_col}`").mapInArrow(work, schema)
