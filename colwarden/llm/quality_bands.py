"""Quality rules with compression bands.

A text is compressed by zstandard as a whole and in fixed chunks. Text that repeats itself compresses far better than
prose of its length, random characters far worse; as short texts compress worse than long ones, each length class has its
own band of accepted ratios (original size over compressed size). A text is rejected if its whole ratio leaves the band of
its length, or if more than a share of its bytes lie in chunks that leave their band: that of full chunks, or for what is
left at the end, the band of its length. A text shorter than a chunk is a chunk of its own. Words, repeated windows, symbols
and lines are counted over the whole text, next to it.

Defined results: null is a text without words; counts of it are 0, its ratios null, and base_failed is true as it has fewer
words than asked for; an empty text likewise. Repeated rows each return; every text is compressed whole, whatever its
length, chunk by chunk in memory of one text. Extra columns do not take part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .common import small

SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Bands:
    """(bytes from, least ratio, greatest ratio) by length, and the band of full chunks. Prose stays well inside; words said over and over or random characters do not."""

    whole: tuple[tuple[int, float, float], ...] = ((0, 0.9, 2.4), (200, 1.05, 2.4), (500, 1.3, 2.6), (1_000, 1.5, 3.0), (2_000, 1.65, 3.3), (5_000, 1.8, 3.6), (10_000, 1.8, 4.0), (20_000, 1.9, 5.0), (50_000, 1.9, 8.0))
    chunk_bytes: int = 4_096
    chunk: tuple[float, float] = (1.5, 4.0)
    bad_chunks: float = 0.3
    level: int = 3


def band_of(bands: Bands, size: int) -> tuple[float, float]:
    low, high = 0.0, float("inf")
    for start, a, b in bands.whole:
        if size >= start:
            low, high = a, b
    return low, high


class Judge:
    """Holds the compressors, which are made once for each task."""

    def __init__(self, bands: Bands):
        import zstandard

        self.bands = bands
        self.compress = zstandard.ZstdCompressor(level=bands.level, write_content_size=False, write_checksum=False).compress

    def ratios(self, text: bytes) -> tuple[float | None, int, int, int]:
        """Ratio of the whole, chunks, chunks outside their band, bytes in these."""
        if not text:
            return None, 0, 0, 0
        size, whole = self.bands.chunk_bytes, len(text) / len(self.compress(text))
        bad = []
        for at in range(0, len(text), size):
            part = text[at : at + size]
            low, high = self.bands.chunk if len(part) == size else band_of(self.bands, len(part))
            if not low <= (whole if len(part) == len(text) else len(part) / len(self.compress(part))) <= high:
                bad.append(len(part))
        return whole, -(-len(text) // size), len(bad), sum(bad)

    def kept(self, text: bytes) -> tuple[bool, float | None, int, int]:
        ratio, chunks, bad, bad_bytes = self.ratios(text)
        if ratio is None:
            return True, None, 0, 0
        low, high = band_of(self.bands, len(text))
        return low <= ratio <= high and bad_bytes <= self.bands.bad_chunks * len(text), ratio, chunks, bad


def repeated_words(words: list[bytes], window: int = 8) -> int:
    """Words in windows of so many words that occur twice or more, first occurrences included.

    Exact: ranks of windows of 1, 2, 4, ... words, each from two halves, so equal ranks mean equal windows. Most texts end
    early, as no shorter window is there twice.
    """
    import numpy as np

    total = len(words)
    if total <= window:
        return 0
    number: dict[bytes, int] = {}
    rank = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, total)
    width = 1
    while width < window:
        step = min(width, window - width)
        pair = rank[: len(rank) - step] * (total + 1) + rank[step:]
        values, rank = np.unique(pair, return_inverse=True)
        if len(values) == len(pair):
            return 0
        width += step
    twice = np.bincount(rank)[rank] > 1
    cover = np.zeros(total + 1, np.int64)
    cover[: len(twice)] += twice
    cover[window : window + len(twice)] -= twice
    return int((np.cumsum(cover)[:total] > 0).sum())


def counts(text: bytes) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, lines with a word that equal an earlier line, words in repeated windows."""
    words = text.split()  # of bytes: at blank, tab, line feed, vertical tab, form feed, carriage return only
    chars = len(text.translate(None, _BLANK_OR_CONTINUED))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(words), chars, len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


#: Bytes that begin no word character: the blanks, and UTF-8's continuation bytes.
_BLANK_OR_CONTINUED = b" \t\n\v\f\r" + bytes(range(0x80, 0xC0))

SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, ratio double, n_chunks long, n_bad_chunks long"


def judge(docs: DataFrame, bands: Bands = Bands(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for every row of docs, in the columns of SCHEMA. A map: nothing is shuffled."""
    ship(docs.sparkSession)

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        own, schema = Judge(bands), None
        for batch in small(batches):
            rows = []
            for ident, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or b""
                n = counts(text)
                failed = n[0] < 20 or 100 * n[4] > 30 * n[0]
                kept, *ratios = own.kept(text)
                rows.append((ident, *n, failed, kept and not failed, *ratios))
            schema = schema or pa.schema([(c, {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}[t]) for c, t in (x.split() for x in SCHEMA.split(", "))])
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True) if rows else [[]] * len(schema), schema, strict=True)], schema=schema)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary")).mapInArrow(work, SCHEMA)
