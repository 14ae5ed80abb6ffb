"""Fill-in-middle transformation by a byte automaton.

One table-driven automaton over UTF-8 bytes knows three things at once: whether a byte goes on with a character, whether it
begins a unit (a line, with its line feed), and how much of a sentinel was seen. Its transitions emit what they mean: a
character begins, a unit begins, a sentinel is complete. One scan over all texts of a batch counts these; a second pass
over the unit transitions of each text finds where its two cuts fall.

The automaton forgets everything but the last `memory` bytes (three continuation bytes, or a sentinel but its last byte), so
its state before a byte follows from the bytes just before it, whatever the state before those. The scan therefore runs for
all bytes of a block side by side, in `memory` lookups, and needs no order between blocks. A text begins with a symbol of
its own, which leads to the first state from any other.

A text is cut after the smaller and after the larger of two seeded numbers of units: prefix, middle and suffix. It is
written as prefix, suffix, middle (psm) or suffix, prefix, middle (spm), each with its sentinel, or left as it is (plain) if
it is empty or null or holds a sentinel. Seeds are digests of the id, so reruns agree; rows of one id share their seeds,
null ids those of the word null. `restore` rebuilds the text from output and form.

Defined results: null is the empty text; very long texts are handled whole, block by block; repeated rows give equal rows;
an empty table gives an empty one. Other columns are passed through, also those named as the new ones, which then get
leading underscores (`common.fresh`); the new columns are the last five. A map: nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shipping import ship
from .common import byte_column, fresh, slices

#: What a transition emits, as bits.
CHARACTER, UNIT, SENTINEL = 1, 2, 4
#: The symbol before every text; bytes are 0 to 255.
BEGIN = 256


@dataclass(frozen=True)
class State:
    boundary: bool = True
    #: Continuation bytes to come.
    due: int = 0
    #: The longest beginning of a sentinel that was just read.
    seen: bytes = b""


@dataclass(frozen=True)
class Cutting:
    """How texts are cut and written. percent: texts transformed; spm_percent: of these, suffix first."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    seed: str = "7"
    percent: int = 100
    spm_percent: int = 50

    @property
    def sentinels(self) -> tuple[bytes, ...]:
        return self.prefix.encode(), self.suffix.encode(), self.middle.encode()

    @cached_property
    def automaton(self) -> Automaton:
        return Automaton(self.sentinels)


class Automaton:
    def __init__(self, sentinels: tuple[bytes, ...]):
        import numpy as np

        self.sentinels = sentinels
        self.memory = max(3, *(len(s) - 1 for s in sentinels))
        states, table = [State()], []
        for state in states:  # grows by the states that are reached
            row = []
            for symbol in range(BEGIN + 1):
                after, emitted = self.step(state, symbol)
                if after not in states:
                    states.append(after)
                row.append((states.index(after), emitted))
            table.append(row)
        full = np.array(table, np.int64)  # state, symbol, (next, emitted)
        columns, self.class_of = np.unique(full.transpose(1, 0, 2).reshape(BEGIN + 1, -1), axis=0, return_inverse=True)
        self.class_of = self.class_of.reshape(-1).astype(np.uint8)
        self.classes = len(columns)
        by_class = columns.reshape(self.classes, len(states), 2).transpose(1, 0, 2)
        #: Of each state times classes plus class: the next state times classes, and what is emitted.
        self.next, self.emitted = (by_class[..., 0] * self.classes).astype(np.uint16).ravel(), by_class[..., 1].astype(np.uint8).ravel()
        self.states = states
        self.anywhere = states.index(State(boundary=False)) * self.classes

    def step(self, state: State, symbol: int) -> tuple[State, int]:
        if symbol == BEGIN:
            return State(), 0
        going_on = 0x80 <= symbol < 0xC0
        due = max(state.due - 1, 0) if going_on else (symbol >= 0xC0) + (symbol >= 0xE0) + (symbol >= 0xF0)
        read = state.seen + bytes([symbol])
        seen = next((read[k:] for k in range(len(read)) if any(len(read) - k < len(s) and s.startswith(read[k:]) for s in self.sentinels)), b"")
        emitted = CHARACTER * (not going_on) + UNIT * state.boundary + SENTINEL * any(read.endswith(s) for s in self.sentinels)
        return State(symbol == 0x0A, due, seen), emitted

    def scan(self, data, starts, block: int = 1 << 19):
        """What the transition into each symbol emits: a byte for every byte of data, and one before each text for its beginning.

        data: bytes as uint8, texts end to end; starts: where each text begins.
        """
        import numpy as np

        classes = np.insert(self.class_of[data], starts, self.class_of[BEGIN])
        out = np.empty(len(classes), np.uint8)
        before = np.concatenate([np.full(self.memory, self.class_of[BEGIN], np.uint8), classes])
        for at in range(0, len(classes), block):
            n = min(block, len(classes) - at)
            state = np.full(n, self.anywhere, np.uint16)
            for k in range(self.memory):
                state = self.next.take(state + before[at + k : at + k + n])
            out[at : at + n] = self.emitted.take(state + classes[at : at + n])
        return out


def pieces(how: Cutting, texts, seeds: list[tuple[int, int, int, int]]) -> Iterator[tuple[int, str, int | None, int | None, bytes]]:
    """(units, form, characters of the prefix, of the middle, output) of each text. texts: an Arrow column without nulls."""
    import numpy as np
    import pyarrow as pa

    _, where, content = texts.cast(pa.string()).buffers()
    ends = np.frombuffer(where, np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
    data = np.frombuffer(content, np.uint8, ends[-1])[ends[0] :] if content else np.empty(0, np.uint8)
    raw, starts = memoryview(data), ends - ends[0]
    emitted = how.automaton.scan(data, starts[:-1])
    marks = starts + np.arange(len(starts))  # of the symbols that begin the texts
    units, found = np.flatnonzero(emitted & UNIT), np.flatnonzero(emitted & SENTINEL)
    unit_ends, found_ends = np.searchsorted(units, marks), np.searchsorted(found, marks)
    begins = emitted & CHARACTER
    for k, (h1, h2, h3, h4) in enumerate(seeds):
        first, n = int(unit_ends[k]), int(unit_ends[k + 1] - unit_ends[k])
        begin, end, mark = int(starts[k]), int(starts[k + 1]), int(marks[k])
        if begin == end or found_ends[k] < found_ends[k + 1] or h3 % 100 >= how.percent:
            yield n, "plain", None, None, raw[begin:end].tobytes()
            continue
        # the second pass: a cut is where the unit after it begins
        low, high = (end if c == n else begin + int(units[first + c]) - mark - 1 for c in sorted((h1 % (n + 1), h2 % (n + 1))))
        count = lambda a, b: int(np.count_nonzero(begins[mark + 1 + a - begin : mark + 1 + b - begin]))  # noqa: B023, E731
        prefix, middle, suffix = raw[begin:low], raw[low:high], raw[high:end]
        p, s, m = how.sentinels
        spm = h4 % 100 < how.spm_percent
        output = b"".join((s, suffix, p, prefix, m, middle) if spm else (p, prefix, s, suffix, m, middle))
        yield n, "spm" if spm else "psm", count(begin, low), count(low, high), output


def transform(docs: DataFrame, how: Cutting | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs and `units` (long), `form`, `prefix_chars`, `middle_chars` (long; null if plain), `output`."""
    ship(docs.sparkSession)
    how = how or Cutting()
    names = fresh(docs, "units", "form", "prefix_chars", "middle_chars", "output")
    kinds = (T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.StringType())
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, k) for n, k in zip(names, kinds, strict=True))])
    digest = F.sha2(F.concat(F.lit(f"{how.seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null"))).cast("binary"), 256)
    seeds = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]
    body = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for part in slices(batches):
            *kept, h1, h2, h3, h4, text = part.columns
            done = list(pieces(how, text, list(zip(*(h.to_pylist() for h in (h1, h2, h3, h4)), strict=True))))
            new = [pa.array([d[k] for d in done], kind) for k, kind in enumerate((pa.int64(), pa.string(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*kept, *new, byte_column([d[4] for d in done], "string")], names=schema.names)

    scratch = [c.alias(f"seed{k}") for k, c in enumerate(seeds)]
    return docs.select("*", *scratch, body.alias("body")).mapInArrow(work, schema)


def restore(output: Column, form: Column, how: Cutting | None = None) -> Column:
    """The text, from what transform made of it: neither it nor its parts hold a sentinel, so sentinels divide the output."""
    how = how or Cutting()
    parts = F.split(output, "|".join(re.escape(s) for s in (how.prefix, how.suffix, how.middle)))
    part = lambda k: F.get(parts, F.lit(k))
    return F.when(form == "psm", F.concat(part(1), part(3), part(2))).when(form == "spm", F.concat(part(2), part(3), part(1))).otherwise(output)
