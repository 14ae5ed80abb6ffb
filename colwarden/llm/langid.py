"""Language identification with string kernels.

The blended-spectrum presence kernel of two texts is the number of n-grams, of all lengths from low to high, that both
hold, normalised by the root of either text's own number. n-grams are of lower-cased letters and single blanks, hashed to
a fixed number of slots. A bounded sample of labelled rows is fitted: some of them are landmarks, the Nyström features of
a text are its kernel values with the landmarks times the inverse root of the landmarks' own kernel matrix, and one ridge
regression per language against the rest is solved in closed form. As the kernel is a product of presence vectors, the
landmarks, the inverse root and the weights fold into one matrix of slots by languages, so that scoring is one product of
a batch of presence vectors with that matrix, and costs the same for any number of landmarks.

Sampling: the different rows (id and text) of each language are counted by a sketch, and a row is drawn if a hash of its id
and text falls under quota / count, so an id on many rows is drawn no more than others; rows of one id and text count once.
The quota is per_language, or most_rows over the number of languages where that is less. Of each language at most 1.5 times
the quota is taken, and of these at most most_bytes of slots in all languages, so what the driver gets is bounded in rows
and in bytes, whatever the corpus. No language is left out; more than most_languages distinct ones raise an error.
Everything else covers all rows.

Defined results: null text, or text without a letter, is ``und`` with score 0; without any training row all are ``und``;
a null id is never a training row and not held out; very long texts are read
whole, in memory of one text and its slots; ties go to the language first in code point order; the score is the
softmax share of the winning language. Repeated rows each return. Extra columns do not take part.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shipping import ship
from .common import small


@dataclass(frozen=True)
class Settings:
    low: int = 2
    high: int = 4
    slots: int = 1 << 15
    per_language: int = 600
    most_rows: int = 20_000
    #: Of slots that the driver gets, 4 each.
    most_bytes: int = 128 << 20
    most_languages: int = 512
    landmarks: int = 512
    ridge: float = 1e-2
    sharpness: float = 8.0
    seed: int = 7


#: Rows of the weights that one product gathers, times languages: 16 MB of float32, or one text's where that is more.
GATHERED = 1 << 22
_LETTER = re.compile(r"[A-Za-z]")
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def has_letter(text: str) -> bool:
    return bool(_LETTER.search(text)) or any(map(str.isalpha, text))


def slots_of(text: str, how: Settings):
    """The distinct slots of a text's n-grams, ascending."""
    import numpy as np

    clean = f" {_NOT_LETTERS.sub(' ', text.lower()).strip()} "
    codes = np.frombuffer(clean.encode("utf-32-le"), np.uint32)
    seen = np.zeros(how.slots, bool)
    gram = np.zeros(len(codes), np.uint32)
    shift = np.uint32(32 - (how.slots.bit_length() - 1))
    for n in range(1, how.high + 1):
        gram = gram[: len(codes) - n + 1] * np.uint32(0x01000193) + codes[n - 1 :] + np.uint32(n == 1)
        if n >= how.low:
            seen[(gram * np.uint32(0x9E3779B1)) >> shift] = True
    return np.flatnonzero(seen)


@dataclass
class Model:
    languages: list[str]
    weights: object  # slots x languages
    bias: object
    how: Settings

    def scores(self, found: list):
        """Texts, given as their slots, by languages: a sparse presence matrix times the weights, row sums within each text."""
        import numpy as np

        size = np.array([len(x) for x in found])
        rows = self.weights[np.concatenate(found)]
        return np.add.reduceat(rows, np.concatenate([[0], np.cumsum(size)[:-1]]), axis=0) / np.sqrt(size)[:, None] + self.bias

    def batches(self, texts: list[str], most: int = GATHERED) -> Iterator[list]:
        """The texts' slots in order, in batches of no more than most weights to gather, or of one text."""
        part, held = [], 0
        for text in texts:
            slots = slots_of(text, self.how)
            if part and (held + len(slots)) * len(self.languages) > most:
                yield part
                part, held = [], 0
            part.append(slots)
            held += len(slots)
        if part:
            yield part

    def predict(self, texts: list[str | None], most: int = GATHERED) -> tuple[list[str], list[float]]:
        import numpy as np

        names, shares = ["und"] * len(texts), [0.0] * len(texts)
        known = [i for i, t in enumerate(texts) if t and has_letter(t)] if self.languages else []
        at = iter(known)
        for part in self.batches([texts[i] for i in known], most):
            s = self.scores(part)
            e = np.exp(self.how.sharpness * (s - s.max(axis=1, keepdims=True)))
            for best, share in zip(s.argmax(axis=1), e.max(axis=1) / e.sum(axis=1), strict=True):
                i = next(at)
                names[i], shares[i] = self.languages[best], float(share)
        return names, shares


def train(found: list, labels: list[str], how: Settings = Settings()) -> Model:
    """Closed-form fit on the rows' slots; the result depends on the given rows only, in the given order."""
    import numpy as np

    languages = sorted(set(labels), key=lambda y: y.encode())
    if not languages:
        return Model([], None, None, how)

    pick = np.sort(np.random.default_rng(how.seed).permutation(len(found))[: how.landmarks])
    marks = np.zeros((how.slots, len(pick)), np.float32)
    for k, i in enumerate(pick):
        marks[found[i], k] = 1 / np.sqrt(len(found[i]))
    kernel = np.array([marks[slots].sum(axis=0) / np.sqrt(len(slots)) for slots in found], np.float64)
    values, vectors = np.linalg.eigh(kernel[pick])
    good = values > values.max() * 1e-8
    whiten = vectors[:, good] / np.sqrt(values[good])
    features = kernel @ whiten
    number = Counter(labels)
    y = np.array([[1.0 if label == c else -1.0 for c in languages] for label in labels])
    # each language weighs the same, however many rows it has
    share = np.array([1.0 / number[label] for label in labels])[:, None]
    share *= len(labels) / share.sum()
    mean_f, mean_y = (features * share).mean(axis=0), (y * share).mean(axis=0)
    f = features - mean_f
    beta = np.linalg.solve(f.T @ (f * share) + how.ridge * len(labels) * np.eye(f.shape[1]), f.T @ ((y - mean_y) * share))
    return Model(languages, (marks @ (whiten @ beta)).astype(np.float32), mean_y - mean_f @ beta, how)


def fold_of(id_col: Column | str) -> Column:
    """0, 1 or 2; 1 is held out. Null for a null id."""
    return F.crc32(F.col(id_col).cast("string") if isinstance(id_col, str) else id_col.cast("string")) % 3


def fit(docs: DataFrame, how: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on a bounded sample of the rows outside fold 1 that have a language."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where((fold_of("id") != 1) & F.col("lang").isNotNull())
    key = F.xxhash64("id", "text")
    counted = rows.groupBy("lang").agg(F.approx_count_distinct(key, 0.02).alias("n")).limit(how.most_languages + 1).collect()
    if len(counted) > how.most_languages:
        raise ValueError(f"more than {how.most_languages} languages; raise most_languages")
    quota = min(how.per_language, max(1, how.most_rows // max(1, len(counted))))
    spread = F.pmod(F.xxhash64(key, F.lit(how.seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    rate = F.lit(0.0)
    for lang, n in sorted(map(tuple, counted)):
        rate = F.when(F.col("lang") == lang, F.lit(quota * 1.2 / max(1, n))).otherwise(rate)

    def work(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in small(batches):
            found = [slots_of(t, how).astype(np.uint32).tobytes() if has_letter(t) else b"" for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["lang", "spread", "slots"])

    # slots, not texts, go to the driver: no row has more than how.slots of them
    drawn = rows.where(F.col("text").isNotNull()).withColumn("spread", spread).where(F.col("spread") < rate).select("lang", "spread", "text")
    different = drawn.mapInArrow(work, "lang string, spread double, slots binary").where(F.length("slots") > 0).dropDuplicates(["lang", "spread"])
    order = Window.partitionBy("lang").orderBy("spread")
    ranked = different.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= int(1.5 * quota))
    weighed = ranked.withColumn("bytes", F.sum(F.length("slots")).over(order))
    # the first row of a language stays, however long
    most = how.most_bytes // max(1, len(counted))
    got = weighed.where((F.col("bytes") <= most) | (F.col("nth") == 1)).select("lang", "spread", "slots").collect()
    import numpy as np

    kept = sorted((r["lang"], r["spread"], bytes(r["slots"])) for r in got)
    return train([np.frombuffer(x, np.uint32) for _, _, x in kept], [y for y, _, _ in kept], how)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row. A map; the model has a fixed size (slots by languages)."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in small(batches):
            names, shares = shared.value.predict(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(shares, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    held = F.coalesce(fold_of(id_col) == 1, F.lit(False))
    return docs.select(F.col(id_col).alias("doc_id"), held.alias("held_out"), F.col(text_col)).mapInArrow(work, "doc_id long, held_out boolean, lang_pred string, score double")
