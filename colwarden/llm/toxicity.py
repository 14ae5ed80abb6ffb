"""Toxicity severity by cumulative-link ordinal regression.

A text's sparse features are its distinct lower-cased words and their leading 4 and 6 letters, so inflected forms share
weight. For ordered grades 0..K, P(grade > k) = sigmoid(w x - theta_k) with one weight vector for all thresholds, and
theta ascending. Weights get an L1 penalty, which chooses among all features that are more frequent in higher grades by
more than chance: least_z standard errors, which 3 of a million features that mean nothing would reach, in at least
least_rows rows. Without that a long clean text adds up small noise. No number of features is set. The result is the
expected severity, the sum of P(grade > k) over k.

Fit: a bounded sample of labelled ids (about per_label of each label, drawn by a hash of the id), joined to the documents
by a broadcast of just these ids, one row for each id: that with the smallest text. Of rows with one label and the same
copy_features or more features, which are copies, one is fitted, as otherwise every word of a text with many copies tells
something; fewer features do not make a copy. Feature hashes of these rows,
most_bytes at most in all, go to the driver, where the convex problem is solved by accelerated proximal gradient steps on a
sparse matrix; features with weight are then looked up as strings in the sample, and texts are scored by strings. Labels of two values are made three
grades: positive rows that hold more telling features than the median positive are grade 2, which ranks them by the number
of telling features and is no label of its own. Labels with more values are used as they are.

Defined results: null and empty texts have no features, hence the severity of a text without any; rows without label, or
with a null label or id, are not fitted; an id labelled twice counts with its highest label, before anything is drawn; if
fewer than two labels are there, every severity is 0; more than Settings.most_labels different labels raise ValueError. Repeated rows each return; whole texts are read. Extra columns do not take part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shipping import ship
from .common import small, spill

_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Settings:
    per_label: int = 4_000
    most_labels: int = 64  # bounds the sample, as per_label does; with more, an error tells so
    most_bytes: int = 64 << 20  # of feature hashes, 4 bytes each; texts of a label beyond its part of them are not fitted
    copy_features: int = 32
    least_rows: int = 3
    least_z: float = 4.5
    l1: float = 1e-5
    steps: int = 2_000
    seed: int = 11


def features_of(token: str) -> set[str]:
    """Features of what stands between blanks; in most cases that's one word with its marks."""
    found = set()
    for w in _WORD.findall(token.lower()):
        found.add(w)
        if len(w) > 4:
            found.add(w[:4] + "*")
        if len(w) > 6:
            found.add(w[:6] + "*")
    return found


def hashed(feature: str) -> int:
    """32 bits, for the fit alone: half the memory of 64 on the driver."""
    import xxhash

    return xxhash.xxh32_intdigest(feature.encode())


@dataclass
class Model:
    """Weights by feature; empty if nothing could be fitted."""

    weights: dict[str, float] = field(default_factory=dict)
    thetas: tuple[float, ...] = ()

    def scorer(self):
        import math

        class Tokens(dict):
            def __missing__(own, token: str):  # noqa: N805
                hits = tuple((h, self.weights[h]) for h in features_of(token) if h in self.weights)
                if len(token) <= 64:
                    if len(own) >= 200_000:
                        own.clear()
                    own[token] = hits
                return hits

        tokens = Tokens()

        def score(text: str | None) -> list[float]:
            """P(grade > k) for each k."""
            hits: dict[str, float] = {}
            for found in filter(None, map(tokens.__getitem__, set((text or "").split()))):
                hits.update(found)
            at = math.fsum(hits.values())
            return [1 / (1 + math.exp(min(700.0, t - at))) for t in self.thetas]

        return score


class Presence:
    """A sparse matrix of ones, in as many columns as features: row of[i] has column at[i]."""

    def __init__(self, of, at, shape: tuple[int, int]):
        self.of, self.at, self.shape = of, at, shape

    @property
    def T(self) -> Presence:  # noqa: N802
        return Presence(self.at, self.of, self.shape[::-1])

    def __matmul__(self, v):
        import numpy as np

        return np.bincount(self.of, v[self.at], self.shape[0])

    def mean(self, axis: int):
        import numpy as np

        return np.bincount(self.at if axis == 0 else self.of, minlength=self.shape[1 - axis]) / self.shape[axis]


def solve(x, grades, how: Settings):
    """x: Presence, or an array.

    Weights and thresholds that minimise the mean cumulative-link loss plus l1 times the sum of weights, by FISTA.

    Weights are held at 0 or more, so no text gets milder by added words, and thetas in ascending order.
    """
    import numpy as np

    n, k = len(grades), int(grades.max())
    above = (grades[:, None] > np.arange(k)).astype(np.float64)
    base = above.mean(axis=0).clip(1e-3, 1 - 1e-3)
    scale = 1 / np.sqrt(x.mean(axis=0).clip(1e-6))  # rare and frequent features then converge alike
    turned, v = x.T, np.ones(x.shape[1])
    for _ in range(20):  # the largest eigenvalue, for the step
        v = scale * (turned @ (x @ (scale * v)))
        v /= max(np.linalg.norm(v), 1e-12)
    step = 4.0 / (k * (float(np.linalg.norm(x @ (scale * v)) ** 2) / n + 1.0))
    w, theta = np.zeros(x.shape[1]), np.log((1 - base) / base)
    look_w, look_t, t = w.copy(), theta.copy(), 1.0
    for _ in range(how.steps):
        error = 1 / (1 + np.exp(-np.clip((x @ (scale * look_w))[:, None] - look_t, -30, 30))) - above
        new_w = np.maximum(look_w - step * scale * ((turned @ error.sum(axis=1)) / n + how.l1), 0)
        new_t = np.maximum.accumulate(look_t + step * error.mean(axis=0))
        last, t = t, (1 + (1 + 4 * t * t) ** 0.5) / 2
        look_w, look_t = new_w + (last - 1) / t * (new_w - w), new_t + (last - 1) / t * (new_t - theta)
        w, theta = new_w, new_t
    return w * scale, theta


def train(rows: list[tuple[object, int]], how: Settings = Settings(), spell=dict) -> Model:
    """rows: (distinct feature hashes as uint32 array, sorted, label). spell gives the feature of each hash of a list, as a dict."""
    import numpy as np

    first = {(h.tobytes(), y) if len(h) >= how.copy_features else i: i for i, (h, y) in reversed(list(enumerate(rows)))}
    rows = [rows[i] for i in sorted(first.values())]
    labels = np.array([y for _, y in rows], np.int64)
    if len(set(labels.tolist())) < 2:
        return Model()
    grades = np.searchsorted(np.unique(labels), labels)
    flat, of = np.concatenate([h for h, _ in rows]), np.repeat(np.arange(len(rows)), [len(h) for h, _ in rows])
    names, at = np.unique(flat, return_inverse=True)
    del flat
    at, of = at.astype(np.int32), of.astype(np.int32)
    bad = grades > 0
    in_bad, in_all = np.bincount(at, bad[of], len(names)), np.bincount(at, minlength=len(names))
    in_good = in_all - in_bad
    n_bad, n_good, share = bad.sum(), (~bad).sum(), in_all / len(rows)
    z = (in_bad / n_bad - in_good / n_good) / np.sqrt((share * (1 - share)).clip(1e-9) * (1 / n_bad + 1 / n_good))
    z[in_bad < how.least_rows] = 0
    chosen = np.flatnonzero(z > how.least_z)
    place = np.full(len(names), -1, np.int32)
    place[chosen] = np.arange(len(chosen), dtype=np.int32)
    at = place[at]
    x = Presence(of[at >= 0], at[at >= 0], (len(rows), len(chosen)))
    if grades.max() == 1 and bad.sum() > 1:
        telling = np.bincount(x.of, minlength=len(rows))
        grades = grades + (bad & (telling > np.median(telling[bad])))
    w, theta = solve(x, grades, how)
    weights = {int(names[c]): float(v) for c, v in zip(chosen, w, strict=True) if v}
    spelt = spell(sorted(weights))
    return Model({spelt[h]: v for h, v in weights.items()}, tuple(map(float, theta)))


def fit(docs: DataFrame, labels: DataFrame, how: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on at most about per_label labelled documents of each label."""
    ship(docs.sparkSession)
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).na.drop().groupBy("id").agg(F.max("label").alias("label"))
    per = {r["label"]: r["n"] for r in marked.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy("label").limit(how.most_labels + 1).collect()}
    if len(per) > how.most_labels:
        raise ValueError(f"more than {how.most_labels} different labels: bin them, or raise most_labels")
    spread = F.pmod(F.xxhash64("id", F.lit(how.seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    rate = F.lit(0.0)
    for label, n in per.items():
        rate = F.when(F.col("label") == label, F.lit(how.per_label / n)).otherwise(rate)
    # about per_label ids of each of at most most_labels labels, and a row for each: a proven bound
    drawn = marked.where(spread < rate)
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(drawn), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
    own = spill(own, "labelled")

    def work(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in small(batches):
            found = []
            for text in batch.column(2).to_pylist():
                distinct = {f for token in set((text or "").split()) for f in features_of(token)}
                found.append(np.sort(np.fromiter(map(hashed, distinct), np.uint32, len(distinct))).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["id", "label", "features"])

    def spell(hashes: list[int]) -> dict[int, str]:
        """The feature of each hash; of several with one hash, that of the most rows of the sample."""
        wanted = frozenset(hashes)  # each is in least_rows rows of the sample or more, whose hashes are bounded

        def names(batches: Iterator) -> Iterator:
            import pyarrow as pa

            for batch in small(batches):
                found = [f for text in batch.column(0).to_pylist() for f in {f for token in set((text or "").split()) for f in features_of(token)} if hashed(f) in wanted]
                yield pa.RecordBatch.from_arrays([pa.array(map(hashed, found), pa.int64()), pa.array(found, pa.string())], names=["hash", "feature"])

        if not wanted:
            return {}
        number = own.select("text").mapInArrow(names, "hash long, feature string").groupBy("hash", "feature").agg(F.count(F.lit(1)).alias("n"))
        best = number.groupBy("hash").agg(F.min(F.struct((-F.col("n")).alias("n"), "feature")).alias("best"))
        return {r["hash"]: r["feature"] for r in best.select("hash", "best.feature").collect()}

    import numpy as np

    coded = own.mapInArrow(work, "id long, label int, features binary")
    order = Window.partitionBy("label").orderBy(F.xxhash64("id", F.lit(how.seed)), "id")
    ranked = coded.withColumn("nth", F.row_number().over(order)).withColumn("bytes", F.sum(F.length("features")).over(order))
    # the first row of a label stays, however long
    within = (F.col("nth") <= int(1.5 * how.per_label)) & (F.col("bytes") <= how.most_bytes // max(1, len(per)))
    got = sorted((r["id"], r["label"], bytes(r["features"])) for r in ranked.where(within | (F.col("nth") == 1)).select("id", "label", "features").collect())
    return train([(np.frombuffer(f, np.uint32), y) for _, y, f in got], how, spell)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, severity, grade, toxic, kept) for every row; toxic where P(grade > 0) is over a half. A map."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fewer weights than the sample has hashes, which are bounded

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        own = shared.value.scorer()
        for batch in small(batches):
            p = [own(t) for t in batch.column(1).to_pylist()]
            grade = [sum(v > 0.5 for v in x) for x in p]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([float(sum(x)) for x in p], pa.float64()), pa.array(grade, pa.int32()), pa.array([g > 0 for g in grade], pa.bool_()), pa.array([g == 0 for g in grade], pa.bool_())],
                names=["doc_id", "severity", "grade", "toxic", "kept"],
            )

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col)).mapInArrow(work, "doc_id long, severity double, grade int, toxic boolean, kept boolean")


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs, all columns, without the rows whose text is toxic."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        own = shared.value.scorer()
        for batch in small(batches):
            yield batch.filter(pa.array([not any(v > 0.5 for v in own(t)) for t in batch.column(place).to_pylist()], pa.bool_()))

    return docs.mapInArrow(work, docs.schema)
