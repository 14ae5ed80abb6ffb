import math
import random
import re

import numpy as np
import pytest

from colwarden.llm import toxicity as tx
from colwarden.llm.queries import op1_toxicity


def rows(rng, n, first=0):
    out = []
    for i in range(first, first + n):
        words = [rng.choice("lorem ipsum dolor sit amet magna aliqua tempor".split()) for _ in range(rng.randint(5, 60))]
        y = int(rng.random() < 0.3)
        if y:
            words[rng.randrange(len(words))] = rng.choice(["grobian", "Grobiane,", "schuft!"])
        out.append((i, " ".join(words), y))
    return out


def test_solver_reaches_a_stationary_point():
    rng = np.random.default_rng(0)
    x = (rng.random((300, 6)) < 0.4).astype(float)
    at = x @ np.array([3.0, 1.0, 0, 0, 0, 0]) + rng.logistic(size=300)
    grades = (at > 2).astype(int) + (at > 4)
    how = tx.Settings(l1=1e-3, steps=4000)
    w, theta = tx.solve(x, grades, how)

    def loss(w, theta):
        s = (x @ w)[:, None] - theta
        above = grades[:, None] > np.arange(2)
        return np.where(above, np.log1p(np.exp(-s)), np.log1p(np.exp(s))).sum(axis=1).mean() + how.l1 * w.sum()

    best = loss(w, theta)
    for j in range(6):
        for d in (1e-2, -1e-2):
            assert loss(np.maximum(w + d * (np.arange(6) == j), 0), theta) >= best - 1e-7
    assert all(loss(w, theta + d * np.eye(2)[k]) >= best - 1e-7 for k in (0, 1) for d in (1e-2, -1e-2))
    assert theta[0] <= theta[1] and w.min() >= 0 and w[0] > w[1] > 0.3


def test_tables(spark):
    rng = random.Random(4)
    data = rows(rng, 600)
    odd = [(9001, None, "x"), (9002, "", "x"), (9003, "lorem " * 20_000 + "GROBIAN", "x"), (9003, "lorem " * 20_000 + "GROBIAN", "x"), (None, "schuft", "x")]
    df = spark.createDataFrame([(i, t, "x") for i, t, _ in data] + odd, "doc_id long, text string, severity string")
    labels = spark.createDataFrame([(i, y) for i, _, y in data[:400]] + [(None, 1), (9001, None), (3, 0)], "doc_id long, toxic int")
    model = tx.fit(df, labels)
    out = tx.score(df, model).collect()
    assert len(out) == len(data) + len(odd)
    by = {r["doc_id"]: r for r in out}
    assert np.mean([by[i]["toxic"] == bool(y) for i, _, y in data[400:]]) > 0.98
    assert by[9003]["toxic"] and by[None]["toxic"] and not by[9001]["toxic"] and not by[9002]["toxic"]
    assert all(0 <= r["severity"] <= 2 and r["kept"] != r["toxic"] for r in out)
    kept = tx.keep_clean(df, model)
    assert kept.schema == df.schema and kept.count() == sum(r["kept"] for r in out)
    none = tx.fit(df, labels.where("toxic = 0"))
    assert {r["severity"] for r in tx.score(df, none).collect()} == {0.0}
    assert tx.score(df.limit(0), tx.fit(df.limit(0), labels.limit(0))).count() == 0


def test_ordered_labels_are_used_as_grades():
    rng = random.Random(1)
    data = []
    for _ in range(600):
        y = rng.choice([0, 1, 2])
        words = {"calm", rng.choice(["a", "b", "c"])} | ({"rude"} if y else set()) | ({"vile"} if y == 2 else set())
        data.append((np.array([tx.hashed(w) for w in words], np.uint32), y))
    names = {tx.hashed(w): w for w in ("calm", "a", "b", "c", "rude", "vile")}
    score = tx.train(data, spell=lambda hashes: names).scorer()
    low, mid, high = (sum(score(t)) for t in ("calm a", "calm a rude", "calm a rude vile"))
    assert low < 0.3 < 0.7 < mid < 1.3 < 1.7 < high


def test_query_on_labelled_rows(spark):
    sf = "/root/testdata/sf0.01"
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    out = {r["doc_id"]: r["toxic"] for r in op1_toxicity(spark, sf).collect()}
    assert len(out) == 1000
    assert np.mean([out[i] for i, y in toxic.items() if y]) > 0.9 and np.mean([out[i] for i, y in toxic.items() if not y]) < 0.02


def test_severity_is_the_sum_over_thresholds(spark):
    """Against the formula, from whole lists of features."""
    model = tx.Model({"rude": 2.0, "vile": 1.5, "vile*": 9.0, "stin*": 0.5, "stinki*": 0.25}, (1.0, 3.0))
    texts = ["", None, "calm words", "RUDE", "rude, rude rude!", "vile and rude", "stinking rude", "stink", "vilest"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in tx.score(df, model).collect():
        words = set(re.findall(r"[a-z]+", (texts[r["doc_id"]] or "").lower()))
        features = words | {w[:4] + "*" for w in words if len(w) > 4} | {w[:6] + "*" for w in words if len(w) > 6}
        at = sum(model.weights.get(f, 0.0) for f in features)
        p = [1 / (1 + math.exp(t - at)) for t in model.thetas]
        assert abs(r["severity"] - sum(p)) < 1e-12 and r["grade"] == sum(x > 0.5 for x in p) and r["toxic"] == (p[0] > 0.5)


def test_ids_on_many_rows_and_labelled_twice(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(tx, "train", lambda rows, how, spell: seen.append(rows) or tx.Model())
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(i, "text") for i in range(2, 12)], "doc_id long, text string")
    labels = [(i, 0) for i in range(1, 12)] + [(i, 0) for i in range(1, 12)] + [(i, 1) for i in range(1, 8)]
    tx.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), tx.Settings(per_label=1_000))
    assert sorted(y for _, y in seen[0]) == [0] * 4 + [1] * 7  # an id once, with its highest label


def test_all_labels_or_an_error(spark):
    docs = spark.createDataFrame([(i, f"word{i}") for i in range(70)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i) for i in range(70)], "doc_id long, toxic int")
    with pytest.raises(ValueError, match="different labels"):
        tx.fit(docs, labels)
    assert len(tx.fit(docs, labels, tx.Settings(most_labels=70)).thetas) == 69


def test_more_telling_words_mean_more_severity(spark):
    rng = random.Random(9)
    bad, calm = "grobian schuft lump halunke".split(), "lorem ipsum dolor sit amet magna aliqua tempor".split()
    data = []
    for i in range(900):
        n = rng.choice([0, 0, 0, 1, 2, 3])
        data.append((i, " ".join(rng.sample(bad, n) + [rng.choice(calm) for _ in range(30)]), n))
    df = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string")
    model = tx.fit(df, spark.createDataFrame([(i, int(n > 0)) for i, _, n in data[:600]], "doc_id long, toxic int"))
    out = {r["doc_id"]: r["severity"] for r in tx.score(df, model).collect()}
    mean = [np.mean([out[i] for i, _, n in data[600:] if n == k]) for k in range(4)]  # rows left out of the fit
    assert mean[0] < 0.2 and mean[0] < mean[1] < mean[2] < mean[3]


def test_sparse_and_dense_products_solve_alike():
    rng = np.random.default_rng(3)
    x = (rng.random((200, 9)) < 0.3).astype(float)
    grades = (x[:, 0] + x[:, 1] + rng.random(200) > 1.2).astype(int)
    of, at = np.nonzero(x)
    how = tx.Settings(l1=1e-3, steps=500)
    (a, s), (b, t) = tx.solve(x, grades, how), tx.solve(tx.Presence(of, at, x.shape), grades, how)
    assert np.allclose(a, b) and np.allclose(s, t)


def test_bytes_of_the_fit_are_bounded(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(tx, "train", lambda rows, how, spell: seen.append(rows) or tx.Model())
    docs = spark.createDataFrame([(i, f"word{'abcdefghij'[i]} of its own") for i in range(10)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)], "doc_id long, toxic int")
    tx.fit(docs, labels)
    size = 4 * len(seen[0][0][0])
    tx.fit(docs, labels, tx.Settings(most_bytes=2 * 3 * size))
    assert len(seen[0]) == 10 and [sum(len(f) * 4 for f, y in seen[1] if y == label) for label in (0, 1)] == [3 * size] * 2
    tx.fit(docs, labels, tx.Settings(most_bytes=0))
    assert sorted(y for _, y in seen[2]) == [0, 1]  # a text of each label stays


def test_copies_count_once():
    """A toxic text that is there 200 times teaches no more than once."""
    rng = random.Random(8)
    calm = [f"calm{i}" for i in range(900)]
    data = [(set(rng.sample(calm, 40)) | ({"vile"} if i % 4 == 0 else set()), int(i % 4 == 0)) for i in range(400)]
    copied = {"vile", *(f"plain{i}" for i in range(40))}
    names = {tx.hashed(w): w for r, _ in data + [(copied, 1)] for w in r}
    model = tx.train([(np.sort(np.array([tx.hashed(w) for w in r], np.uint32)), y) for r, y in data + [(copied, 1)] * 200], spell=lambda hashes: names)
    assert set(model.weights) == {"vile"}


def test_more_telling_words_than_any_fixed_number():
    rng = random.Random(2)
    calm, foul = [f"calm{i}" for i in range(400)], [f"foul{i}" for i in range(1_200)] * 8
    rng.shuffle(foul)
    data = [({*foul[i : i + 8], *rng.sample(calm, 20)}, 1) for i in range(0, len(foul), 8)] + [(set(rng.sample(calm, 20)), 0) for _ in range(7_200)]
    names = {tx.hashed(w): w for r, _ in data for w in r}
    model = tx.train([(np.sort(np.array([tx.hashed(w) for w in r], np.uint32)), y) for r, y in data], tx.Settings(steps=300), lambda hashes: names)
    assert len(model.weights) > 1_150 and all(w.startswith("foul") for w in model.weights)
