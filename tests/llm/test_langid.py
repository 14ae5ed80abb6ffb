import zlib

import numpy as np
import pytest

from colwarden.llm import langid
from colwarden.llm.queries import op10_language_id

WORDS = {"aa": "alla besa calma dena solo".split(), "bb": "wrunk vext tschik zwolp".split(), "cc": "ouie eaux quoi deuil".split()}


def text(lang, k):
    return " ".join(WORDS[lang][(k * 7 + i * i) % len(WORDS[lang])] for i in range(12))


def test_folded_weights_equal_the_kernel_computation():
    """Kernels by counting common slots, ridge regression as weighted least squares, text by text."""
    how = langid.Settings(slots=1 << 10, landmarks=20)
    rows = [(text(y, k), y) for y, n in zip(WORDS, (15, 9, 4), strict=True) for k in range(n)]
    sets = [set(langid.slots_of(t, how).tolist()) for t, _ in rows]
    model = langid.train([langid.slots_of(t, how) for t, _ in rows], [y for _, y in rows], how)

    kernel = lambda a, b: len(a & b) / (len(a) * len(b)) ** 0.5
    marks = [sets[i] for i in np.sort(np.random.default_rng(how.seed).permutation(len(sets))[: how.landmarks])]
    values, vectors = np.linalg.eigh(np.array([[kernel(a, b) for b in marks] for a in marks]))
    good = values > values.max() * 1e-8
    features = lambda group: np.array([[kernel(a, b) for b in marks] for a in group]) @ (vectors[:, good] / np.sqrt(values[good]))
    x = features(sets)
    weight = np.array([len(rows) / (len(WORDS) * [y for _, y in rows].count(y)) for _, y in rows])
    others = ["alla vext quoi", "zz", "calma solo dena tschik", "é wrunk"]
    want = []
    for lang in sorted(WORDS):
        y = np.array([1.0 if label == lang else -1.0 for _, label in rows])
        mid_x, mid_y = np.average(x, axis=0, weights=weight), np.average(y, weights=weight)
        # rows for the data, then rows for the penalty
        left = np.vstack([(x - mid_x) * np.sqrt(weight)[:, None], np.sqrt(how.ridge * len(rows)) * np.eye(x.shape[1])])
        right = np.concatenate([(y - mid_y) * np.sqrt(weight), np.zeros(x.shape[1])])
        beta = np.linalg.lstsq(left, right, rcond=None)[0]
        want.append((features([set(langid.slots_of(t, how).tolist()) for t in others]) - mid_x) @ beta + mid_y)
    got = model.scores([langid.slots_of(t, how) for t in others])
    assert model.languages == sorted(WORDS) and np.allclose(got, np.array(want).T, atol=1e-4)

    names, shares = model.predict([t for t, _ in rows] + [None, "", "12 34 _", "É"])
    assert names[: len(rows)] == [y for _, y in rows] and names[-4:-1] == ["und"] * 3 and names[-1] != "und"
    assert all(0 <= s <= 1 for s in shares)


def test_batches_are_bounded_and_change_nothing():
    how = langid.Settings(slots=1 << 10, landmarks=20)
    rows = [(text(y, k), y) for y in WORDS for k in range(6)]
    model = langid.train([langid.slots_of(t, how) for t, _ in rows], [y for _, y in rows], how)
    texts = [t for t, _ in rows] + [None, "12", "alla " * 5000]
    known = [t for t in texts if t and langid.has_letter(t)]
    sizes = [[len(x) for x in part] for part in model.batches(known, 600)]
    assert sum(map(len, sizes)) == len(known) and len(sizes) > 1
    assert all(len(part) == 1 or sum(part) * len(model.languages) <= 600 for part in sizes)
    whole, cut = model.predict(texts), model.predict(texts, 600)
    assert whole[0] == cut[0] and np.allclose(whole[1], cut[1])


def test_rows_of_a_fit_are_bounded_and_languages_counted(spark):
    rows = [(k, text(y, k), y) for j, y in enumerate(WORDS) for k in range(j * 400, j * 400 + 400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    sizes = []
    inner, langid.train = langid.train, lambda found, labels, how: seen.extend(labels) or sizes.extend(map(len, found)) or inner(found, labels, how)
    try:
        model = langid.fit(df, langid.Settings(most_rows=60))
        # an id on many rows, with texts of its own or one text, is drawn like any other row
        hot = [(7, text("aa", k), "aa") for k in range(5_000)] + [(8, "zz", "bb")] * 5_000
        first = list(seen)
        del seen[:]
        langid.fit(spark.createDataFrame([*rows, *hot], df.schema).repartition(5), langid.Settings(per_language=50))
        assert len(seen) <= 75 * 3 and all(20 <= seen.count(y) <= 75 for y in WORDS)
        del seen[:], sizes[:]
        langid.fit(df, langid.Settings(most_bytes=3 * 4 * 3_000))
        assert sum(sizes) <= 3 * 3_000 and set(seen) == set(WORDS)
        seen[:] = first
    finally:
        langid.train = inner
    assert model.languages == sorted(WORDS) and len(seen) <= 90 and all(seen.count(y) <= 30 for y in WORDS)
    with pytest.raises(ValueError, match="most_languages"):
        langid.fit(df, langid.Settings(most_languages=2))


def test_slots_are_the_distinct_ngrams():
    how = langid.Settings()
    assert len(langid.slots_of("ab ab ab", how)) == len({g for n in (2, 3, 4) for s in [" ab ab ab "] for g in (s[i : i + n] for i in range(len(s) - n + 1))})


def test_tables(spark):
    rows = [(k, text(y, k), y, "x") for j, y in enumerate(WORDS) for k in range(j * 40, j * 40 + 40)]
    rows += [(None, text("aa", 1), "bb", "x"), (500, None, "aa", "x"), (501, "123", "aa", "x"), (502, text("cc", 3), None, "x"), (502, text("cc", 3), None, "x"), (503, (text("bb", 2) + " ") * 3000, "bb", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    out = langid.predict(df, langid.fit(df)).collect()
    assert len(out) == len(rows)
    by = {r["doc_id"]: r for r in out}
    assert by[500]["lang_pred"] == by[501]["lang_pred"] == "und" and by[502]["lang_pred"] == "cc" and by[503]["lang_pred"] == "bb" and by[None]["lang_pred"] == "aa"
    assert all(by[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in by if i is not None) and not by[None]["held_out"]
    empty = df.limit(0)
    assert langid.predict(empty, langid.fit(empty)).count() == 0
    assert {r["lang_pred"] for r in langid.predict(df, langid.fit(empty)).collect()} == {"und"}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = [r for r in op10_language_id(spark, sf).collect() if r["held_out"] and lang[r["doc_id"]]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in got]) > 0.95
