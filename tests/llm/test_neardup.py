import random
import re

from pyspark.sql import functions as F

from colwarden.llm import neardup
from colwarden.llm.components import components
from colwarden.llm.queries import op4_near_dedup


def shingle_set(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 4]) for i in range(len(words) - 3)) if len(words) >= 4 else frozenset([tuple(words)])


def brute(rows, percent=80):
    """Exact components, from an inverted index over all shingles."""
    sets = [shingle_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        counts = {}
        for x in s:
            for j in holders.setdefault(x, []):
                counts[j] = counts.get(j, 0) + 1
            holders[x].append(i)
        for j, n in counts.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n) and root(i) != root(j):
                up[root(i)] = root(j)
    low = {}
    for i, (ident, _) in enumerate(rows):
        if ident is not None:
            low[root(i)] = min(low.get(root(i), ident), ident)
    return sorted((str(ident), len(sets[i]), str(low.get(root(i), ident))) for i, (ident, _) in enumerate(rows))


def edited(rng, words, share):
    return [rng.choice("xyzw") + str(rng.random()) if rng.random() < share else w for w in words]


def check(spark, rows, **options):
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, component long")
    got = sorted((str(r["id"]), r["n_shingles"], str(r["component"])) for r in neardup.groups_of(df, **options).collect())
    assert got == brute(rows)
    return df


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "ONE  two"), (6, "one two three"), (7, "a b c d"), (8, "A b\x0bc d"), (8, "A b\x0bc d"), (9, "É b c d"), (10, "é b c d"), (None, "a b c d"), (None, "alone here"), (11, "w " * 30_000), (12, "w"), (13, " ".join(map(str, range(9000)))), (8, "other text of the same id")]
    df = check(spark, rows)
    kept = neardup.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, 6, 7, 8, 9, 10, 11, 12, 13, None]))


def test_texts_of_one_id_are_judged_each_by_its_group(spark):
    rows = [(1, "a b c d"), (None, "A b c d"), (None, "alone here"), (None, "alone too"), (None, None)]
    rows += [(2, "e f g h"), (3, "E f g h"), (3, "own text of three"), (4, "one text of four"), (4, "another text of it")]
    rows += [(5, "copies of one id"), (5, "COPIES of one id"), (6, "said twice over"), (6, "said twice over"), (7, ""), (7, ""), (7, "not empty at all")]
    df = check(spark, rows)
    kept = sorted((str(r["doc_id"]), (r["text"] or "").lower()) for r in neardup.keep_first(df).collect())
    gone = [(None, "A b c d"), (3, "E f g h"), (5, "COPIES of one id"), (6, "said twice over"), (7, "")]
    want = list(rows)
    for row in gone:
        want.remove(row)
    assert kept == sorted((str(i), (t or "").lower()) for i, t in want)


def test_empty(spark):
    check(spark, [])


def test_dense_group_near_the_threshold(spark):
    """Many copies whose similarities lie around 0.8: most links are not with a key's smallest class."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(edited(rng, base, rng.choice([0.005, 0.02, 0.03, 0.05])))) for i in range(220)]
    other = [f"v{i}" for i in range(400)]
    rows += [(1000 + i, " ".join(edited(rng, other, 0.01))) for i in range(40)]
    rows += [(2000 + i, " ".join(rng.choice(base) for _ in range(80))) for i in range(60)]
    check(spark, rows, block=(50, 6_000))


def test_sets_with_one_short_name_are_told_apart(spark):
    rng = random.Random(8)
    base = [[f"w{rng.randrange(5_000)}" for _ in range(60)] for _ in range(12)]
    rows = [(k, " ".join(edited(rng, base[k % 12], 0.02))) for k in range(60)] + [(100 + k, " ".join(base[k])) for k in range(12)]
    check(spark, rows, how=neardup.Tensor(name_bits=3))


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (201, 202), (300, 300), (5, 5)] + [(500, 500 + k) for k in range(1, 60)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in [*range(41), 100]} | {200: 200, 201: 200, 202: 200} | {500 + k: 500 for k in range(60)}
    assert got == want


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = op4_near_dedup(spark, sf)
    assert sorted((str(r[0]), r[1], str(r[2])) for r in got.collect()) == brute(rows)
    assert got.where(F.col("kept") != (F.col("doc_id") == F.col("component_id"))).count() == 0
