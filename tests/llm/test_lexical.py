import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from colwarden.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute(docs, items, top):
    held = [(i, Counter(TERM.findall(lower(t)))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in {(i, t) for i, t in items if t}:
        asked, found = TERM.findall(lower(text)), []
        for doc, c in held:
            m = 75 + 25 * sum(c.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t in asked if t in c)
            if score > 0:
                found.append((-score, doc is None, doc))
        out += [(item, rank, doc, -minus) for rank, (minus, _, doc) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=str)


def corpus(rng, n):
    words = [f"w{k}" for k in range(40)] + ["É", "é", "日本", "X1", "x1", "ß"]
    text = lambda size: rng.choice((" ", "-", "\n")).join(rng.choices(words, [1 / (k + 1) for k in range(len(words))], k=size))
    docs = [(k, text(rng.choice((1, 2, 5, 40)))) for k in range(n)]
    docs += [(n + k, docs[k % 7][1]) for k in range(n // 3)]  # copies: equal scores
    return docs + [(None, "w39 w38"), (5, None), (6, ""), (7, "--- !"), (8, "w3 w3"), (8, "w3 w3")], text


@pytest.mark.parametrize("how", [lexical.Ranking(top=5, leaf=2, fan=2, range_docs=37), lexical.Ranking(), lexical.Ranking(top=3, leaf=4, fan=3, range_postings=50, block_bytes=200)])
def test_equals_brute_force(spark, how):
    rng = random.Random(how.leaf)
    docs, text = corpus(rng, 400)
    rng.shuffle(docs)
    items = [(k, text(rng.choice((1, 3, 12)))) for k in range(12)]
    items += [(3, "w1 w1 W1 w5"), (20, None), (21, ""), (22, "unseen words"), (23, "w3"), (23, "w3"), (None, "w2 é")]
    table = spark.createDataFrame([(i, t, 1, "a") for i, t in docs], "doc_id LONG, text STRING, score INT, rank STRING").repartition(3)
    asked = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id LONG, text STRING, id INT")
    got = lexical.search(table, asked, how)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items, how.top)


def test_empty(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id LONG, text STRING")
    items = spark.createDataFrame([(1, "a")], "item_id LONG, text STRING")
    assert lexical.search(docs.limit(0), items).collect() == []
    assert lexical.search(docs, items.limit(0)).collect() == []
    assert lexical.search(spark.createDataFrame([(1, "..")], docs.schema), items).collect() == []


def test_nodes_below_the_worst_kept_document_stay_closed():
    how = lexical.Ranking(top=2, leaf=4, fan=4)
    lengths, postings = [2] * 256, [(np.array([0, 1]), np.array([1, 1]))] * 256
    postings[100] = postings[101] = (np.array([0, 2]), np.array([1, 1]))
    tree = lexical.Tree(how, np.array([10, 10, 5000], np.int64), lengths, postings, 256, 512)
    best = lexical.Best(2)
    opened = tree.search(np.array([0, 2]), np.array([1, 1]), best, list(range(256)))
    assert [i for _, i in best.rows] == [100, 101] and opened == 4  # the root, two nodes and a leaf
    every = lexical.Best(2)
    assert tree.search(np.array([0]), np.array([1]), every, list(range(255, -1, -1))) == 1 + 4 + 16 + 64  # all equal: the smallest ids win
    assert [i for _, i in every.rows] == [0, 1]
