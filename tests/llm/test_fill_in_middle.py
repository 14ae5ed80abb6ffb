import hashlib
import random
import re

import pyarrow as pa
from pyspark.sql import functions as F

from colwarden.llm import fill_in_middle as fim


def brute(doc_id, text, how):
    """(units, form, prefix characters, middle characters, output), by regular expressions over characters."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    hexed = hashlib.sha256(f"{how.seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hexed[8 * k : 8 * k + 8], 16) for k in range(4))
    low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    marks = how.prefix, how.suffix, how.middle
    if not text or any(x in text for x in marks) or h3 % 100 >= how.percent:
        return len(units), "plain", None, None, text
    spm = h4 % 100 < how.spm_percent
    P, S, M = marks
    return len(units), "spm" if spm else "psm", len(p), len(m), S + s + P + p + M + m if spm else P + p + S + s + M + m


def samples(rng, n):
    parts = ["\n", "a", "é", "日", "😀", "<", "P", "<P", "<P>", "S>", "<M", "<S", ">", " ", "\r", "\0", " "]
    return ["".join(rng.choice(parts[: rng.choice((7, 9, 17))]) for _ in range(rng.choice((0, 1, 3, 10, 200)))) for _ in range(n)]


def test_automaton_runs_side_by_side_as_one_byte_after_another():
    import numpy as np

    machine = fim.Cutting().automaton
    assert len(machine.states) == 9
    texts = [t.encode() for t in samples(random.Random(3), 300)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.cumsum([0, *map(len, texts)])[:-1]
    want = []
    for t in texts:
        state = fim.State()
        want.append(0)
        for b in t:
            state, emitted = machine.step(state, b)
            want.append(emitted)
    for block in (1, 2, 3, 50, 1 << 20):
        assert machine.scan(data, starts, block).tolist() == want


def test_equals_brute_force_in_slices():
    how, texts = fim.Cutting(percent=90), samples(random.Random(4), 2_000)
    seeds = []
    for k in range(len(texts)):
        hexed = hashlib.sha256(f"7:{k}".encode()).hexdigest()
        seeds.append(tuple(int(hexed[8 * j : 8 * j + 8], 16) for j in range(4)))
    column = pa.array(texts)
    for at in range(0, len(texts), 333):
        for k, (n, form, p, m, out) in enumerate(fim.pieces(how, column.slice(at, 333), seeds[at : at + 333]), at):
            assert (n, form, p, m, out.decode()) == brute(k, texts[k], how)


def test_rows(spark):
    texts = samples(random.Random(5), 300) + ["line é\n" * 200_000, "no line feed " * 100_000]
    rows = [(k, t, "x") for k, t in enumerate(texts)] + [(7, None, None), (None, "a\nb\nc\n", "y"), (3, "a\nb", "z"), (3, "a\nb", "z")]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, form STRING").repartition(3)
    for how in (fim.Cutting(), fim.Cutting("[[a", "[[b", "[[cé", "9", 70, 20)):
        got = fim.transform(docs, how)
        assert got.columns == ["doc_id", "text", "form", "units", "_form", "prefix_chars", "middle_chars", "output"]
        found = got.withColumn("again", fim.restore(F.col("output"), F.col("_form"), how)).collect()
        assert len(found) == len(rows)
        for r in found:
            assert (r["units"], r["_form"], r["prefix_chars"], r["middle_chars"], r["output"]) == brute(r["doc_id"], r["text"], how)
            assert r["again"] == (r["text"] or "")
    assert {r["_form"] for r in found} == {"plain", "spm", "psm"}
    assert fim.transform(docs.limit(0)).collect() == []
