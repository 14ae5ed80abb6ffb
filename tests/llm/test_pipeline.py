import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus_pipeline
from colwarden.llm import toxicity
from colwarden.llm.queries import default_model
from test_secret_ledger import brute as secrets_in


@pytest.fixture(scope="module")
def fixture_dir(spark, tmp_path_factory):
    """Documents whose fate is known: toxic, copies, near copies, secrets, odd ones."""
    rng = random.Random(6)
    vocabulary = [a + b for a in ("ka", "lo", "mi", "nu", "re") for b in ("bar", "den", "fos", "gim", "tol")]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    rows, toxic = [], {}
    for i in range(200):
        text = prose(rng.randint(30, 90))
        if toxic.setdefault(i, int(i % 4 == 0)):
            text += " grobian"
        rows.append((i, text))
    base = prose(80)
    rows += [(1000, base), (1001, base), (1002, base + " coda"), (1003, "pre " + base), (1004, prose(40) + " token=abcdef99 " + prose(5)), (1005, None), (1006, ""), (1007, "x " + prose(20_000))]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"file://{path}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, y in toxic.items()], "doc_id long, quality int, toxic int").write.parquet(f"file://{path}/labels.parquet")
    return f"file://{path}", dict(rows), toxic


def test_stages_against_brute_force(spark, fixture_dir):
    import sentencepiece

    path, texts, toxic = fixture_dir
    docs = spark.read.parquet(f"{path}/documents.parquet")
    schema, out = docs.schema, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = stage(spark, docs, path).cache()
        if name != "tokens":
            assert docs.columns == schema.names
    ids = lambda name: sorted(r["doc_id"] for r in out[name].collect())
    clean = sorted(i for i in texts if not toxic.get(i))
    assert ids("toxicity") == clean
    assert ids("near_duplicates") == ids("secrets") == [i for i in clean if i not in (1001, 1002, 1003)]
    masked = {r["doc_id"]: r["text"] for r in out["secrets"].collect()}
    assert "[SECRET]" in masked[1004] and not any(secrets_in(t) for t in masked.values())
    assert all(masked[i] == texts[i] for i in masked if i != 1004)
    mixed = out["mixing"].collect()
    assert all(r["text"] == masked[r["doc_id"]] for r in mixed) and max(sum(r["doc_id"] == i for r in mixed) for i in masked) == 2
    model = sentencepiece.SentencePieceProcessor(model_file=default_model())
    final = out["tokens"].collect()
    assert sorted(r["doc_id"] for r in final) == sorted(r["doc_id"] for r in mixed)
    assert all(r["ids"] == model.encode(masked[r["doc_id"]] or "") and r["decodes"] for r in final)


def test_run(spark, fixture_dir):
    path, _, _ = fixture_dir
    got = [sorted((r["doc_id"], r["n_tokens"]) for r in corpus_pipeline.run(spark, path).collect()) for _ in range(2)]
    assert got[0] == got[1] and len(got[0]) > 150


def test_real_table(spark):
    sf = "/root/testdata/sf0.001"
    labels = {r["doc_id"] for r in spark.read.parquet(f"{sf}/labels.parquet").where("toxic = 1").collect()}
    got = corpus_pipeline.run(spark, sf).collect()
    assert len(got) > 100 and all(r["decodes"] for r in got)
    assert toxicity.Settings().per_label > len(labels)


EXTRA = "doc_id long, text string, lang string, source string, n_chars long, size string, copies int, blob string, spans string, node long, id long, label int, target double, gone_id long, severity double, first int, hit int"


def test_stages_on_odd_tables(spark, tmp_path):
    """Nulls in every column, repeated rows and extra columns with names that stages use inside."""
    extra = ("x", 1, "b", "s", 2, 3, 4, 5.0, 6, 7.0, 8, 9)
    texts = ["", None, "one", "token=abcdef12 token=abcdef12", "w " * 3000, "same text of five words here", "same text of five words here"]
    rows = [(i, t, "en", "s", 1, *extra) for i, t in enumerate(texts)] * 2 + [(None, "null id text of its own", None, None, None, *[None] * len(extra)), (None, None, None, None, None, *extra)]
    labels = spark.createDataFrame([(0, 0, 0), (2, 1, 1), (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"file://{tmp_path}/labels.parquet")
    for table in (rows, []):
        docs = spark.createDataFrame(table, EXTRA)
        for name, stage in corpus_pipeline.STAGES:
            before, docs = docs, stage(spark, docs, f"file://{tmp_path}").cache()
            if name != "tokens":
                assert docs.schema.names == before.schema.names, name
            assert docs.count() == 0 if not table else docs.count() > 0, name
    once = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, EXTRA), "").collect()
    assert sorted(str(r["doc_id"]) for r in once) == ["0", "1", "2", "3", "4", "5", "None", "None"]
