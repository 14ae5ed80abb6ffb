"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and works on every row that the stage before it kept; all but the last return the
columns of docs. run() writes each stage's result as Parquet to shared storage and reads it back for the next one.

All stages take whole texts, however long; an empty table gives an empty one; other columns pass through. What each does
with nulls, empty texts, repeated rows and ties is stated at its operator: a null or empty text is clean, has no near
duplicate, no secret, no words to mix and no ids; repeated rows are judged alike, and near-duplicate removal keeps one of those with an id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colwarden.llm import mixing, neardup, secret_ledger, sp_codec, toxicity
from colwarden.llm.common import read, spill
from colwarden.llm.queries import default_model


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fit on the labelled ones of these documents; those judged toxic go."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Word shingles of five at a similarity of 0.8 or more; the smallest id of each group stays."""
    return neardup.keep_first(docs, how=neardup.Tensor(words=5))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are masked."""
    return secret_ledger.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: 0, 1 or 2 times."""
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document of the mix, and whether they decode to its text."""
    body = docs.select("doc_id", "source", "lang", "text", F.coalesce("text", F.lit("")).alias("was"))
    coded = sp_codec.encode(body, default_model())
    return coded.select("doc_id", "source", "lang", "ids", F.size("ids").cast("long").alias("n_tokens"), (F.col("decoded") == F.translate("was", "▁", " ")).alias("decodes"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("tokens", tokenize),
]

#: Not expressible: fitted weights, and the tokenizer's merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = spill(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
