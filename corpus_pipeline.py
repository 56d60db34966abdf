"""Training-corpus pipeline: toxic documents out, one of each near-duplicate
group, no benchmark copies, secrets redacted, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of documents. Every stage is judged on what it is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tagloom.llm.bpe import bpe_encode
from tagloom.llm.common import fresh_path
from tagloom.llm.decontaminate import decontaminate
from tagloom.llm.neardup import FIVE_80, drop_near_duplicates
from tagloom.llm.queries import _tokenizer
from tagloom.llm.secrets import redact
from tagloom.llm.toxicity import score, train

#: Documents scored at or above it are rejected.
TOXIC = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fit on labelled documents (a bounded sample), keep what scores below TOXIC."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model, keep_below=TOXIC)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, 0.8) the least doc_id stays."""
    return drop_near_duplicates(docs, FIVE_80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a copy of a benchmark item go."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests."""
    return bpe_encode(docs, _tokenizer(), with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_copies),
    ("decontamination", drop_leaks),
    ("secrets", redact_secrets),
    ("bpe", encode),
]

#: Fitting, min-wise sampling and tokenizing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = fresh_path(spark, f"stage-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
