"""A corpus pipeline of five stages: quality rules, near-duplicate removal,
benchmark decontamination, mixing to target weights, token-id files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet in the shared folder and read again as the next one's docs.
All but the last return the columns of ``documents``.  Odd input is defined by
the operators' own docstrings (tidemark/llm).
"""

from __future__ import annotations

from tidemark.llm import decontaminate, jaccard, mixing, quality, token_files
from tidemark.session import scratch_path
from tidemark.sources.tables import read_table


def quality_rules(spark, docs, sf_dir):
    """Documents that the quality rules reject go."""
    return quality.keep(docs, quality.train(docs, read_table(spark, sf_dir, "labels")))


def near_duplicates(spark, docs, sf_dir):
    """One document of each near-duplicate group stays."""
    return jaccard.representatives(docs)


def decontamination(spark, docs, sf_dir):
    """Documents that hold a benchmark passage go."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def mixture(spark, docs, sf_dir):
    """The documents are drawn to the target weights, repeated by epoch."""
    return mixing.mix(docs)


def token_ids(spark, docs, sf_dir):
    """The token ids are written in ascending doc_id order and read back."""
    return token_files.encode_and_read(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixture),
    ("token_ids", token_ids),
]


def run(spark, sf_dir):
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.schema(docs.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


# The first stage is a trained model, which SQL can't express; tests/llm holds
# the stages against brute-force versions.
ORACLE_SQL = None
