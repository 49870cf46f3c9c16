"""The corpus pipeline: every stage works on all documents that the one before it kept."""

from __future__ import annotations

from wearlens.llm import bpe, decontam, near_dedup, queries, secret_scan, toxicity
from wearlens.llm.store import keep


def drop_toxic(spark, docs, sf_dir):
    """Documents that the ordinal model rejects go."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each group of near copies stays."""
    return near_dedup.drop_near_duplicates(docs)


def drop_contaminated(spark, docs, sf_dir):
    """Documents that repeat benchmark passages go."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark, docs, sf_dir):
    """Every secret in a text gives way to its kind in brackets; n_chars follows."""
    return secret_scan.redact(docs)


def encode(spark, docs, sf_dir):
    """Token ids of the texts left, with digests of the ids and of the bytes they decode to."""
    encoded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), queries.tokens(), decoded=True)
    return queries.with_digests(encoded, "lang", "source", "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("tokens", encode),
]
ORACLE_SQL = None  # the toxicity stage fits a model


def run(spark, sf_dir):
    """All stages over documents; between them the documents are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
