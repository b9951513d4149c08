"""Corpus pipeline over ``documents``: toxicity, near duplicates, repeated passages, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet in the shared folder and reread as the next stage's docs.  All but the
last return the columns of ``documents``; each works on all rows its
predecessor kept.
"""

from __future__ import annotations

from tessera.llm import decontaminate, ngram_join, packing, substring_dedup, toxicity
from tessera.llm.common import staged
from tessera.session import load


def toxic_documents_go(spark, docs, sf_dir):
    """Documents whose toxicity is 0.5 or more go."""
    return toxicity.keep_clean(docs, load(spark, sf_dir, "labels"), threshold=0.5)


def one_of_near_duplicates(spark, docs, sf_dir):
    """One document of each group linked by shingle similarity 0.8 stays."""
    return ngram_join.keep_one_per_group(docs, num=80, den=100)


def repeated_passages_go(spark, docs, sf_dir):
    """Passages of 50 words or more stay in their first document only."""
    return substring_dedup.remove_repeats(docs, min_words=50)


def benchmark_passages_go(spark, docs, sf_dir):
    """Ten-word windows of benchmark items are cut; documents covered by half or more go."""
    return decontaminate.remove_hits(docs, load(spark, sf_dir, "benchmark"), window=10, max_hit=0, max_coverage=0.5)


def packed_sequences(spark, docs, sf_dir):
    """Token pieces placed in sequences of at most 4096 tokens."""
    return packing.pack_documents(docs, packing.public_vocabulary("word_bpe_49k.json"), capacity=4096)


STAGES = [
    ("toxicity", toxic_documents_go),
    ("ngram_jaccard_join", one_of_near_duplicates),
    ("substring_dedup", repeated_passages_go),
    ("benchmark_decontamination", benchmark_passages_go),
    ("best_fit_packing", packed_sequences),
]
ORACLE_SQL = None       # learned scores and tokenization have no SQL form; tests compare with brute force


def run(spark, sf_dir):
    """All stages over ``documents``; every stage's rows are written before the next one reads them."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
