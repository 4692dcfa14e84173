"""The corpus pipeline: toxicity, line dedup, near duplicates, mixing, BPE.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of documents.  Other columns of
``docs`` are not carried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

import public_tokenizers
from tessera.llm import bpe_automaton, jaccard_join, line_dedup, mixing, toxicity
from tessera.llm.common import written
from tessera.session import ensure_checkpoint_dir, read_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
TOKENIZER = "word_bpe_49k.json"


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that operator 5 predicts to be toxic go, with all rows of their id; rows with a null id stay."""
    docs = docs.select(*COLUMNS)
    scored = toxicity.score(docs, read_table(spark, sf_dir, "labels"), weighting=toxicity.MARKED)
    bad = written(scored.filter("predicted = 1").select("doc_id").distinct(), "toxic-ids")
    return docs.join(bad, "doc_id", "left_anti")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that operator 4 drops; a document that loses all of them stays with an empty text."""
    docs = docs.select(*COLUMNS)
    out = line_dedup.kept(docs, line_dedup.keep_bitmaps(docs))
    changed = F.col("n_dropped") > 0
    return out.select("row.doc_id", F.when(changed, F.col("kept")).otherwise(F.col("row.text")).alias("text"),
                      "row.lang", "row.source",
                      F.when(changed, F.length("kept").cast("long")).otherwise(F.col("row.n_chars")).alias("n_chars"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the least id) of each group that operator 9 links; rows with a null id stay."""
    docs = docs.select(*COLUMNS)
    groups = jaccard_join.near_groups(docs)
    gone = written(groups.filter("class_id <> doc_id").select("doc_id"), "near-duplicates")
    return docs.join(gone, "doc_id", "left_anti")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents replicated by operator 3 to the tempered source weights, globally shuffled."""
    return mixing.mix(docs.select(*COLUMNS)).select("row.*")


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids: operator 8's encoding, packed as little-endian unsigned 32-bit integers."""
    coded = bpe_automaton.encode(docs, public_tokenizers.path(TOKENIZER), decoded=False,
                                 carry=["doc_id", "lang", "source"])
    return coded.select("row.doc_id", "row.lang", "row.source", "n_tokens", "ids")


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

#: No SQL form: toxicity, the near-duplicate groups and BPE are not expressible; the tests hold each stage
#: against its operator and brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again in the shared scratch folder."""
    ensure_checkpoint_dir(spark)
    docs = read_table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
