"""A training corpus from raw documents: five stages, each written as Parquet and read by the next.

1. quality_rules: documents that fail the base rules or are depleted of their own lines go; lines
   above their host's limit leave the text.
2. line_dedup: later copies of line runs of 50 words or more leave the text; documents left without
   words go.
3. near_dedup: of documents connected by similarity 0.8 on five-word shingles the first one stays.
4. mixing: documents in the target weights of their sources, packed in blocks of 1024 words. A
   document can come several times, or in part where a block ends inside it.
5. encoding: sampled piece ids of the final texts.

Stages 1 to 4 return the columns of their input. No stage but mixing, whose feature it is, leaves
out a clean document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm.common import stored
from tributary.llm.line_dedup import without_repeated_runs
from tributary.llm.line_frequency import MEASURES, judged
from tributary.llm.minmax_dedup import without_near_duplicates
from tributary.llm.mixing import mixed_documents
from tributary.llm.sampled_pieces import encoded


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Kept documents without frequent lines; columns named like a measure keep their own values."""
    own = {c: f"__own_{c}" for c in docs.columns if c.lower() in MEASURES}
    rows = judged(docs.withColumnsRenamed(own), remove_lines=True).filter("kept")
    return rows.select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repeated_runs(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are not the first of their component go; equal ids with equal text stay once."""
    return without_near_duplicates(docs, shingle=5)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encoded(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("mixing", mixing), ("encoding", encoding)]

#: Suffix arrays, hashing signatures and sampling are not expressible in SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
