"""Words, row identity and storage shared by the operators of this subpackage.

White space is the six ASCII characters space and 0x09 to 0x0D; a word is a run of anything else.
Columns that begin with two underscores are internal; ``own_names`` keeps those of an input apart.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.session import scratch_path, store

SPACES = r"[\x20\x09-\x0D]+"
NON_SPACE = r"[^\x20\x09-\x0D]"
NO_ID = -(2 ** 63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Array of the words; null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def identity(id_col: str, text_col: str) -> list[Column]:
    """Columns ``__id`` and ``__text`` that tell rows apart without nulls.

    Rows with equal id and equal text count as one document, so repeated rows share every verdict.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("__id"),
            F.xxhash64(text, F.col(text_col).isNull()).alias("__text")]


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once under the shared folder and read back, which also cuts its lineage."""
    return store(df, scratch_path(df.sparkSession, label))


def own_names(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``stage`` for inputs that may have columns named like internal ones; they come back as they were."""

    @wraps(stage)
    def run(docs: DataFrame, **options) -> DataFrame:
        plain = {c: f"column {k} of the input" for k, c in enumerate(docs.columns) if c.startswith("__")}
        return stage(docs.withColumnsRenamed(plain), **options).withColumnsRenamed({v: k for k, v in plain.items()})

    return run


def thrifty(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``task`` on batches that gives freed memory back at its end, as its worker lives on for other stages."""

    @wraps(task)
    def run(frames: Iterator) -> Iterator:
        import ctypes

        import pyarrow

        try:
            yield from task(frames)
        finally:
            pyarrow.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
            if trim:
                trim(0)

    return run
