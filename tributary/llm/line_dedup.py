"""Removal of repeated line runs by a distributed suffix array (operator 2).

The worded lines of each document, cut at outer white space, are a sequence of line ids. Prefix
doubling ranks suffixes by their first 1, 2, 4, ... lines: the rank pair (rank of i, rank of
i + 2^k) is sorted over distinct pairs and numbered in order, so ranks of a level are the suffix
array cut at that depth. Suffixes whose prefix occurs once leave at each level, as no longer prefix
of theirs can repeat.

All suffixes that agree on their first m lines are one interval of the suffix array whose longest
common prefix is m or more; for 2^k <= m < 2^(k+1) the interval is named by m and the ranks of the
two halves that cover the run (starting at s and at s + m - 2^k). Of every run the shortest forms
with at least ``min_words`` words are looked up, from each line forwards and from each line
backwards. Together they cover exactly the lines of all maximal repeated runs of ``min_words``
words or more. The first place of a run, by document id (nulls first) and line, stays; the lines of
later places are deleted, also within one document.

Rule: a line goes if and only if it lies in a run of consecutive worded lines with at least
``min_words`` words that also occurs at an earlier place.

Other lines, blank ones too, keep their order. A document of which no word is left through this is
dropped; texts that were null or empty before stay as they are. Rows with equal id and text are one
document and share what happens to it. Texts without a worded line, however many, have no runs; very
long texts are read whole. Empty tables give empty results. Other columns stay as they are, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import identity, own_names, stored, thrifty

WHITE = b" \t\n\x0b\x0c\r"


def _worded(text: str) -> tuple[list[bytes], list[int], list[bytes]]:
    """All lines, the indexes of those with a word, and these without outer white space."""
    lines = text.encode("utf-8", "surrogatepass").split(b"\n")
    bare = [x.strip(WHITE) for x in lines]
    at = [i for i, x in enumerate(bare) if x]
    return lines, at, [bare[i] for i in at]


def _shortest_runs(counts: np.ndarray, min_words: int) -> np.ndarray:
    """Distinct (start, end) of the shortest runs of min_words words from and up to each line."""
    sums = np.concatenate(([0], np.cumsum(counts)))
    n = len(counts)
    ends = np.searchsorted(sums, sums[:-1] + min_words)  # sums[end] - sums[start] >= min_words
    starts = np.searchsorted(sums, sums[1:] - min_words, side="right") - 1
    forward = np.stack((np.arange(n), ends), axis=1)[ends <= n]
    backward = np.stack((starts, np.arange(1, n + 1)), axis=1)[starts >= 0]
    return np.unique(np.concatenate((forward, backward)), axis=0)


def line_sequences(docs: DataFrame, min_words: int, id_col: str, text_col: str) -> DataFrame:
    """(__id, __text, at, h1, h2, ends): worded lines with 128-bit ids and the ends of their runs."""

    @thrifty
    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        for frame in frames:
            for part in (frame.iloc[at:at + 256] for at in range(0, len(frame), 256)):
                ids, texts, ats, hashes, runs = [], [], [], [], []
                for i, t, text in zip(part["__id"], part["__text"], part["text"]):
                    bare = _worded(text)[2]
                    if not bare:
                        continue
                    own: list[list[int]] = [[] for _ in bare]
                    for start, end in _shortest_runs(np.array([len(x.split()) for x in bare]), min_words).tolist():
                        own[start].append(end)
                    ids += [i] * len(bare)
                    texts += [t] * len(bare)
                    ats += range(len(bare))
                    hashes += [xxhash.xxh3_128_digest(x) for x in bare]
                    runs += own
                if not ids:
                    continue
                halves = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
                yield pd.DataFrame({"__id": ids, "__text": texts, "at": ats, "h1": halves[:, 0],
                                    "h2": halves[:, 1], "ends": runs})

    return docs.select(*identity(id_col, text_col), F.col(text_col).alias("text")).filter(
        "text is not null").mapInPandas(read, "__id long, __text long, at int, h1 long, h2 long, ends array<int>")


def _ranked(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """``pairs`` with ``rank`` in the order of (left, right); pairs that occur once drop out.

    Only distinct pairs are sorted. Their numbers rise with the sort order and are written before
    use, so a recomputed task cannot give others.
    """
    repeated = pairs.groupBy(left, right).agg(F.count("*").alias("__n")).filter("__n > 1").drop("__n")
    ranks = stored(repeated.repartitionByRange(left, right).sortWithinPartitions(left, right)
                   .withColumn("__rank", F.monotonically_increasing_id()), "ranks")
    return pairs.join(ranks, [left, right]).drop(left, right).withColumnRenamed("__rank", "rank")


def suffix_ranks(lines: DataFrame, longest: int) -> list[DataFrame]:
    """Ranks (__id, __text, at, rank) by the first 2^k lines, for 2^k <= longest."""
    levels = [stored(_ranked(lines.select("__id", "__text", "at", "h1", "h2"), "h1", "h2"), "level")]
    while 2 ** len(levels) <= longest:
        level = levels[-1]
        step = 2 ** (len(levels) - 1)
        ahead = level.select("__id", "__text", (F.col("at") - step).alias("at"), F.col("rank").alias("ahead"))
        levels.append(stored(_ranked(level.join(ahead, ["__id", "__text", "at"]), "rank", "ahead"), "level"))
    return levels


def repeated_runs(docs: DataFrame, *, min_words: int = 50, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(__id, __text, start, end) of runs that occur at an earlier place; lines count worded ones."""
    lines = stored(line_sequences(docs, min_words, id_col, text_col).dropDuplicates(["__id", "__text", "at"]), "lines")
    longest = lines.agg(F.max(F.array_max("ends") - F.col("at"))).first()[0] or 0
    levels = suffix_ranks(lines, longest)
    runs = lines.select("__id", "__text", F.col("at").alias("start"), F.explode("ends").alias("end"))
    runs = runs.withColumn("lines", F.col("end") - F.col("start")).withColumn(
        "level", F.floor(F.log2("lines") + 1e-9).cast("int"))
    found = None
    for k, level in enumerate(levels):
        head = level.select("__id", "__text", F.col("at").alias("start"), F.col("rank").alias("head"))
        tail = level.select("__id", "__text", (F.col("at") + 2 ** k).alias("end"), F.col("rank").alias("tail"))
        own = (runs.filter(F.col("level") == k).join(head, ["__id", "__text", "start"])
               .join(tail, ["__id", "__text", "end"]))
        own = own.select("__id", "__text", "start", "end", "lines", "head", "tail")
        found = own if found is None else found.union(own)
    found = stored(found, "runs")
    interval = ["lines", "head", "tail"]
    # stored, so that the join below reads plain shuffles, whose hot intervals Spark can split
    first = stored(found.groupBy(*interval).agg(
        F.min(F.struct("__id", "__text", "start")).alias("first"), F.count("*").alias("__n"))
        .filter("__n > 1").drop("__n"), "first")
    return (found.join(first, interval)
            .filter(F.struct("__id", "__text", "start") != F.col("first"))
            .select("__id", "__text", "start", "end"))


@thrifty
def _without(frames: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Each text without its runs of worded lines; None if no word is left."""

    def one(text: str, starts: list[int], ends: list[int]) -> str | None:
        lines, at, bare = _worded(text)
        gone = np.zeros(len(bare) + 1, np.int64)
        np.add.at(gone, np.asarray(starts, np.int64), 1)
        np.add.at(gone, np.asarray(ends, np.int64), -1)
        cut = {i for i, n in zip(at, np.cumsum(gone).tolist()) if n > 0}
        if len(cut) == len(at):
            return None
        return b"\n".join(x for i, x in enumerate(lines) if i not in cut).decode("utf-8", "surrogatepass")

    for text, starts, ends in frames:
        yield pd.Series([t if s is None else one(t, s, e) for t, s, e in zip(text, starts, ends)], dtype=object)


def _cut_texts(text: Column, starts: str, ends: str) -> Column:
    """``_without`` on Spark columns; rows without cuts bring a null text, so their texts stay in the JVM.

    Marked so that a filter on the result is not pushed below it, which would cut all texts twice.
    """
    return F.pandas_udf(_without, "string").asNondeterministic()(text, starts, ends)


def _with_cuts(docs: DataFrame, min_words: int, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with ``__starts`` and ``__ends`` of the runs to delete, null where there are none."""
    runs = repeated_runs(docs, min_words=min_words, id_col=id_col, text_col=text_col)
    cuts = runs.groupBy("__id", "__text").agg(
        F.collect_list("start").alias("__starts"), F.collect_list("end").alias("__ends"))
    keyed = docs.withColumns(dict(zip(("__id", "__text"), identity(id_col, text_col))))
    return keyed.join(cuts, ["__id", "__text"], "left")


@own_names
def without_repeated_runs(docs: DataFrame, *, min_words: int = 50, id_col: str = "doc_id",
                          text_col: str = "text") -> DataFrame:
    """``docs`` without the later copies of line runs; rows left without words are dropped."""
    rows, cut = _with_cuts(docs, min_words, id_col, text_col), F.col("__starts").isNotNull()
    kept = _cut_texts(F.when(cut, F.col(text_col)), "__starts", "__ends")
    return (rows.withColumn("__left", F.when(cut, kept).otherwise(F.col(text_col)))
            .filter(~cut | F.col("__left").isNotNull())
            .select(*[F.col("__left").alias(c) if c == text_col else F.col(c) for c in docs.columns]))


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Documents with the lines that stay, and how many worded lines went.

    The text of a document that lost all its words is empty here.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows, cut = _with_cuts(docs, 50, "doc_id", "text"), F.col("__starts").isNotNull()
    kept = F.coalesce(_cut_texts(F.when(cut, F.col("text")), "__starts", "__ends"), F.lit(""))
    return rows.select("doc_id", F.when(cut, kept).otherwise(F.col("text")).alias("text"), cut.alias("changed"))
