"""Mixing sources to target weights in fixed-length blocks (operator 4).

A size is a number of words. Sources in code-point order, null last, weigh 1, 2, 3, 1, 2, ...; they
share the total of all sizes by weight, but no target passes ``max_repeats`` times its source's
size, and the excess is shared again. The words of a source, its documents in hashed order, are
packed end to end into blocks of ``block_words`` (the last one may be shorter). A source fills as
many slots as its target needs: slot t takes block ``permutation(epoch, t mod blocks)`` of epoch
``t div blocks``, the permutation being a keyed Feistel network over block indexes; the short block
closes each epoch and the last slot is cut to the word. The slots of a source are dealt to the
output shards by a multinomial draw, so that a shard's source counts are multinomial given its
size while each source's total is exact. Slots and blocks meet in a join by (source, block).

Null text has size 0, documents without words are never taken, null is a source of its own, and
repeated rows are separate documents, also where only their source differs. Very long texts span
blocks. Everything is seeded: reruns agree. Empty tables give empty results. Columns of the input
with the names of result columns are replaced in the query and kept in the mix of documents.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import identity, own_names, stored, thrifty

#: Rows of a source that one task lays end to end, on average.
ROWS_PER_BUCKET = 5000
#: Equal rows that are laid out together.
ROWS_PER_GROUP = 500
#: Tasks that fill slots at most, and shards whose slots are drawn at once.
FILLERS, SHARDS_AT_ONCE = 4096, 1 << 16
NON_SPACES = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, max_repeats: int = 3) -> DataFrame:
    """source, source_size, n_docs, __s (ordinal), target, for rows (source, size).

    With sources ordered by limit / weight, the first i limits bind and the others share the rest
    by weight; i is the first place where the shared level stays within the limit.
    """
    everywhere = Window.partitionBy()
    per_source = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    weighted = per_source.withColumn(
        "__s", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ).withColumn("__w", (F.col("__s") % 3 + 1).cast("double")
    ).withColumn("__limit", F.col("source_size") * max_repeats)
    by_ratio = Window.orderBy(F.col("__limit") / F.col("__w"), "__s")
    levels = weighted.withColumns({
        "__i": F.row_number().over(by_ratio),
        "__level": (F.sum("source_size").over(everywhere)
                    - F.sum("__limit").over(by_ratio.rowsBetween(Window.unboundedPreceding, 0)) + F.col("__limit"))
        / F.sum("__w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))})
    fits = F.col("__level") <= F.col("__limit") / F.col("__w")
    shared = F.min(F.when(fits, F.struct("__i", "__level"))).over(everywhere)["__level"]
    return levels.withColumn("target", F.least(F.col("__limit").cast("double"), shared * F.col("__w"))).select(
        "source", "source_size", "n_docs", "__s", "target")


def laid_out(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             max_repeats: int = 3) -> DataFrame:
    """One stored row per document: id, source, size, source_size, target, __s, __start.

    ``__start`` is the document's first word within its source. Equal rows follow each other. Documents go by hash into buckets
    per source; the small table of bucket sizes gives each bucket its start, a window does the rest.
    """
    sized = stored(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), *identity(id_col, text_col),
        F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(NON_SPACES)).cast("long").alias("size")),
        "sized")
    targets = stored(source_targets(sized, max_repeats), "targets")
    # equal rows are counted and dealt in groups, so that no bucket holds all copies of a row
    many = sized.groupBy(*sized.columns).agg(F.count("*").alias("__n")).withColumn("__group", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("__n") - 1) / ROWS_PER_GROUP)))).withColumn(
        "__copies", F.least(F.lit(ROWS_PER_GROUP), F.col("__n") - F.col("__group") * ROWS_PER_GROUP))
    rows = many.join(targets.withColumnRenamed("source", "__source"),
                     F.col("source").eqNullSafe(F.col("__source"))).drop("__source", "__n")
    draw = F.when(F.col("__group") == 0, F.xxhash64("__id", "__text", F.lit("order"))).otherwise(
        F.xxhash64("__id", "__text", F.lit("order"), "__group"))
    rows = rows.withColumn("__hash", draw).withColumn(
        "__bucket", F.pmod("__hash", F.floor(F.col("n_docs") / ROWS_PER_BUCKET) + 1))
    words = F.col("size") * F.col("__copies")
    before = Window.partitionBy("__s").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = (rows.groupBy("__s", "__bucket").agg(F.sum(words).alias("__n"))
             .withColumn("__first", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n"))
    within = (Window.partitionBy("__s", "__bucket").orderBy("__hash", "__id", "__text", "__group")
              .rowsBetween(Window.unboundedPreceding, 0))
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("__copies") - 1))
    return stored(rows.withColumn("__end", F.sum(words).over(within)).join(first, ["__s", "__bucket"])
                  .withColumn("__copy", copy)
                  .withColumn("__start", F.col("__first") + F.col("__end") - words + F.col("__copy") * F.col("size"))
                  .drop("__first", "__end", "__bucket", "__hash", "__group", "__copies", "__copy", "n_docs"), "rows")


def _scramble(x: np.ndarray, key: int) -> np.ndarray:
    """64-bit finaliser of x + key."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64(key & (2 ** 64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, size: int, key: int, rounds: int = 4) -> np.ndarray:
    """Keyed pseudorandom permutation of 0..size-1 at ``index``.

    A balanced Feistel network permutes the next power of four; results outside go through again.
    """
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        value = out[todo]
        left, right = value >> np.uint64(half), value & mask
        for r in range(rounds):
            left, right = right, left ^ (_scramble(right, key * 31 + r) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= size]
    return out.astype(np.int64)


def _plan(source_size: int, target: float, block_words: int) -> tuple[int, int, int, int, int]:
    """Words to take, whole blocks, blocks, slots, words of the last slot."""
    take = int(math.floor(target + 0.5))
    whole, tail = divmod(source_size, block_words)
    blocks = whole + (tail > 0)
    if not blocks or not take:
        return 0, whole, blocks, 0, 0
    epochs, rest = divmod(take, source_size)
    more = min(-(-rest // block_words), blocks)
    last = rest - (more - 1) * block_words if more else (tail or block_words)
    return take, whole, blocks, epochs * blocks + more, last


def dealt_slots(targets: DataFrame, *, block_words: int, slots_per_shard: int, seed: int = 0) -> DataFrame:
    """(__s, shard, epoch, block, words, draw): every slot; ``draw`` orders a shard's slots."""
    ranges = "__s int, shard int, source_size long, target double, first long, n long"
    targets = targets.select("__s", "source_size", "target").distinct()
    total = targets.agg(F.sum(F.least(F.col("target"), F.lit(float(2 ** 62))))).first()[0] or 0.0
    shards = int(total // (block_words * slots_per_shard)) + 1

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for s, size, target in zip(frame["__s"], frame["source_size"], frame["target"]):
                draw, at = np.random.default_rng([seed, int(s)]), 0
                slots = _plan(int(size), target, block_words)[3]
                shares = [min(SHARDS_AT_ONCE, shards - k) for k in range(0, shards, SHARDS_AT_ONCE)]
                own = draw.multinomial(slots, np.array(shares) / shards) if len(shares) > 1 else [slots]
                for k, (share, n) in enumerate(zip(shares, own)):
                    counts = draw.multinomial(n, np.full(share, 1.0 / share))
                    found = np.flatnonzero(counts)
                    ends = at + np.cumsum(counts)
                    at += int(n)
                    yield pd.DataFrame({"__s": int(s), "shard": k * SHARDS_AT_ONCE + found, "source_size": size,
                                        "target": target, "first": (ends - counts)[found], "n": counts[found]})

    def fill(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for (s, size, target), own in frame.groupby(["__s", "source_size", "target"]):
                _, whole, blocks, slots, last = _plan(int(size), target, block_words)
                for part in (own.iloc[at:at + 16] for at in range(0, len(own), 16)):
                    n = part["n"].to_numpy()
                    t = np.repeat(part["first"].to_numpy() - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    epoch, block = t // blocks, t % blocks
                    words = np.where(block < whole, block_words, size % block_words)
                    words[t == slots - 1] = last
                    for e in np.unique(epoch):
                        at = (epoch == e) & (block < whole)
                        key = (seed * 1_000_003 + int(s)) * 1_000_003 + int(e)
                        block[at] = permuted(block[at], whole, key)
                    draw = _scramble(t, seed * 7 + int(s) * 1_000_003).view(np.int64)
                    yield pd.DataFrame({"__s": int(s), "shard": np.repeat(part["shard"].to_numpy(), n), "epoch": epoch,
                                        "block": block, "words": words, "draw": draw})

    dealt = targets.mapInPandas(deal, ranges)
    return dealt.repartition(min(shards, FILLERS), "__s", "shard").mapInPandas(
        fill, "__s int, shard int, epoch long, block long, words long, draw long")


def taken_pieces(rows: DataFrame, *, block_words: int = 64, slots_per_shard: int = 4096,
                 seed: int = 0) -> DataFrame:
    """Slots joined to blocks: (shard, draw, epoch, block, __s, __start, size, from, to).

    ``from`` and ``to`` bound the words of the document that the slot takes.
    """
    slots = dealt_slots(rows.select("__s", "source_size", "target"), block_words=block_words,
                        slots_per_shard=slots_per_shard, seed=seed)
    pieces = rows.filter("size > 0").select("__s", "__start", "size", F.explode(F.sequence(
        F.floor(F.col("__start") / block_words),
        F.floor((F.col("__start") + F.col("size") - 1) / block_words))).alias("block"))
    at = F.col("block") * block_words
    # slots come out of Python, so Spark can't know their size and must not broadcast them
    return (pieces.join(slots.hint("merge"), ["__s", "block"])
            .withColumns({"from": F.greatest(at, "__start") - F.col("__start"),
                          "to": F.least(at + F.col("words"), F.col("__start") + F.col("size")) - F.col("__start")})
            .filter(F.col("to") > F.col("from")).drop("words"))


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    """Every document with the words that the mix takes of it, repeats counted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = laid_out(docs)
    taken = taken_pieces(rows).groupBy("__s", "__start", "size").agg(F.sum(F.col("to") - F.col("from")).alias("taken"))
    return rows.join(taken, ["__s", "__start", "size"], "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "source")


@thrifty
def _cut(frames: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """The spans of words of each text, with the white space between neighbouring words kept."""
    def one(text: str, size: int, spans: list) -> str:
        spans = sorted((s["from"], s["to"]) for s in spans)
        if sum(b - a for a, b in spans) >= size:
            return text
        merged: list[list[int]] = []
        for a, b in spans:
            if merged and merged[-1][1] == a:
                merged[-1][1] = b
            else:
                merged.append([a, b])
        words = [m.span() for m in re.finditer(NON_SPACES, text)]
        return "\n".join(text[words[a][0]:words[b - 1][1]] for a, b in merged)

    for batch in frames:
        yield pd.Series([one(*x) for x in zip(*batch)], dtype=object)


@own_names
def mixed_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    block_words: int = 1024, slots_per_shard: int = 4096, seed: int = 0) -> DataFrame:
    """The mix as documents: one row per document and epoch that takes words of it.

    Columns are those of ``docs``; the text holds the words taken, whole where all are. Of rows
    with equal id, text and source the other columns come from the one with the smallest hash.
    """
    rows = laid_out(docs, id_col=id_col, text_col=text_col, source_col=source_col)
    keys = ["__id", "__text", "__source"]
    spans = (taken_pieces(rows, block_words=block_words, slots_per_shard=slots_per_shard, seed=seed)
             .groupBy("__s", "__start", "size", "epoch")
             .agg(F.collect_list(F.struct("from", "to")).alias("__spans")))
    spans = spans.join(rows.withColumn("__source", _source_key("source")), ["__s", "__start", "size"]).select(
        *keys, F.col("size").alias("__size"), "__spans")
    keyed = docs.withColumns(dict(zip(keys, (*identity(id_col, text_col), _source_key(source_col)))))
    repeated = stored(rows.groupBy("__id", "__text", _source_key("source").alias("__source")).agg(
        F.count("*").alias("__n")).filter("__n > 1").drop("__n"), "repeated")
    again = keyed.join(repeated, keys, "left_semi").groupBy(*keys).agg(
        F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("__row"))
    unique = keyed.join(repeated, keys, "left_anti").unionByName(again.select("__row.*", *keys))
    return unique.join(spans, keys).withColumn(
        text_col, F.pandas_udf(_cut, "string")(text_col, "__size", "__spans")).select(*docs.columns)


def _source_key(source_col: str) -> Column:
    return F.xxhash64(F.col(source_col), F.col(source_col).isNull())
