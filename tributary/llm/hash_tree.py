"""Sharding by a hierarchical weighted hash tree (operator 10), DataFrame functions only.

A topology lists leaves ``(region, rack, shard, weight)``. A row descends region, rack and shard;
at each level every child draws ``-ln(u) / weight`` with ``u`` hashed from the row key and the
child's name, and the smallest draw wins (weighted rendezvous). A child's draw depends on its own
weight alone, so a change of weights moves rows only into or out of the subtrees whose weights
changed. A shard that is added as a region of its own takes rows only into itself.

Null ids are keyed by the checksum of their text. Equal ids always share a shard. Null text has
size 8 and checksum 0. Empty tables give empty results. Columns of the input with the names of
result columns are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored


class Leaf(NamedTuple):
    region: str
    rack: str
    shard: int
    weight: float = 1.0


#: Rows numbered by one task at a time; a shard's rows of a range keep to this number on average.
ROWS_PER_BUCKET = 100_000


def regular_topology(shards: int = 24, racks: int = 3, per_rack: int = 4) -> list[Leaf]:
    """Equal shards, ``per_rack`` to a rack and ``racks`` to a region."""
    return [Leaf(f"g{s // (racks * per_rack)}", f"g{s // (racks * per_rack)}r{s // per_rack}", s)
            for s in range(shards)]


def grown(topology: Sequence[Leaf], weight: float = 1.0) -> list[Leaf]:
    """``topology`` and one more shard in a region of its own."""
    shard = max((leaf.shard for leaf in topology), default=-1) + 1
    return [*topology, Leaf(f"new{shard}", f"new{shard}r", shard, weight)]


def _hash_fraction(key: Column, name: Column) -> Column:
    """Number in (0, 1) from 52 bits of the key's and the name's digest."""
    digits = F.substring(F.md5(F.concat_ws(":", key, name)), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2 ** 52))


def _level(children: dict[str, dict[str, float]]) -> Column:
    return F.create_map(*[x for parent, named in sorted(children.items()) for x in (
        F.lit(parent), F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight"))
                                 for n, w in sorted(named.items()) if w > 0]))])


def _draw(key: Column, children: Column) -> Column:
    return F.array_min(F.transform(children, lambda c: F.struct(
        (-F.ln(_hash_fraction(key, c["name"])) / c["weight"]).alias("draw"),
        c["name"].alias("name"))))["name"]


def descend(key: Column, topology: Sequence[Leaf]) -> Column:
    """Shard of a string key: the leaf that weighted draws reach from the root."""
    levels: list[dict[str, dict[str, float]]] = [{"": {}}, {}, {}]
    for leaf in topology:
        steps = ["", leaf.region, leaf.rack, f"s{leaf.shard}"]
        for level, (parent, child) in enumerate(zip(steps, steps[1:])):
            named = levels[level].setdefault(parent, {})
            named[child] = named.get(child, 0.0) + leaf.weight
    if not any(levels[0][""].values()):
        raise ValueError("the topology has no weight")
    node = F.lit("")
    for level in levels:
        node = _draw(key, F.element_at(_level(level), node))
    return F.substring(node, 2, 10).cast("int")


def placed(docs: DataFrame, topology: Sequence[Leaf], *, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``docs`` with size, text_crc32, shard and grown_shard; no shuffle."""
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    crc = F.crc32(raw)
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text:"), crc.cast("string")))
    return docs.withColumns({
        "size": (F.octet_length(raw) + 8).cast("long"), "text_crc32": crc.cast("long"),
        "shard": descend(key, topology), "grown_shard": descend(key, grown(topology))})


def numbered(rows: DataFrame, shards: int, *, id_col: str = "doc_id",
             rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``placed`` rows with ``slot``, which counts each shard's rows from 0 without gaps.

    Slots follow the id at every size (null ids last), then checksum and size. Rows are dealt to
    ranges of that order and stored with their range's number; rows are counted per (shard, range),
    the small table of counts gives each range its first slot, and a window numbers the rows within.
    """
    order = [F.col(id_col).asc_nulls_last(), F.col("text_crc32").asc(), F.col("size").asc()]
    ranges = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                 rows.count() // (shards * rows_per_bucket) + 1)
    rows = stored(rows.repartitionByRange(ranges, *order).withColumn("__bucket", F.spark_partition_id()), "ranges")
    before = Window.partitionBy("shard").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = (rows.groupBy("shard", "__bucket").agg(F.count("*").alias("__n"))
             .withColumn("__first", F.coalesce(F.sum("__n").over(before), F.lit(0)))
             .drop("__n"))
    within = Window.partitionBy("shard", "__bucket").orderBy(*order)
    return (rows.withColumn("__at", F.row_number().over(within))
            .join(first, ["shard", "__bucket"])
            .withColumn("slot", (F.col("__first") + F.col("__at") - 1).cast("long"))
            .drop("__bucket", "__at", "__first"))


def op10_hash_tree(spark, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of two regions under the law ``key``, with their slots."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = placed(docs, regular_topology(24)).drop("text")
    return numbered(rows, 24).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
