"""Near-duplicate components by min-max hashing (operator 8).

A document's set holds its distinct shingles of ``shingle`` words (A-Z lower-cased, words split at
ASCII white space); a shorter text is one shingle, a text without words has no set. Texts with
equal sets are one class. Each of 144 permutations of a class's set gives its minimum and its
maximum, 288 values that make 48 bands of 6. Two large sets of similarity 0.8 miss each other with a
chance of 5e-7; in small sets minimum and maximum depend on each other, which makes it 1.8e-6 with 8
of 10 shingles shared and 8.5e-6, the most, with 4 of 5. Within a bucket (classes that agree on a band):

1. every member is compared with one pivot, the member that shares most buckets overall;
2. connected components are formed from the links found;
3. buckets whose members are not all connected are finished. Each member is compared with the hub
   of the bucket's largest component. Only shingles that occur in another component can support a
   link between components; a set in which too few do has no such link and leaves. Of the others
   a set outside the largest component can only be linked to a set that shares some of its
   differences to the hub. Such pairs meet by their rarest differences (prefix filter) and are
   compared on whole sets. So many copies that are all just under the threshold, whose differences
   are their own, make few pairs.

Pairs inside a component need no comparison, so a large group of copies costs one comparison per
class, and no link between components that share a bucket is left out. Every link is confirmed on
whole sets of 64-bit shingle hashes, which come from one row of each class, known by id and text.

Very long texts are hashed whole. Null and empty texts are linked with nothing. Null ids come last
among ids. Rows with equal ids keep their own texts' links; repeated rows share everything. Empty
tables give empty results; columns beside id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import identity, own_names, stored, thrifty
from .components import components
from .hashing import U64, mixed, word_hashes

BANDS, ROWS = 48, 6
PERMUTATIONS = BANDS * ROWS // 2


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; bytes are hashed by prefix sums."""
    words = word_hashes(text)[2]
    if not len(words):
        return words
    n = min(shingle, len(words))
    grams = np.full(len(words) - n + 1, n, U64)
    for k in range(n):
        grams = mixed(grams * U64(0x9E3779B97F4A7C15) + words[k:len(words) - n + 1 + k])
    return np.unique(grams)


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20240607)
    return (draw.integers(0, 2 ** 32, PERMUTATIONS, dtype=np.uint32) | np.uint32(1),
            draw.integers(0, 2 ** 32, PERMUTATIONS, dtype=np.uint32))


def min_max_signature(hashes: np.ndarray) -> np.ndarray:
    """Minimum and maximum of the set under each permutation of 32-bit integers."""
    a, b = _multipliers()
    short = (hashes >> U64(32)).astype(np.uint32)
    low, high = np.full(PERMUTATIONS, 2 ** 32 - 1, np.uint32), np.zeros(PERMUTATIONS, np.uint32)
    for at in range(0, len(short), 1024):
        values = a[:, None] * short[None, at:at + 1024] + b[:, None]
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    return np.stack((low, high), axis=1).reshape(-1)


def band_keys(signature: np.ndarray) -> np.ndarray:
    keys = np.arange(1, BANDS + 1, dtype=U64)
    for column in signature.reshape(BANDS, ROWS).T:
        keys = mixed(keys * U64(0x9E3779B97F4A7C15) + column.astype(U64))
    return keys.view(np.int64)


def signed(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, __id, __text, n_shingles, __set: 128-bit fingerprint, __bands) of every row."""

    @thrifty
    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        with np.errstate(over="ignore"):
            for frame in frames:
                for at in range(0, len(frame), 512):
                    part, rows = frame.iloc[at:at + 512], []
                    for text in part["text"]:
                        hashes = shingle_hashes(text, shingle)
                        if len(hashes):
                            rows.append((len(hashes), xxhash.xxh3_128_digest(hashes.tobytes()),
                                         band_keys(min_max_signature(hashes))))
                        else:
                            rows.append((0, b"", None))
                    out = pd.DataFrame(rows, columns=["n_shingles", "__set", "__bands"])
                    out["__bands"] = out["__bands"].astype(object)
                    for k, name in enumerate(("doc_id", "__id", "__text")):
                        out.insert(k, name, part[name].array)
                    yield out

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), *identity(id_col, text_col),
                       F.col(text_col).alias("text")).mapInPandas(
        sign, "doc_id long, __id long, __text long, n_shingles long, __set binary, __bands array<long>")


def class_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(node, __hashes) of rows (node, text, __class); a text of another class drops out.

    Repeated rows meet in one task, which gives their set once.
    """

    @thrifty
    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        seen: set[int] = set()
        with np.errstate(over="ignore"):
            for frame in frames:
                for at in range(0, len(frame), 512):
                    part, nodes, sets = frame.iloc[at:at + 512], [], []
                    for node, kind, text in zip(part["node"], part["__class"], part["text"]):
                        if node in seen:
                            continue
                        hashes = shingle_hashes(text, shingle)
                        if xxhash.xxh3_128_digest(hashes.tobytes()) == bytes(kind):
                            seen.add(node)
                            nodes.append(node)
                            sets.append(hashes.view(np.int64))
                    if nodes:
                        yield pd.DataFrame({"node": nodes, "__hashes": sets})

    return texts.select("node", "__class", "text").mapInPandas(build, "node long, __hashes array<long>")


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(u, v, common, whole) of pairs (u, v), from whole sets."""
    left = sets.select(F.col("node").alias("u"), F.col("__hashes").alias("__a"))
    right = sets.select(F.col("node").alias("v"), F.col("__hashes").alias("__b"))
    common = F.size(F.array_intersect("__a", "__b")).cast("long")
    found = pairs.select("u", "v").join(left, "u").join(right, "v").select(
        "u", "v", common.alias("common"), (F.size("__a") + F.size("__b")).cast("long").alias("__sum"))
    return found.select("u", "v", "common", (F.col("__sum") - F.col("common")).alias("whole")).withColumn(
        "linked", 100 * F.col("common") >= percent * F.col("whole"))


def _supported(rest: DataFrame, hubs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node): sets of whose shingles enough occur in another component.

    Hubs count among the components' sets, whether or not their buckets are mixed.
    """
    nodes = rest.select("node", "part", "n").union(
        hubs.select("hub", "part", F.lit(None).alias("n"))).groupBy("node", "part").agg(F.max("n").alias("n"))
    shingles = nodes.join(sets, "node").select("node", "part", "n", F.explode("__hashes").alias("h"))
    shared = shingles.groupBy("h").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter(
        "low <> high")
    common = shingles.join(shared, "h", "left_semi").groupBy("node", "n").agg(F.count("*").alias("common"))
    return common.filter(100 * F.col("common") >= percent * F.col("n")).select("node")


def _beside_hubs(rest: DataFrame, sets: DataFrame, able: DataFrame, percent: int) -> DataFrame:
    """(node, hub, part, main, n, linked, r, __apart) of each set and the hub of its bucket's largest component.

    ``__apart`` holds the shingles that only one of the two has. For two sets beside one hub these
    differences tell their own: with d = |apart| and x common elements, they differ in d + d' - 2x
    shingles and are linked if r + r' <= 2 (100 + percent) x, where
    r = (100 + percent) d - (100 - percent) n.
    """
    near = rest.select("node", "hub", "part", "main", "n").distinct().join(able, "node")
    near = near.join(sets.select("node", F.col("__hashes").alias("__a")), "node").join(
        sets.select(F.col("node").alias("hub"), F.col("__hashes").alias("__h")), "hub")
    apart = F.concat(F.array_except("__a", "__h"), F.array_except("__h", "__a"))
    near = near.select("node", "hub", "part", "main", "n", F.size("__h").alias("n_hub"), apart.alias("__apart"))
    d = F.size("__apart")
    linked = (100 + percent) * d <= (100 - percent) * (F.col("n") + F.col("n_hub"))
    return near.select("node", "hub", F.when(linked, F.col("main")).otherwise(F.col("part")).alias("part"), "main", "n",
                       linked.alias("linked"), ((100 + percent) * d - (100 - percent) * F.col("n")).cast("long").alias("r"),
                       "__apart")


def _candidates(beside: DataFrame, percent: int) -> DataFrame:
    """(u, v) of sets beside one hub, of which one is outside the hub's component, that may be linked.

    Such a pair has r + r' > 0, as a set outside is not linked to the hub, so its differences have
    at least (r + r') / (2 (100 + percent)) elements in common. With the least r' of the others
    beside the hub this gives each set a number of elements it must share; all but that many and
    one more of its rarest cannot be without one of them (prefix filter), and from their first common
    one on enough must be left in both (positional filter). Elements that no other set has are left
    out first.
    """
    double = 2 * (100 + percent)
    low = beside.groupBy("hub").agg(F.min(F.when(F.col("part") != F.col("main"), F.col("r"))).alias("low_out"),
                                    F.min(F.when(F.col("part") == F.col("main"), F.col("r"))).alias("low_in"))
    low = stored(low.filter("low_out is not null"), "low")
    elements = stored(beside.join(low, "hub").select("node", "hub", F.explode("__apart").alias("h")), "elements")
    often = stored(elements.groupBy("hub", "h").agg(F.count("*").alias("df")).filter("df > 1"), "often")
    ranked = elements.join(often, ["hub", "h"]).withColumns({
        "place": F.row_number().over(Window.partitionBy("node", "hub").orderBy("df", "h")),
        "whole": F.count("*").over(Window.partitionBy("node", "hub"))})
    facts = beside.drop("__apart", "linked").join(low, "hub")

    def needed(other: str) -> Column:
        return F.greatest(F.lit(1), F.ceil((F.col("r") + F.col(other)) / double))

    rows = ranked.join(facts, ["node", "hub"]).select(
        "hub", "h", "node", "part", "n", "r", (F.col("whole") - F.col("place") + 1).alias("left"),
        (F.col("part") != F.col("main")).alias("out"),
        (F.col("place") <= F.col("whole") - needed("low_out") + 1).alias("for_out"),
        (F.col("place") <= F.col("whole") - needed("low_in") + 1).alias("for_in"))
    rows = stored(rows.filter("for_out OR (out AND for_in)"), "prefixes")
    a, b = (rows.select("hub", "h", *[F.col(c).alias(f"{side}_{c}") for c in rows.columns[2:]])
            for side in "ab")
    # from their first common element on, neither set has more than ``left`` elements to share
    meet = ((F.col("a_part") != F.col("b_part"))
            & (F.col("a_r") + F.col("b_r") <= double * F.least("a_left", "b_left"))
            & (100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n"))
            & F.when(F.col("b_out"), F.col("a_for_out") & (F.col("a_node") < F.col("b_node"))).otherwise(F.col("a_for_in")))
    return a.filter("a_out").join(b.filter("b_for_out"), ["hub", "h"]).filter(meet).select(
        F.least("a_node", "b_node").alias("u"), F.greatest("a_node", "b_node").alias("v")).distinct()


def _linked(docs: DataFrame, shingle: int, percent: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``signed`` rows, and (__set, first_id, component) of every class; components are nodes."""
    if percent < 80:
        raise ValueError("the bands are made for similarities of 0.8 and more")
    signatures = stored(signed(docs, shingle, id_col, text_col), "signatures")
    classes = stored(
        signatures.filter("n_shingles > 0").groupBy("__set").agg(
            F.min("doc_id").alias("first_id"), F.any_value("n_shingles").alias("n"), F.any_value("__bands").alias("__bands"),
            F.min(F.struct("__id", "__text")).alias("__holder"))
        .withColumn("node", F.monotonically_increasing_id()), "classes")
    banded = classes.select("node", F.col("n").cast("int").alias("n"), F.explode("__bands").alias("key"))
    # stored, so that the join below reads plain shuffles, whose hot buckets Spark can split
    crowded = stored(banded.groupBy("key").agg(F.count("*").alias("crowd")).filter("crowd > 1"), "crowded")
    members = stored(banded.join(crowded, "key"), "members")
    central = members.groupBy("node").agg(F.sum("crowd").alias("central"))
    pivots = stored(members.join(central, "node").groupBy("key").agg(F.max_by(
        F.struct("node", "n"), F.struct("central", -F.col("node"))).alias("pivot")).select(
        "key", F.col("pivot.node").alias("pivot"), F.col("pivot.n").alias("pivot_n")), "pivots")
    sizes_fit = 100 * F.least("n", "pivot_n") >= percent * F.greatest("n", "pivot_n")
    first = stored(members.join(pivots, "key").filter((F.col("node") != F.col("pivot")) & sizes_fit).select(
        F.col("node").alias("u"), F.col("pivot").alias("v")).distinct(), "pairs")

    wanted = members.select("node").distinct()
    # a class's set comes from one of its texts, which rows of equal id and text share
    holders = classes.join(wanted, "node", "left_semi").select(
        "node", "__holder.__id", "__holder.__text", F.col("__set").alias("__class"))
    texts = docs.select(*identity(id_col, text_col), F.col(text_col).alias("text")).join(holders, ["__id", "__text"])
    sets = stored(class_sets(texts, shingle), "sets")
    if sets.count() > sets.select("node").distinct().count():  # such rows met in several tasks
        sets = stored(sets.groupBy("node").agg(F.any_value("__hashes").alias("__hashes")), "sets")

    tested = stored(_compared(first, sets, percent), "tested")
    parts = components(tested.filter("linked"))
    member_parts = (members.select("key", "node", "n").join(parts, "node", "left")
                    .withColumn("part", F.coalesce("component", "node")).drop("component"))
    member_parts = stored(member_parts, "parts")
    counts = member_parts.groupBy("key", "part").agg(F.count("*").alias("c"))
    mixed = counts.groupBy("key").agg(F.count("*").alias("parts"), F.max_by(
        "part", F.struct("c", -F.col("part"))).alias("main")).filter("parts > 1").select("key", "main")
    # stored, so that the join by ``main`` reads plain shuffles, whose hot components Spark can split
    hubs = stored(member_parts.select("node", "part").distinct().join(central, "node").groupBy("part").agg(
        F.max_by("node", F.struct("central", -F.col("node"))).alias("hub")), "hubs")
    mixed = stored(mixed, "mixed")
    rest = member_parts.join(mixed, "key").join(hubs.withColumnRenamed("part", "main"), "main")
    rest = stored(rest.select("node", "n", "part", "main", "hub").distinct(), "rest")
    beside = stored(_beside_hubs(rest, sets, _supported(rest, hubs, sets, percent), percent), "beside")
    probed = beside.filter("linked").select(F.col("node").alias("u"), F.col("hub").alias("v")).filter("u <> v")
    known = tested.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    second = _candidates(beside, percent).join(known, ["u", "v"], "left_anti")
    more = stored(_compared(second, sets, percent).filter("linked").select("u", "v").union(probed), "more")
    if more.isEmpty():
        whole = parts
    else:
        whole = components(tested.filter("linked").select("u", "v").union(more))

    return signatures, classes.select("__set", "node", "first_id").join(whole, "node", "left").select(
        "__set", "first_id", F.coalesce("component", "node").alias("component"))


def near_duplicates(docs: DataFrame, *, shingle: int = 2, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row; ids are as in ``docs``.

    Links hold where 100 * |intersection| >= percent * |union|, ``percent`` 80 or more.
    """
    signatures, labelled = _linked(docs, shingle, percent, id_col, text_col)
    smallest = labelled.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = labelled.join(smallest, "component").select("__set", "component_id")
    rows = signatures.select("doc_id", "n_shingles", "__set").join(named, "__set", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


@own_names
def without_near_duplicates(docs: DataFrame, *, shingle: int = 2, percent: int = 80, id_col: str = "doc_id",
                            text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, the one of smallest id; null ids come last.

    Rows are told apart by id and text, so other texts of an id stay; of equal ids the smallest text
    hash decides. Rows with equal id and equal text are one document and stay once, also without
    words: of these the one with the smallest hash over all columns stays.
    """
    signatures, labelled = _linked(docs, shingle, percent, id_col, text_col)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "__id", "__text")
    firsts = signatures.filter("n_shingles > 0").groupBy("__set").agg(F.min(place).alias("first"))
    firsts = labelled.join(firsts, "__set").select("__set", "component", "first")
    smallest = firsts.groupBy("component").agg(F.min("first").alias("first"))
    named = firsts.drop("first").join(smallest, "component").select(
        "__set", F.col("first.__id").alias("__first_id"), F.col("first.__text").alias("__first_text"))
    lost = (F.col("__id") != F.col("__first_id")) | (F.col("__text") != F.col("__first_text"))
    verdicts = (signatures.select("__id", "__text", "__set").join(named, "__set", "left")
                .groupBy("__id", "__text").agg(F.count("*").alias("__n"),
                                               F.max(F.coalesce(lost, F.lit(False))).alias("__lost")))
    odd = stored(verdicts.filter("__lost OR __n > 1"), "verdicts")
    keys = ["__id", "__text"]
    rows = docs.select("*", *identity(id_col, text_col))
    once = rows.join(odd, keys, "left_anti").select(*docs.columns)
    again = (rows.join(odd.filter("NOT __lost"), keys, "left_semi").groupBy(*keys).agg(
        F.min_by(F.struct(*docs.columns), F.struct(F.col(id_col).isNull(), F.xxhash64(*docs.columns))).alias("__row")).select("__row.*"))
    return once.union(again)


def op8_minmax_dedup(spark, sf_dir: str) -> DataFrame:
    """Components of all documents on 2-word shingles at similarity 0.8."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
