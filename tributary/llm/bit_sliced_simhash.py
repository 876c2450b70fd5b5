"""SimHash near-duplicate components by bit-sliced comparison (operator 11).

A text's fingerprint has 64 bits; a bit is 1 if it is set in over half of the XXH64 hashes (seed 42)
of its shingles of ``shingle`` words, repeats included (A-Z lower-cased, words split at ASCII white
space and joined by one space; a shorter text is one shingle, a text without words has fingerprint
zero). Fingerprints link at ``radius`` or fewer differing bits; rows with equal fingerprints are one
node.

Pairs meet in buckets: the bits are cut into ``radius`` + 1 blocks, so two linked fingerprints agree
on one block whole and share the bucket of its leading bits. As many of these are used as keep
buckets small at the number of fingerprints. A bucket of more than ``CAPACITY`` fingerprints is dealt
again by the same rule on the bits that were not used yet, and after ``DEPTH`` rounds it is cut into
chunks of which every two meet in a task of their own. So no task holds more than ``CAPACITY``
fingerprints at once, and no link is missed.

Inside a bucket, bit planes are stored vertically: word w of plane b has bit b of 64 fingerprints.
Against one fingerprint a plane's differing bits are the plane, inverted where that fingerprint has
a 1. Carry-save adders add four planes at a time into bitwise counters of ones and twos and a
flag for four and more, so 64 distances advance in some twenty operations. Words in which every
counter is over the radius are abandoned after each eight planes. Of the links of a bucket only a spanning
forest leaves the task, so a large group of copies costs one link per fingerprint.

Null and empty texts have fingerprint zero and are linked like any other. Null ids come last: a
component's id is its smallest, null only if it has no other. Repeated rows share their component.
Empty tables give empty results; columns beside id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, table
from .components import components

U64 = np.uint64
#: Fingerprints that one task compares at once, and the mean size of a bucket of evenly spread ones.
CAPACITY, MEAN = 1024, 128
#: Rounds of dealing, and leading bits of a block that a later round uses.
DEPTH, NARROW = 4, 8
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


# ---- fingerprints ----

def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit fingerprint of a whole text."""
    import xxhash

    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    n = min(shingle, len(words))
    count = len(words) - n + 1
    digest, set_bits = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, count, 4096):
        spans = zip(starts[at:min(at + 4096, count)].tolist(), ends[at + n - 1:min(at + 4096, count) + n - 1].tolist())
        hashes = np.array([digest(joined[a:b - 1], 42) for a, b in spans], ">u8")
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > count).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, fp: the fingerprint as a signed long) of every row."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = np.array([fingerprint(t, shingle) for t in frame["text"]], U64)
            yield pd.DataFrame({"doc_id": frame["doc_id"].array, "fp": found.view(np.int64)})

    # ids travel as text, as a column of numbers with nulls would lose digits
    return docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(
        read, "doc_id string, fp long").withColumn("doc_id", F.col("doc_id").cast("long"))


# ---- bit-sliced comparison ----

def bit_planes(fps: np.ndarray) -> np.ndarray:
    """planes[b, w]: bit b of fingerprints 64 w to 64 w + 63."""
    room = np.zeros(-(-len(fps) // 64) * 64, U64)
    room[:len(fps)] = fps
    bits = (room[None] >> np.arange(64, dtype=U64)[:, None]).astype(np.uint8) & 1
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").astype(U64)


def _carry_save(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and carry of three planes of bits."""
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def near_pairs(fps: np.ndarray, others: np.ndarray, radius: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of all pairs of ``fps`` and ``others`` with at most ``radius`` (0 to 3) differing bits."""
    if not len(fps) or not len(others):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    planes = bit_planes(others)
    full = U64(2 ** 64 - 1)
    row, word = (x.reshape(-1) for x in np.indices((len(fps), planes.shape[1])))
    ones, twos, over = (np.zeros(len(row), U64) for _ in range(3))
    for at in range(0, 64, 4):
        if at and at % 8 == 0:
            left = np.flatnonzero(over != full)
            if len(left) < 0.8 * len(row):
                row, word, ones, twos, over = (x[left] for x in (row, word, ones, twos, over))
            if not len(row):
                break
        apart = []
        for b in range(at, at + 4):
            flips = np.where((fps >> U64(b)) & U64(1), full, U64(0))
            apart.append(planes[b][word] ^ flips[row])
        ones, first = _carry_save(ones, apart[0], apart[1])
        ones, second = _carry_save(ones, apart[2], apart[3])
        twos, fours = _carry_save(twos, first, second)
        over = over | fours
    more = (ones | twos, twos, ones & twos, U64(0))[radius]  # counters over the radius
    near = ~(over | more)
    return _unsliced(row, word, near, len(others))


def _unsliced(row: np.ndarray, word: np.ndarray, near: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    some = np.flatnonzero(near)
    bits = np.unpackbits(near[some].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, bit = np.nonzero(bits)
    own, other = row[some][at], word[some][at] * 64 + bit
    return own[other < n], other[other < n]


def forest(fps: np.ndarray, radius: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Links between distinct fingerprints that join the same ones as all pairs within the radius do."""
    own, other = near_pairs(fps, fps, radius)
    label = np.arange(len(fps))
    while True:
        step = label.copy()
        np.minimum.at(step, own, label[other])
        step = step[step]
        if (step == label).all():
            break
        label = step
    linked = np.flatnonzero(label != np.arange(len(fps)))
    return fps[linked], fps[label[linked]]


# ---- buckets ----

def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def dealt(rows: DataFrame, width: int, radius: int) -> DataFrame:
    """Each of ``rows`` (fp, key, used) once per block of the bits that are not in ``used``.

    The new key hashes the old one, the block and its first ``width`` bits, which then count as used.
    A collision only puts two buckets together.
    """

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for mask, part in frame.groupby("used"):
                fp, key = (part[c].to_numpy(np.int64).view(U64) for c in ("fp", "key"))
                free = [b for b in range(64) if not int(mask) >> b & 1]
                for number, block in enumerate(np.array_split(free, radius + 1)):
                    lead = U64(sum(1 << b for b in block[:width].tolist()))
                    with np.errstate(over="ignore"):
                        own = _mixed(_mixed(key + U64(number + 1)) ^ (fp & lead))
                    used = np.array([int(mask) % 2 ** 64], U64) | lead
                    yield pd.DataFrame({"fp": part["fp"], "key": own.view(np.int64), "used": used.view(np.int64)[0]})

    return rows.mapInPandas(deal, "fp long, key long, used long")


def links(nodes: DataFrame, radius: int = 3, capacity: int = CAPACITY, depth: int = DEPTH) -> DataFrame:
    """(u, v): links that connect what all pairs of ``nodes`` (fp) within the radius connect."""
    width = max(1, min(64 // (radius + 1), (nodes.count() // MEAN).bit_length()))
    rows = nodes.select("fp", F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("used"))
    found, level = [], 0
    while True:
        rows, level = stored(dealt(rows, width if level == 0 else NARROW, radius), "buckets"), level + 1
        crowded = stored(rows.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > capacity), "crowded")
        if crowded.isEmpty():
            found.append(rows.select("fp", "key"))
            break
        found.append(rows.join(crowded, "key", "left_anti").select("fp", "key"))
        if level == depth:
            found.append(_chunk_pairs(rows.join(crowded, "key"), capacity))
            break
        rows = rows.join(crowded, "key", "left_semi").select("fp", "key", "used")
    buckets = found[0]
    for more in found[1:]:
        buckets = buckets.union(more)

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        u, v = forest(frame["fp"].to_numpy(np.int64).view(U64), radius)
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    return stored(buckets.groupBy("key").applyInPandas(compare, "u long, v long").distinct(), "links")


def _chunk_pairs(rows: DataFrame, capacity: int) -> DataFrame:
    """Buckets (fp, key, n) as buckets of two chunks each, so that every two chunks meet."""
    chunks: Column = F.ceil(4 * F.col("n") / capacity)
    own = F.pmod(F.xxhash64("fp"), chunks)
    return (rows.select("fp", "key", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("other"))
            .select("fp", F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key")))


def simhash_components(docs: DataFrame, *, shingle: int = 3, radius: int = 3, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) of every row; component_id is the smallest id reachable."""
    rows = stored(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    labels = components(links(nodes, radius))
    labelled = nodes.join(labels, nodes["fp"] == labels["node"], "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component"))
    smallest = labelled.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = labelled.join(smallest, "component").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def op11_bit_sliced_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
