"""Product codes of vectors by Lloyd rounds over dual trees (operator 12).

Components are ``floor(scale * x)``; a vector is cut into ``parts`` equal consecutive parts, each
position with a codebook of its own. Entries start as the parts of the vectors with the smallest
ids. A round gives every part its nearest entry (squared distance, ties to the lower index) and
moves each entry to the floor of its parts' mean; entries without parts stay.

Points: each task cuts its rows into chunks and builds, per part position, a balanced tree of boxes
with cached sums and counts. The trees are written once and read by every round. Entries: a small
tree of boxes per position, rebuilt each round. Both trees are walked together from their roots:

1. an entry node goes where its least distance to the point node passes the greatest distance of
   another entry node that is still there;
2. single entries go by the same bounds and by the difference of their distances to the entry next
   to the node's middle, which is linear over a box and has its maximum in a corner;
3. a node with one entry left is assigned whole, by its cached sum and count;
4. leaves with several entries left compute integer distances of their points to those entries.

All arithmetic is on 64-bit integers, so bounds and ties are exact; a table whose squared distances
would not fit raises a ValueError. Only sums of (part, entry, position) reach the driver.

Rows whose vector is null or holds null or non-finite components are dropped. Null ids stay, as the
last ones; equal ids are ordered by vector; repeated rows count each. Shorter vectors, and lengths
that ``parts`` does not divide, are filled up with 0. With fewer rows than ``entries``, codebooks
have one entry per row. Null labels are one label. An empty table gives an empty result; columns
of the input beside id, vector and label are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, table

CHUNK, LEAF = 2048, 32
FAR = np.iinfo(np.int64).max


# ---- trees ----

@dataclass
class Boxes:
    """Levels of a balanced tree, root first: ``lo``, ``hi`` and ``sums`` per node, bounds of places."""

    lo: list[np.ndarray]
    hi: list[np.ndarray]
    sums: list[np.ndarray]
    bounds: list[np.ndarray]


def _depth(n: int, leaf: int) -> int:
    return max(0, (n // leaf).bit_length() - 1)


def _bounds(n: int, level: int) -> np.ndarray:
    """Places where the nodes of a level begin, and the end; halves meet at the same places."""
    return n * np.arange(2 ** level + 1) // 2 ** level


def tree_order(x: np.ndarray, leaf: int) -> np.ndarray:
    """Order of the points in which each node is a run: nodes are halved along their widest side."""
    order = np.arange(len(x))
    for level in range(_depth(len(x), leaf)):
        at, bounds = x[order], _bounds(len(x), level)
        side = (np.maximum.reduceat(at, bounds[:-1]) - np.minimum.reduceat(at, bounds[:-1])).argmax(axis=1)
        node = np.repeat(np.arange(len(side)), np.diff(bounds))
        order = order[np.lexsort((at[np.arange(len(x)), side[node]], node))]
    return order


def boxes(x: np.ndarray, leaf: int) -> Boxes:
    """Boxes and sums of points that are in tree order."""
    depth = _depth(len(x), leaf)
    first = _bounds(len(x), depth)[:-1]
    levels = [(np.minimum.reduceat(x, first), np.maximum.reduceat(x, first), np.add.reduceat(x, first))]
    for _ in range(depth):
        lo, hi, sums = levels[0]
        levels.insert(0, (np.minimum(lo[::2], lo[1::2]), np.maximum(hi[::2], hi[1::2]), sums[::2] + sums[1::2]))
    return Boxes(*map(list, zip(*levels)), [_bounds(len(x), level) for level in range(depth + 1)])


@dataclass
class Entries:
    """One codebook and its tree; ``members`` tells which entries a tree node holds."""

    points: np.ndarray
    tree: Boxes
    members: list[np.ndarray]

    @classmethod
    def of(cls, points: np.ndarray) -> Entries:
        order = tree_order(points, 1)
        tree = boxes(points[order], 1)
        members = []
        for bounds in tree.bounds:
            own = np.zeros((len(bounds) - 1, len(points)), bool)
            own[np.repeat(np.arange(len(own)), np.diff(bounds)), order] = True
            members.append(own)
        return cls(points, tree, members)


# ---- walking both trees ----

def _least(lo: np.ndarray, hi: np.ndarray, other_lo: np.ndarray, other_hi: np.ndarray) -> np.ndarray:
    gap = np.maximum(np.maximum(other_lo[None] - hi[:, None], lo[:, None] - other_hi[None]), 0)
    return (gap * gap).sum(axis=2)


def _most(lo: np.ndarray, hi: np.ndarray, other_lo: np.ndarray, other_hi: np.ndarray) -> np.ndarray:
    span = np.maximum(other_hi[None] - lo[:, None], hi[:, None] - other_lo[None])
    return (span * span).sum(axis=2)


def pruned(lo: np.ndarray, hi: np.ndarray, alive: np.ndarray, entries: Entries) -> np.ndarray:
    """Which entries can be nearest to some point of each box; ``alive`` are those not yet ruled out."""
    tree, e = entries.tree, entries.points
    for own_lo, own_hi, members in zip(tree.lo, tree.hi, entries.members):
        present = (alive[:, None, :] & members[None]).any(axis=2)
        bound = np.where(present, _most(lo, hi, own_lo, own_hi), FAR).min(axis=1)
        gone = present & (_least(lo, hi, own_lo, own_hi) > bound[:, None])
        alive = alive & ~(gone[:, :, None] & members[None]).any(axis=1)
    rows, index = np.arange(len(alive)), np.arange(len(e))
    most = np.where(alive, _most(lo, hi, e, e), FAR)
    best = most.argmin(axis=1)
    least, bound = _least(lo, hi, e, e), most[rows, best][:, None]
    alive = alive & ((least < bound) | ((least == bound) & (index <= best[:, None])))
    # of the entry next to the middle and another: the greatest difference of their distances
    middle = np.where(alive, _least(lo + hi, lo + hi, 2 * e, 2 * e), FAR).argmin(axis=1)
    step = e[None] - e[middle][:, None]
    corner = np.where(step > 0, hi[:, None], lo[:, None])
    norm = (e * e).sum(axis=1)
    worst = norm[middle][:, None] - norm[None] + 2 * (corner * step).sum(axis=2)
    keeps = (worst > 0) | ((worst == 0) & (index < middle[:, None])) | (index == middle[:, None])
    return alive & keeps


def assigned(x: np.ndarray, tree: Boxes, entries: Entries) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest entry of each point, and sums and counts of each entry's points."""
    k = len(entries.points)
    code, totals, counts = np.zeros(len(x), np.int64), np.zeros_like(entries.points), np.zeros(k, np.int64)
    nodes, alive = np.zeros(1, np.int64), np.ones((1, k), bool)
    for level, bounds in enumerate(tree.bounds):
        alive = pruned(tree.lo[level][nodes], tree.hi[level][nodes], alive, entries)
        sure = alive.sum(axis=1) == 1
        own, entry = nodes[sure], alive[sure].argmax(axis=1)
        np.add.at(totals, entry, tree.sums[level][own])
        np.add.at(counts, entry, bounds[own + 1] - bounds[own])
        for node, e in zip(own.tolist(), entry.tolist()):
            code[bounds[node]:bounds[node + 1]] = e
        nodes, alive = nodes[~sure], alive[~sure]
        if not len(nodes):
            return code, totals, counts
        if level + 1 < len(tree.bounds):
            nodes, alive = (2 * nodes[:, None] + np.arange(2)).reshape(-1), np.repeat(alive, 2, axis=0)
    size = bounds[nodes + 1] - bounds[nodes]
    place = np.repeat(bounds[nodes] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    apart = x[place][:, None] - entries.points[None]
    entry = np.where(np.repeat(alive, size, axis=0), (apart * apart).sum(axis=2), FAR).argmin(axis=1)
    code[place] = entry
    np.add.at(totals, entry, x[place])
    np.add.at(counts, entry, 1)
    return code, totals, counts


# ---- Spark ----

def whole_vectors(rows: DataFrame, scale: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, v: array<long>, top) of the rows that are kept."""
    x = F.transform(vector_col, lambda c: c.cast("double"))
    good = F.col(vector_col).isNotNull() & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = rows.filter(F.coalesce(good, F.lit(False)))
    return kept.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                       F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"),
                       F.array_max(F.transform(x, lambda c: F.abs(c) * scale)).alias("top"))


TREES = "ids binary, no_ids binary, labels array<string>, orders binary, points binary, lo binary, hi binary, sums binary"


def trees(rows: DataFrame, parts: int, width: int, chunk: int = CHUNK, leaf: int = LEAF) -> DataFrame:
    """One row per chunk: ids, labels, and for each part position the points in tree order and the boxes."""

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part in (frame.iloc[at:at + chunk] for at in range(0, len(frame), chunk)):
                whole = np.zeros((len(part), parts * width), np.int64)
                for row, v in zip(whole, part["v"]):
                    row[:len(v)] = v
                out: dict[str, list[bytes]] = {k: [] for k in ("orders", "points", "lo", "hi", "sums")}
                for p in range(parts):
                    x = whole[:, p * width:(p + 1) * width]
                    order = tree_order(x, leaf)
                    own = boxes(x[order], leaf)
                    out["orders"].append(order.astype(np.int32).tobytes())
                    out["points"].append(x[order].tobytes())
                    for name in ("lo", "hi", "sums"):
                        out[name].append(np.concatenate(getattr(own, name)).tobytes())
                yield pd.DataFrame({"ids": [part["vec_id"].to_numpy(np.int64).tobytes()],
                                    "no_ids": [part["no_id"].to_numpy(bool).tobytes()],
                                    "labels": [part["label"].tolist()], **{k: [b"".join(v)] for k, v in out.items()}})

    return rows.select(F.coalesce("vec_id", F.lit(0)).alias("vec_id"), F.col("vec_id").isNull().alias("no_id"),
                       "label", "v").mapInPandas(build, TREES)


def _read(row: dict, parts: int, width: int, leaf: int) -> Iterator[tuple[np.ndarray, np.ndarray, Boxes]]:
    """Order, points and boxes of each part position of a chunk."""
    n = len(row["no_ids"])
    orders = np.frombuffer(row["orders"], np.int32).reshape(parts, n)
    points = np.frombuffer(row["points"], np.int64).reshape(parts, n, width)
    bounds = [_bounds(n, level) for level in range(_depth(n, leaf) + 1)]
    ends = np.cumsum([len(b) - 1 for b in bounds])[:-1]
    lo, hi, sums = (np.frombuffer(row[k], np.int64).reshape(parts, -1, width) for k in ("lo", "hi", "sums"))
    for p in range(parts):
        yield orders[p], points[p], Boxes(*(np.split(x[p], ends) for x in (lo, hi, sums)), bounds)


def moved(chunks: DataFrame, books: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The codebooks after one round; each task sends its sums of (part, entry, position)."""
    parts, k, width = books.shape

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals, counts = np.zeros(books.shape, np.int64), np.zeros((parts, k), np.int64)
        known = [Entries.of(book) for book in books]
        for frame in frames:
            for row in frame.to_dict("records"):
                for p, (_, x, tree) in enumerate(_read(row, parts, width, leaf)):
                    _, own, n = assigned(x, tree, known[p])
                    totals[p] += own
                    counts[p] += n
        part, entry, place = (a.reshape(-1) for a in np.indices(books.shape))
        yield pd.DataFrame({"part": part, "entry": entry, "place": place, "total": totals.reshape(-1),
                            "n": np.repeat(counts.reshape(-1), width)})

    sums = (chunks.mapInPandas(add, "part int, entry int, place int, total long, n long")
            .groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")))
    out = books.copy()
    for part, entry, place, total, n in sums.filter("n > 0").collect():  # parts * entries * width rows
        out[part, entry, place] = total // n
    return out


def coded(chunks: DataFrame, books: np.ndarray, leaf: int = LEAF) -> DataFrame:
    """(vec_id, label, code, error) of every row."""
    parts, _, width = books.shape

    def code(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = [Entries.of(book) for book in books]
        for frame in frames:
            for row in frame.to_dict("records"):
                ids, missing = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["no_ids"], bool)
                codes, error = np.zeros((len(ids), parts), np.uint8), np.zeros(len(ids), np.int64)
                for p, (order, x, tree) in enumerate(_read(row, parts, width, leaf)):
                    own = assigned(x, tree, known[p])[0]
                    apart = x - books[p][own]
                    codes[order, p] = own
                    error[order] += (apart * apart).sum(axis=1)
                yield pd.DataFrame({"vec_id": pd.arrays.IntegerArray(ids.copy(), missing.copy()),
                                    "label": np.asarray(row["labels"], object),
                                    "code": [c.tobytes().hex() for c in codes], "error": error})

    return chunks.mapInPandas(code, "vec_id long, label string, code string, error long")


def product_codes(vectors: DataFrame, *, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096,
                  id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                  chunk: int = CHUNK, leaf: int = LEAF) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of every kept row, and the codebooks (part, entry, position)."""
    if entries > 256:
        raise ValueError("an index has two hex digits")
    rows = stored(whole_vectors(vectors, scale, id_col, vector_col, label_col), "vectors")
    longest, top = rows.agg(F.max(F.size("v")), F.max("top")).first()
    width = -(-(longest or 0) // parts)
    if (top or 0) + 1 >= 2.0 ** 29 / (parts * width + 1) ** 0.5:  # 16 * components * top ** 2 stays under 2 ** 62
        raise ValueError("squared distances do not fit 64-bit integers")
    seeds = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    books = np.zeros((parts, len(seeds), width), np.int64)
    for k, (v,) in enumerate(seeds):
        books[:, k] = np.pad(v, (0, parts * width - len(v))).reshape(parts, width)
    if not books.size:  # no rows, or vectors without components
        codes = rows.select("vec_id", "label", F.lit("00" * parts).alias("code"), F.lit(0).cast("long").alias("error"))
        return codes, books
    chunks = stored(trees(rows, parts, width, chunk, leaf), "trees")
    for _ in range(rounds):
        books = moved(chunks, books, leaf)
    return coded(chunks, books, leaf), books


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def op12_dual_tree_codes(spark, sf_dir: str) -> DataFrame:
    """Code and error of every embedding, with the error of its label and the codebooks' digest."""
    codes, books = product_codes(table(spark, sf_dir, "embeddings"))
    codes = stored(codes, "codes")
    by_label = codes.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error"))
    return codes.join(by_label, F.col("label").eqNullSafe(F.col("__label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
