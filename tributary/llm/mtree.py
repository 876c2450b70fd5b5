"""Exact top-k inner products by best-first search in paged metric-tree nodes (operator 7).

Components are ``floor(256 * x)`` in double precision, scores integer inner products. With M the
largest norm, a candidate x gets the extra coordinate sqrt(M^2 - |x|^2) and a query 0; then
d(q, x)^2 = |q|^2 + M^2 - 2 <q, x>, and the highest scores are the nearest neighbours of a metric.

Build: rows go to the nearest of up to ``fanout`` routing vectors of their group, level by level,
until no group holds more than ``capacity`` rows (routing vectors are the rows of smallest hash in
each of ``fanout`` hash classes; rows at equal distance are dealt by a hash that differs from level
to level, so equal vectors split too, however many there are). Each group becomes one stored node
of pages: routing vector, covering radius, the pages' distances to the node's routing vector and
every entry's distance to its page's.

Upper nodes are stored as well: a node's entries are its children's routing vectors, covering radii and
distances to the node's own routing vector, at most ``fanout`` of them.

Search: each query is searched in its own group first, which gives a score to beat. Blocks of queries from
one subtree then descend level by level. |d(q, parent) - d(parent, child)| and the covering radius rule
children out for each query, on upper nodes alone; a child that no query of the block can use goes no
further, and only the groups that are left ship their vectors. Within a group, pages are visited in
the order of their least possible distance until it passes the k-th best, with the same two bounds on
pages and entries. Bounds have a margin for rounding; scores are exact, ties go to the smaller id.

Rows with a null id, a null vector, or a null or non-finite component take no part; equal rows
count once; shorter vectors are padded with 0. Empty tables give empty results. Scores are computed in
double precision, exact up to 2^53; a squared norm above that raises a ValueError.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

CAPACITY, FANOUT, PAGE, BLOCK, CHUNK = 8192, 64, 128, 512, 16384


def whole_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Distinct (vec_id, v: array<long>) of the rows that take part."""
    good = F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & F.forall(
        vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return table.filter(F.coalesce(good, F.lit(False))).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(vector_col, lambda x: F.floor(x.cast("double") * 256).cast("long")).alias("v")).distinct()


def _matrix(vectors: pd.Series, dim: int) -> np.ndarray:
    out = np.zeros((len(vectors), dim))
    for row, v in zip(out, vectors):
        row[:len(v)] = v
    return out


def _far(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between rows of two matrices."""
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(square, 0))


def _lifted(x: np.ndarray, top: float) -> np.ndarray:
    return np.concatenate((x, np.sqrt(np.maximum(top - (x * x).sum(1), 0))[:, None]), axis=1)


def grouped(rows: DataFrame, dim: int, top: float, capacity: int, fanout: int) -> DataFrame:
    """``rows`` with ``grp``, split by nearest routing vectors until groups fit ``capacity``."""
    if "grp" not in rows.columns:
        rows = rows.withColumn("grp", F.lit(""))
    level = 0
    while True:
        counts = rows.groupBy("grp").agg(F.count("*").alias("n")).filter(F.col("n") > capacity)
        if counts.isEmpty():
            return rows
        level += 1
        draw = F.xxhash64("v", "vec_id", F.lit(level))
        slot, order = F.pmod(F.xxhash64("vec_id", F.lit(level)), F.lit(fanout)), F.xxhash64("v", F.lit(level))
        routing = (rows.join(counts.select("grp"), "grp", "left_semi")
                   .groupBy("grp", slot.alias("slot")).agg(F.min_by("v", F.struct(order, "vec_id")).alias("v"))
                   .groupBy("grp").agg(F.collect_list("v").alias("routing")))

        def assign(part: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
            routes = pd.Series(list(pivots["routing"].iloc[0]))
            far = _far(_lifted(_matrix(part["v"], dim), top), _lifted(_matrix(routes, dim), top))
            near = far <= far.min(axis=1, keepdims=True) + 1e-6
            chosen = part["draw"].to_numpy(np.int64) % near.sum(axis=1)
            pick = (near.cumsum(axis=1) > chosen[:, None]).argmax(axis=1)
            return pd.DataFrame({"vec_id": part["vec_id"], "v": part["v"],
                                 "grp": [f"{grp}/{p}" for grp, p in zip(part["grp"], pick)]})

        # routing vectors go to chunks of a group, once each
        chunks = counts.select("grp", F.floor(F.col("n") / CHUNK + 1).alias("chunks"))
        dealt = rows.join(chunks, "grp").withColumn("chunk", F.pmod(F.xxhash64("vec_id", "v"), "chunks")).withColumn("draw", draw)
        sent = routing.join(chunks, "grp").select(
            F.col("grp").alias("to"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("part"), "routing")
        split = dealt.groupBy("grp", "chunk").cogroup(sent.groupBy("to", "part")).applyInPandas(
            assign, "vec_id long, v array<long>, grp string")
        rows = stored(rows.join(chunks, "grp", "left_anti").select("vec_id", "v", "grp").unionByName(split), "groups")


NODE = "grp string, ids binary, vectors binary, page binary, parent binary, center binary, radius binary, above binary, root binary, cover double, n long"


def nodes(rows: DataFrame, dim: int, top: float) -> DataFrame:
    """One row per group: entries by page, with the distances that the search uses."""

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("vec_id", kind="stable")
        plain = _matrix(frame["v"], dim)
        x = _lifted(plain, top)
        seeds = x[:: max(1, PAGE)]
        nearest = _far(x, seeds).argmin(axis=1)
        order = np.argsort(nearest, kind="stable")
        # a page has at most PAGE entries: equal vectors fill several pages of one routing vector
        run = np.concatenate(([0], np.flatnonzero(np.diff(nearest[order])) + 1, [len(order)]))
        cuts = [c for a, b in zip(run, run[1:]) for c in range(a, b, PAGE)] + [len(order)]
        page = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
        center = seeds[nearest[order][cuts[:-1]]]
        parent = np.sqrt(np.maximum(((x[order] - center[page]) ** 2).sum(1), 0))
        radius = np.maximum.reduceat(parent, cuts[:-1])
        root = x.mean(axis=0)
        above = np.sqrt(((center - root) ** 2).sum(1))
        cover = float(np.sqrt(((x - root) ** 2).sum(1)).max())
        return pd.DataFrame({"grp": [frame["grp"].iloc[0]], "ids": [frame["vec_id"].to_numpy(np.int64)[order].tobytes()],
                             "vectors": [plain[order].tobytes()], "page": [np.asarray(cuts, np.int64).tobytes()],
                             "parent": [parent.tobytes()], "center": [center.tobytes()], "radius": [radius.tobytes()],
                             "above": [above.tobytes()], "root": [root.tobytes()], "cover": [cover], "n": [len(x)]})

    return rows.groupBy("grp").applyInPandas(build, NODE)


UPPER = ("node string, names array<string>, leaf array<boolean>, centers binary, covers binary, above binary, "
         "center binary, cover double, n long")


def upper_nodes(leaves: DataFrame) -> DataFrame | None:
    """The nodes above the groups, made level by level; None for a tree of one group."""
    below = leaves.select(F.col("grp").alias("node"), F.col("root").alias("center"), "cover", "n",
                          F.lit(True).alias("is_leaf"), (F.size(F.split("grp", "/")) - 1).alias("depth"))
    deepest = below.agg(F.max("depth")).first()[0] or 0

    def over(children: pd.DataFrame) -> pd.DataFrame:
        children = children.sort_values("node", kind="stable")
        centers = np.stack([np.frombuffer(c) for c in children["center"]])
        covers, n = children["cover"].to_numpy(float), children["n"].to_numpy(np.int64)
        center = (centers * (n / n.sum())[:, None]).sum(axis=0)
        above = np.sqrt(((centers - center) ** 2).sum(axis=1))
        return pd.DataFrame({"node": [children["parent"].iloc[0]], "names": [children["node"].tolist()],
                             "leaf": [children["is_leaf"].tolist()], "centers": [centers.tobytes()], "covers": [covers.tobytes()],
                             "above": [above.tobytes()], "center": [center.tobytes()],
                             "cover": [float((above + covers).max())], "n": [int(n.sum())]})

    out = made = None
    for depth in range(deepest, 0, -1):
        level = below.filter(F.col("depth") == depth).drop("depth")
        if made is not None:
            level = level.unionByName(made.select("node", "center", "cover", "n", F.lit(False).alias("is_leaf")))
        made = stored(level.withColumn("parent", F.regexp_replace("node", "/[^/]*$", ""))
                      .groupBy("parent").applyInPandas(over, UPPER), "upper")
        out = made if out is None else out.unionByName(made)
    return out


def _reach(square: np.ndarray, top: float, floor: np.ndarray, margin: float) -> np.ndarray:
    """Distances at which scores lie, for queries of squared norm ``square``."""
    with np.errstate(invalid="ignore"):
        return np.where(np.isneginf(floor), np.inf, np.sqrt(np.maximum(square + top - 2 * floor, 0)) + margin)


def _margin(square: np.ndarray, top: float) -> float:
    return 1e-6 * (1 + np.sqrt(top) + np.sqrt(square.max(initial=0)))


def descended(blocked: DataFrame, upper: DataFrame | None, dim: int, top: float) -> DataFrame:
    """(block, grp, alive): the groups that each block must search, with the places of the queries that must."""
    start = blocked.select("block", "node", F.sequence(F.lit(0), F.size("queries") - 1).alias("alive"),
                           F.array().cast("array<double>").alias("far"))
    if upper is None:
        return start.select("block", F.col("node").alias("grp"), "alive")

    def step(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.to_dict("records"):
                alive = np.array(row["alive"], np.int64)
                x = _matrix(pd.Series([row["vs"][i] for i in alive]), dim)
                square = (x * x).sum(axis=1)
                x = np.concatenate((x, np.zeros((len(x), 1))), axis=1)
                margin = _margin(square, top)
                limit = _reach(square, top, np.array(row["floors"], float)[alive], margin)
                far = np.array(row["far"], float)
                if not len(far):
                    far = np.sqrt(((x - np.frombuffer(row["center"])) ** 2).sum(axis=1))
                centers = np.frombuffer(row["centers"]).reshape(-1, dim + 1)
                covers, above = np.frombuffer(row["covers"]), np.frombuffer(row["above"])
                out = []
                for i, name in enumerate(row["names"]):
                    maybe = np.flatnonzero(np.abs(far - above[i]) - covers[i] <= limit + margin)
                    to_child = np.sqrt(((x[maybe] - centers[i]) ** 2).sum(axis=1))
                    hit = to_child - covers[i] <= limit[maybe] + margin
                    if hit.any():
                        out.append((row["block"], name, alive[maybe[hit]].tolist(), to_child[hit].tolist(), bool(row["leaf"][i])))
                yield pd.DataFrame(out, columns=["block", "node", "alive", "far", "leaf"])

    found = None
    front = start
    while True:
        pairs = front.join(blocked.select("block", "vs", "floors"), "block").join(
            upper.select("node", "names", "leaf", "centers", "covers", "above", "center"), "node")
        reached = stored(pairs.mapInPandas(
            step, "block string, node string, alive array<int>, far array<double>, leaf boolean"), "front")
        leaves = reached.filter("leaf").select("block", F.col("node").alias("grp"), "alive")
        found = leaves if found is None else found.unionByName(leaves)
        front = reached.filter("not leaf").drop("leaf")
        if front.isEmpty():
            return found


def _search(node: dict, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int, dim: int,
            top: float) -> Iterator[tuple[int, int, int]]:
    """(query index, vec_id, score) of each query's best k of one node that reach ``floor``."""
    ids, cuts = np.frombuffer(node["ids"], np.int64), np.frombuffer(node["page"], np.int64)
    x = np.frombuffer(node["vectors"]).reshape(-1, dim)
    parent, radius, above = (np.frombuffer(node[c]) for c in ("parent", "radius", "above"))
    center, root = np.frombuffer(node["center"]).reshape(-1, dim + 1), np.frombuffer(node["root"])
    lifted = np.concatenate((queries, np.zeros((len(queries), 1))), axis=1)
    square = (queries * queries).sum(axis=1)
    margin = _margin(square, top)
    to_root = np.sqrt(np.maximum(((lifted - root) ** 2).sum(axis=1), 0))

    def reach(q: int, score: float) -> float:
        """Distance at which a score lies."""
        return np.inf if score == -np.inf else float(np.sqrt(max(square[q] + top - 2 * score, 0))) + margin

    for q in range(len(queries)):
        limit = reach(q, floor[q])
        if to_root[q] - node["cover"] > limit:
            continue
        best: list[tuple[int, int]] = []  # heap of (score, -id), the worst first
        maybe = np.flatnonzero(np.abs(to_root[q] - above) - radius <= limit)
        far = np.sqrt(((center[maybe] - lifted[q]) ** 2).sum(axis=1))
        least = np.maximum(far - radius[maybe], 0)
        for p in np.argsort(least, kind="stable"):
            if least[p] > limit:
                break
            first, last = cuts[maybe[p]], cuts[maybe[p] + 1]
            entries = first + np.flatnonzero(np.abs(far[p] - parent[first:last]) <= limit)
            scores = x[entries] @ queries[q]
            worst = best[0][0] if len(best) == k else floor[q]
            for e in np.flatnonzero(scores >= worst):
                found = (int(scores[e]), -int(ids[entries[e]]))
                if -found[1] == own[q]:
                    continue
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
            if len(best) == k:
                limit = min(limit, reach(q, best[0][0]))
        for score, negative in best:
            yield q, -negative, score


def _searched(pairs: DataFrame, k: int, dim: int, top: float) -> DataFrame:
    """(query, query_id, vec_id, score) of rows that hold a block of queries, those ``alive`` in it, and a node."""

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.to_dict("records"):
                at = np.array(row["alive"], np.int64)
                names, own = np.array(row["queries"])[at], np.array(row["query_ids"])[at]
                asked = _matrix(pd.Series([row["vs"][i] for i in at]), dim)
                hits = list(_search(row, asked, own, np.array(row["floors"], float)[at], k, dim, top))
                at = [h[0] for h in hits]
                yield pd.DataFrame({"query": names[at] if at else [], "query_id": own[at] if at else [],
                                    "vec_id": [h[1] for h in hits], "score": [h[2] for h in hits]})

    return pairs.mapInPandas(search, "query long, query_id long, vec_id long, score long")


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 5, *, id_col: str = "vec_id",
          vector_col: str = "embedding", capacity: int = CAPACITY, fanout: int = FANOUT) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` its best rows of ``candidates``.

    ``queries`` are rows of ``candidates``; a row with the query's own id is no candidate.
    """
    rows = stored(whole_vectors(candidates, id_col, vector_col).withColumn("grp", F.lit("")), "vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    dim, top = rows.agg(F.max(F.size("v")), F.max(norm)).first()
    dim, top = dim or 0, top or 0.0
    if top > 2 ** 53:
        raise ValueError("squared norms above 2^53 have no exact scores in double precision")
    rows = grouped(rows, dim, top, capacity, fanout)
    tree = stored(nodes(rows, dim, top), "nodes")
    asked = whole_vectors(queries, id_col, vector_col).join(rows, ["vec_id", "v"]).withColumn(
        "query", F.xxhash64("vec_id", "v"))

    def blocks(asked: DataFrame, key: Column) -> DataFrame:
        """Queries in blocks of about ``BLOCK`` that share a key; an array each of what the search needs."""
        named = asked.withColumn("key", key)
        sizes = named.groupBy("key").agg(F.floor(F.count("*") / BLOCK + 1).alias("parts"))
        name = F.concat_ws(" ", "key", F.pmod("query", "parts").cast("string"))
        return named.join(sizes, "key").groupBy(name.alias("block")).agg(
            F.min("grp").alias("grp"), F.collect_list(F.struct("query", "vec_id", "v", "floor")).alias("q")).select(
            "block", "grp", *[F.col(f"q.{c}").alias(n) for c, n in (("query", "queries"), ("vec_id", "query_ids"),
                                                                    ("v", "vs"), ("floor", "floors"))])

    asked = stored(asked.withColumn("floor", F.lit(float("-inf"))), "asked")
    everyone = F.sequence(F.lit(0), F.size("queries") - 1)
    at_home = _searched(blocks(asked, F.col("grp")).withColumn("alive", everyone).join(tree, "grp"), k, dim, top)
    floors = (at_home.withColumn("rank", F.row_number().over(
        Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")))
        .filter(F.col("rank") == k).select("query", F.col("score").cast("double").alias("floor")))
    asked = asked.drop("floor").join(floors, "query", "left").withColumn(
        "floor", F.coalesce("floor", F.lit(float("-inf"))))
    # the root's name is stored, as a join on a literal would be planned as a product
    blocked = stored(blocks(asked, F.regexp_replace("grp", "/[^/]*$", "")).drop("grp").withColumn("node", F.lit("")), "asked")
    pairs = descended(blocked, upper_nodes(tree), dim, top)
    found = _searched(pairs.join(blocked.drop("node"), "block").join(tree, "grp"), k, dim, top)
    ranked = found.withColumn("rank", F.row_number().over(
        Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_mtree(spark, sf_dir: str) -> DataFrame:
    """The 5 best candidates of every embedding whose id is divisible by 50."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(table, table.filter("vec_id % 50 = 0"))
