"""Operator 12 against brute force, and its SQL."""

import math
import random

import duckdb
import numpy as np
import pytest

from tributary.llm import dual_tree_codes as codes
from tributary.llm.oracles import ORACLES

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error string, v int"


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    """[(vec_id, label, code, error)] and the codebooks of (vec_id, vector, label) in order of ids."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, [math.floor(scale * x) for x in r[1]]))
    width = -(-max((len(r[1]) for r in kept), default=0) // parts)
    x = [[math.floor(scale * c) for c in r[1]] + [0] * (parts * width - len(r[1])) for r in kept]
    x = [[v[p * width:(p + 1) * width] for p in range(parts)] for v in x]
    books = [[list(x[i][p]) for i in range(min(entries, len(x)))] for p in range(parts)]

    def nearest(part, p):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        found = [[nearest(v[p], p)[1] for p in range(parts)] for v in x]
        for p in range(parts):
            for k in range(len(books[p])):
                own = [v[p] for v, f in zip(x, found) if f[p] == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    out = []
    for r, v in zip(kept, x):
        best = [nearest(v[p], p) for p in range(parts)]
        out.append((r[0], r[2], "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best)))
    return out, books


def vectors(n, dim, seed, spread=1.0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, spread) for _ in range(dim)], i % 3 if i % 4 else None) for i in range(n)]


def awkward():
    rows = vectors(150, 16, 1)
    rows += [(None, rows[3][1], 7), (None, rows[4][1], None), (5, rows[5][1], 2), (5, rows[9][1], 2)]
    rows += [(200, None, 1), (201, [None] * 16, 1), (202, [math.nan] * 16, 1), (203, [math.inf] + [0.0] * 15, 1),
             (204, [0.5, -0.5], 1), (205, [], 1)]
    rows += [(300 + i, rows[0][1], 1) for i in range(90)]  # ties and a large group of equal vectors
    rows += [(400 + i, [(i % 5) / 4096] * 16, None) for i in range(40)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", "e", 1) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("rows, entries", [(awkward(), 16), (awkward(), 5), (vectors(9, 16, 2), 16), (vectors(300, 8, 3), 3),
                                           (vectors(200, 11, 4, 0.001), 16), (vectors(1, 8, 5), 16)])
def test_codes(spark, rows, entries):
    want, books = brute(rows, entries=entries)
    got, own = codes.product_codes(frame(spark, rows), entries=entries, chunk=64, leaf=4)
    assert own.tolist() == books
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        ((i, None if label is None else str(label), c, e) for i, label, c, e in want), key=repr)


def test_nothing(spark):
    got, books = codes.product_codes(frame(spark, []))
    assert got.count() == 0 and books.size == 0
    got, _ = codes.product_codes(frame(spark, [(1, None, 2), (2, [math.nan], 3)]))
    assert got.count() == 0
    got, _ = codes.product_codes(frame(spark, [(1, [], 2), (None, [], 3)]))
    assert [r["error"] for r in got.collect()] == [0, 0]


def test_components_beyond_64_bits(spark):
    with pytest.raises(ValueError):
        codes.product_codes(frame(spark, [(1, [1e300] * 8, 1), (2, [0.0] * 8, 1)]))
    got, _ = codes.product_codes(frame(spark, [(1, [3e4] * 8, 1), (2, [-3e4] * 8, 1)]))
    assert sorted(r["error"] for r in got.collect()) == [0, 0]


def test_nodes_are_assigned_by_bounds():
    """Far clusters are settled by cached sums: no point is compared on its own."""
    draw = np.random.default_rng(1)
    centers = draw.integers(-10 ** 6, 10 ** 6, (16, 8))
    x = np.repeat(centers, 64, axis=0) + draw.integers(-50, 50, (1024, 8))
    x = x[codes.tree_order(x, 32)]
    tree, entries = codes.boxes(x, 32), codes.Entries.of(centers)
    alive = codes.pruned(tree.lo[-1], tree.hi[-1], np.ones((len(tree.lo[-1]), 16), bool), entries)
    assert alive.sum(axis=1).mean() < 2
    code, totals, counts = codes.assigned(x, tree, entries)
    apart = ((x[:, None] - centers[None]) ** 2).sum(axis=2)
    assert (code == apart.argmin(axis=1)).all() and counts.tolist() == np.bincount(code, minlength=16).tolist()
    assert (totals == np.array([x[code == k].sum(axis=0) for k in range(16)])).all()


def test_query_and_sql(spark, tmp_path):
    rows = vectors(120, 16, 8) + [(500, None, 1), (501, [0.25] * 16, None), (502, [math.nan] * 16, None)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(
        f"{tmp_path}/embeddings.parquet")
    got = codes.op12_dual_tree_codes(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = con.execute(ORACLES["op12_dual_tree_codes"]).fetchall()
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) == 121
