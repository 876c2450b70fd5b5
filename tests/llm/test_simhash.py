"""Operator 11 against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from cases import documents, empty, rows
from tributary.llm import bit_sliced_simhash as simhash


def brute_fingerprint(text, n=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = min(n, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + n]), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(docs, radius=3):
    """(doc_id, fingerprint, component) of (doc_id, fingerprint)."""
    fps = sorted({f for _, f in docs})
    label = {f: f for f in fps}
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if (a ^ b).bit_count() <= radius and label[b] < label[a]:
                    label[a], changed = label[b], True
    ids = {}
    for i, f in docs:
        if i is not None:
            ids[label[f]] = min(ids.get(label[f], i), i)
    return Counter((i, f, ids.get(label[f])) for i, f in docs)


def test_fingerprints():
    texts = [r[1] for r in rows()] + ["É à É", "A  b\tC\x0bd\u00a0e", "x" * 100_000, " ".join(f"w{i}" for i in range(9000))]
    assert [simhash.fingerprint(t) for t in texts] == [brute_fingerprint(t) for t in texts]
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


def fingerprints(seed, clusters, size, flips):
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(200)]
    for _ in range(clusters):
        center = rng.getrandbits(64)
        for _ in range(size):
            out.append(center ^ sum(1 << b for b in set(rng.choices(range(64), k=rng.randrange(flips + 1)))))
    return out


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_near_pairs(radius):
    a = fingerprints(1, 6, 40, 6)
    b = a[150:] + [a[0] ^ (2 ** 64 - 1)]
    want = {(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if (x ^ y).bit_count() <= radius}
    own, other = simhash.near_pairs(np.array(a, np.uint64), np.array(b, np.uint64), radius)
    assert set(zip(own.tolist(), other.tolist())) == want and len(own) == len(want)
    assert not len(simhash.near_pairs(np.empty(0, np.uint64), np.array(b, np.uint64))[0])


@pytest.mark.parametrize("capacity, depth", [(1024, 4), (16, 4), (8, 1), (4, 2)])
def test_links_of_crowded_buckets(spark, capacity, depth):
    fps = sorted(set(fingerprints(2, 4, 90, 5)))
    nodes = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long").repartition(3)
    found = simhash.links(nodes, capacity=capacity, depth=depth).collect()
    label = {f: f for f in fps}

    def top(f):
        while label[f] != f:
            f = label[f]
        return f

    for u, v in found:
        a, b = sorted((top(u % 2 ** 64), top(v % 2 ** 64)))
        label[b] = a
    want = brute_components([(i, f) for i, f in enumerate(fps)])
    first = {f: i for i, f in enumerate(fps)}
    got = Counter((first[f], f, min(first[g] for g in fps if top(g) == top(f))) for f in fps)
    assert got == want


def test_components(spark):
    near = [(600 + k, " ".join([f"c{i}" for i in range(300)][:300 - k]), *[None] * 7) for k in range(12)]
    given = rows() + near + [(None, None, *[None] * 7), (None, "one", *[None] * 7), (2 ** 53 + 1, "big id", *[None] * 7)]
    docs = spark.createDataFrame(given, documents(spark).schema).repartition(3)
    got = Counter((r["doc_id"], r["fp"] % 2 ** 64, r["component_id"]) for r in simhash.simhash_components(docs).collect())
    want = brute_components([(r[0], brute_fingerprint(r[1])) for r in given])
    assert got == want and len({c for _, _, c in want}) < len(want) - 12


def test_many_equal_rows(spark):
    given = [(None, "a text that repeats", *[None] * 7)] * 1500 + [(7, "", *[None] * 7)] * 1200
    docs = spark.createDataFrame(given, documents(spark).schema).repartition(3)
    got = Counter(map(tuple, simhash.simhash_components(docs).collect()))
    assert sorted(got.values()) == [1200, 1500] and (7, 0, 7) in got


def test_nothing(spark, tmp_path):
    assert simhash.simhash_components(empty(spark)).count() == 0
    documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    got = simhash.op11_bit_sliced_simhash(spark, str(tmp_path))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    want = brute_components([(r[0], brute_fingerprint(r[1])) for r in rows()])
    assert Counter(map(tuple, got.collect())) == Counter({(i, f"{f:016x}", c): n for (i, f, c), n in want.items()})
