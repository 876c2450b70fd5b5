"""Operators 2 and 8 against brute force."""

from collections import Counter, defaultdict

import numpy as np
import pytest

from cases import documents, empty, rows
from tributary.llm import components, line_dedup, minmax_dedup
from tributary.llm.hashing import word_hashes

WHITE = b" \t\n\x0b\x0c\r"


def brute_runs(docs, min_words):
    """Rows (id, text) -> text without lines of runs that occurred before, None if none is left."""
    unique = sorted({(r[0] is not None, r[0], r[1]) for r in docs if r[1] is not None}, key=lambda r: (r[0], r[1] or 0))
    seen, out = {}, {}
    sequences = []
    for _, doc_id, text in unique:
        lines = text.encode().split(b"\n")
        at = [i for i, x in enumerate(lines) if x.strip(WHITE)]
        bare = [lines[i].strip(WHITE) for i in at]
        sequences.append((doc_id, text, lines, at, bare))
    for doc_id, text, lines, at, bare in sequences:
        cut = set()
        for s in range(len(bare)):
            n = 0
            for e in range(s, len(bare)):
                n += len(bare[e].split())
                if n >= min_words:
                    key = tuple(bare[s:e + 1])
                    if seen.setdefault(key, (doc_id, text, s)) != (doc_id, text, s):
                        cut |= set(range(s, e + 1))
        gone = {at[i] for i in cut}
        out[doc_id, text] = None if at and len(gone) == len(at) else (
            b"\n".join(x for i, x in enumerate(lines) if i not in gone).decode())
    return out


@pytest.mark.parametrize("min_words", [1, 25, 50])
def test_line_runs(spark, min_words):
    # ids must decide the order, so rows without one are left to the test below
    docs = [r for r in rows() if r[0] is not None]
    want = brute_runs(docs, min_words)
    got = line_dedup.without_repeated_runs(spark.createDataFrame(docs, documents(spark).schema).repartition(3),
                                           min_words=min_words)
    assert got.columns == documents(spark).columns
    expected = Counter()
    for r in docs:
        left = None if r[1] is None else want[r[0], r[1]]
        if r[1] is None or left is not None:
            expected[r[0], left] += 1
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == expected


def test_line_runs_without_ids_and_rows(spark):
    assert line_dedup.without_repeated_runs(empty(spark)).count() == 0
    got = line_dedup.without_repeated_runs(documents(spark), min_words=2).collect()
    assert {r["text"] for r in got if r["doc_id"] is None} == {"one", "no id here"}
    assert any(r["doc_id"] == 0 and r["text"] is None for r in got)
    assert any(r["doc_id"] == 1 and r["text"] == "" for r in got)


def test_texts_are_cut_once(spark):
    """A filter on the cut text must not make Spark cut the texts a second time."""
    docs = spark.createDataFrame([(1, "a b\nc"), (2, "a b\nc"), (3, "d")], "doc_id long, text string")
    got = line_dedup.without_repeated_runs(docs, min_words=2)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert {(r["doc_id"], r["text"]) for r in got.collect()} == {(1, "a b\nc"), (3, "d")}


def test_suffix_ranks_are_in_order(spark):
    docs = spark.createDataFrame([(1, "a\nb\na\nb\na"), (2, "b\na\nb")], "doc_id long, text string")
    lines = line_dedup.line_sequences(docs, 1, "doc_id", "text")
    names = {(r["__id"], r["at"]): (r["h1"], r["h2"]) for r in lines.collect()}
    for k, level in enumerate(line_dedup.suffix_ranks(lines, 2)):
        found = {(r["__id"], r["at"]): r["rank"] for r in level.collect()}
        prefix = {p: [names[p[0], p[1] + j] for j in range(2 ** k)] for p in found}
        assert found and all((found[p] < found[q]) == (prefix[p] < prefix[q]) for p in found for q in found)


def sets(text, n):
    found = (text or "").encode().lower().split()
    n = min(n, len(found))
    return frozenset(tuple(found[i:i + n]) for i in range(len(found) - n + 1)) if found else frozenset()


def brute_components(docs, n):
    nodes = [(r[0], sets(r[1], n)) for r in docs]
    label = list(range(len(nodes)))
    changed = True
    while changed:
        changed = False
        for i, (_, a) in enumerate(nodes):
            for j, (_, b) in enumerate(nodes):
                if a and b and 100 * len(a & b) >= 80 * len(a | b) and label[j] < label[i]:
                    label[i], changed = label[j], True
    smallest = defaultdict(list)
    for i, (doc_id, s) in enumerate(nodes):
        smallest[label[i]].append(doc_id)
    out = Counter()
    for i, (doc_id, s) in enumerate(nodes):
        ids = [x for x in smallest[label[i]] if x is not None]
        component = (min(ids) if ids else None) if s else doc_id
        out[doc_id, len(s), component, doc_id == component] += 1
    return out


@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates(spark, n):
    docs = rows() + [(500 + k, " ".join(f"c{i}" for i in range(k, k + 40)), *[None] * 7) for k in range(0, 30, 2)]
    got = minmax_dedup.near_duplicates(spark.createDataFrame(docs, documents(spark).schema).repartition(3), shingle=n)
    assert Counter(map(tuple, got.collect())) == brute_components(docs, n)


def test_near_duplicates_of_nothing(spark):
    assert minmax_dedup.near_duplicates(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        minmax_dedup.near_duplicates(empty(spark), percent=70)


def test_word_hashes_match_words():
    text = "Ab ab\tÉcole école\x0bAB  x" + "y" * 5000
    starts, ends, hashes = word_hashes(text)
    raw = text.encode()
    assert [raw[a:b] for a, b in zip(starts, ends)] == raw.split()
    same = [w.lower() for w in raw.split()]
    assert [[a == b for b in same] for a in same] == (hashes[:, None] == hashes[None, :]).tolist()


def test_signature_estimates_similarity():
    with np.errstate(over="ignore"):
        draw = np.random.default_rng(1).integers(0, 2 ** 63, 1500).astype(np.uint64)
        a, b = (minmax_dedup.min_max_signature(np.sort(x)) for x in (draw[:1000], draw[100:1100]))
    assert abs((a == b).mean() - 900 / 1100) < 0.1


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (1, 0)]
    got = dict(map(tuple, components.components(spark.createDataFrame(links, "u long, v long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}


def test_chance_to_miss_a_small_pair():
    def miss(common, whole):  # both ends of a random order agree when they fall on shared shingles
        return (1 - (common * (common - 1) / (whole * (whole - 1))) ** 3) ** 48

    assert max((miss(4 * n, 5 * n), 5 * n) for n in range(1, 200)) == (miss(4, 5), 5)
    text = " ".join(minmax_dedup.__doc__.split())
    assert f"{miss(4, 5):.1e}".replace("e-0", "e-") in text and f"{miss(8, 10):.1e}".replace("e-0", "e-") in text
