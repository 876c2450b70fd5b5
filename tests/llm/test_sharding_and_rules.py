"""Operators 6 and 10 against plain Python."""

import math
import random
import zlib
from collections import Counter, defaultdict

from cases import documents, empty, prose, rows, words
from tributary.llm import hash_tree, line_frequency
from tributary.llm.hash_tree import Leaf


def base(text):
    found, text = words(text), text or ""
    lines = [x for x in text.split("\n") if words(x)]
    windows = Counter(tuple(found[i:i + 8]) for i in range(len(found) - 7))
    covered = {j for i in range(len(found) - 7) if windows[tuple(found[i:i + 8])] > 1 for j in range(i, i + 8)}
    return (len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered), len(found) < 20 or 100 * len(covered) > 30 * len(found))


def test_base_measures(spark):
    got = line_frequency.judged(documents(spark)).collect()
    want = Counter((r[0], *base(r[1])) for r in rows())
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
                    r["n_repeat_words"], r["base_failed"]) for r in got) == want


def normalised(line):
    return "".join("0" if c in "0123456789" else c for c in " ".join(words(line))).lower()


def test_lines_above_the_limit_and_depleted_documents(spark):
    held, docs = defaultdict(set), defaultdict(set)
    for _, text, _, host, *_ in rows():
        for line in (text or "").split("\n"):
            if words(line):
                held[host, normalised(line)].add(text)
                docs[host].add(text)
    common = {k for k, v in held.items() if len(v) > 2 and len(v) > 0.1 * len(docs[k[0]])}
    assert common
    got = line_frequency.judged(documents(spark), max_share=0.1, min_docs=2, max_removed=0.3, remove_lines=True)
    assert set(rows()[0]) is not None and "kept" in got.columns and got.columns.count("kept") == 1
    want = Counter()
    for doc_id, text, _, host, *_ in rows():
        lines = (text or "").split("\n")
        gone = [bool(words(x)) and (host, normalised(x)) in common for x in lines]
        n = sum(len(words(x)) for x, g in zip(lines, gone) if g)
        left = None if text is None else "\n".join(x for x, g in zip(lines, gone) if not g) if any(gone) else text
        want[doc_id, n, not base(text)[-1] and n <= 0.3 * len(words(text)), left] += 1
    assert Counter((r["doc_id"], r["n_common_words"], r["kept"], r["text"]) for r in got.collect()) == want
    assert any(not k[2] and k[1] for k in want)


def test_copies_of_a_text_count_as_one_document(spark):
    text = "\n".join(" ".join(prose(random.Random(i), 9)) for i in range(5))
    copies = spark.createDataFrame([(i, text, "s") for i in range(50)], "doc_id long, text string, source string")
    assert all(r["kept"] for r in line_frequency.judged(copies, min_docs=5).collect())


def test_empty_tables(spark):
    assert line_frequency.judged(empty(spark), remove_lines=True).count() == 0
    assert hash_tree.numbered(hash_tree.placed(empty(spark), hash_tree.regular_topology(24)), 24).count() == 0


def test_shards_slots_and_sizes(spark):
    got = hash_tree.numbered(hash_tree.placed(documents(spark), hash_tree.regular_topology(24)), 24,
                             rows_per_bucket=1).collect()
    slots = defaultdict(list)
    for r in got:
        raw = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 8, zlib.crc32(raw))
        assert r["grown_shard"] in (r["shard"], 24)
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    by_id = defaultdict(set)
    for r in got:
        by_id[r["doc_id"]].add(r["shard"])
    assert all(len(s) == 1 for k, s in by_id.items() if k is not None)


def test_draws_follow_weights_and_changes_stay_in_their_subtree(spark):
    docs = spark.range(40_000).selectExpr("id AS doc_id", "cast(id AS string) AS text")
    tree = [Leaf("a", "a1", 0, 1.0), Leaf("a", "a2", 1, 3.0), Leaf("b", "b1", 2, 2.0), Leaf("b", "b1", 3, 2.0)]
    heavier = [Leaf("a", "a1", 0, 2.0), *tree[1:]]
    old = {r[0]: r["shard"] for r in hash_tree.placed(docs, tree).select("doc_id", "shard").collect()}
    new = {r[0]: r["shard"] for r in hash_tree.placed(docs, heavier).select("doc_id", "shard").collect()}
    for shard, share in enumerate((1 / 8, 3 / 8, 2 / 8, 2 / 8)):
        n = sum(s == shard for s in old.values())
        assert abs(n - 40_000 * share) < 5 * math.sqrt(40_000 * share)
    moved = {(old[k], new[k]) for k in old if old[k] != new[k]}
    # only into region a, and inside it only into rack a1; nothing moves between b's shards
    assert moved and all(b in (0, 1) and (a, b) != (0, 1) for a, b in moved)


def test_slots_follow_ids_at_every_size(spark):
    docs = spark.range(3000).selectExpr("IF(id < 2700, (id * 7919) % 2700 - 900, NULL) AS doc_id", "cast(id AS string) AS text")
    placed = hash_tree.placed(docs.repartition(3), hash_tree.regular_topology(24))
    for per in (10, 100_000):
        slots = defaultdict(list)
        for r in hash_tree.numbered(placed, 24, rows_per_bucket=per).collect():
            slots[r["shard"]].append((r["doc_id"] is None, r["doc_id"] or 0, r["text_crc32"], r["slot"]))
        assert sum(map(len, slots.values())) == 3000
        assert all([x[-1] for x in sorted(s)] == list(range(len(s))) for s in slots.values())
