"""Operators 3, 5 and 7: held-out accuracy, spans, and exact neighbours."""

import math
import random
import re
import zlib

import numpy as np
import pytest

from cases import documents, empty, prose
from tributary.llm import labelled, mtree, passage_quality, toxicity


def corpus(spark, n=400):
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(n):
        sentences = [" ".join(prose(rng, 9)) for _ in range(rng.randrange(1, 9))]
        toxic = i % 4 == 0
        if toxic:
            sentences[rng.randrange(len(sentences))] += " Idiot"
        if i % 3 == 0:
            sentences = [" ".join(f"{w}***" for w in s.split()) for s in sentences]
        docs.append((i, ". ".join(sentences) + "."))
        labels.append((i, int(i % 3 != 0), int(toxic)))
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (passage_quality, "quality")])
def test_held_out_accuracy(spark, module, label):
    docs, labels = corpus(spark)
    model = module.trained(docs, labels)
    scored = {r["doc_id"]: r["score"] for r in module.scored(docs, model).collect()}
    truth = {r["doc_id"]: r[label] for r in labels.collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(scored) == len(truth) and all(0 <= s <= 1 for s in scored.values())
    assert sum((scored[i] >= 0.5) == truth[i] for i in held) >= 0.97 * len(held)


def test_held_out_labels_are_never_learnt(spark):
    docs, labels = corpus(spark)
    sample = labelled.training_sample(docs, labels.unionByName(labels.limit(9)), "toxic", 10_000)
    held = docs.filter(labelled.held_out()).count()
    assert 0 < held and sample.count() == docs.count() - held
    assert labelled.training_sample(docs, labels, "toxic", 30).count() == 30


def test_offending_sentences(spark):
    docs, labels = corpus(spark)
    model = toxicity.trained(docs, labels)
    got = toxicity.offending_sentences(docs.filter("doc_id < 40"), model).collect()
    assert {r["doc_id"] for r in got} == {i for i in range(0, 40, 4)}
    assert all("idiot" in r["text"].lower() for r in got)


@pytest.mark.parametrize("module", [toxicity, passage_quality])
def test_awkward_documents_and_labels(spark, module):
    docs, labels = corpus(spark, 60)
    label = "toxic" if module is toxicity else "quality"
    model = module.trained(docs, labels)
    got = module.scored(documents(spark), model).collect()
    assert len(got) == documents(spark).count() and all(0 <= r["score"] <= 1 for r in got)
    assert module.scored(empty(spark), model).count() == 0
    alike = module.trained(docs, labels.filter(f"{label} = 1"))
    assert all(0 <= r["score"] <= 1 for r in module.scored(documents(spark), alike).collect())
    module.trained(empty(spark), labels)


def test_attention_gradients():
    rng = np.random.default_rng(0)
    x, bag, y = rng.normal(size=(9, passage_quality.FEATURES)), np.array([0, 0, 0, 1, 2, 2, 2, 2, 3]), np.array([1., 0, 1, 0])
    model = passage_quality.Model(np.zeros(passage_quality.FEATURES), np.ones(passage_quality.FEATURES))

    def loss():
        p = model.forward(x, bag, 4)["y"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    grads = model.gradients(model.forward(x, bag, 4), bag, y)
    for name, value in model.p.items():
        at = tuple(rng.integers(0, n) for n in value.shape)
        keep = value[at]
        value[at] = keep + 1e-5
        up = loss()
        value[at] = keep - 1e-5
        down = loss()
        value[at] = keep
        assert abs((up - down) / 2e-5 - grads[name][at]) < 1e-6


def vectors(seed=3, n=700):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 0.2, (n, 8)) + rng.integers(0, 3, (n, 1))
    out = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    out += [(1000 + i, out[0][1]) for i in range(120)]  # one very common vector
    out += [(2000, None), (2050, []), (2001, [1.0, None]), (2002, [float("nan")]), (2003, [float("inf")]),
            (None, [1.0]), (2100, [1.0, 2.0]), out[5], out[50]]
    return out


def brute(rows, k=5):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            good[i] = [int(np.floor(np.float64(np.float32(x)) * 256)) for x in v]
    out = set()
    for q, a in good.items():
        if q % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good.items() if i != q)
            out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)}
    return out


@pytest.mark.parametrize("capacity, fanout", [(8192, 64), (60, 4)])
def test_top_k_is_exact(spark, monkeypatch, capacity, fanout):
    monkeypatch.setattr(mtree, "PAGE", 16)
    frame = spark.createDataFrame(vectors(), "vec_id long, embedding array<float>").repartition(3)
    got = mtree.top_k(frame, frame.filter("vec_id % 50 = 0"), capacity=capacity, fanout=fanout).collect()
    assert {tuple(r) for r in got} == brute(vectors()) and len(got) == len(set(map(tuple, got)))


def test_top_k_of_few_rows(spark):
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in mtree.top_k(few, few.filter("vec_id = 0")).collect()] == [(0, 1, 1, 131072)]
    none = few.filter("false")
    assert mtree.top_k(none, none).count() == 0


def test_more_equal_vectors_than_one_level_splits(spark, monkeypatch):
    rounds = []
    store = mtree.stored

    def counted(df, label):
        rounds.append(label)
        assert rounds.count("groups") < 25, "groups of equal vectors do not get smaller"
        return store(df, label)

    monkeypatch.setattr(mtree, "stored", counted)
    copies = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(120)], "vec_id long, embedding array<float>")
    rows = mtree.whole_vectors(copies, "vec_id", "embedding")
    groups = mtree.grouped(rows, 2, 5.0 * 256 ** 2, 8, 2).groupBy("grp").count().collect()
    assert sum(r["count"] for r in groups) == 120 and max(r["count"] for r in groups) <= 8
    got = mtree.top_k(copies, copies.filter("vec_id % 50 = 0"), capacity=8, fanout=2).collect()
    assert {tuple(r) for r in got} == brute([(i, [1.0, 2.0]) for i in range(120)])


def test_descent_leaves_out_most_pairs(spark, monkeypatch):
    """Clustered vectors: blocks meet few of the groups, and no neighbour is lost."""
    rng = np.random.default_rng(8)
    hubs = rng.normal(0, 1, (12, 6))
    hubs /= np.linalg.norm(hubs, axis=1)[:, None]
    rows = [(i, [float(v) for v in hubs[i % 12] * 4 + rng.normal(0, 0.02, 6)]) for i in range(1800)]
    monkeypatch.setattr(mtree, "PAGE", 8)
    seen, real = [], mtree.descended

    def counted(blocked, upper, dim, top):
        pairs = real(blocked, upper, dim, top)
        seen.extend((blocked.count(), r["grp"], len(r["alive"])) for r in pairs.collect())
        groups = {x for r in upper.collect() for x, leaf in zip(r["names"], r["leaf"]) if leaf}
        seen.append(len(groups))
        return pairs

    monkeypatch.setattr(mtree, "descended", counted)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = mtree.top_k(frame, frame.filter("vec_id % 50 = 0"), capacity=40, fanout=4).collect()
    assert {tuple(r) for r in got} == brute(rows)
    groups = seen.pop()
    blocks = seen[0][0]
    assert groups > 40 and len(seen) < 0.5 * blocks * groups
    assert sum(n for *_, n in seen) < 0.25 * 36 * groups


def test_huge_components_are_refused(spark):
    frame = spark.createDataFrame([(0, [1e9]), (1, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError):
        mtree.top_k(frame, frame)


def test_noisy_or_of_a_small_table(spark):
    """Scores and worst sentences against a plain product over sentences."""
    docs, labels = corpus(spark, 80)
    model = toxicity.trained(docs, labels)
    assert model.weights

    def plain(text):
        sentences = [re.findall(rb"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", s) for s in
                     re.split(rb"[.!?\n]", (text or "").lower().encode())]
        chances = []
        for words in filter(None, sentences):
            z = model.bias
            for w in set(words):
                z += model.weights.get(w, 0) + sum(model.weights.get(w[:n] + b"*", 0) for n in range(4, 9) if len(w) > n)
            chances.append(1 / (1 + math.exp(-z)))
        clean = math.prod(1 - p for p in chances)
        return (1 - clean, chances.index(max(chances)), max(chances)) if chances else (0.0, None, None)

    rows = docs.unionByName(spark.createDataFrame([(None, "Idiot! fine."), (900, None), (901, ""), (902, " .!\n? ")], docs.schema))
    texts = {r["doc_id"]: r["text"] for r in rows.collect()}
    got = toxicity.scored(rows, model).collect()
    assert len(got) == len(texts) == 84
    for r in got:
        score, place, chance = plain(texts[r["doc_id"]])
        assert abs(r["score"] - score) < 1e-9 and (r["worst_sentence"] is None) == (place is None)
        if place is not None:
            assert abs(r["worst_probability"] - chance) < 1e-9 and r["worst_sentence"] == place
