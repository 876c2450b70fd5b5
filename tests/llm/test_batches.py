"""Batches that are awkward throughout, repeated rows, null ids and clashing names."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cases import documents, empty, words
from tributary.llm import line_dedup, minmax_dedup, mixing, token_blocks
from tributary.llm.common import stored


def frame(spark, given, parts=2):
    return spark.createDataFrame([(i, t, "en", s, *[None] * 5) for i, t, s in given], documents(spark).schema).repartition(parts)


def prose(name, n=80):
    return " ".join(f"{name}{k}" for k in range(n))


BLANK = {"empty": [(i, "", "s") for i in range(5)], "blank": [(i, " \n\t", "s") for i in range(300)],
         "null": [(i, None, "s") for i in range(300)],
         "few worded": [(i, "", "s") for i in range(300)] + [(900 + i, prose(f"a{i}"), "s") for i in range(10)],
         "one empty": [(i, prose(f"b{i}_"), "s") for i in range(256)] + [(900, "", "s")],
         "null ids": [(None, prose(f"c{i % 900}_"), f"s{i % 3}") for i in range(2000)],
         "repeated": [(7, prose("d"), "s")] * 2000 + [(8, prose("e"), "s")],
         "one id": [(7, prose(f"f{i}_"), "s") for i in range(1500)]}


@pytest.mark.parametrize("name", BLANK)
def test_stages(spark, name):
    """Every stage on its own, over batches of one kind."""
    given = BLANK[name]
    docs = frame(spark, given, 1)
    for stage, function in corpus_pipeline.STAGES:
        got = function(spark, docs, "").collect()
        if stage == "line_dedup" or name in ("empty", "blank", "null") and stage == "near_dedup":
            kept = Counter((r["doc_id"], r["text"]) for r in got)
            want = Counter((i, t) for i, t, _ in given)
            assert set(kept) == set(want)
        if stage == "near_dedup" and name in ("null ids", "one id", "repeated"):
            assert Counter(r["text"] for r in got) == Counter({t for _, t, _ in given})


def test_near_duplicate_classes_of_null_ids(spark):
    given = [(None, prose(f"c{i % 40}_"), "s") for i in range(800)] + [(5, prose("c3_") + " more", "s")]
    got = minmax_dedup.near_duplicates(frame(spark, given)).collect()
    assert len(got) == 801
    assert Counter((r["doc_id"], r["component_id"]) for r in got) == Counter({(None, None): 780, (None, 5): 20, (5, 5): 1})


def test_copies_under_the_threshold_make_few_pairs(spark, monkeypatch):
    """Copies of one text that are less than 0.8 alike: a pivot of each band and few pairs beside hubs."""
    counts = {}
    base = [f"w{k}" for k in range(200)]
    compared = minmax_dedup._compared

    def seen(pairs, sets, percent):
        pairs = stored(pairs.select("u", "v"), "compared")
        counts.setdefault("compared", []).append(pairs.count())
        return compared(pairs, sets, percent)

    monkeypatch.setattr(minmax_dedup, "_compared", seen)
    for n in (100, 200):
        counts.clear()
        draw = np.random.default_rng(3)
        given = []
        for i in range(n):
            edited = list(base)
            for k in draw.choice(200, 12, replace=False):
                edited[k] = f"x{i}_{k}"
            given.append((i, " ".join(edited), "s"))
        sets = [{tuple(t.split()[k:k + 2]) for k in range(199)} for _, t, _ in given]
        got = minmax_dedup.near_duplicates(frame(spark, given))
        label = list(range(n))
        for a in range(n):
            for b in range(a):
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and label[a] != label[b]:
                    old, new = max(label[a], label[b]), min(label[a], label[b])
                    label = [new if x == old else x for x in label]
        assert {r["doc_id"]: r["component_id"] for r in got.collect()} == dict(enumerate(label))
        pivots, beside = counts["compared"]
        assert pivots <= minmax_dedup.BANDS * n and beside <= n


def test_mix_of_one_text_in_two_sources(spark):
    given = [(i, prose("a", 100), s) for i in range(4) for s in ("a", "b")]
    docs = frame(spark, given)
    got = mixing.mixed_documents(docs, block_words=10)
    taken = Counter()
    for r in got.collect():
        taken[r["source"]] += len(words(r["text"]))
    assert {k: round(v) for k, v in taken.items()} == {"a": 267, "b": 533}
    again = mixing.mixed_documents(docs.repartition(5), block_words=10)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, again.collect()))


def test_mix_of_many_equal_rows(spark):
    given = [(1, "one two three", "a")] * 1300 + [(i, prose(f"p{i}_", 50), "b") for i in range(10, 40)]
    rows = mixing.laid_out(frame(spark, given))
    spans = sorted((r["__s"], r["__start"], r["size"]) for r in rows.collect())
    for a, b in zip(spans, spans[1:]):
        assert b[1] == (a[1] + a[2] if a[0] == b[0] else 0)
    assert len(spans) == len(given)


def test_mixing_query(spark, tmp_path):
    documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    got = mixing.op4_mixing(spark, str(tmp_path))
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken", "source"]
    rows = got.collect()
    given = documents(spark).collect()
    assert Counter((r["doc_id"], r["size"], r["source"]) for r in rows) == Counter(
        (r["doc_id"], len(words(r["text"])), r["source"]) for r in given)
    size = Counter()
    for r in given:
        size[r["source"]] += len(words(r["text"]))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    target, free = {}, set(order)
    while free:
        level = (sum(size.values()) - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * size[s]}
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        target |= {s: 3 * size[s] for s in over}
        free -= over
    taken = Counter()
    for r in rows:
        taken[r["source"]] += r["taken"]
        assert r["source_size"] == size[r["source"]] and r["taken"] <= 3 * r["size"]
        assert r["target"] == pytest.approx(target[r["source"]], abs=1e-6)
    assert all(abs(taken[s] - target[s]) <= 0.5 + 1e-6 for s in order)
    assert Counter(map(tuple, mixing.op4_mixing(spark, str(tmp_path)).collect())) == Counter(map(tuple, rows))


def test_multinomial_draws_in_groups_of_shards(spark, monkeypatch):
    targets = spark.createDataFrame([(0, 64_000, 64_000.0), (1, 900, 2700.0)], "__s int, source_size long, target double")
    monkeypatch.setattr(mixing, "SHARDS_AT_ONCE", 7)
    slots = mixing.dealt_slots(targets, block_words=10, slots_per_shard=100).collect()
    assert Counter(r["__s"] for r in slots) == {0: 6400, 1: 270}
    assert sum(r["words"] for r in slots) == 66_700 and len({r["shard"] for r in slots}) == 67


def test_checksums_are_those_of_the_ids(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    docs = documents(spark)
    token_blocks.write_tokens(docs, path, f"{tmp_path}/tokens")
    got = token_blocks.document_checks(spark, f"{tmp_path}/tokens").collect()

    def check(text):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        return len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())

    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter(
        (r["doc_id"], *check(r["text"])) for r in docs.collect())
    start = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == start
        start += r["n_tokens"]


def test_words_that_hold_the_parting_sign():
    import public_tokenizers

    encoder = token_blocks.WordEncoder(public_tokenizers.path("word_bpe_49k.json"), kept=50)
    texts = ["a | b", "||x|| y", "full ｜ width", "｜x", "c\u0000d | \u0001", "plain words here"] + [
        f"many{k} words|{k} of{k % 7} | one" for k in range(300)]
    got = [ids for at in range(0, len(texts), 40) for ids in encoder.encode(texts[at:at + 40])]
    assert [x.astype("<u4").tobytes() for x in got] == encoder._batch(texts)


def test_clashing_names(spark):
    docs = documents(spark).withColumns({"__id": F.lit("x"), "__text": F.col("doc_id"), "__starts": F.lit(1),
                                         "__n": F.lit(2.5), "__row": F.lit(None).cast("int"), "size": F.lit("z")})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, "")
        assert got.dtypes == docs.dtypes, name
        rows = got.collect()
        assert rows and all(r["__id"] == "x" and r["__text"] == r["doc_id"] and r["__n"] == 2.5 and r["size"] == "z"
                            for r in rows)
    assert corpus_pipeline.encoding(spark, docs, "").count() == docs.count()
    assert line_dedup.without_repeated_runs(empty(spark)).count() == 0
