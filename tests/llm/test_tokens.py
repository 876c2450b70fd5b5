"""Operators 1, 4 and 9: round trips and exact amounts."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from cases import documents, empty, rows, words
from tributary.llm import mixing, sampled_pieces, token_blocks
from tributary.session import scratch_path

public_tokenizers = pytest.importorskip("public_tokenizers")
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2 ** 32 - 1)), max_size=1200),
       st.sampled_from([0.5, 0.9, 1.0]))
def test_blocks_round_trip(ids, percentile):
    ids = np.array(ids, np.uint32)
    starts, data = token_blocks.pack(ids, percentile)
    assert token_blocks.unpack(starts, data, len(ids)).tolist() == ids.tolist()
    for k in range(len(starts) - 1):
        own = token_blocks.unpack(starts, data, len(ids), k, k + 1)[:256]
        assert own.tolist() == ids[256 * k:256 * (k + 1)].tolist()


def test_outliers_do_not_widen_a_block():
    ids = np.full(256, 1000, np.uint32) + np.arange(256, dtype=np.uint32) % 8
    ids[5] = 2 ** 31
    starts, data = token_blocks.pack(ids)
    low, width, exceptions = token_blocks.BLOCK_HEAD.unpack_from(data)
    assert (low, width, exceptions) == (1000, 3, 1) and len(data) == 7 + 96 + 5


def test_words_give_the_ids_of_whole_texts():
    from tokenizers import Tokenizer
    texts = [r[1] or "" for r in rows()] + [
        "Don't 'S <|endoftext|>x ab<|startoftext|> 12,a1!", "A b c\x1cd\x85e", "é ́x İI ΑΣ Σ",
        "we'll THEY'VE it''s ***a*** \x00\x07.", "J\u030c I\u0307x ﬁ K, É! Ab.,c AB's A1. (B) x<|endoftext|>, Q.",
        "<|ENDOFTEXT|> Abc, abc' abc'd. \x1f!\x1c? ab\x85cd \u00a0x"]
    for path, by_word in ((WORDS, True), (BYTES, False)):
        own = token_blocks.WordEncoder(path, kept=50)
        assert own.by_word is by_word
        whole = Tokenizer.from_file(path)
        for at in range(0, len(texts), 7):
            got = [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts[at:at + 7])]
            assert got == [whole.encode(t, add_special_tokens=False).ids for t in texts[at:at + 7]]


def test_written_tokens_come_back(spark):
    from tokenizers import Tokenizer
    path = scratch_path(spark, "tokens")
    token_blocks.write_tokens(documents(spark), WORDS, path)
    whole = Tokenizer.from_file(WORDS)
    want, start = Counter(), 0
    for doc_id, text, *_ in sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0)):
        n = len(whole.encode(text or "", add_special_tokens=False).ids) + 1
        want[doc_id, n] += 1
        start += n
    got = sorted(token_blocks.read_documents(spark, path).collect(), key=lambda r: r["start"])
    assert Counter((r["doc_id"], r["n_tokens"]) for r in got) == want
    ends = [r["start"] + r["n_tokens"] for r in got]
    assert [r["start"] for r in got] == [0, *ends[:-1]] and ends[-1] == start
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert ids == sorted(ids) and all(r["ids"][-4:] == b"\x01\0\0\0" for r in got)
    assert token_blocks.document_checks(spark, path).count() == len(got)


def test_tokens_of_an_empty_table(spark):
    path = scratch_path(spark, "tokens")
    token_blocks.write_tokens(empty(spark), WORDS, path)
    assert token_blocks.document_checks(spark, path).count() == 0


# ---- mixing ----------------------------------------------------------------------------------

def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: float(i % 3 + 1) for i, s in enumerate(names)}
    total, target = float(sum(sizes.values())), dict.fromkeys(names, 0.0)
    free = set(names)
    left = total
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * sizes[s]}
        for s in over or free:
            target[s] = 3.0 * sizes[s] if over else level * weight[s]
        left -= sum(target[s] for s in over)
        if not over:
            break
        free -= over
    return target


@pytest.mark.parametrize("skew", [False, True])
def test_mix(spark, skew):
    docs = rows()
    if skew:
        docs = [r if r[3] != "s3" else (*r[:3], "s1", *r[4:]) for r in docs] + [
            (900, "tiny source", None, "z", *[None] * 5), (901, "", None, "without words", *[None] * 5)]
    frame = spark.createDataFrame(docs, documents(spark).schema).repartition(3)
    sizes = Counter()
    for r in docs:
        sizes[r[3]] += len(words(r[1]))
    target = brute_targets(sizes)

    def taken():
        laid = mixing.laid_out(frame)
        pieces = mixing.taken_pieces(laid, block_words=16, slots_per_shard=8)
        return laid, pieces.groupBy("__s", "__start", "size").sum("to", "from").collect()

    laid, first = taken()
    mix = {(r["__s"], r["__start"], r["size"]): r["sum(to)"] - r["sum(from)"] for r in first}
    got = Counter()
    for r in laid.collect():
        n = mix.get((r["__s"], r["__start"], r["size"]), 0) if r["size"] else 0
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - target[r["source"]]) < 1e-6
        assert 0 <= n <= 3 * r["size"]
        got[r["source"]] += n
    assert all(abs(got[s] - target[s]) <= 0.5 for s in target)
    assert sorted(map(tuple, taken()[1])) == sorted(map(tuple, first))


def test_permutation_is_one_to_one():
    for n in (1, 2, 5, 64, 1000, 4097):
        whole = mixing.permuted(np.arange(n), n, 12345)
        assert sorted(whole.tolist()) == list(range(n))
        assert n < 100 or whole.tolist() != list(range(n))
        assert mixing.permuted(np.arange(n)[n // 2:], n, 12345).tolist() == whole[n // 2:].tolist()


def test_shards_get_multinomial_counts(spark):
    targets = spark.createDataFrame([(0, 64_000, 64_000.0), (1, 64_000, 128_000.0)],
                                    "__s int, source_size long, target double")
    slots = mixing.dealt_slots(targets, block_words=16, slots_per_shard=1000).collect()
    assert Counter(r["__s"] for r in slots) == {0: 4000, 1: 8000}
    per_shard = Counter((r["shard"], r["__s"]) for r in slots)
    assert all(abs(n - (1 + s) * 4000 / 13) < 6 * ((1 + s) * 4000 / 13) ** 0.5 for (_, s), n in per_shard.items())
    takes = Counter((r["__s"], r["block"]) for r in slots)
    assert set(takes.values()) == {1, 2} and all(n == s + 1 for (s, _), n in takes.items())


def test_mixed_documents(spark):
    frame = documents(spark)
    got = mixing.mixed_documents(frame, block_words=16).collect()
    assert mixing.mixed_documents(empty(spark)).count() == 0
    assert got and set(got[0].asDict()) == set(frame.columns)
    known = defaultdict(list)
    for r in rows():
        known[r[0]].append(words(r[1]))
    amount = Counter()
    for r in got:
        own = words(r["text"])
        amount[r["source"]] += len(own)
        assert own and any(not Counter(own) - Counter(w) for w in known[r["doc_id"]])
    sizes = Counter()
    for r in rows():
        sizes[r[3]] += len(words(r[1]))
    assert all(abs(amount[s] - t) <= 0.5 for s, t in brute_targets(sizes).items())


# ---- sampled pieces --------------------------------------------------------------------------

def test_pieces_decode_to_the_text(spark):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    frame = documents(spark)
    got = sampled_pieces.encoded(frame, PIECES, keep_text=True).collect()
    assert all(r["lossless"] for r in got)
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter((r[0], r[1]) for r in rows())
    for r in got:
        if r["text"] and "▁" not in r["text"]:
            assert model.decode(list(r["ids"])) == r["text"]
        assert r["n_pieces"] == len(r["ids"] or [])
    assert [r["ids"] for r in got if r["text"] is None] == [None]
    again = sampled_pieces.encoded(frame.repartition(7), PIECES).collect()
    assert Counter((r["doc_id"], str(r["ids"])) for r in again) == Counter((r["doc_id"], str(r["ids"])) for r in got)
    other = sampled_pieces.encoded(frame, PIECES, seed=1).collect()
    assert Counter(str(r["ids"]) for r in other) != Counter(str(r["ids"]) for r in got)
    back = sampled_pieces.decoded(spark.createDataFrame([(r["doc_id"], r["ids"]) for r in got],
                                                        "doc_id long, ids array<int>"), PIECES)
    assert Counter(r["text"] for r in back.collect()) == Counter(r[1] for r in rows())
    assert sampled_pieces.encoded(empty(spark), PIECES).count() == 0


def test_kept_lattices_do_not_change_the_draws(monkeypatch):
    texts = [r[1] or "" for r in rows()]
    seeds = np.arange(len(texts), dtype=np.uint64) * np.uint64(7919)
    whole = sampled_pieces.PieceSampler(PIECES).encode(texts, seeds)
    monkeypatch.setattr(sampled_pieces, "KEPT", 10)
    small = sampled_pieces.PieceSampler(PIECES)
    assert all((small.encode([t], seeds[i:i + 1])[0] == whole[i]).all() for i, t in enumerate(texts))


def test_a_task_leaves_no_lattices_in_its_worker(spark):
    def tables(frames):
        import pandas as pd

        own = sampled_pieces.sampler(PIECES)
        for frame in frames:
            yield pd.DataFrame({"n": [len(own.known.segments) + len(own.older.segments)] * len(frame)})

    assert sampled_pieces.encoded(documents(spark).coalesce(1), PIECES).filter("n_pieces > 0").collect()
    assert {r["n"] for r in spark.range(64).repartition(8).mapInPandas(tables, "n long").collect()} == {0}


def test_cut_texts_give_memory_back_at_the_end_of_a_task(monkeypatch):
    import ctypes
    from types import SimpleNamespace

    import pandas as pd

    from tributary.llm import line_dedup

    trimmed = []
    monkeypatch.setattr(ctypes, "CDLL", lambda name: SimpleNamespace(malloc_trim=trimmed.append))
    spans = [[{"from": 0, "to": 1}], [{"from": 1, "to": 2}, {"from": 0, "to": 1}]]
    batch = (pd.Series(["a b", "c  d"]), pd.Series([2, 3]), pd.Series(spans))
    assert [list(x) for x in mixing._cut(iter([batch, batch]))] == [["a", "c  d"]] * 2
    assert trimmed == [0]
    lines = (pd.Series(["a\n\nb", "c", None]), pd.Series([[1], [0], None]), pd.Series([[2], [1], None]))
    assert [list(x) for x in line_dedup._without(iter([lines]))] == [["a\n", None, None]]
    assert trimmed == [0, 0]


def test_draws_follow_the_lattice():
    """Each segmentation of a short word comes as often as its weight says."""
    own = sampled_pieces.PieceSampler(PIECES)

    def paths(text):
        if not text:
            return {(): 1.0}
        out = {}
        for n in range(1, len(text) + 1):
            if text[:n] in own.pieces:
                i, w = own.pieces[text[:n]]
                out |= {(i, *rest): w * x for rest, x in paths(text[n:]).items()}
        return out

    weights = paths(" the")
    total, n = sum(weights.values()), 40_000
    got = Counter(tuple(x.tolist()) for x in own.encode(["the"] * n, np.arange(n, dtype=np.uint64)
                                                        * np.uint64(0x9E3779B97F4A7C15)))
    assert set(got) <= set(weights)
    for path, w in weights.items():
        p = w / total
        assert abs(got[path] - n * p) < 6 * (n * p * (1 - p)) ** 0.5 + 1
