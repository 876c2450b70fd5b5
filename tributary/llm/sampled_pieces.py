"""SentencePiece encoding by forward filtering and backward sampling, and decoding (operator 9).

A text, with the model's leading space, is cut before each run of spaces; no piece of the model
crosses such a cut, so a text's piece lattice is a chain of small ones. Merge ranks become Zipf
weights 1 / (rank + 2) ** sharpness, normalised; a character without a piece stands for its UTF-8
byte pieces. The forward pass sums the weights of all segmentations up to each place; the backward
pass draws the last piece in proportion, then the one before it, and so on, so each segmentation
comes with exactly its probability. A draw at a place depends only on the row key and the place:
reruns, other batches and other executors give the same pieces. Filtered lattices of repeated
segments are kept in two bounded tables of cumulative 32-bit probabilities: when one is full it
becomes the older one, from which the segments that still occur are copied. A task drops them at
its end, as its worker lives on beside other stages.

Decoding is lossless for every text: a literal U+2581 is encoded as bytes, never as the space sign.
The row key is the id, or the text's hash where the id is null. Null text gives null ids, empty
text none. Repeated rows get equal pieces. Empty tables give empty results. Columns of the input
with the names of result columns are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import thrifty
from .hashing import U64, Powers, mixed

_SEGMENT = re.compile(r" *[^ ]+| +")
_GOLDEN = U64(0x9E3779B97F4A7C15)
#: Entries of one of the two tables of lattices that a worker keeps; 9 bytes each, and their segments.
KEPT = 3_000_000


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Lattices:
    """Filtered lattices of segments, bounded: entries of a place are ordered by piece length, longest first.

    An entry is taken if a draw is at most its limit, the first such one of its place counts.
    """

    def __init__(self) -> None:
        self.segments: dict[str, int] = {}
        self.nodes = self.entries = 0
        # untouched room costs no memory; a batch that needs more doubles it
        self.first = np.zeros(KEPT // 2 + 1, np.int32)
        self.limit, self.ids = np.empty(KEPT, np.uint32), np.empty(KEPT, np.int32)
        self.lengths = np.empty(KEPT, np.int8)

    def add(self, segments: list[str], size: np.ndarray, counts: np.ndarray, limit: np.ndarray, ids: np.ndarray,
            lengths: np.ndarray) -> None:
        """Segments of ``size`` places, ``counts`` entries per place, and the entries in order."""
        while self.entries + len(ids) > len(self.ids):
            self.limit, self.ids, self.lengths = (np.concatenate((x, np.empty_like(x)))
                                                  for x in (self.limit, self.ids, self.lengths))
        while self.nodes + len(counts) >= len(self.first):
            self.first = np.concatenate((self.first, np.empty_like(self.first)))
        own = slice(self.entries, self.entries + len(ids))
        self.limit[own], self.ids[own], self.lengths[own] = limit, ids, lengths
        self.first[self.nodes + 1:self.nodes + 1 + len(counts)] = self.entries + np.cumsum(counts)
        start = self.nodes + np.cumsum(size) - size
        # the place after e characters of a segment is its first node plus e - 1
        self.segments.update(zip(segments, (start << 32 | size).tolist()))
        self.nodes += len(counts)
        self.entries += len(ids)

    def taken_from(self, older: Lattices, segments: list[str]) -> None:
        """Copy segments that another table has."""
        entry = np.array([older.segments[s] for s in segments], np.int64)
        start, size = entry >> 32, entry & 0xFFFFFFFF
        nodes = _ranges(start, size)
        counts = older.first[nodes + 1] - older.first[nodes]
        own = _ranges(older.first[start].astype(np.int64), (older.first[start + size] - older.first[start]).astype(np.int64))
        self.add(segments, size, counts, older.limit[own], older.ids[own], older.lengths[own])


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


class PieceSampler:
    def __init__(self, path: str, sharpness: float = 1.0) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.byte_id = {b: model.piece_to_id(f"<0x{b:02X}>") for b in range(256)}
        special = {i for i in range(size) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)}
        plain = [i for i in range(size) if i not in special]
        weights = [(rank + 2.0) ** -sharpness for rank in range(len(plain))]
        total = sum(weights)
        self.pieces = {model.id_to_piece(i).replace("▁", " "): (i, w / total) for i, w in zip(plain, weights)}
        self.longest = max(map(len, self.pieces))
        self.byte_weight = weights[-1] / total
        self.spelled = [b""] * size
        for piece, (i, _) in self.pieces.items():
            self.spelled[i] = piece.encode()
        for b, i in self.byte_id.items():
            self.spelled[i] = bytes([b])
        self.powers = Powers(0x9E3779B97F4A7C15)
        self.by_length = []
        for n in range(1, self.longest + 1):
            own = [p for p in self.pieces if len(p) == n]
            found = self._hashes(_points("".join(own)), n)[::n] if own else np.empty(0, U64)
            order = np.argsort(found)
            sieve = np.zeros(1 << 16, bool)  # most substrings are no piece, which their top bits tell
            sieve[(found >> U64(48)).astype(np.int64)] = True
            self.by_length.append((found[order], np.array([self.pieces[p][0] for p in own], np.int32)[order],
                                   np.array([self.pieces[p][1] for p in own], float)[order], sieve))
        self.bytes_of = np.array([self.byte_id[b] for b in range(128)], np.int32)
        self.forget()

    def forget(self) -> None:
        """Empty tables; lattices are filtered again when they are needed."""
        self.known, self.older = Lattices(), Lattices()

    def _hashes(self, points: np.ndarray, n: int) -> np.ndarray:
        """Hash of the n characters from each place."""
        up, down = self.powers.reach(len(points) + 1)
        with np.errstate(over="ignore"):
            sums = np.concatenate((np.zeros(1, U64), np.cumsum((points.astype(U64) + U64(1)) * up[:len(points)])))
            return (sums[n:] - sums[:-n]) * down[:len(points) + 1 - n]

    def _hits(self, points: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
        """End, length, weight and id of every piece in the segments, by end, longest first."""
        up, down = self.powers.reach(len(points) + 1)
        found = []
        with np.errstate(over="ignore"):
            sums = np.concatenate((np.zeros(1, U64), np.cumsum((points.astype(U64) + U64(1)) * up[:len(points)])))
            for n, (known, own, w, sieve) in enumerate(self.by_length, 1):
                if not len(known) or len(points) < n:
                    continue
                hashes = (sums[n:] - sums[:-n]) * down[:len(points) + 1 - n]
                may = np.flatnonzero(sieve[(hashes >> U64(48)).astype(np.int64)])
                may = may[place[may + n - 1] >= n - 1]
                at = np.minimum(np.searchsorted(known, hashes[may]), len(known) - 1)
                hit = known[at] == hashes[may]
                at = at[hit]
                found.append((may[hit] + n - 1, np.full(len(at), n), w[at], own[at]))
        single = np.zeros(len(points), bool)
        for end, n, _, _ in found:
            if len(n) and n[0] == 1:
                single[end] = True
        bare = np.flatnonzero(~single)
        code = points[bare].astype(np.int64)
        spelled = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
        found.append((bare, np.ones(len(bare), np.int64), self.byte_weight ** spelled,
                      np.where(code < 128, self.bytes_of[np.minimum(code, 127)], -code).astype(np.int32)))
        end, n, w, ids = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((-n, end))
        return end[order], n[order], w[order], ids[order]

    def _learn(self, segments: list[str]) -> None:
        """Filter segments forward and keep each place's cumulative probabilities.

        All segments advance together, one character a step. The sum up to a place is kept as a
        logarithm, and those of its pieces in proportion to the place before, so long segments do
        not underflow.
        """
        size = np.array([len(s) for s in segments], np.int64)
        points = _points("".join(segments))
        place = np.arange(len(points)) - np.repeat(np.cumsum(size) - size, size)
        end, n, w, ids = self._hits(points, place)
        by_step = np.argsort(place[end], kind="stable")
        stops = np.cumsum(np.bincount(place[end], minlength=int(size.max())))
        log_sum, limit = np.zeros(len(points)), np.empty(len(end), np.uint32)
        for step, (first, last) in enumerate(zip([0, *stops[:-1].tolist()], stops.tolist())):
            own = by_step[first:last]
            at, back = end[own], n[own]
            head = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
            before = np.where(back > step, 0.0, log_sum[at - back])
            latest = log_sum[at - 1] if step else np.zeros(len(at))
            share = w[own] * np.exp(np.minimum(before - latest, 690.0))
            total = np.add.reduceat(share, head)
            pieces = np.diff(np.concatenate((head, [len(at)])))
            run = np.cumsum(share / np.repeat(total, pieces))
            run -= np.repeat(run[head] - (share[head] / total), pieces)
            limit[own] = np.clip(np.ceil(run * 4294967296.0) - 1, 0, 4294967295).astype(np.uint32)
            limit[own[np.concatenate((head[1:], [len(at)])) - 1]] = 4294967295
            log_sum[at[head]] = latest[head] + np.log(total)
        self.known.add(segments, size, np.bincount(end, minlength=len(points)), limit, ids, n)

    def _prepare(self, segments: set[str]) -> None:
        """Have the lattices of all segments in the newer table; the one before it keeps what was used lately."""
        if self.known.entries > KEPT:
            self.older, self.known = self.known, Lattices()
        missing = segments.difference(self.known.segments)
        again = [s for s in missing if s in self.older.segments]
        if again:
            self.known.taken_from(self.older, again)
            missing.difference_update(again)
        new, chars = [], 0
        for s in missing:
            new.append(s)
            chars += len(s)
            if chars > 100_000:
                self._learn(new)
                new, chars = [], 0
        if new:
            self._learn(new)

    def encode(self, texts: list[str], seeds: np.ndarray) -> list[np.ndarray]:
        """Sampled piece ids of each text."""
        cut = [_SEGMENT.findall(" " + t) if t else [] for t in texts]
        segments = [s for parts in cut for s in parts]
        if not segments:
            return [np.empty(0, np.int32) for _ in texts]
        self._prepare(set(segments))
        own = self.known
        entry = np.array(list(map(own.segments.__getitem__, segments)), np.int64)
        start, size = entry >> 32, entry & 0xFFFFFFFF
        counts = np.array([len(p) for p in cut])
        doc = np.repeat(np.arange(len(texts)), counts)
        before = np.cumsum(size) - size
        first = np.zeros(len(texts), np.int64)
        has = counts > 0
        first[has] = before[(np.cumsum(counts) - counts)[has]]
        with np.errstate(over="ignore"):
            seed = seeds.astype(U64)[doc] + (before - first[doc]).astype(U64) * _GOLDEN
        left, active, drawn = size.copy(), np.arange(len(segments)), []
        while len(active):
            at = left[active]
            with np.errstate(over="ignore"):
                draw = (mixed(seed[active] + at.astype(U64) * _GOLDEN) >> U64(32)).astype(np.uint32)
            chosen = own.first[start[active] + at - 1]
            todo = np.flatnonzero(draw > own.limit[chosen])
            while len(todo):
                chosen[todo] += 1
                todo = todo[draw[todo] > own.limit[chosen[todo]]]
            drawn.append((active, own.ids[chosen]))
            at = at - own.lengths[chosen]
            left[active] = at
            active = active[at > 0]
        pieces = np.zeros(len(segments), np.int64)
        for some, _ in drawn:
            pieces[some] += 1
        ends = np.cumsum(pieces)
        out = np.empty(ends[-1], np.int32)
        for step, (some, ids) in enumerate(drawn):
            out[ends[some] - 1 - step] = ids
        stops = np.concatenate(([0], ends))[np.cumsum(counts)]
        split = np.split(out, stops[:-1])
        return [self._with_bytes(x) if len(x) and x.min() < 0 else x for x in split]

    def _with_bytes(self, ids: np.ndarray) -> np.ndarray:
        spelled: list[int] = []
        for i in ids.tolist():
            spelled += [i] if i >= 0 else [self.byte_id[b] for b in chr(-i).encode()]
        return np.array(spelled, np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of piece ids, without the leading space."""
        return b"".join(map(self.spelled.__getitem__, ids.tolist()))[1:].decode("utf-8", "replace")


_samplers: dict[tuple[str, float], PieceSampler] = {}


def sampler(path: str, sharpness: float = 1.0) -> PieceSampler:
    if (path, sharpness) not in _samplers:
        _samplers[path, sharpness] = PieceSampler(path, sharpness)
    return _samplers[path, sharpness]


def encoded(docs: DataFrame, model: str, *, seed: int = 0, sharpness: float = 1.0, id_col: str = "doc_id",
            text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """(doc_id, n_pieces, ids, lossless) of whole texts; ``lossless`` compares the decoded ids.

    ``model`` is a SentencePiece file that every executor can open. ``keep_text`` adds the decoded text.
    """

    @thrifty
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = sampler(model, sharpness)
        try:
            for frame in frames:
                for part in (frame.iloc[at:at + 64] for at in range(0, len(frame), 64)):
                    texts = part["text"].tolist()
                    with np.errstate(over="ignore"):
                        seeds = mixed(part["key"].to_numpy(np.int64).view(U64) + U64(seed) * _GOLDEN)
                    ids = own.encode([t or "" for t in texts], seeds)
                    back = [None if t is None else own.decode(x) for t, x in zip(texts, ids)]
                    out = pd.DataFrame({
                        "doc_id": part["doc_id"].array, "n_pieces": [len(x) for x in ids],
                        "ids": [None if t is None else x for t, x in zip(texts, ids)],
                        "lossless": [t == b for t, b in zip(texts, back)]})
                    if keep_text:
                        out["text"] = back
                    yield out
        finally:
            own.forget()

    key = F.coalesce(F.col(id_col).cast("long"), F.xxhash64(F.col(text_col)))
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), key.alias("key"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, "doc_id string, n_pieces long, ids array<int>, lossless boolean"
                            + ", text string" * keep_text).withColumn("doc_id", F.col("doc_id").cast("long"))


def decoded(rows: DataFrame, model: str, *, ids_col: str = "ids") -> DataFrame:
    """``rows`` with ``text`` spelled by their ids."""

    def spell(ids: pd.Series) -> pd.Series:
        own = sampler(model)
        return pd.Series([None if x is None else own.decode(np.asarray(x)) for x in ids], dtype=object)

    return rows.withColumn("text", F.pandas_udf(spell, "string")(ids_col))


def op9_sampled_pieces(spark, sf_dir: str) -> DataFrame:
    """Sampled piece ids of every document."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encoded(docs, public_tokenizers.path("piece_bpe_32k.model"))
