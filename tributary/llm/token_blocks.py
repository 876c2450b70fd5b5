"""Token ids in patched frame-of-reference blocks (operator 1).

A table of segments is the file format: rows (shard, segment, ids of the shard before it, n_ids,
payload), shards in ascending document order, written by Spark's own writer, so that a lost executor leaves no half file. A
payload is little-endian and self-contained:

    "PFR1"  u32 documents  u32 blocks  u64 ids
    i64 document id, u8 id present, u32 ids      (three arrays, one entry per document)
    u32 byte offset of each block's start, and of the end
    blocks of 256 ids (the last one may be shorter):
        u32 minimum  u8 width  u16 exceptions
        the ids less the minimum, packed at ``width`` bits, first id in the lowest bits
        u8 place of each exception, u32 its difference to the minimum

The width is the smallest that holds ``percentile`` of a block's differences; wider ones are packed
as 0 and listed as exceptions. Null text is encoded as empty text; ``end_id`` closes each document.
Null ids come first, equal ids are ordered by text. Empty tables give a table without rows.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.session import scratch_path

from .common import thrifty
from .hashing import span_hashes

BLOCK = 256
SEGMENT_IDS = 1 << 18
#: Shards whose counts (16 bytes each) are broadcast; more of them are joined by shuffle.
MAX_SHARDS = 200_000
SEGMENTS = "shard int, segment int, before long, n_ids long, payload binary"
HEAD = struct.Struct("<4sIIQ")
BLOCK_HEAD = struct.Struct("<IBH")


# ---- blocks ----

def _bit_lengths(x: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(x.astype(np.float64) + 1)).astype(np.uint8)


def pack(ids: np.ndarray, percentile: float = 0.9) -> tuple[np.ndarray, bytes]:
    """Byte offsets of the block starts and the end, and the blocks."""
    n, count = len(ids), -(-len(ids) // BLOCK)
    if not n:
        return np.zeros(1, np.uint32), b""
    grid = np.empty(count * BLOCK, np.uint32)
    grid[:n] = ids
    grid[n:] = ids[-1]
    grid = grid.reshape(count, BLOCK)
    low = grid.min(axis=1)
    rest = grid - low[:, None]
    bits = _bit_lengths(rest)
    width = np.sort(bits, axis=1)[:, int(np.ceil(percentile * BLOCK)) - 1]
    over = bits > width[:, None]
    over.reshape(-1)[n:] = False
    body: list[bytes] = [b""] * count
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        low_bits = np.where(over[at], np.uint32(0), rest[at])
        spread = ((low_bits[:, :, None] >> np.arange(w, dtype=np.uint32)) & 1).astype(np.uint8)
        packed = np.packbits(spread.reshape(len(at), BLOCK * w), axis=1, bitorder="little")
        for k, row in zip(at.tolist(), packed):
            body[k] = row.tobytes()
    if n % BLOCK:
        body[-1] = body[-1][:-(-(n % BLOCK) * int(width[-1]) // 8)]
    parts, starts, end = [], np.zeros(count + 1, np.uint32), 0
    exceptions = over.sum(axis=1)
    for k in range(count):
        extra = b""
        if exceptions[k]:
            places = np.flatnonzero(over[k])
            extra = places.astype(np.uint8).tobytes() + rest[k, places].astype("<u4").tobytes()
        parts.append(BLOCK_HEAD.pack(low[k], width[k], exceptions[k]) + body[k] + extra)
        end += len(parts[-1])
        starts[k + 1] = end
    return starts, b"".join(parts)


def unpack(starts: np.ndarray, data: bytes, n: int, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids of the blocks first..last-1 (all by default) of ``n`` ids."""
    last = len(starts) - 1 if last is None else last
    heads = [BLOCK_HEAD.unpack_from(data, int(starts[k])) for k in range(first, last)]
    out = np.zeros((max(last - first, 0), BLOCK), np.uint32)
    by_width: dict[int, list[int]] = {}
    for k, (_, width, _) in enumerate(heads):
        by_width.setdefault(width, []).append(k)
    for width, own in by_width.items():
        if not width:
            continue
        whole = np.zeros((len(own), BLOCK * width // 8), np.uint8)
        for row, k in enumerate(own):
            size = min(BLOCK, n - (first + k) * BLOCK)
            length = -(-size * width // 8)
            whole[row, :length] = np.frombuffer(data, np.uint8, length, int(starts[first + k]) + BLOCK_HEAD.size)
        spread = np.unpackbits(whole, axis=1, bitorder="little").reshape(len(own), BLOCK, width)
        value = np.zeros((len(own), BLOCK), np.uint32)
        for bit in range(width):
            value |= spread[:, :, bit].astype(np.uint32) << np.uint32(bit)
        out[own] = value
    for k, (low, width, exceptions) in enumerate(heads):
        if exceptions:
            end = int(starts[first + k + 1])
            places = np.frombuffer(data, np.uint8, exceptions, end - 5 * exceptions)
            out[k, places] = np.frombuffer(data, "<u4", exceptions, end - 4 * exceptions)
        out[k] += np.uint32(low)
    return out.reshape(-1)[:n - first * BLOCK]


def pack_segment(doc_ids: list[int | None], ids: list[np.ndarray], percentile: float = 0.9) -> bytes:
    joined = np.concatenate(ids) if ids else np.empty(0, np.uint32)
    starts, blocks = pack(joined, percentile)
    return b"".join((
        HEAD.pack(b"PFR1", len(doc_ids), len(starts) - 1, len(joined)),
        np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
        np.array([x is not None for x in doc_ids], np.uint8).tobytes(),
        np.array([len(x) for x in ids], "<u4").tobytes(), starts.astype("<u4").tobytes(), blocks))


def unpack_segment(payload: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, ids per document, all ids."""
    magic, docs, blocks, n = HEAD.unpack_from(payload)
    if magic != b"PFR1":
        raise ValueError("not a segment")
    at = HEAD.size
    numbers = np.frombuffer(payload, "<i8", docs, at).tolist()
    present = np.frombuffer(payload, np.uint8, docs, at + 8 * docs).tolist()
    lengths = np.frombuffer(payload, "<u4", docs, at + 9 * docs)
    at += 13 * docs
    starts = np.frombuffer(payload, "<u4", blocks + 1, at)
    ids = unpack(starts, payload[at + 4 * (blocks + 1):], n)
    return [x if p else None for x, p in zip(numbers, present)], lengths, ids


# ---- encoding ----

_LETTER, _MARK, _SPACE = (np.zeros(256, bool) for _ in range(3))
_LETTER[97:123] = True
_MARK[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes that are cut into words at once; a longer text is cut alone.
_BYTES = 4_000_000
#: Characters beyond U+017F could combine with a letter whose case was changed.
_FAR = re.compile(rb"[\xc6-\xff]|<\|")
#: Parts words that are encoded together.
_SIGN = "|"
_PROBES = ["Ab cd\tEF", "don't, Été! 12a", "x.\n\ny", "word*** a|b"]


class WordEncoder:
    """Ids of whole texts as little-endian u32 bytes, by a file of the tokenizers library.

    If the tokenizer drops white space and joins nothing across it, a text's ids are its words'
    ids, so each word is encoded once and kept; if it also ignores case and parts letters from
    punctuation, words are kept in lower case and without the punctuation behind them. Probe texts
    decide whether each holds; otherwise whole texts are encoded. Words are kept in two bounded
    tables: when one is full it becomes the older one, from which words that still occur come back.
    New words are encoded many at a time, parted by a sign whose id tells them apart.
    """

    def __init__(self, path: str, kept: int = 300_000) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kept, self.known, self.older = kept, {}, {}
        plain = [self._ids(x) for x in _PROBES]
        words = [b"".join(self._ids(w.decode()) for w in x.encode().split()) for x in _PROBES]
        self.by_word = plain == words
        self.by_part = self.by_word and self._ids("Thing,***") == self._ids("thing") + self._ids(",***")
        sign = self._ids(_SIGN)
        self.sign = int.from_bytes(sign, "little") if len(sign) == 4 and self._ids(f"ab {_SIGN} cd") == (
            self._ids("ab") + sign + self._ids("cd")) else None

    def _ids(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _batch(self, texts: list[str]) -> list[bytes]:
        """Ids of many texts; few at a time, as the library's results are large."""
        return [array("I", x.ids).tobytes() for at in range(0, len(texts), 1000)
                for x in self.tokenizer.encode_batch_fast(texts[at:at + 1000], add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words; a line of words with a second sign of its own is encoded word by word."""
        if not self.by_word or self.sign is None:
            return self._batch(words)
        lines = [words[at:at + 256] for at in range(0, len(words), 256)]
        out: list[bytes] = []
        for line, ids in zip(lines, self._batch([f" {_SIGN} ".join(line) for line in lines])):
            cuts = (np.flatnonzero(np.frombuffer(ids, "<u4") == self.sign) * 4).tolist()
            if len(cuts) == len(line) - 1:
                out += [ids[a:b] for a, b in zip([0, *(c + 4 for c in cuts)], [*cuts, len(ids)])]
            else:
                out += self._batch(line)
        return out

    def _cut(self, raws: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
        """All texts joined, their words' starts and ends in it, and each word's text.

        In texts that ignore case, letters and the punctuation behind them are two words.
        """
        plain = np.array([self.by_part and not _FAR.search(raw) for raw in raws], bool)
        joined = b" ".join(raw.lower() if p else raw for raw, p in zip(raws, plain))
        data = np.frombuffer(joined, np.uint8)
        edge = np.flatnonzero(np.diff(np.concatenate(([True], _SPACE[data], [True])).astype(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        text = np.searchsorted(np.cumsum([len(raw) + 1 for raw in raws]), starts, side="right")
        letter, mark = _LETTER[data], _MARK[data]
        back = np.concatenate(([0], np.cumsum(letter[1:] & mark[:-1]), [0]))  # letters behind punctuation
        letters, marks = (np.concatenate(([0], np.cumsum(x))) for x in (letter, mark))
        n = letters[ends] - letters[starts]
        two = plain[text] & (n > 0) & (n < ends - starts) & (n + marks[ends] - marks[starts] == ends - starts)
        two &= back[ends - 1] == back[starts]
        parts = np.repeat(np.arange(len(starts)), 1 + two)
        second = np.concatenate(([False], parts[1:] == parts[:-1])) if len(parts) else np.zeros(0, bool)
        middle = (starts + n)[parts]
        return (joined, np.where(second, middle, starts[parts]), np.where(two[parts] & ~second, middle, ends[parts]),
                text[parts])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; equal words of some 4 MB of text are looked up once, told apart by 64-bit hashes."""
        if not self.by_word:
            return [np.frombuffer(x, "<u4") for x in self._batch(texts)]
        out: list[np.ndarray] = []
        group: list[bytes] = []
        size = 0
        for raw in (x.encode("utf-8", "replace") for x in texts):
            if group and size + len(raw) > _BYTES:
                out += self._encoded(group)
                group, size = [], 0
            group.append(raw)
            size += len(raw)
        return out + self._encoded(group) if group else out

    def _encoded(self, raws: list[bytes]) -> list[np.ndarray]:
        joined, starts, ends, text = self._cut(raws)
        if not len(starts):
            return [np.empty(0, "<u4") for _ in raws]
        hashes = span_hashes(np.frombuffer(joined, np.uint8), starts, ends)
        _, first, of = np.unique(hashes, return_index=True, return_inverse=True)
        words = [joined[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        if len(self.known) > self.kept:
            self.older, self.known = self.known, {}
        known = self.known
        ids = list(map(known.get, words))
        missing = [w for w, own in zip(words, ids) if own is None]
        if missing:
            again = self.older.keys() & set(missing)
            known.update((w, self.older[w]) for w in again)
            new = [w for w in missing if w not in again]
            known.update(zip(new, self._words([x.decode("utf-8", "replace") for x in new])))
            ids = list(map(known.__getitem__, words))
        flat = np.frombuffer(b"".join(ids), "<u4")
        length = np.array(list(map(len, ids)), np.int64) // 4
        at = (np.cumsum(length) - length)[of]
        length = length[of]
        stops = np.cumsum(length)
        whole = flat[np.repeat(at - (stops - length), length) + np.arange(stops[-1])]
        cuts = np.concatenate(([0], stops))[np.searchsorted(text, np.arange(1, len(raws)))]
        return np.split(whole, cuts)


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def write_tokens(docs: DataFrame, tokenizer: str, path: str, *, end_id: int = 1, percentile: float = 0.9,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text and write segments at ``path`` in ascending id order.

    ``tokenizer`` is a tokenizer file that every executor can open.
    """

    @thrifty
    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode = encoder(tokenizer).encode
        shard, segment, end = TaskContext.get().partitionId(), 0, np.array([end_id], "<u4")
        numbers: list[int | None] = []
        held: list[np.ndarray] = []
        size = before = 0
        for frame in frames:
            for at in range(0, len(frame), 1024):
                part = frame.iloc[at:at + 1024]
                ids = encode(part["text"].tolist())
                for number, missing, own in zip(part["doc_id"].tolist(), part["no_id"].tolist(), ids):
                    numbers.append(None if missing else number)
                    held.append(np.append(own, end))
                    size += len(held[-1])
                    if size >= SEGMENT_IDS:
                        yield pd.DataFrame({"shard": [shard], "segment": [segment], "before": [before], "n_ids": [size],
                                            "payload": [pack_segment(numbers, held, percentile)]})
                        numbers, held, size, segment, before = [], [], 0, segment + 1, before + size
        if numbers:
            yield pd.DataFrame({"shard": [shard], "segment": [segment], "before": [before], "n_ids": [size],
                                "payload": [pack_segment(numbers, held, percentile)]})

    ordered = docs.select(F.col(id_col).cast("long").alias("__id"),
                          F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn(
        "__text", F.xxhash64("text")).sort(F.col("__id").asc_nulls_first(), "__text")
    (ordered.select(F.coalesce("__id", F.lit(0)).alias("doc_id"), F.col("__id").isNull().alias("no_id"), "text")
     .mapInPandas(write, SEGMENTS)
     .write.option("compression", "none").parquet(path))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of a written table; ``start`` counts the ids of all documents before."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for first, payload in zip(frame["first"], frame["payload"]):
                numbers, lengths, ids = unpack_segment(payload)
                ends = np.cumsum(lengths, dtype=np.int64)
                for at in range(0, len(numbers), 512):
                    own = slice(at, at + 512)
                    yield pd.DataFrame({
                        "doc_id": pd.array(numbers[own], "Int64"), "start": first + ends[own] - lengths[own],
                        "n_tokens": lengths[own].astype(np.int64),
                        "ids": [ids[e - n:e].tobytes() for e, n in zip(ends[own].tolist(), lengths[own].tolist())]})

    return _placed(spark, path).mapInPandas(read, "doc_id long, start long, n_tokens long, ids binary")


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """Segments with the position of their first id.

    A segment knows the ids before it in its shard. The shards' counts, one row per task that wrote,
    are added up and sent to every reader, so payloads stay where they are.
    """
    segments = spark.read.schema(SEGMENTS).parquet(path)
    shards = segments.groupBy("shard").agg(F.sum("n_ids").alias("__n")).withColumn(
        "__before", F.coalesce(F.sum("__n").over(
            Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    if shards.count() <= MAX_SHARDS:
        shards = F.broadcast(shards)
    return segments.join(shards, "shard").select((F.col("__before") + F.col("before")).alias("first"), "payload")


def document_checks(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the written table, without shipping the ids."""

    @thrifty
    def check(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for first, payload in zip(frame["first"], frame["payload"]):
                numbers, lengths, ids = unpack_segment(payload)
                ends = np.cumsum(lengths, dtype=np.int64)
                data = memoryview(ids.astype("<u4").tobytes())
                yield pd.DataFrame({
                    "doc_id": pd.array(numbers, "Int64"), "start": first + ends - lengths,
                    "n_tokens": lengths.astype(np.int64),
                    "ids_crc32": [zlib.crc32(data[4 * (e - n):4 * e])
                                  for e, n in zip(ends.tolist(), lengths.tolist())]})

    return _placed(spark, path).mapInPandas(check, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op1_token_blocks(spark, sf_dir: str) -> DataFrame:
    """Start, number and checksum of each document's ids, read back from the written segments."""
    import public_tokenizers

    path = scratch_path(spark, "tokens")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    write_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), path)
    return document_checks(spark, path)
