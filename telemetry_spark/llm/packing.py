"""Packing: documents in the order of a Hilbert curve through hashed document vectors, cut into full sequences.

Method. Every document gets a vector of hashed byte trigrams, projected to a few dimensions. The cell it falls into has a
position on a Hilbert curve, so documents alike in language and content are close in that order. Spark range-sorts
documents by (curve key, id hash); each task then tokenises its range once, in order, and fills sequences one after the other.
A sequence at a power of two needs no padding, so the last, incomplete run of a range is cut into powers of two, at most
``log2(length)`` of them: no sequence is padded at all, wherever Spark puts the borders between ranges.

Defined results: a null text counts as empty and gives the end mark alone; equal texts follow each other in the order of a
hash of their ids, so a group of copies spreads over several ranges; rows that repeat an id are packed each by itself;
no rows give no pieces; columns other than id and text are not read.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType

LENGTH = 2048
END = 1
DIMENSIONS, BITS = 4, 12
BUCKETS = 256
PIECE_SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
)


def projection() -> np.ndarray:
    """Signs that take a bucket of hashed trigrams to the few dimensions of the curve."""
    return np.random.default_rng(17).choice([-1.0, 1.0], (BUCKETS, DIMENSIONS))


def trigram_counts(data: np.ndarray) -> np.ndarray:
    """How often each bucket of hashed byte trigrams occurs in a whole text."""
    if len(data) < 3:
        data = np.concatenate([data, np.zeros(3 - len(data), np.uint8)])
    wide = data.astype(np.uint32)
    mixed = wide[:-2] * np.uint32(0x9E3779B1) + wide[1:-1] * np.uint32(0x85EBCA6B) + wide[2:] * np.uint32(0xC2B2AE35)
    return np.bincount(mixed >> np.uint32(24), minlength=BUCKETS)


def cells(counts: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Coordinates of the cell a vector falls into: its direction, not its length, decides."""
    flat = counts - counts.mean(axis=1, keepdims=True)
    norm = np.linalg.norm(flat, axis=1, keepdims=True)
    point = (flat / np.where(norm == 0, 1, norm)) @ signs
    return np.clip((point + 4) / 8 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Positions on the Hilbert curve through a grid of ``2**bits`` cells a side (Skilling's transpose form)."""
    x = [points[:, i].copy() for i in range(points.shape[1])]
    q = 1 << (bits - 1)
    while q > 1:
        for axis in x:
            odd = (axis & q) != 0
            swap = np.where(odd, 0, (x[0] ^ axis) & (q - 1))
            x[0] ^= np.where(odd, q - 1, swap)
            if axis is not x[0]:
                axis ^= swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << 1) | (((axis ^ turn) >> bit) & 1)
    return key


@arrow_udf(LongType())
def curve_key(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The curve position of each text."""
    signs = projection()
    for texts in batches:
        counts = [trigram_counts(np.frombuffer(x or b"", np.uint8)) for x in texts.cast("binary").to_pylist()]
        yield pa.array(hilbert_keys(cells(np.stack(counts), signs)) if counts else [], pa.int64())


class Encoder:
    """Token ids as the ``tokenizers`` library gives them for a vocabulary file.

    ``tiktoken`` has the same vocabulary as ranks and is several times as fast. The two libraries may see the character
    classes of rare scripts differently, and only one knows special tokens by their text: texts with either go through
    ``tokenizers`` itself.
    """

    PLAIN = regex.compile(r"[\x00-ſ‐-‧‰-›€]*")

    def __init__(self, vocabulary: str, ranks: str | None):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks:
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        plain = self.fast is not None and self.PLAIN.fullmatch(text) and not any(s in text for s in self.special)
        found = self.fast.encode_ordinary(text) if plain else self.slow.encode(text, add_special_tokens=False).ids
        return np.array(found + [END], np.uint32)


def packed(documents: Iterator[tuple[int, np.ndarray]], length: int) -> Iterator[tuple]:
    """Pieces (id, start, ids, document's ids, sequence, offset) of documents laid end to end; sequences count from 0."""
    waiting, filled, sequence = [], 0, 0
    for key, ids in documents:
        start = 0
        while start < len(ids):
            take = min(length - filled, len(ids) - start)
            waiting.append((key, start, ids[start : start + take], len(ids), sequence, filled))
            start, filled = start + take, filled + take
            if filled == length:
                yield from waiting
                waiting, filled, sequence = [], 0, sequence + 1
    room = 0
    for key, start, ids, total, _, _ in waiting:  # what is left goes into sequences of a power of two
        while len(ids):
            if not room:
                size = room = 1 << (filled.bit_length() - 1)
            take = min(room, len(ids))
            yield key, start, ids[:take], total, sequence, size - room
            start, ids, room, filled = start + take, ids[take:], room - take, filled - take
            sequence += not room


def pack(
    docs: DataFrame, vocabulary: str, ranks: str | None = None, length: int = LENGTH, with_ids: bool = True,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece. ``length`` is a power of two; ``ids`` are the piece's tokens, left out on request.

    ``sequence_id`` is the number of the range in its upper half and the place in it in its lower half.
    """
    if length & (length - 1):
        raise ValueError("a sequence's length has to be a power of two")
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        rows.withColumn("curve", curve_key("text")).withColumn("tie", F.xxhash64("doc_id"))
        .repartitionByRange(ranges, "curve", "tie").sortWithinPartitions("curve", "tie", "doc_id", F.xxhash64("text"))
        .select("doc_id", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, base = Encoder(vocabulary, ranks), TaskContext.get().partitionId() << 32
        documents = (
            (key, encoder.ids(text or ""))
            for batch in batches
            for key, text in zip(batch.column(0).to_pylist(), (x.as_py() for x in batch.column(1)), strict=True)
        )
        rows, held = [], 0
        for key, start, ids, total, sequence, offset in packed(documents, length):
            crc = zlib.crc32(ids.astype("<u4").tobytes())
            rows.append((key, start, len(ids), crc, total, base + sequence, offset) + ((ids.astype(np.int32),) if with_ids else ()))
            held += len(ids) if with_ids else 1
            if held >= 1 << 17:
                yield as_batch(rows)
                rows, held = [], 0
        if rows:
            yield as_batch(rows)

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        arrays = [pa.array(c, pa.int64()) for c in columns[:7]]
        names = [f.split()[0] for f in PIECE_SCHEMA.split(", ")]
        if with_ids:
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in columns[7]])])
            arrays.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(columns[7]), pa.int32())))
        return pa.RecordBatch.from_arrays(arrays, names + ["ids"] * with_ids)

    return ordered.mapInArrow(run, PIECE_SCHEMA + ", ids array<int>" * with_ids)
