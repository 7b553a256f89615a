import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from telemetry_spark.llm import packing

VOCABULARY, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def check_round_trip(pieces, docs, length):
    slow = Tokenizer.from_file(VOCABULARY)
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
        assert p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes()) and p.length == len(p.ids)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= length and at & (at - 1) == 0  # full, or a power of two: nothing is padded
    want = {}
    for key, text in docs:
        ids = slow.encode(text or "", add_special_tokens=False).ids + [1]
        want.setdefault((key, len(ids)), []).extend(ids)
    got = {k: [i for p in sorted(v, key=lambda p: p.start) for i in p.ids] for k, v in by_doc.items()}
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    for k, ids in want.items():
        if len(ids) == k[1]:
            assert got[k] == ids


def test_round_trip(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    pieces = packing.pack(docs, VOCABULARY, RANKS).collect()
    check_round_trip(pieces, [tuple(r) for r in docs.select("doc_id", "text").collect()], 2048)


def test_odd_rows(spark, odd_documents):
    docs = odd_documents.union(odd_documents.limit(1).withColumns({"doc_id": F.lit(9), "text": F.lit("a<|endoftext|>b 中文 हि")}))
    pieces = packing.pack(docs, VOCABULARY, RANKS, length=64).collect()
    check_round_trip(pieces, [tuple(r) for r in docs.select("doc_id", "text").collect()], 64)
    assert packing.pack(docs.limit(0), VOCABULARY, RANKS).count() == 0


def test_fast_ids_are_the_same():
    encoder, slow = packing.Encoder(VOCABULARY, RANKS), Tokenizer.from_file(VOCABULARY)
    plain = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000 and encoder.PLAIN.fullmatch(chr(c))]
    texts = [f"a{x}b {x}{x} 1{x}2\n{x} {x}'s" for x in plain]
    for text, want in zip(texts, slow.encode_batch(texts, add_special_tokens=False), strict=True):
        assert encoder.ids(text).tolist() == want.ids + [1], repr(text)


def test_hilbert_neighbours_touch():
    side = 8
    grid = np.array([(x, y, z) for x in range(side) for y in range(side) for z in range(side)], np.int64)
    keys = packing.hilbert_keys(grid.copy(), 3)
    assert sorted(keys) == list(range(side**3))
    path = grid[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()
