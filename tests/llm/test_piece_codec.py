import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from telemetry_spark.llm import piece_codec, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def known():
    return piece_codec.Vocabulary(PATH)


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


TEXTS = [
    "", " ", "  ", "a", "hello world", "  two  spaces   and more    ", "\n\t\r\n x", "▁▁ marks ▁a", "<s> </s> <unk> <0x41>", "日本語の文章です", "ไม่มีช่องว่าง",
    "\U0001f600\U0001f468‍\U0001f469‍\U0001f467", "é", "\x00\x01 nul", "١٢٣ 12345 3.14", "� ﬁ Å", "x" * 5000, " " * 3000 + "end", "ab" * 20000, "Zug über 12 " * 500,
]


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
def test_ids_and_decoding_are_the_librarys(known, library, text):
    encoder = piece_codec.Encoder(known)
    found = encoder.ids(text)
    ids = found.tolist()
    assert ids == library.encode(text) and known.decode(found) == library.decode(ids)
    assert not text or known.merged(known.prefix + text.replace(" ", "▁")) == ids  # one agenda for the whole text


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" ▁\nabcdeinth")), max_size=60))
def test_any_text(text):
    known = test_any_text.__dict__.setdefault("known", piece_codec.Vocabulary(PATH))
    ids = piece_codec.Encoder(known).ids(text)
    assert ids.tolist() == known.library.encode(text) and known.decode(ids) == known.library.decode(ids.tolist())


def test_decoding_of_any_ids(known, library):
    """Ids that no text encodes to: broken bytes, control and unknown pieces anywhere."""
    rng = random.Random(9)
    for _ in range(400):
        ids = [rng.choice([0, 1, 2, rng.randrange(3, 259), rng.randrange(259, 32000), 29871]) for _ in range(rng.randrange(12))]
        assert known.decode(known.inside(ids)) == library.decode(ids)
    assert known.decode(known.inside([None, -1, 32000])) == library.decode([0, 0, 0])


def test_the_memory_of_cuts_is_bounded(known, library):
    encoder = piece_codec.Encoder(known, limit=60)
    for start in range(0, 500, 20):
        text = " ".join(f"word{i} again" for i in range(start, start + 30))
        assert encoder.ids(text).tolist() == library.encode(text) and len(encoder.known) <= 60 and len(encoder.before) <= 60


def test_only_cuts_that_are_not_remembered_are_learned(known, library):
    encoder, asked = piece_codec.Encoder(known), []
    learn = encoder.learn
    encoder.learn = lambda cuts: asked.append(set(cuts)) or learn(cuts)
    texts = ["one two two three", "three  four one " + "long" * 20, "long" * 20 + " four"]
    for text in texts:
        assert encoder.ids(text).tolist() == library.encode(text)
    assert asked == [{"one", "two", "three"}, {"▁four", "long" * 20}, {"long" * 20, "four"}]
    assert [i.tolist() for i in piece_codec.Encoder(known, limit=2).of_all(texts)] == library.encode(texts)


def test_long_texts_take_time_in_proportion(known):
    import time

    def seconds(n):
        text, started = "".join(chr(97 + i * i % 26) for i in range(n)), time.perf_counter()
        piece_codec.Encoder(known).ids(text)
        return time.perf_counter() - started

    seconds(20_000)
    assert seconds(200_000) < 25 * seconds(20_000)


def test_odd_rows(spark, odd_documents, library):
    rows = piece_codec.coded(odd_documents, PATH).collect()
    assert len(rows) == odd_documents.count() and all(r.coded.agrees for r in rows)
    for r in rows:
        assert list(r.coded.ids) == library.encode(r.text or "") and r.coded.decoded == (r.text or "")
    assert piece_codec.coded(odd_documents.limit(0), PATH).count() == 0
    ids = spark.createDataFrame([([1, *library.encode("Hello there"), 2],), (None,), ([],), ([None, 40000],)], "ids array<int>")
    assert [r.text for r in piece_codec.decoded(ids, PATH).collect()] == ["Hello there", None, "", " ⁇  ⁇ "]


def test_bytes_that_are_no_utf8(spark):
    rows = spark.sql("select cast(unhex(h) as string) as text from values ('61FF62'), ('E4B8'), ('C0AF'), ('EDA080') as t(h)")
    assert all(r.coded.agrees for r in piece_codec.coded(rows, PATH).collect())


def test_other_vocabularies_are_refused(tmp_path):
    from sentencepiece.sentencepiece_model_pb2 import ModelProto

    proto = ModelProto()
    with open(PATH, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = proto.trainer_spec.UNIGRAM
    (tmp_path / "other.model").write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError, match="merge-type"):
        piece_codec.Vocabulary(str(tmp_path / "other.model"))


def test_a_vocabulary_with_marks_inside_is_not_cut(tmp_path):
    """A piece over a space: texts are then merged as a whole, as the library does."""
    from sentencepiece.sentencepiece_model_pb2 import ModelProto

    proto = ModelProto()
    with open(PATH, "rb") as file:
        proto.ParseFromString(file.read())
    for text, score in (("e▁", -0.5), ("e▁t", -0.25)):
        proto.pieces.add(piece=text, score=score)
    (tmp_path / "wide.model").write_bytes(proto.SerializeToString())
    known = piece_codec.Vocabulary(str(tmp_path / "wide.model"))
    assert not known.cut
    text = "the tree was there to take the time"
    assert piece_codec.Encoder(known).ids(text).tolist() == known.library.encode(text)


def test_the_query_agrees_with_the_library(spark, sf):
    rows = queries.op13_sentencepiece(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count() and all(r.agrees for r in rows)


def test_a_workers_tasks_share_an_encoder():
    path = public_tokenizers.path("piece_bpe_32k.model")
    assert piece_codec.shared_encoder(path) is piece_codec.shared_encoder(path)
